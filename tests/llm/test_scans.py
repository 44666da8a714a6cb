from lexmill.llm import scans as S

WORDS = (
    "the model was trained on records of patients and the results of the study were reported by the authors in a journal "
    "post-surgical follow-up measures remained high while training improved the balance of older adults during treatment"
)
SCHEMA = "text_id long, paper_id string, title string, full_text string, clean_text string, clean_sections map<string,string>, word_count int, line_no int"


def papers(spark):
    plain = "\n".join([WORDS] * 30)
    scanned = (
        "Introduction\nThe model was trai-\nned on records of pati\u00ad\nJournal of Tests | 12\nents and the resu1ts of the post-\nsurgical study.\n[13]\n\n"
        "Journal of Tests | 13\nOlder aclults during t r e a t m e n t remained high."
    )
    rows = [(i, f"p_{i}", "Some title", plain, None, None, 1, 1) for i in range(3)]
    rows += [
        (10, "p_10", "Some title", scanned, scanned.replace("\n", " "), {"results": "The stu-\ndy was high.\n- 4 -", "empty": ""}, 1, 1),
        (11, "p_11", None, None, "  ", None, None, None), (12, "p_12", None, "", None, {}, 0, 0),
        (13, "p_13", "T", "the model " * 60_000, None, None, 0, 0),
    ]
    venues = spark.createDataFrame([("Journal of Tests", "J. Tests")], "venue string, short_name string")
    return spark.createDataFrame(rows, SCHEMA), venues


def test_faults(spark):
    df, venues = papers(spark)
    got = {(r.text_id, r.field, r.line_no, r.kind) for r in S.faults(df, venues).collect()}
    mine = {x[1:] for x in got if x[0] == 10}
    assert {x for x in mine if x[0] == "full_text"} == {
        ("full_text", 2, "hyphen"), ("full_text", 3, "hyphen"), ("full_text", 4, "header"), ("full_text", 5, "misread"),
        ("full_text", 7, "page_number"), ("full_text", 9, "header"), ("full_text", 10, "misread"),
    }
    assert {x for x in mine if x[0] == "clean_text"} == {("clean_text", 1, k) for k in ("header", "hyphen", "misread", "page_number")}
    assert {x for x in mine if "sections" in x[0]} == {("clean_sections.results", 1, "hyphen"), ("clean_sections.results", 3, "page_number")}
    assert {x[0] for x in got} == {10}


def test_repair(spark):
    df, venues = papers(spark)
    text = {r.text_id: r.text for r in S.repaired(df, venues).collect()}
    assert "model was trained on records of patients and the results of the post-surgical study." in text[10]
    assert "Older adults during treatment remained high." in text[10]
    assert "Journal of Tests" not in text[10] and "[13]" not in text[10]
    assert text[11] == text[12] == "" and len(text) == 7


def test_empty(spark):
    df, venues = papers(spark)
    assert S.faults(df.limit(0), venues).count() == 0


def test_words_run_together():
    reader = S.Reader({w: 50 for w in WORDS.split()}, [])
    assert reader.split("modelwas") == "model was"
    assert reader.split("unknownish") == "unknownish"
    assert reader.decode(["the", "modei was"]).split()[0] == "the"


def test_joined_letters_are_misread():
    reader = S.Reader({"office": 60, "findings": 60}, [])
    assert reader.read("ofﬁce") == ("office", "misread") and reader.read("office") is None
    assert reader.join("ﬁnd-", "ings") == ("findings", "hyphen", True, False)


def test_skeletons_meet():
    for a, b in [("clinical", "c1inical"), ("modern", "rnodern"), ("thin", "thiri"), ("should", "sliould"), ("depth", "clepth"), ("issue", "i5sue")]:
        assert S.skeleton(a) == S.skeleton(b)
    assert S.skeleton("gait") != S.skeleton("gate")


def test_rare_real_words_stay():
    reader = S.Reader({"car": 100, "ear": 5, "corn": 4, "com": 90, "the": 9000, "thc": 40}, [])
    assert reader.read("ear") is None and reader.read("corn") is None
    assert reader.read("thc") == ("the", "misread") and reader.read("eorn")[0] == "com"


def test_the_path_joins_parts_and_reads_at_once():
    counts = {w: 80 for w in "methods of the clinical study were reported in two rooms by readers with some care".split()}
    reader = S.Reader(counts, [])
    assert reader.decode(["the meth ods were rep-", "orted bythe clinicalstudy"]) == "the methods were reported bythe clinical study"
    words, faults = reader.stream("the c1inical stu- dy wcre t h e care".split(), [1, 1, 1, 2, 2, 2, 2, 2, 2])
    assert words == ["the", "clinical", "study", "were", "the", "care"]
    assert faults == {(1, "misread"), (1, "hyphen"), (2, "misread")}


def test_the_path_is_the_cheapest_of_all():
    import math
    import random

    rng = random.Random(2)
    vocabulary = ["ab", "abc", "cd", "abcd", "dabc", "bcd", "da", "a", "b", "c", "d"]
    for _ in range(200):
        reader = S.Reader({w: rng.randint(3, 400) for w in rng.sample(vocabulary, 7)}, [])
        tokens = [rng.choice(vocabulary) for _ in range(6)]
        got = []
        for i in range(6):
            reader._joined(tokens, i, 6, lambda i, j, cost, text, kinds: got.append((i, j, cost)))
        alone = [(i, i + 1, min(reader.cost(t), reader.cost(t) - S.PARTING if reader.split(t) != t else math.inf)) for i, t in enumerate(tokens)]
        if any(reader.read(t) for t in tokens):
            continue
        edges = got + alone

        def cheapest(i):
            return 0.0 if i == 6 else min(c + cheapest(j) for a, j, c in edges if a == i)

        path = reader._cheapest(tokens, [1] * 6, 0, 6)
        assert "".join(t.replace(" ", "") for t, _ in path) == "".join(tokens)
        spent = 0.0
        at = 0
        for text, _ in path:
            size = next(j for j in range(at + 1, 7) if "".join(tokens[at:j]) == text.replace(" ", ""))
            spent += min(c for a, j, c in edges if a == at and j == size)
            at = size
        assert abs(spent - cheapest(0)) < 1e-9
