import itertools
import random

from lexmill.llm import names as N


def distance_one(a, b):
    """Brute force: one insertion, deletion, substitution or exchange of neighbours."""
    if a == b:
        return False
    if len(a) == len(b):
        diff = [i for i in range(len(a)) if a[i] != b[i]]
        return len(diff) == 1 or (len(diff) == 2 and diff[1] == diff[0] + 1 and a[diff[0]] == b[diff[1]] and a[diff[1]] == b[diff[0]])
    s, t = sorted((a, b), key=len)
    return len(t) == len(s) + 1 and any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def test_automaton_equals_brute_force():
    rng = random.Random(1)
    words = list({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(400)})
    trie = N.Trie(words)
    for w in words[:150]:
        assert set(trie.near(w)) == {x for x in words if distance_one(w, x)}


def test_shards_find_all_neighbours(spark):
    rng = random.Random(2)
    words = list({"".join(rng.choice("abcd") for _ in range(8)) for _ in range(300)})
    words += [w[:3] + w[4:] for w in words[:60]] + [w[:4] + w[5] + w[4] + w[6:] for w in words[60:120]]
    words = sorted(set(words))
    got = {(r.family, r.near) for r in N.neighbours(spark.createDataFrame([(w,) for w in words], "family string")).collect()}
    assert got == {(a, b) for a, b in itertools.permutations(words, 2) if distance_one(a, b)}


def test_short_words_find_all_neighbours(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(2, 8))) for _ in range(500)} | {"khan", "kahn", "smith", "simth", "martin", "matrin", "lee", "le"})
    got = {(r.family, r.near) for r in N.neighbours(spark.createDataFrame([(w,) for w in words], "family string")).collect()}
    assert got == {(a, b) for a, b in itertools.permutations(words, 2) if distance_one(a, b)}


SAME = [
    ["Vandermeer, Alice K.", "Alice Vandermeer", "A. K. Vandermeer", "Vandermeer AK", "VANDERMEER, Alice", "Vandermeer Alice", "Dr. Alice Vandermeer, PhD", "Alice Vandemreer"],
    ["Robert Kowalczuk", "Bob Kowalczuk", "Kowalczuk, R.", 'Robert "Kit" Kowalczuk'],
    ["Thomas Kowalczuk", "Kowalczuk, T.", "Tom Kowalczuk"],
    ["Nordwind Gait Study Group", "The Nordwind Gait Study Grp", "Study Group Nordwind on Gait", "NORDWIND GAIT STUDY GROUP"],
    ["Peter Mueller-Test", "Mueller-Test, P."],
]


def test_spellings_of_people_and_groups(spark):
    # Given names become known from lists that write "Last, First".
    known = [f"{l}, {g}" for g in ("Alice", "Robert", "Thomas", "Peter") for l in ("Aaaabbb", "Bbbbccc", "Ccccddd", "Ddddeee")]
    lists = [[n] for group in SAME for n in group for _ in range(3)] + [[n] for n in known] + [["et al.", "", None], None, []]
    df = spark.createDataFrame([(i, a, "x") for i, a in enumerate(lists)], "rec_id long, authors array<string>, entity string")
    entity = {r.name: r.entity for r in N.link_names(df, "authors").collect()}
    for group in SAME:
        assert len({entity[n] for n in group}) == 1, [(n, entity[n]) for n in group]
    assert len({entity[g[0]] for g in SAME}) == len(SAME)
    assert "et al." not in entity and "" not in entity
    pairs = {(r.name_a, r.name_b) for r in N.name_pairs(df, "authors").collect()}
    assert all(a < b for a, b in pairs)
    assert {tuple(sorted(p)) for g in SAME for p in itertools.combinations(g, 2)} <= pairs


def test_empty(spark):
    df = spark.createDataFrame([], "authors array<string>")
    assert N.name_pairs(df, "authors").count() == 0


def test_ambiguous_initials_are_linked_to_nobody():
    rows = [("Jonas Low", "person", "jonas", "j"), ("Joseph Low", "person", "joseph", "j"), ("J. Low", "person", "", "j"), ("Low, J.", "person", "", "j")]
    got = dict(N.resolve(rows))
    assert got["Jonas Low"] != got["Joseph Low"] and got["J. Low"] == got["Low, J."]
    assert got["J. Low"] not in (got["Jonas Low"], got["Joseph Low"])


def test_a_familiar_form_is_the_name_its_family_is_seen_with(spark):
    families = ("Aaaabbb", "Bbbbccc", "Ccccddd", "Ddddeee")
    lists = [[f"{l}, {g}"] for g in ("Andrea", "Andrew", "Edward", "Theodore", "Jonathan", "Jonas") for l in families]
    lists += [["Andrew Kowalczuk"], ["Andy Kowalczuk"], ["Andrea Lindqvist"], ["Andy Lindqvist"], ["Ted Lindqvist"], ["Theodore Lindqvist"]]
    lists += [["Jon Kowalczuk"], ["Jonas Kowalczuk"], ["Jonathan Kowalczuk"], ["Ted Kowalczuk"], ["Kowalczuk"], ["Zzyxq"], ["Zzyxq, Andrew"]]
    df = spark.createDataFrame([(a,) for a in lists], "authors array<string>")
    entity = {r.name: r.entity for r in N.link_names(df, "authors").collect()}
    assert set(entity) == {n for a in lists for n in a}
    assert entity["Andy Kowalczuk"] == entity["Andrew Kowalczuk"] and entity["Andy Lindqvist"] == entity["Andrea Lindqvist"]
    assert entity["Ted Lindqvist"] == entity["Theodore Lindqvist"] and entity["Zzyxq"] == entity["Zzyxq, Andrew"]
    assert entity["Jon Kowalczuk"] not in (entity["Jonas Kowalczuk"], entity["Jonathan Kowalczuk"])
    assert entity["Kowalczuk"] not in {e for n, e in entity.items() if n != "Kowalczuk"}


def test_repeated_tables_are_read_alike(spark):
    lists = [[n] for group in SAME for n in group] + [[f"{l}, {g}"] for g in ("Alice", "Robert", "Peter") for l in ("Aaaabbb", "Bbbbccc", "Ccccddd")]
    df = spark.createDataFrame([(a,) for a in lists], "authors array<string>")
    many = df.crossJoin(spark.range(10)).select("authors")
    assert {tuple(r) for r in N.name_pairs(df, "authors").collect()} == {tuple(r) for r in N.name_pairs(many, "authors").collect()}
