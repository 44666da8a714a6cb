import pytest

from lexmill.llm import quality as Q

COMMON = frozenset("the of and to in was were is by with that a for on be".split())
PROSE = "The study was carried out in two hospitals, and the results were better than those of the control group."
CASES = [
    (PROSE, "prose"), (PROSE.replace(" ", "\n", 3), "prose"), (PROSE + "\n- first\n- second\n" + PROSE, "prose"), ("Q: " + PROSE + "\nA: " + PROSE, "prose"),
    ("- gait\n- lumbar pain\n- walking speed\n- balance", "list"), ("1. one thing\n2) another thing\n3. a third", "list"),
    ("gait; lumbar pain; walking speed; sleep quality; grip strength", "list"), ("Introduction gait .......... 1\nMethods pain ............ 12\nResults sleep ..... 30", "list"),
    ('[1] A. Ab, "gait", J. Test, vol. 3, pp. 1-2, 2004.\n[2] B. Bc, "pain", J. Test, vol. 4, pp. 3-4, 2005.\n[3] C. Cd, "sleep", J. Test, vol. 5, pp. 5-6, 2006.', "list"),
    ("name\tmean\tsd\ngait\t1.2\t0.4\npain\t3.1\t0.9", "table"), ("| a | b |\n| gait | 1.0 |\n| pain | 2.0 |", "table"), ("gait,1.2,0.4\npain,3.1,0.9\nsleep,2.2,0.8", "table"),
    ("gait          1.2     0.4\npain speed    3.1     0.9\nsleep         2.2     0.8", "table"), ("0.1 0.2 0.3\n0.4 0.5 0.6\n0.7 0.8 0.9", "table"),
    ("Download PDF\n" * 9, "junk"), ("Accept all settings " * 20, "junk"), ("Download PDF " * 6, "junk"), ("<div><span id=x></span></div> " * 12, "junk"), ("#@!%^&*()_+={}[]|<>~" * 8, "junk"),
    ("A" * 50 + "b9/" + "Zx81+" * 60 + "==", "junk"), ("Home | Login | Share | Print | Contact\nAbout\nSitemap\nPrivacy", "junk"), ("vszclqqlfb bfvkddbkds dtdldfljxkt qrl fxf sdxrsfbj lwxkrtjd rt sct wrwtrlwq", "junk"),
    (None, None), ("", None), (" \n\t ", None),
]


@pytest.mark.parametrize("text, kind", CASES)
def test_kinds(text, kind):
    assert Q.describe(text, COMMON)[-1] == kind


def test_statistics():
    n, mean, symbols, stopped, share, *_ = Q.describe("The cat sat on the mat.\nNo stop here", COMMON)
    assert (n, stopped) == (9, 0.5)
    assert mean == pytest.approx(27 / 9, abs=1e-5) and share == pytest.approx(3 / 9, abs=1e-5) and symbols == pytest.approx(1 / 28, abs=1e-5)


def test_frame(spark):
    rows = [(i, t, "k", 1) for i, (t, _) in enumerate(CASES)] + [(900, PROSE * 5000, None, None), (901, "\r\n".join(["- gait", "- balance", "- sleep"]), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string, n_words int")
    words = spark.createDataFrame([("en", w) for w in COMMON] + [("en", None)], "lang string, word string")
    got = {r.doc_id: r.kind for r in Q.not_prose(df, "doc_id", "text", words).collect()}
    assert got == {i: k for i, (_, k) in enumerate(CASES) if k not in (None, "prose")} | {901: "list"}
    assert Q.statistics(df.limit(0), "doc_id", "text", words).count() == 0


def test_columns_are_places():
    cells = lambda line: Q._cells(line)["gap"]
    assert Q._columns("gap", cells("gait     1.2     0.4"), cells("pain     3.1     0.9"))
    assert Q._columns("gap", cells("gait        1.2     0.4"), cells("gait       11.2    10.4"))
    assert not Q._columns("gap", cells("a   b   c"), cells("a word      b         c and d"))
