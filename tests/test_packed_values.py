import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.operators.packed_values import split_packed, split_values

NAMES = [
    ("Ada B. Cole; T. Dorn", ["Ada B. Cole", "T. Dorn"]), ("Cole, A., Dorn, T., Esk, A.C.", ["Cole, A.", "Dorn, T.", "Esk, A.C."]),
    ('"Cole, Ada", "Dr. Tom Dorn", "Esk, B."', ["Cole, Ada", "Dr. Tom Dorn", "Esk, B."]), ('"Q. ""Kit"" Cole", "Dorn, V."', ['Q. "Kit" Cole', "Dorn, V."]),
    ("A. Cole and T. Dorn and L. Esk", ["A. Cole", "T. Dorn", "L. Esk"]), ("Cole, Ada K. and Dorn, Petra", ["Cole, Ada K.", "Dorn, Petra"]),
    ("J. D. Cole, E. Dorn & Y. ESK", ["J. D. Cole", "E. Dorn", "Y. ESK"]), ("O. Cole, Rob Dorn, and North Posture Group", ["O. Cole", "Rob Dorn", "North Posture Group"]),
    ("Cole A;; Dorn B | Esk C\nFay D\tGil E • Hob F · Ida G; ", ["Cole A", "Dorn B", "Esk C", "Fay D", "Gil E", "Hob F", "Ida G"]),
    ('["Cole, Ada F.", "Dorn, Rosa N."]', ["Cole, Ada F.", "Dorn, Rosa N."]), ("Prof. Ada Cole, PhD, Tom Dorn", ["Prof. Ada Cole, PhD", "Tom Dorn"]), ("Cole, Ada", ["Cole, Ada"]),
]
TERMS = [
    ("stroke, chronic;; R&D in care; gait | balance", ["stroke, chronic", "R&D in care", "gait", "balance"]), ('gait, pain, "Models, statistical"', ["gait", "pain", "Models, statistical"]),
    ('"Stroke, chronic"', ["Stroke, chronic"]), ("units (IMU; x), a, b", ["units (IMU; x)", "a", "b"]), ('"a";"b";"a"', ["a", "b", "a"]), ("posture and balance", ["posture and balance"]),
    ('"say \\"hi\\"", b', ['say "hi"', "b"]), ('"open, x', ['"open', "x"]), ("a) b; c", ["a) b", "c"]), (";; , ", []), ("", []), (None, []), ("  ", []),
]


@pytest.mark.parametrize("text, items", NAMES)
def test_names(text, items):
    assert split_packed(text, True) == items


@pytest.mark.parametrize("text, items", TERMS)
def test_terms(text, items):
    assert split_packed(text) == items


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='abc ,;|"\\()[]\n', min_size=1, max_size=12).map(str.strip).filter(bool), min_size=1, max_size=6))
def test_quoted_values_round_trip(values):
    text = ";".join('"' + v.replace("\\", "\\\\").replace('"', '""') + '"' for v in values)
    assert split_packed(text) == [v for v in values]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='ab ,;|"\\()[]\n', max_size=60))
def test_never_fails_and_gives_no_blank(text):
    for names in (True, False):
        assert all(v == v.strip() and v for v in split_packed(text, names))


def test_linear_on_long_fields():
    assert len(split_packed("a;" * 200_000)) == 200_000
    assert len(split_packed('x "y ' * 100_000 + ";z")) == 2
    assert len(split_packed("(" * 100_000 + ";z")) == 2


def test_frame(spark):
    rows = [(1, "b; a; b", "Cole, A.; Dorn, B.", "x"), (2, None, "", "x"), (3, "one", None, "x"), (1, "b; a; b", None, "x")]
    df = spark.createDataFrame(rows, "hit_id long, keywords string, authors string, item string")
    got = sorted((r.hit_id, r.field, r.pos, r.item) for r in split_values(df, ["hit_id"], {"authors": True, "keywords": False}).collect())
    assert got == sorted(
        [(1, "authors", 1, "Cole, A."), (1, "authors", 2, "Dorn, B."), (3, "keywords", 1, "one")] + 2 * [(1, "keywords", 1, "b"), (1, "keywords", 2, "a"), (1, "keywords", 3, "b")]
    )
    assert split_values(df.limit(0), ["hit_id"], {"keywords": False}).count() == 0
    known = spark.createDataFrame([("pain, low back",), (None,)], "term string")
    one = spark.createDataFrame([(1, "Pain, low back"), (2, "pain, gait")], "hit_id long, keywords string")
    got = sorted((r.hit_id, r.item) for r in split_values(one, ["hit_id"], {"keywords": False}, known).collect())
    assert got == [(1, "Pain, low back"), (2, "gait"), (2, "pain")]
