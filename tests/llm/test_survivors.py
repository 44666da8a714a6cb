import datetime
import itertools

from lexmill.llm import survivors as S

SCHEMA = "rec_id long, paper_id string, abstract string, venue string, year int, authors array<string>, document_type string, retrieved_at timestamp, row string, rank string"
D = lambda d: datetime.datetime(2024, 1, d)


def frames(spark, rows):
    venues = spark.createDataFrame([("Journal of Tests", "J. Tests", "journal")], "venue string, short_name string, venue_category string")
    return spark.createDataFrame(rows, SCHEMA), venues


def test_best_values(spark):
    rows = [
        (1, "p", "No abstract available.", "J. Tests", 2010, ["A", "et al."], "article", D(1), "", ""),
        (2, "p", "A long and complete abstract of the work.", "Journal of Tests", 9999, ["A", "B"], "journal", D(5), "", ""),
        (3, "p", "A long and complete abst...", None, 2011, ["A", "B"], None, D(3), "", ""),
        (4, "p", None, "Unknown", 2010, [], "conference", D(2), "", ""),
        (5, "q", None, None, None, None, None, None, None, None),
    ]
    df, venues = frames(spark, rows)
    got = {(r.paper_id, r.field): (r.rec_id, r.n_values) for r in S.survivors(df, "paper_id", "rec_id", "retrieved_at", venues).collect()}
    assert got[("p", "abstract")] == (2, 4)
    assert got[("p", "venue")] == (2, 4)
    assert got[("p", "year")] == (3, 3)
    assert got[("p", "authors")] == (2, 3)
    assert all(got[("q", f)] == (5, 1) for f in S.FIELDS)
    one = {r.paper_id: r for r in S.golden(df, "paper_id", "rec_id", "retrieved_at", venues).collect()}
    assert one["p"].year == 2011 and one["p"].authors == ["A", "B"] and one["q"].venue is None


def test_empty(spark):
    df, venues = frames(spark, [])
    assert S.survivors(df, "paper_id", "rec_id", "retrieved_at", venues).count() == 0


def test_a_hot_group_leaves_few_candidates(spark):
    rows = [(i, "hot", f"text {i}", "Journal of Tests", 2000 + i % 20, ["A"], "journal", D(1 + i % 28), "", "") for i in range(3000)]
    df, venues = frames(spark, rows)
    best = S._best(S._candidates(df, "paper_id", "rec_id", "retrieved_at", venues), "paper_id")
    assert best.count() <= 10


def test_branch_and_bound_equals_brute_force():
    import random

    rng = random.Random(3)
    for _ in range(300):
        bundles = [[(round(rng.random(), 2), rng.choice("abc"), rng.randrange(99)) for _ in range(rng.randint(1, 4))] for _ in range(rng.randint(1, 4))]
        banned = {(i, a, j, b) for i in range(4) for j in range(i + 1, 4) for a in "abc" for b in "abc" if rng.random() < 0.3}
        excluded = lambda i, a, j, b: (i, a, j, b) in banned  # noqa: B023, E731
        legal = [
            sum(c[0] for c in pick)
            for pick in itertools.product(*bundles)
            if not any(excluded(i, pick[i][1], j, pick[j][1]) for i in range(len(pick)) for j in range(i + 1, len(pick)))
        ]
        trust, chosen = S.branch_and_bound(bundles, excluded)
        assert len(chosen) == len(bundles)
        assert abs(trust - max(legal)) < 1e-9 if legal else trust == 0.0


def test_the_record_type_decides_between_full_names(spark):
    rows = [
        (1, "p", "text", "Journal of Very Long Tests", 2010, ["A"], "conference", D(1), "", ""),
        (2, "p", "text", "Proc. Tests", 2010, ["A"], "conference", D(2), "", ""),
        (3, "q", "text", "Journal of Very Long Tests", 2010, ["A"], "conference", D(1), "", ""),
        (4, "q", "text", "P. Tests", 2010, ["A"], "conference", D(2), "", ""),
        (5, "r", "text", "Journal of Very Long Tests", 2010, ["A"], "article", D(1), "", ""),
        (6, "r", "text", "Proc. Tests", 2010, ["A"], None, D(2), "", ""),
    ]
    venues = spark.createDataFrame([("Journal of Very Long Tests", "J", "journal"), ("Proc. Tests", "P", "conference")], "venue string, short_name string, venue_category string")
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.paper_id: r.rec_id for r in S.survivors(df, "paper_id", "rec_id", "retrieved_at", venues).where("field = 'venue'").collect()}
    # The longest full name survives field by field; in p the types of the group contradict it.
    assert got == {"p": 2, "q": 3, "r": 5}
    records = {r.paper_id: r for r in S.golden(df, "paper_id", "rec_id", "retrieved_at", venues).collect()}
    assert records["p"].document_type == "conference" and records["q"].document_type is None and records["r"].document_type == "article"


def test_bundles_that_bind_equal_enumeration():
    import random

    rng = random.Random(7)
    kinds, changed = ["journal", "conference", "workshop"], 0
    for _ in range(400):
        cells = {n: [((float(rng.randint(0, 2)), float(rng.randint(0, 9))), "", rng.randrange(1000)) for _ in range(rng.randint(1, 3))] for n in S.FIELDS}
        cells["venue"] = [((2.0, float(rng.randint(5, 9))), k, rng.randrange(1000)) for k in rng.sample(kinds, rng.randint(1, 3))]
        cells["document_type"] = [((1.0, 0.0), k, rng.randrange(1000)) for k in rng.sample([*kinds, "article"], rng.randint(1, 2))]
        bundles = [S.trusted(cells[n], S.WEIGHT[n]) for n in S.NAMES]
        bundles[-1].append((0.0, "", -1))
        trust, chosen = S.branch_and_bound(bundles, S.contradicts)
        legal = [
            sum(c[0] for c in pick)
            for pick in itertools.product(*bundles)
            if not any(S.contradicts(i, pick[i][1], j, pick[j][1]) for i in range(5) for j in range(i + 1, 5))
        ]
        assert abs(trust - max(legal)) < 1e-9
        changed += chosen[1] != bundles[1][0][2]
    assert changed > 20
