"""Pairs of sets and texts by shared words, against brute force."""

import random

import pyarrow as pa

from lexmill.operators import overlap
from lexmill.plans import enrichment


def brute(sets, texts, least):
    met = [(s, t, len(set(a) & set(b))) for s, a in sets for t, b in texts]
    return sorted(x for x in met if x[2] >= least)


def test_all_pairs_and_their_numbers(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(25)]
    sets = [(i, rng.sample(words, rng.choice([3, 4]))) for i in range(150)] + [(200, ["no", "such", "word"]), (1, words[:4])]
    texts = [(f"t{i}", rng.sample(words, rng.randint(0, 20)) + ["other"]) for i in range(90)] + [("none", [])]
    s, t = spark.createDataFrame(sets, "key long, words array<string>"), spark.createDataFrame(texts, "key string, words array<string>")
    for blocks in (10, 1_000_000):
        monkeypatch.setattr(overlap, "SETS", blocks)
        for least in (1, 3, 4):
            got = sorted(tuple(r) for r in overlap.sharing(s, t, len(sets), 4, least).collect())
            assert got == brute(sets, texts, least)
    assert overlap.sharing(s.limit(0), t, 0, 4, 3).count() == overlap.sharing(s, t.limit(0), len(sets), 4, 3).count() == 0


def test_parts_of_a_block(monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(25)]
    sets, texts = ([(i, rng.sample(words, k)) for i in range(n)] for n, k in ((150, 4), (90, 14)))
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["key", "words"])
    monkeypatch.setattr(overlap, "AT_ONCE", 7)
    monkeypatch.setattr(overlap, "ROWS", 13)
    held = overlap._Sets([batch(sets).slice(0, 50), batch(sets).slice(50)], 4)
    parts = [pa.Table.from_batches([batch(texts).slice(at, n)]) for at, n in ((0, 33), (33, 57))]
    got = [tuple(r.values()) for part in parts for found in held.sharing(part, 3) for r in found.to_pylist()]
    assert sorted(got) == brute(sets, texts, 3)


def test_candidates_are_not_written(spark, tmp_path, request):
    """Common words make all pairs candidates; written to a shuffle, they fill the disk (files_matched_to_titles)."""
    shared = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", shared))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    n = 700
    spark.range(n).selectExpr("id AS rec_id", "'north south eastern western' AS title").write.parquet(f"{tmp_path}/canonical.parquet")
    word = "element_at(array('north', 'south', 'eastern', 'western'), cast(id % 4 + 1 AS int))"
    spark.range(n).selectExpr("id AS text_id", f"{word} AS full_text").write.parquet(f"{tmp_path}/papers.parquet")
    before = {s.stageId() for s in _stages(spark)}
    assert enrichment.files_matched_to_titles(spark, str(tmp_path)).count() == 0
    assert sum(s.shuffleWriteRecords() for s in _stages(spark) if s.stageId() not in before) < 20 * 2 * n


def _stages(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    status = spark.sparkContext._jsc.sc().statusStore()
    stages = status.stageList(None, False, False, getattr(status, "stageList$default$4")(), None)
    return [stages.apply(i) for i in range(stages.size())]
