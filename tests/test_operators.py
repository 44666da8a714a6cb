"""Core operators against brute force and on awkward input."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill import providers
from lexmill.functions import text as X
from lexmill.operators import blocks, greedy, identity, numbering, ranking
from lexmill.plans import registry
from lexmill.sinks import reports
from lexmill.streaming import ingest


def union_find(edges, records):
    parent = {r: r for r in records}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for r, k in edges:
        if k in by:
            a, b = find(r), find(by[k])
            parent[max(a, b)] = min(a, b)
        by.setdefault(k, r)
    return {r: find(r) for r in records}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    records = list(range(200))
    edges = [(rng.choice(records), f"k{rng.randint(0, 150)}") for _ in range(220)] + [(i, "hot") for i in range(0, 60)]
    edges += [(i, f"chain{i}") for i in range(150, 199)] + [(i + 1, f"chain{i}") for i in range(150, 199)]
    got = identity.components(spark.createDataFrame(edges, "record int, key string"), spark.createDataFrame([(r,) for r in records], "record int"))
    assert {r.record: r.component for r in got.collect()} == union_find(edges, records)


def test_identity_keys(spark):
    rows = [(1, " 12 ", "DOI 10.1234/A.", "Some Títle", 2020), (2, "", None, "A title long enough without year", None), (3, None, "", "short", None), (4, None, None, None, 0)]
    df = spark.createDataFrame(rows, "rec_id int, pmid string, doi string, title string, year int")
    got = {(r.record, r.key.split(":")[0]) for r in identity.identity_keys(df, "rec_id").collect()}
    assert got == {(1, "pmid"), (1, "doi"), (1, "ty"), (2, "t")}


def test_survivorship(spark):
    rows = [(1, "g", "", 2001, ["b", "a"]), (2, "g", "longest", 2003, ["a", "c"]), (3, "g", "same777", 2001, None), (4, "h", None, None, [])]
    df = spark.createDataFrame(rows, "rec_id int, g string, t string, y int, l array<string>")
    one = {r.g: r for r in df.groupBy("g").agg(identity.longest(F.col("t")).alias("t"), identity.first_non_empty(F.col("t")).alias("f")).collect()}
    assert one["g"].t == "longest" and one["g"].f == "longest" and one["h"].t is None
    assert {r.g: r.y for r in identity.most_frequent(df, ["g"], "y").collect()} == {"g": 2001}
    assert {r.g: r.l for r in identity.ordered_union(df, ["g"], "l", "rec_id").collect()} == {"g": ["b", "a", "c"]}


def test_numbering(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(7)
    assert sorted((r.k, r.n) for r in numbering.number_rows(df, ["k"], "n").collect()) == [(k, k + 1) for k in range(1000)]
    assert numbering.number_rows(df.limit(0), ["k"], "n").count() == 0


def vectors(spark, n=60, groups=3):
    rng = np.random.RandomState(0)
    v = rng.randn(n, 8)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(i, i % groups, i % 7, v[i].tolist()) for i in range(n)]
    return v, spark.createDataFrame(rows, "k long, g int, p int, v array<double>")


def test_blocks(spark):
    v, df = vectors(spark)
    wanted = {(i, j) for i, j in itertools.combinations(range(60), 2) if i % 3 == j % 3 and v[i] @ v[j] >= 0.3}
    for block in (5, 1000):
        assert {(r.a, r.b) for r in blocks.pairs_above(df, "g", "k", "v", 0.3, block).collect()} == wanted
        near = blocks.nearest_in_group(df, "g", "k", "p", "v", 2, block).collect()
        for i in range(60):
            best = sorted((j for j in range(60) if j % 3 == i % 3 and j % 7 != i % 7), key=lambda j: -(v[i] @ v[j]))[:2]
            assert {r.other for r in near if r.k == i} == set(best)


def test_greedy_dedup(spark):
    v, df = vectors(spark)
    kept = []
    for i in range(60):
        if not any(j % 3 == i % 3 and v[i] @ v[j] >= 0.4 for j in kept):
            kept.append(i)
    got = greedy.greedy_dedup(df, "g", "k", "v", 0.4)
    assert sorted(r.k for r in got.where("kept").collect()) == kept and got.count() == 60


def test_pack_in_order(spark):
    rng = random.Random(1)
    sizes = [(i, rng.randint(1, 50)) for i in range(300)]
    got = greedy.pack_in_order(spark.createDataFrame(sizes, "k long, s int"), "k", "s", [F.desc("s"), F.col("k")], 10, 120)
    wanted, n, held, total = {}, 0, 0, 0
    for k, s in sorted(sizes, key=lambda x: (-x[1], x[0])):
        if held and (held >= 10 or total + s > 120):
            n, held, total = n + 1, 0, 0
        held, total = held + 1, total + s
        wanted[k] = n
    assert {r.k: r.container for r in got.collect()} == wanted


def test_average_linkage_distances(spark):
    v, df = vectors(spark, 45, 1)
    got = {r.k: r.cluster for r in greedy.average_linkage(df, "g", "k", "v").collect()}
    assert set(got) == set(range(45))
    clusters = [[k for k in got if got[k] == c] for c in set(got.values())]
    limit = 0.38
    for a, b in itertools.combinations(clusters, 2):
        assert np.mean(1 - v[a] @ v[b].T) > limit
    assert all(min(c) == got[c[0]] for c in clusters)


def test_stream_quota(spark):
    rows = [("a", 1, 0.9), ("a", 2, 0.8), ("a", 3, 0.7), ("b", 1, 0.95), ("b", 3, 0.9), ("b", 4, 0.1)]
    selected, overflow = ranking.stream_quota(spark.createDataFrame(rows, "s string, k int, score double"), "s", "k", "score", 2)
    assert sorted((r.k, r.s) for r in selected.collect()) == [(1, "a"), (2, "a"), (3, "b")]
    assert sorted((r.k, r.s) for r in overflow.collect()) == [(3, "a"), (4, "b")]


def test_evidence_chain(spark):
    rows = [(1, "p", i, s) for i, s in enumerate([0.9, 0.8, 0.7, 0.6, 0.2])] + [(1, "q", 10, 0.55), (1, "r", 11, 0.45)]
    got = ranking.evidence_chain(spark.createDataFrame(rows, "c int, d string, k int, s double"), "c", "d", "k", "s", 0.3, 0.5, 0.5, 80).collect()
    assert {(r.k, r.rescued) for r in got} == {(0, False), (1, False), (2, False), (10, True)} | ({(3, False)} if any(r.k == 3 for r in got) else set())


def test_text_functions(spark):
    rows = [("Ünïcode  ﬁne-Títle!", "https://doi.org/10.1234/AbC.", "a | b|", " 12 "), (None, None, None, "12.0"), ("", "10.1234/x y", "a;b,c", "-3")]
    df = spark.createDataFrame(rows, "t string, d string, k string, i string")
    got = df.select(X.normalized_title(F.col("t")), X.normalize_doi(F.col("d")), X.split_keywords(F.col("k")), X.safe_int(F.col("i"))).collect()
    assert [tuple(r) for r in got] == [("unicode fine title", "10.1234/abc", ["a", "b"], 12), ("", "", None, None), ("", "10.1234/x", ["a", "b,c"], -3)]


def test_providers(spark):
    df = spark.createDataFrame([("One sentence that is long enough to stay. Two. Three.",), ("x",), (None,), (" ",), ("x",)], "t string")
    cache = spark.createDataFrame([], "key string, answer string")
    answers, new = providers.cached(df, "t", cache, providers.first_sentences(), "string")
    assert answers.count() == new.count() == 2
    again, new = providers.cached(df, "t", answers, providers.first_sentences(), "string")
    assert again.count() == 2 and new.count() == 0
    v = df.select(providers.apply(providers.hashed_encoder(16), F.col("t"), "array<double>").alias("v")).collect()
    assert all(len(r.v) == 16 for r in v) and abs(sum(x * x for x in v[0].v) - 1) < 1e-9
    options = spark.createDataFrame([(1, 2, "b", "B"), (1, 1, "a", None), (2, 1, "a", None)], "k int, priority int, resolver string, value string")
    found = {r.k: (r.resolver, r.value) for r in providers.first_of(spark.createDataFrame([(1,), (2,), (3,)], "k int"), "k", options).collect()}
    assert found == {1: ("b", "B"), 2: (None, None), 3: (None, None)}


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", "p1", 2020), ("a", "p2", 2021), ("b", "p1", 3000)], "source string, paper_id string, year int")
    text = reports.as_text(reports.selection_report(df))
    assert "| a | 2 | 2 |" in text and "## Records by year" in text and "3000" not in text
    reports.write(reports.selection_report(df), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 8
    one = spark.createDataFrame([("article", "k1", "T {x}", ["A", "B"], 2020, "J", None)], "kind string, key string, title string, authors array<string>, year int, venue string, doi string")
    assert reports.bibtex_text(one).collect()[0].entry == "@article{k1,\n  title = {T x},\n  author = {A and B},\n  year = {2020},\n  journal = {J},\n}\n"


def test_streaming(spark, tmp_path):
    rows = [(i, f"2024-01-01 {i % 5:02d}:10:00", "click" if i % 2 else "view", 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    source = str(tmp_path / "in")
    df.repartition(3).write.parquet(source)
    stream = ingest.read(spark, source, df, 1)
    q = ingest.windowed_counts(stream, "ts", "event_type", "value").writeStream.outputMode("complete").format("memory").queryName("counted").start()
    q.processAllAvailable()
    q.stop()
    batch = df.groupBy(F.date_trunc("hour", "ts").alias("start"), "event_type").count()
    assert {(r.start, r.event_type, r.n) for r in spark.table("counted").collect()} == {(r.start, r.event_type, r["count"]) for r in batch.collect()}
    target = str(tmp_path / "table")
    q = stream.writeStream.foreachBatch(ingest.upsert(spark, target, ["event_type"], "event_id")).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    last = spark.read.parquet(target).groupBy("event_type").agg(F.max("event_id").alias("m")).collect()
    assert {r.event_type: r.m for r in last} == {"click": 39, "view": 38}


def test_every_query_with_sql_is_registered():
    queries, sql = registry.queries(), registry.sql()
    assert set(sql) <= set(queries) and len(queries) > 100


def test_boundary_of_the_training_package():
    import pathlib
    import re

    root = pathlib.Path(registry.__file__).parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"lexmill\.llm|from \.+llm", path.read_text()), path


def test_packing_carries_its_state_over_spans(spark):
    rng = random.Random(3)
    sizes = [(i, rng.randint(1, 50)) for i in range(300)]
    got = greedy.pack_in_order(spark.createDataFrame(sizes, "k long, s int"), "k", "s", [F.col("k")], 10, 120, span=7)
    wanted, n, held, total = {}, 0, 0, 0
    for k, s in sizes:
        if held and (held >= 10 or total + s > 120):
            n, held, total = n + 1, 0, 0
        held, total = held + 1, total + s
        wanted[k] = n
    assert {r.k: r.container for r in got.collect()} == wanted


def test_large_clusters_are_split_by_average_linkage(spark):
    rng = np.random.default_rng(5)
    centres = np.eye(3)
    v = np.vstack([centres[i % 3] + rng.normal(0, 0.05, 3) for i in range(25)])
    rows = [(1, i, [float(x) for x in v[i]]) for i in range(25)] + [(2, 100 + i, [1.0, 0.0, 0.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "c long, k long, v array<double>")
    part = {r.k: (r.c, r.part) for r in greedy.split_large(df, "c", "k", "v", 10).collect()}
    assert len(part) == 29 and all(part[i] == part[i % 3] for i in range(25)) and len({part[i] for i in range(3)}) == 3
    assert {part[100 + i] for i in range(4)} == {(2, 0)}
