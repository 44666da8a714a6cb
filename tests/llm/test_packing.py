import random

import numpy as np

from lexmill.llm import packing as P
from lexmill.llm import tokens


def test_every_item_once_and_capacity_kept():
    rng = random.Random(1)
    sizes = [rng.randint(1, 300) for _ in range(800)]
    texts = [" ".join(rng.choice(["gait", "pain", "sleep", "video", "radar"]) + str(rng.randint(0, 9)) for _ in range(12)) for _ in sizes]
    packed = P.pack_tightly(sizes, 512, P.Index(texts))
    assert sorted(i for c in packed for i in c) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in c) <= 512 for c in packed)
    assert len(packed) <= -(-sum(sizes) // 512) + 1


def test_related_items_stay_together():
    rng = random.Random(2)
    sizes = [rng.randint(20, 260) for _ in range(900)]
    texts = [" ".join(f"t{k % 90}x{rng.randint(0, 5)}" for _ in range(12)) for k in range(900)]
    index = P.Index(texts)
    related = lambda packed: sum(len({i % 90 for i in c}) < len(c) for c in packed)
    packed = P.pack_tightly(sizes, 512, index)
    assert sorted(i for c in packed for i in c) == list(range(900))
    assert len(packed) <= -(-sum(sizes) // 512) + 1
    assert related(packed) >= 0.7 * related(P.pack(sizes, 512, index))


def test_query_takes_all_words_and_returns_all_neighbours():
    texts = [" ".join(f"rare{k}" for k in range(60)) + " common"] + [f"rare{k}" for k in range(60)] + ["common"] * 100
    found = P.Index(texts).neighbours(0, np.ones(len(texts), dtype=bool))
    assert sorted(found) == list(range(1, 161))


def test_index_finds_the_brute_force_neighbours():
    texts = ["red fox jumps", "red fox runs far", "blue whale sings", "blue whale dives deep", "green tree"]
    index = P.Index(texts)
    unused = np.ones(5, dtype=bool)
    assert index.neighbours(0, unused)[0] == 1 and index.neighbours(2, unused)[0] == 3
    unused[1] = False
    assert 1 not in index.neighbours(0, unused)


def test_containers(spark):
    machine = tokens.Transducer(*tokens.load_vocabulary())
    texts = {1: "a short text", 2: None, 3: "", 4: " \n", 5: "word " * 1300, 6: "a short text", 7: "another text about gait"}
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in texts.items()], "doc_id long, text string, shard string, piece int")
    limits = spark.createDataFrame([("small", 100), ("large", 2000)], "profile string, capacity_tokens int")
    rows = P.containers(df, "doc_id", "text", limits).collect()
    for profile, capacity in (("small", 100), ("large", 2000)):
        mine = [r for r in rows if r.profile == profile]
        fill = {}
        for r in mine:
            fill[r.container] = fill.get(r.container, 0) + r.n_tokens
        assert max(fill.values()) <= capacity
        got = {}
        for r in mine:
            got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
        assert got == {k: len(machine.encode(texts[k])) for k in (1, 5, 6, 7)}
        assert all((r.piece is not None) == (r.doc_id == 5 and profile == "small") for r in mine)
    assert sorted(r.piece for r in rows if r.doc_id == 5 and r.profile == "small") == list(range(1, 15))
    filled = {r.profile: r for r in P.fill(P.packed_shards(df, "doc_id", "text", limits), limits).collect()}
    assert filled["large"].containers == 1
    assert P.containers(df.limit(0), "doc_id", "text", limits).count() == 0


def test_related_documents_share_a_shard_of_bounded_size(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"topic{k % 20}word{rng.randint(0, 4)}" for _ in range(30)) + " the same words for all" for k in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    limits = spark.createDataFrame([("small", 2000)], "profile string, capacity_tokens int")
    monkeypatch.setattr(P, "SHARD", 60)
    rows = P.packed_shards(df, "doc_id", "text", limits).collect()
    assert sorted(r.doc_id for r in rows) == list(range(600))
    shards = {}
    for r in rows:
        shards.setdefault(r.container >> 32, []).append(r.doc_id)
    topics = sum(len({i % 20 for i in ids}) for ids in shards.values())
    assert max(map(len, shards.values())) <= 75 and topics <= 5 * len(shards)
    filled = P.fill(spark.createDataFrame(rows, P.SCHEMA), limits).first()
    assert filled.placed_by_index > 300 and filled.still_near > 0.7


def test_shards_are_bounded_in_characters(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(P, "SHARD_CHARS", 1000)
    batches = [pd.DataFrame({"doc_id": range(10 * b, 10 * b + 10), "text": ["x" * (5000 if i == 5 else 300) for i in range(10)]}) for b in range(3)]
    runs = list(P._bounded(iter(batches)))
    assert [i for r in runs for i in r["doc_id"]] == list(range(30))
    assert all(len(r) == 1 or r["text"].str.len().sum() <= 1250 for r in runs)
    assert list(P._bounded(iter([]))) == []
