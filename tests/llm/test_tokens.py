"""The transducer against the public library, and the defined results."""

import random

import pytest

from lexmill.llm import tokens as T

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def machine():
    return T.Transducer(*T.load_vocabulary())


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(T.TOKENIZER)
    t.encode_special_tokens = True
    return t


def test_equals_the_library(machine, library):
    rng = random.Random(5)
    letters = [*map(chr, range(0x250)), *"the ing ation  <|endoftext|> \n\n\t中文日本語🎉é́\xa0߷٣"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(1500)]
    texts += ["".join(rng.choice("abcdeinorst ") for _ in range(70)) for _ in range(1500)]
    texts += ["a" * 5000, "=" * 3001, " " * 333, "<|endoftext|>", "abcabc" * 500, "é" * 200]
    for t in texts:
        assert machine.encode(t) == library.encode(t, add_special_tokens=False).ids, t


def test_round_trip_and_empty(machine):
    for t in ["", "plain", "ünïcode 🎉 中文", "\x00\x01", " \n\t "]:
        assert machine.decode(machine.encode(t)) == t
    assert machine.encode(None) == []


def test_emptying_the_tables_changes_nothing(machine, monkeypatch):
    texts = [f"word{i} and {'x' * (i % 17)} tail" for i in range(300)]
    before = [machine.encode(t) for t in texts]
    monkeypatch.setattr(T, "MAX_STATES", 20)
    monkeypatch.setattr(T, "MAX_PIECES", 20)
    fresh = T.Transducer(*T.load_vocabulary())
    assert [fresh.encode(t) for t in texts] == before


def test_frame(spark, machine):
    rows = [(1, "hello world", "k"), (2, "", "k"), (3, None, None), (4, "hello world", "k"), (5, "long " * 20_000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces string")
    got = {r.doc_id: r for r in T.encode(df).collect()}
    assert got[1].ids == got[4].ids == machine.encode("hello world")
    assert got[2].ids == got[3].ids == []
    assert len(got[5].ids) > 19_000 and got[1].pieces == "k"
    assert T.encode(df.limit(0)).count() == 0
    counts = {r.doc_id: r.n_tokens for r in T.count_tokens(df).collect()}
    assert counts == {i: len(r.ids) for i, r in got.items()}
    back = {r.doc_id: r.text for r in T.decode(T.encode(df)).collect()}
    assert back[1] == "hello world" and back[3] == ""
