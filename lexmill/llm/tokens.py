"""Byte-level BPE as a lazily determinised finite-state transducer.

The merge table is compiled into three tables: token bytes to id, the two halves of each token, and the proper
prefixes of tokens. Ids follow the order of merges, which lets a pair of tokens be tested for compatibility: the pair
is kept by the encoder exactly if no merge across its border comes before the merges that made its halves.

While bytes arrive, the encoding of every prefix ends in one definite token, so an encoding is a chain of boundaries.
A start is live while the bytes after it can still grow into a token. All later encodings run through the chain of
some live start; what these chains share is final and is emitted. A state of the transducer is (last emitted token,
pending bytes); the longest token bounds the lookahead. States and transitions are made when first met and reused.

Defined results: null and empty texts give an empty list; strings of special tokens are ordinary text; unpaired
surrogates cannot occur in Arrow strings; texts of any length are read once, piece by piece.
"""

from __future__ import annotations

import codecs
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.session import spread

#: Where the public vocabularies lie; a parameter of every function that needs one.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: The public pattern that splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tables are emptied when they reach these sizes and fill again; results do not depend on it.
MAX_STATES, MAX_PIECES = 150_000, 250_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return letters | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_vocabulary(path: str = TOKENIZER) -> tuple[list[bytes], list[tuple[int, int]]]:
    """(bytes of each id, the two halves of each id; a single byte's halves are itself)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = byte_letters()
    ids: dict[str, int] = model["vocab"]
    tokens = [b""] * (max(ids.values()) + 1)
    halves = [(i, i) for i in range(len(tokens))]
    for text, i in ids.items():
        if all(c in letters for c in text):
            tokens[i] = bytes(letters[c] for c in text)
    made: set[int] = set()
    for pair in model["merges"]:
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        i = ids[left + right]
        if i not in made:
            made.add(i)
            halves[i] = (ids[left], ids[right])
    for i in range(len(tokens)):
        if i not in made and len(tokens[i]) != 1:
            tokens[i] = b""  # a special token: never produced from text
    return tokens, halves


class State:
    __slots__ = ("pending", "last", "starts", "tokens", "final", "next")

    def __init__(self, pending: bytes, last: int, starts: list[int], tokens: list[int]):
        self.pending, self.last = pending, last
        self.starts, self.tokens = starts, tokens  # of each boundary but the first: its last token and where that starts
        self.next: dict[int, tuple[State, tuple[int, ...]]] = {}
        self.final = tuple(self.chain(len(pending))[0])

    def chain(self, end: int) -> tuple[list[int], list[int]]:
        """Tokens and boundaries of the encoding of the pending bytes up to `end`."""
        out, at = [], []
        while end:
            out.append(self.tokens[end - 1])
            at.append(end)
            end = self.starts[end - 1]
        return out[::-1], at[::-1]


class Transducer:
    """Encoder of one vocabulary; see the module's description."""

    def __init__(self, tokens: list[bytes], halves: list[tuple[int, int]]):
        self.bytes_of, self.halves = tokens, halves
        self.ids = {t: i for i, t in enumerate(tokens) if t}
        self.merged = {pair: i for i, pair in enumerate(halves) if pair[0] != i}
        self.prefixes = {t[:k] for t in self.ids for k in range(1, len(t))}
        self.split = regex.compile(PATTERN).findall
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple[int, bytes], State] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.start = State(b"", -1, [], [])
        self.compatible_memo: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Would the encoder leave this pair of tokens side by side?"""
        key = (left, right)
        known = self.compatible_memo.get(key)
        if known is None:
            known = self.compatible_memo[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        limit = len(self.bytes_of) + 1
        halves, merged = self.halves, self.merged
        while True:
            together = merged.get((left, right))
            if together is not None and together < limit:
                return False
            if left > right:  # the left token was made later: undo its merge first
                limit = left
                left = halves[left][1]
                if left == limit:
                    limit = right + 1
                    right = halves[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit = right + 1
                right = halves[right][0]
                if right + 1 == limit:
                    limit = left
                    left = halves[left][1]
                    if left == limit:
                        return True

    def step(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        """The transition of `state` on `byte`: the next state and the tokens that became final."""
        pending = state.pending + bytes((byte,))
        starts, tokens = [*state.starts], [*state.tokens]
        n = len(pending)
        for s in range(n):
            token = self.ids.get(pending[s:])
            if token is None:
                continue
            before = tokens[s - 1] if s else state.last
            if before < 0 or self.compatible(before, token):
                starts.append(s)
                tokens.append(token)
                break
        grown = State(pending, state.last, starts, tokens)
        live = [s for s in range(n) if pending[s:] in self.prefixes] + [n]
        shared_tokens, shared_at = grown.chain(live[0])
        for s in live[1:]:
            other, at = grown.chain(s)
            k = 0
            while k < min(len(at), len(shared_at)) and at[k] == shared_at[k] and other[k] == shared_tokens[k]:
                k += 1
            shared_tokens, shared_at = shared_tokens[:k], shared_at[:k]
        if not shared_at:
            reached = grown
        else:
            cut = shared_at[-1]
            # A boundary that no live start can reach any more keeps a place but is never used again.
            reached = State(pending[cut:], shared_tokens[-1], [max(0, s - cut) for s in starts[cut:]], tokens[cut:])
        key = (reached.last, reached.pending)
        return self.states.setdefault(key, reached), tuple(shared_tokens)

    def piece(self, text: str) -> tuple[int, ...]:
        """Tokens of one piece of the splitting pattern."""
        state, out = self.start, []
        for byte in text.encode("utf-8"):
            found = state.next.get(byte)
            if found is None:
                found = state.next[byte] = self.step(state, byte)
            state, emitted = found
            if emitted:
                out += emitted
        if len(self.states) > MAX_STATES or len(self.pieces) > MAX_PIECES:
            self.reset()
        return (*out, *state.final)

    def encode_into(self, text: str, out: array) -> None:
        pieces = self.pieces
        for piece in self.split(text):
            ids = pieces.get(piece)
            if ids is None:
                ids = self.piece(piece)
                pieces = self.pieces
                if len(piece) <= 64:
                    pieces[piece] = ids
            out.extend(ids)

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        if text:
            self.encode_into(text, out)
        return out.tolist()

    def decode(self, ids: list[int]) -> str:
        """Streaming decode: an incremental UTF-8 state machine is fed token by token; broken bytes are replaced."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        parts = [machine.decode(self.bytes_of[i]) for i in ids]
        return "".join(parts) + machine.decode(b"", True)


_made: dict[str, Transducer] = {}


def shared(vocabulary) -> Transducer:
    """The transducer of a broadcast vocabulary, one for each worker process."""
    path, tokens, halves = vocabulary.value
    if path not in _made:
        _made[path] = Transducer(tokens, halves)
    return _made[path]


def broadcast_vocabulary(spark, path: str = TOKENIZER):
    """A vocabulary file is of fixed size (about 1.5 MB), whatever the corpus."""
    return spark.sparkContext.broadcast((path, *load_vocabulary(path)))


def encode(df: DataFrame, text: str = "text", ids: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """`df` with the column `ids` (array of int) in place of `text`; other columns pass through."""
    vocabulary = broadcast_vocabulary(df.sparkSession, tokenizer)
    others = [f for f in df.schema.fields if f.name not in (text, ids)]
    schema = T.StructType([*others, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared(vocabulary)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            flat, ends = array("i"), [0]
            for value in column:
                s = value.as_py()
                if s:
                    machine.encode_into(s, flat)
                ends.append(len(flat))
            values = pa.array(np.frombuffer(flat, dtype=np.int32)) if flat else pa.array([], pa.int32())
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            keep = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*keep, made], names=[*names, ids])

    return spread(df.select(*names, text)).mapInArrow(run, schema)


def count_tokens(df: DataFrame, text: str = "text", n: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """`df` with the number of tokens of `text` as column `n`; null and empty texts count 0; `text` stays."""
    vocabulary = broadcast_vocabulary(df.sparkSession, tokenizer)

    def run(texts):
        import pandas as pd

        machine = shared(vocabulary)
        out = []
        for s in texts:
            flat = array("i")
            if s:
                machine.encode_into(s, flat)
            out.append(len(flat))
        return pd.Series(out, dtype="int64")

    return spread(df).withColumn(n, F.pandas_udf(run, "long")(F.col(text)))


def decode(df: DataFrame, ids: str = "ids", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """`df` with the text of `ids` in place of `ids`; an empty or null list gives an empty string."""
    vocabulary = broadcast_vocabulary(df.sparkSession, tokenizer)

    def run(lists):
        import pandas as pd

        machine = shared(vocabulary)
        return pd.Series([machine.decode(x) if x is not None else "" for x in lists], dtype=object)

    return df.withColumn(text, F.pandas_udf(run, "string")(F.col(ids))).drop(*([ids] if ids != text else []))
