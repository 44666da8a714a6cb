"""Sets of a few words against long texts' words: all pairs that share enough.

Where the words are common nearly every text is a candidate of every set, so candidates are never written: blocks of sets meet
blocks of texts, and a task compares its block of sets with its texts as bits, a word's bits for many texts at once. What is
written grows with the sets and the texts; equal sets are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sets of a block, texts compared at once (a multiple of 8), sets compared at once, and rows of a batch that is given back.
SETS, TEXTS, AT_ONCE, ROWS = 1_000_000, 1024, 512, 200_000


def _flat(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The elements of lists and the list that each is from."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)


class _Sets:
    """A block of sets: the distinct ones as columns of numbers of words, and the keys of each."""

    def __init__(self, batches: list[pa.RecordBatch], width: int) -> None:
        held = pa.Table.from_batches(batches)
        words, parent = _flat(held["words"])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        # The number after the last word stands for none.
        none = len(self.words)
        numbers = np.full((held.num_rows, width), none, dtype=np.int32)
        first = np.searchsorted(parent, parent)
        numbers[parent, np.arange(len(parent)) - first] = coded.indices.to_numpy(zero_copy_only=False)
        numbers.sort(axis=1)
        self.sets, of = np.unique(numbers, axis=0, return_inverse=True)
        of = of.reshape(-1)
        order = np.argsort(of, kind="stable")
        self.keys = held["key"].combine_chunks()
        self.keys = self.keys.take(pa.array(order))
        self.starts = np.searchsorted(of[order], np.arange(len(self.sets) + 1))

    def sharing(self, texts: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
        """(set_key, text_key, shared) of the sets and `texts`."""
        words, parent = _flat(texts["words"])
        at = pc.index_in(words, value_set=self.words)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        seen, row = np.unique(at.drop_null().to_numpy(zero_copy_only=False), return_inverse=True)
        bits = np.zeros((len(seen) + 1, -(-texts.num_rows // 8) * 8), dtype=bool)
        bits[row, parent[known]] = True
        bits = np.packbits(bits, axis=1)
        # Words that no text holds have the last row, without a bit.
        row_of = np.full(len(self.words) + 1, len(seen))
        row_of[seen] = np.arange(len(seen))
        names = texts["key"].combine_chunks()
        for lo in range(0, len(self.sets), AT_ONCE):
            part = self.sets[lo : lo + AT_ONCE]
            # reached[k]: bits of the texts that share more than k words so far.
            reached = [np.zeros((len(part), bits.shape[1]), dtype=np.uint8) for _ in range(part.shape[1])]
            for column in range(part.shape[1]):
                has = bits[row_of[part[:, column]]]
                for k in range(column, 0, -1):
                    reached[k] |= reached[k - 1] & has
                reached[0] |= has
            if not reached[least - 1].any():
                continue
            s, t = np.nonzero(np.unpackbits(reached[least - 1], axis=1))
            shared = np.full(len(s), least, dtype=np.int32)
            for more in reached[least:]:
                shared += (more[s, t >> 3] >> (7 - (t & 7)).astype(np.uint8)) & 1
            yield from self._rows(s + lo, t, shared, names)

    def _rows(self, s: np.ndarray, t: np.ndarray, shared: np.ndarray, names: pa.Array) -> Iterator[pa.RecordBatch]:
        """Each pair once for every key of its set."""
        times = self.starts[s + 1] - self.starts[s]
        ends = np.cumsum(times)
        total = int(ends[-1])
        for lo in range(0, total, ROWS):
            row = np.arange(lo, min(lo + ROWS, total))
            pair = np.searchsorted(ends, row, side="right")
            key = self.starts[s[pair]] + row - (ends[pair] - times[pair])
            columns = [self.keys.take(pa.array(key)), names.take(pa.array(t[pair])), pa.array(shared[pair])]
            yield pa.RecordBatch.from_arrays(columns, names=["set_key", "text_key", "shared"])


def sharing(sets: DataFrame, texts: DataFrame, n_sets: int, width: int, least: int) -> DataFrame:
    """(set_key, text_key, shared) of all rows of `sets` and `texts` (key, words) that share `least` words or more.

    Words are distinct in a row; a set has `width` of them at most. `n_sets` is about the number of sets. Repeated rows give
    repeated pairs.
    """
    spark = sets.sparkSession
    of_sets = max(1, math.ceil(n_sets / SETS))
    of_texts = max(1, math.ceil(2 * spark.sparkContext.defaultParallelism / of_sets))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    mine = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    key_of = {True: sets.schema["key"].dataType, False: texts.schema["key"].dataType}
    row = lambda df, is_set, i, k: df.select(
        *[(F.col("key") if side == is_set else F.lit(None).cast(key_of[side])).alias(f"{'set' if side else 'text'}_key") for side in (True, False)],
        "words", F.lit(int(not is_set)).alias("text"), i.alias("i"), k.alias("k"),
    )
    # A block of sets with its texts is one partition, the sets first.
    met = row(sets.withColumn("k", every(of_texts)), True, mine(of_sets), F.col("k")).unionByName(
        row(texts.withColumn("i", every(of_sets)), False, F.col("i"), mine(of_texts))
    )
    placed = met.repartitionById(of_sets * of_texts, F.col("i") * of_texts + F.col("k")).sortWithinPartitions("text").drop("i", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting, held, rows = [], [], None, 0
        for batch in batches:
            n_sets_here = batch.num_rows - (pc.sum(batch.column("text")).as_py() or 0)
            for side, part in (("set_key", batch.slice(0, n_sets_here)), ("text_key", batch.slice(n_sets_here))):
                part = pa.RecordBatch.from_arrays([part.column(side), part.column("words")], names=["key", "words"])
                if side == "set_key":
                    block += [part] if part.num_rows else []
                    continue
                if part.num_rows and block:
                    held, block = _Sets(block, width), []
                while part.num_rows and held is not None:
                    now = part.slice(0, TEXTS - rows)
                    part = part.slice(now.num_rows)
                    waiting.append(now)
                    rows += now.num_rows
                    if rows == TEXTS:
                        yield from held.sharing(pa.Table.from_batches(waiting), least)
                        waiting, rows = [], 0
        if waiting:
            yield from held.sharing(pa.Table.from_batches(waiting), least)

    kinds = f"set_key {key_of[True].simpleString()}, text_key {key_of[False].simpleString()}, shared int"
    return placed.mapInArrow(run, kinds)
