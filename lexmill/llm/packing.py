"""Documents packed into containers of fixed capacity, related documents together.

Documents are ordered by content, that is by words of theirs from a topic's to a near copy's (from counts over all
documents in a fixed number of hash buckets), and cut into shards of bounded size in documents and characters, so what is
alike shares a shard. A shard holds an inverted index with BM25 weights over its documents. The largest unused item seeds a container; the index returns the seed's best unused
neighbours, which fill the container greedily in order of their score; what space is left takes the largest unused items
that fit. Where a shard leaves more than `UNUSED` of its space unused, the emptiest containers, as few as save one, are
emptied and their items packed again by best fit: first what the index put together moves as one, then a seed with its best
neighbour, then item by item. All other containers stay as the index filled them.

An item is split only if it exceeds the capacity: it fills whole containers, and its rest is an item like others.

Defined results: null, empty and blank texts are in no container; every other document is whole in exactly one container
of each profile, or all its pieces are; equal texts are packed one by one; ties go to the smaller id; an empty table gives
an empty result. Sizes count tokens of a public tokenizer without special tokens. Shards are independent, so at most one
container of each shard is badly filled; neighbours are sought inside the shard. A query takes all words of its seed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.tokens import TOKENIZER, broadcast_vocabulary, shared
from lexmill.session import spread

#: A shard holds so many documents, or characters, about; a longer document is a shard of its own.
SHARD, SHARD_CHARS = 4000, 1 << 24
#: Buckets of the words' counts, and words of a document's key (see `content_key`).
BUCKETS, KEYS = 1 << 16, 3
K1, B = 1.2, 0.75
#: Words of more than one in so many documents of a shard are held densely.
DENSE = 16
#: A container that leaves at most this share of its capacity unused asks for no neighbours.
GAP = 0.01
#: Share of unused space of a shard at which repacking ends, since it parts what the index put together.
UNUSED = 0.005
WORD = re.compile(r"\w+")
SCHEMA = "profile string, container long, doc_id long, piece int, n_tokens int, placed boolean, near boolean"


class Index:
    """Inverted index of one shard with BM25 weights."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        counts = [Counter(w.lower() for w in WORD.findall(t)) for t in texts]
        lengths = [sum(c.values()) for c in counts]
        mean = sum(lengths) / max(1, self.n) or 1.0
        postings: dict[str, tuple[list[int], list[float]]] = {}
        for i, c in enumerate(counts):
            norm = K1 * (1 - B + B * lengths[i] / mean)
            for w, tf in c.items():
                ids, weights = postings.setdefault(w, ([], []))
                ids.append(i)
                weights.append(tf * (K1 + 1) / (tf + norm))
        # A word of one document has no neighbours. Words of many documents are rows of a dense matrix, which bounds itself:
        # at most DENSE times the documents' mean number of words.
        self.rare: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.rows: dict[str, int] = {}
        dense: list[np.ndarray] = []
        for w, (ids, weights) in postings.items():
            if len(ids) < 2:
                continue
            scores = np.array(weights) * math.log(1 + (self.n - len(ids) + 0.5) / (len(ids) + 0.5))
            if len(ids) * DENSE >= self.n:
                self.rows[w] = len(dense)
                row = np.zeros(self.n)
                row[ids] = scores
                dense.append(row)
            else:
                self.rare[w] = np.array(ids, dtype=np.int32), scores
        self.dense = np.array(dense).reshape(len(dense), self.n)
        self.queries = [(sorted(self.rows[w] for w in c if w in self.rows), sorted(w for w in c if w in self.rare)) for c in counts]

    def neighbours(self, i: int, unused: np.ndarray) -> list[int]:
        """The unused documents that share a word with document i, best first."""
        rows, words = self.queries[i]
        scores = self.dense[rows].sum(axis=0) if rows else np.zeros(self.n)
        if words:
            ids = np.concatenate([self.rare[w][0] for w in words])
            weights = np.concatenate([self.rare[w][1] for w in words])
            scores += np.bincount(ids, weights=weights, minlength=self.n)
        scores[~unused] = 0.0
        scores[i] = 0.0
        top = np.flatnonzero(scores > 0)
        return top[np.lexsort((top, -np.round(scores[top], 9)))].tolist()


class Sizes:
    """Items by size; finds the largest unused one that fits."""

    def __init__(self, sizes: list[int]):
        self.order = sorted(range(len(sizes)), key=lambda i: (sizes[i], -i))
        self.sorted = [sizes[i] for i in self.order]
        self.at = {i: k for k, i in enumerate(self.order)}
        self.below = list(range(len(sizes) + 1))  # 1-based places; 0 is none

    def _find(self, k: int) -> int:
        root = k
        while self.below[root] != root:
            root = self.below[root]
        while self.below[k] != root:
            self.below[k], k = root, self.below[k]
        return root

    def take(self, i: int) -> None:
        k = self.at[i] + 1
        self.below[k] = k - 1

    def fitting(self, space: int) -> int | None:
        import bisect

        k = self._find(bisect.bisect_right(self.sorted, space))
        return self.order[k - 1] if k else None


def pack(sizes: list[int], capacity: int, index: Index | None, seeds: dict[int, int] | None = None) -> list[list[int]]:
    """Containers of items, every size at most `capacity`; `seeds` takes the seed of each item that the index placed."""
    n = len(sizes)
    unused = np.ones(n, dtype=bool)
    by_size = Sizes(sizes)
    out: list[list[int]] = []

    def use(i: int) -> None:
        unused[i] = False
        by_size.take(i)

    while (seed := by_size.fitting(capacity)) is not None:
        use(seed)
        held, space = [seed], capacity - sizes[seed]
        smallest = 1
        if index is not None and space > GAP * capacity:
            for i in index.neighbours(seed, unused):
                if sizes[i] <= space:
                    use(i)
                    held.append(i)
                    if seeds is not None:
                        seeds[i] = seed
                    space -= sizes[i]
                    if space < smallest:
                        break
        while space > 0 and (i := by_size.fitting(space)) is not None:
            use(i)
            held.append(i)
            space -= sizes[i]
        out.append(held)
    return out


def pack_tightly(sizes: list[int], capacity: int, index: Index | None, seeds: dict[int, int] | None = None) -> list[list[int]]:
    """`pack`, then again by best fit for the items of the emptiest containers while more than `UNUSED` is unused."""
    seeds = {} if seeds is None else seeds
    packed = pack(sizes, capacity, index, seeds)
    # What the index put together moves as one, then a seed with its best neighbour, then every item by itself.
    for kept in (len(sizes), 2, 1):
        units = [_units(c, seeds, kept) for c in packed]
        packed = [[i for unit in c for i in unit] for c in _saving(units, sizes, capacity)]
    return packed


def _units(held: list[int], seeds: dict[int, int], kept: int) -> list[list[int]]:
    """The items of a container, those of one seed together, of which `kept` move as one at most."""
    families: dict[int, list[int]] = {}
    for i in held:
        families.setdefault(seeds.get(i, i), []).append(i)
    return [unit for f in families.values() for unit in [f[:kept], *[[i] for i in f[kept:]]]]


def _saving(packed: list[list[list[int]]], sizes: list[int], capacity: int) -> list[list[list[int]]]:
    """Fewer containers of units of items, if repacking saves any and more than `UNUSED` is unused."""
    gap = lambda c: capacity - sum(sizes[i] for unit in c for i in unit)
    least = -(-sum(sizes) // capacity)
    while len(packed) > least and len(packed) * capacity - sum(sizes) > UNUSED * len(packed) * capacity:
        # Containers with much free space and little that the index put together come first.
        packed = sorted(packed, key=lambda c: gap(c) / (1 + sum(len(unit) - 1 for unit in c)), reverse=True)
        free = np.cumsum([gap(c) for c in packed])
        k = int(np.searchsorted(free, capacity)) + 1  # less free space cannot save a container
        saved = None
        while saved is None and k <= len(packed):
            units = [unit for c in packed[:k] for unit in c]
            again = pack([sum(sizes[i] for i in unit) for unit in units], capacity, None)
            if len(again) < k:
                saved = [[units[u] for u in c] for c in again] + packed[k:]
            k = len(packed) if k < len(packed) < 3 * k // 2 + 1 else 3 * k // 2 + 1
        if saved is None:
            break
        packed = saved
    return packed


def pack_shard(docs: pd.DataFrame, profiles: list[tuple[str, int]], shard: int) -> pd.DataFrame:
    """Rows of `SCHEMA` for the documents (doc_id, text, n_tokens) of one shard.

    `placed`: the index put the document with its seed; `near`: it is still there after repacking.
    """
    docs = docs.sort_values("doc_id", kind="stable").reset_index(drop=True)
    ids, sizes = docs["doc_id"].tolist(), docs["n_tokens"].tolist()
    index = Index(docs["text"].tolist())
    rows: list[tuple] = []
    for profile, capacity in profiles:
        number = 0
        rests, pieces = [], []
        for i, size in enumerate(sizes):
            whole = size // capacity if size > capacity else 0
            for p in range(whole):
                rows.append((profile, (shard << 32) + number, ids[i], p + 1, capacity, False, False))
                number += 1
            rests.append(size - whole * capacity)
            pieces.append(whole + 1 if whole else None)
        items = [i for i, r in enumerate(rests) if r > 0]
        local = _Local(index, items)
        seeds: dict[int, int] = {}
        for held in pack_tightly([rests[i] for i in items], capacity, local, seeds):
            together = set(held)
            for k in held:
                i = items[k]
                rows.append((profile, (shard << 32) + number, ids[i], pieces[i], rests[i], k in seeds, seeds.get(k) in together))
            number += 1
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    out["piece"] = out["piece"].astype("Int32")
    return out


class _Local:
    """The index seen through the places of the items that are packed."""

    def __init__(self, index: Index, items: list[int]):
        self.index, self.items = index, np.array(items, dtype=np.int64)
        self.place = {i: k for k, i in enumerate(items)}
        self.mask = np.zeros(index.n, dtype=bool)

    def neighbours(self, k: int, unused: np.ndarray) -> list[int]:
        self.mask[:] = False
        self.mask[self.items[unused]] = True
        return [self.place[i] for i in self.index.neighbours(int(self.items[k]), self.mask)]


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Number of texts that hold a word of each bucket, over all rows; its size is fixed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                counts[list(set(map(_bucket, WORD.findall(text.lower()))))] += 1
        held = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": held, "n": counts[held]})

    counts = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in spread(rows.select("text")).mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def content_key(text: str, counts: np.ndarray) -> list[int]:
    """Buckets of three words, from a topic to a near copy: the most usual word that a shard can hold all texts of, the most
    usual one that an eighth of a shard can, and the rarest. Words of one text relate it to nothing."""
    held = sorted((int(counts[b]), b) for b in set(map(_bucket, WORD.findall(text.lower()))) if counts[b] > 1)
    usual = [max((c for c in held if c[0] <= most), default=(0, -1))[1] for most in (SHARD, SHARD // 8)]
    return [*usual, held[0][1] if held else -1]


def packed_shards(df: DataFrame, key: str, text: str, limits: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Rows of `SCHEMA` of every non-blank document; `limits` (profile, capacity_tokens) is a table of a few rows."""
    profiles = [(r[0], int(r[1])) for r in limits.select("profile", "capacity_tokens").orderBy("profile").collect() if r[1] and r[1] > 0]
    rows = df.where(F.col(text).isNotNull() & F.col(text).rlike(r"(?U)\S")).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    n, chars = rows.agg(F.count("*"), F.sum(F.length("text"))).first()
    shards = max(1, math.ceil(max(n / SHARD, (chars or 0) / SHARD_CHARS)))
    vocabulary = broadcast_vocabulary(df.sparkSession, tokenizer)
    held = df.sparkSession.sparkContext.broadcast(bucket_counts(rows))
    names = [f"k{i}" for i in range(KEYS)]

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = np.array([content_key(t, held.value) for t in batch["text"]], dtype=np.int32).reshape(-1, KEYS)
            yield batch.assign(**{name: keys[:, i] for i, name in enumerate(names)})

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = shared(vocabulary)
        number = TaskContext.get().partitionId() << 12
        for run in _bounded(batches):
            run = run.assign(n_tokens=[len(machine.encode(t)) for t in run["text"]])
            yield pack_shard(run, profiles, number)
            number += 1

    with_key = spread(rows).mapInPandas(keyed, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    placed = with_key.repartitionByRange(shards, *names, "doc_id").sortWithinPartitions(*names, "doc_id")
    return placed.select("doc_id", "text").mapInPandas(packed, SCHEMA)


def _bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive rows in runs of bounded size; a rest of less than a quarter stays with the run before."""
    held: list[pd.DataFrame] = []
    load = 0.0
    for batch in batches:
        costs = np.maximum(1 / SHARD, batch["text"].str.len().to_numpy() / SHARD_CHARS)
        start = 0
        for i, cost in enumerate(costs):
            if load and load + cost > 1.25:
                held.append(batch.iloc[start:i])
                yield pd.concat(held)
                held, load, start = [], 0.0, i
            load += cost
        held.append(batch.iloc[start:])
    if load:
        yield pd.concat(held)


def containers(df: DataFrame, key: str, text: str, limits: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(profile, container, doc_id, piece, n_tokens) of every non-blank document; `piece` only where it was split."""
    return packed_shards(df, key, text, limits, tokenizer).drop("placed", "near")


def fill(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """Of each profile: containers, tokens, the least containers possible, the share of unused space, the documents that
    the index placed with their seed, and the share of these that are still there after repacking."""
    per = packed.groupBy("profile").agg(
        F.countDistinct("container").alias("containers"), F.sum("n_tokens").alias("tokens"),
        F.count_if("placed").alias("placed_by_index"), F.count_if("near").alias("near"),
    )
    capacity = F.col("capacity_tokens")
    return per.join(limits, "profile").select(
        "profile", "containers", "tokens", F.ceil(F.col("tokens") / capacity).alias("least_containers"),
        F.round(1 - F.col("tokens") / (F.col("containers") * capacity), 6).alias("unused_share"), "placed_by_index",
        F.round(F.col("near") / F.greatest("placed_by_index", F.lit(1)), 6).alias("still_near"),
    )
