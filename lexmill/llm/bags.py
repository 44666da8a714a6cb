"""Texts as bags of canonical words: misspellings and synonyms are learned from the corpus itself.

Everything is counted over different texts, so repeated rows change nothing, and every threshold is a number of texts or a
ratio of counts, never a share of the corpus, so a word is read alike in a small and in a large table.

* A word of fewer than `LEAST` texts that is one edit from a word at least `MISSPELT` times as frequent is read as that.
* Two words are synonyms on evidence, not on looks: texts that differ in nothing but these two words must agree in what
  they report (a figure, an identifier) at least `AGREE` times, and hardly ever disagree; the pairs must be more than an
  accident for the rarer word, and the words must not seek each other's company. Words that only fill the same place (two
  drugs, "reduces" and "increases") have no such evidence and stay apart.
* A word of more texts is misspelt only if a neighbour is `FAR_RARER` times as frequent and is seen between the same two words
  in most places where it stands itself; a real word has places of its own.

What is learned are tables. A table is broadcast only after its rows are counted (`SMALL`); a larger one is joined.

`similar` finds the bags of a given Jaccard similarity, `within` those that are part of another. Both are exact. With the
words of every bag in one order, rarest first, two bags that share enough for the thresholds share two (or three) of the
first few words; bags that do so are compared, those of frequent words in blocks of bounded size. Of long bags single words
are the keys, so what is written grows with their length and not with its square. Bit sketches, which
bound what two bags can share from above, and then the whole bags decide.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.names import fold, one_edit
from lexmill.operators.identity import components
from lexmill.session import cut, grown, release

#: A word of so many texts is one; a rarer one may be misspelt if a neighbour is so many times as frequent.
LEAST, MISSPELT = 5, 20
#: A word of `LEAST` texts is misspelt only if a neighbour is so many times as frequent and is seen in this share of its places.
FAR_RARER, PLACES = 50, 0.5
#: Longer words are not read as misspellings.
LONGEST = 40
#: Synonyms: pairs of texts that agree at least, how much more often than they disagree, share of the rarer word's texts,
#: and how often the two may stand in one text against chance.
AGREE, AGAINST, SUBSTITUTES, TOGETHER = 2, 4, 0.02, 0.7
#: Texts that differ in one word must share so many others to say anything of it.
HOLE = 6
#: A word follows another always if it does so in so many texts and in this share of them.
FOLLOWS_LEAST, FOLLOWS = 20, 0.85
#: A learned table of so many rows at most is broadcast.
SMALL = 100_000
#: Bags of one word that a block holds at most, about, and pairs of blocks that a task compares, about.
BLOCK, CELLS = 2048, 2000
#: Parts of so much of the whole are found by three words, smaller ones by two.
NEAR = 0.75
#: Of bags of more words than this, single words are the keys, since their pairs and triples are too many.
LONG = 40
WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")


def tasks(df: DataFrame) -> int:
    """A number of partitions that keeps all cores busy; adaptive execution does not join what is set by number."""
    spark = df.sparkSession
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_texts(df: DataFrame, key: str, text: str, read: Callable[[str], tuple[list[str], float | None, float | None]]) -> tuple[DataFrame, DataFrame]:
    """((key, doc) of every row with a text, (doc, tokens, lo, hi) of every different text).

    `read` must be deterministic; lo and hi bound the figure that the text reports, or are None.
    """
    rows = df.where(F.col(text).isNotNull()).select(F.col(key), F.md5(text).alias("doc"), F.col(text).alias("__text"))

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(t) for t in texts], columns=["tokens", "lo", "hi"])

    different = rows.select("doc", "__text").repartition(tasks(df), "doc").dropDuplicates(["doc"])
    parsed = different.select("doc", F.pandas_udf(run, "tokens array<string>, lo double, hi double")("__text").alias("r"))
    return rows.select(key, "doc"), cut(parsed.select("doc", "r.*"))


def looked_up(docs: DataFrame, units: Column, learned: DataFrame) -> DataFrame:
    """`docs` with `found`: for each element of `units` its value in `learned` (k, v), or null."""
    rows = docs.withColumn("__units", units)
    few = learned.select("k", "v").limit(SMALL + 1).toArrow()
    if few.num_rows <= SMALL:
        shared = docs.sparkSession.sparkContext.broadcast(dict(zip(few["k"].to_pylist(), few["v"].to_pylist())))
        del few

        def look(lists: pd.Series) -> pd.Series:
            return lists.map(lambda us: [shared.value.get(u) for u in us])

        return rows.withColumn("found", F.pandas_udf(look, "array<string>")("__units")).drop("__units")
    flat = rows.select("doc", F.posexplode("__units").alias("pos", "k")).join(grown(learned), "k")
    held = flat.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("pos", "v"))).alias("__held"))
    joined = rows.join(grown(held), "doc", "left")
    return joined.withColumn("found", F.transform("__units", lambda u, i: F.try_element_at("__held", i))).drop("__units", "__held")


def replaced(docs: DataFrame, column: str, learned: DataFrame) -> DataFrame:
    """`docs` with the words of `column` as `learned` (k, v) reads them."""
    rows = looked_up(docs, F.col(column), learned)
    return rows.withColumn(column, F.zip_with(column, "found", lambda w, v: F.coalesce(v, w))).drop("found")


def word_counts(docs: DataFrame, column: str) -> DataFrame:
    """(w, df): the words and the number of texts that hold them."""
    return docs.select(F.explode(F.array_distinct(column)).alias("w")).groupBy("w").agg(F.count("*").alias("df"))


def edits(rare: DataFrame, usual: DataFrame) -> DataFrame:
    """(w, n, near, m): pairs of words (w, df) of the two tables that are one edit apart; they meet by what is left of them
    without one letter."""
    left = "array_distinct(array_append(transform(sequence(1, length(w)), i -> concat(left(w, i - 1), substring(w, i + 1))), w))"
    plain = (F.length("w") > 3) & (F.length("w") <= LONGEST) & ~F.col("w").rlike(r"\d")
    a = rare.where(plain).select("w", F.col("df").alias("n"), F.explode(F.expr(left)).alias("part"))
    b = usual.where(plain).select(F.col("w").alias("near"), F.col("df").alias("m"), F.explode(F.expr(left)).alias("part"))
    met = a.join(grown(b), "part").where(F.col("w") != F.col("near")).select("w", "n", "near", "m").distinct()
    return met.where(F.pandas_udf(one_edit, "boolean")("w", "near"))


def corrections(words: DataFrame, ratio: float = MISSPELT) -> DataFrame:
    """(k, v): the misspelt words of (w, df) and what they are read as, the most frequent neighbour."""
    near = edits(words.where(F.col("df") < LEAST), words.where(F.col("df") >= LEAST)).where(F.col("m") >= ratio * F.col("n"))
    return near.groupBy(F.col("w").alias("k")).agg(F.max_by("near", F.struct("m", "near")).alias("v"))


def misspellings(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(k, v): like `corrections`, for words of `LEAST` texts and more, by the places where they stand in (doc, tokens)."""
    usual = words.where(F.col("df") >= LEAST)
    pairs = cut(edits(usual, usual).where(F.col("m") >= FAR_RARER * F.col("n")))
    beside = lambda i: F.coalesce(F.try_element_at("tokens", i), F.lit(""))
    # Positions of element_at count from 1; before the first and after the last word stands nothing.
    around = F.transform("tokens", lambda w, i: F.struct(w.alias("w"), F.xxhash64(F.when(i > 0, beside(F.greatest(i, F.lit(1)))), beside(i + 2)).alias("place")))
    stands = docs.select(F.explode(around).alias("p")).select("p.w", "p.place")
    asked = stands.join(grown(pairs.select("w").distinct()), "w").groupBy("w", "place").agg(F.count("*").alias("times"))
    targets = stands.join(grown(pairs.select(F.col("near").alias("w")).distinct()), "w").distinct().withColumnRenamed("w", "near")
    total = asked.groupBy("w").agg(F.sum("times").alias("total"))
    met = asked.join(grown(pairs), "w").join(grown(targets), ["near", "place"]).groupBy("w", "near", "m").agg(F.sum("times").alias("times"))
    sure = met.join(grown(total), "w").where(F.col("times") >= PLACES * F.col("total"))
    return sure.groupBy(F.col("w").alias("k")).agg(F.max_by("near", F.struct("m", "near")).alias("v"))


def implied(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(k, v): pairs "a b" of words of which b follows a nearly always, and so says nothing there ("encoding model")."""
    pairs = docs.where(F.size("bag") > 1).select(F.explode(_beside()).alias("k")).where("k <> ''").groupBy("k").count()
    first = pairs.where(F.col("count") >= FOLLOWS_LEAST).withColumn("w", F.split("k", " ")[0])
    return first.join(grown(counts), "w").where(F.col("count") >= FOLLOWS * F.col("df")).select("k", F.lit("").alias("v"))


def _beside() -> Column:
    """Each word of the bag with the one before it; '' for the first."""
    return F.transform("bag", lambda w, i: F.when(i > 0, F.concat(F.get(F.col("bag"), i - 1), F.lit(" "), w)).otherwise(F.lit("")))


def without_implied(docs: DataFrame, counts: DataFrame) -> DataFrame:
    rows = looked_up(docs, _beside(), implied(docs, counts))
    held = F.filter(F.arrays_zip("bag", "found"), lambda x: x["found"].isNull())
    return rows.withColumn("bag", F.transform(held, lambda x: x["bag"])).drop("found")


def synonyms(docs: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """(k, v): words of (doc, bag, lo, hi) and one word of their class of synonyms, see the module's description."""
    words = counts.where(F.col("df") >= LEAST)
    sorted_ = docs.where(F.size("bag") > HOLE).withColumn("bag", F.sort_array("bag"))
    holes = sorted_.select(F.explode("bag").alias("w"), "bag", "lo", "hi")
    holes = holes.select("w", F.xxhash64(F.array_remove("bag", F.col("w"))).alias("rest"), "lo", "hi")
    # The figures of equal texts meet in one interval, or in none.
    places = holes.groupBy("rest", "w").agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"))
    several = places.groupBy("rest").agg(F.count("*").alias("n")).where("n > 1").select("rest")
    places = cut(places.join(grown(several), "rest").join(grown(words.select("w")), "w"))
    sure = places.where(F.col("lo") <= F.col("hi"))
    binned = sure.select("rest", "w", "lo", "hi", F.explode(F.sequence(F.floor("lo"), F.floor("hi"))).alias("bin"))
    one, two = (binned.select("rest", "bin", *[F.col(c).alias(f"{c}_{x}") for c in ("w", "lo", "hi")]) for x in ("a", "b"))
    agreed = one.join(grown(two), ["rest", "bin"]).where((F.col("w_a") < F.col("w_b")) & (F.greatest("lo_a", "lo_b") <= F.least("hi_a", "hi_b")))
    agreed = agreed.select("rest", F.col("w_a").alias("a"), F.col("w_b").alias("b")).distinct()
    asked = agreed.groupBy("a", "b").count().where(F.col("count") >= AGREE).select("a", "b")
    side = lambda x: places.select("rest", F.col("w").alias(x), F.col("lo").alias(f"lo_{x}"), F.col("hi").alias(f"hi_{x}"))
    met = asked.join(grown(side("a")), "a").join(grown(side("b")), ["rest", "b"])
    told = (F.col("lo_a") <= F.col("hi_a")) & (F.col("lo_b") <= F.col("hi_b"))
    same = F.greatest("lo_a", "lo_b") <= F.least("hi_a", "hi_b")
    seen = met.groupBy("a", "b").agg(
        F.count("*").alias("places"), F.count_if(told & same).alias("agree"), F.count_if(told & ~same).alias("against")
    )
    evidence = (F.col("agree") >= AGREE) & (F.col("agree") >= AGAINST * F.col("against"))
    count = lambda x: words.select(F.col("w").alias(x), F.col("df").alias(f"n{x}"))
    enough = F.col("places") >= SUBSTITUTES * F.least("na", "nb")
    release(docs.sparkSession)
    held = cut(seen.where(evidence).join(grown(count("a")), "a").join(grown(count("b")), "b").where(enough))
    # How often both stand in one text is counted from the texts of the rarer one.
    rarer = F.col("na") <= F.col("nb")
    pairs = held.select(F.when(rarer, F.col("a")).otherwise(F.col("b")).alias("w"), F.when(rarer, F.col("b")).otherwise(F.col("a")).alias("v"))
    stand = docs.select("doc", "bag", F.explode("bag").alias("w"))
    both = stand.join(grown(pairs), "w").where(F.array_contains("bag", F.col("v"))).groupBy("w", "v").agg(F.count("*").alias("both"))
    both = both.select(F.least("w", "v").alias("a"), F.greatest("w", "v").alias("b"), "both")
    apart = F.coalesce("both", F.lit(0)) <= TOGETHER * F.col("na") * F.col("nb") / F.lit(float(n_docs))
    return _classes(held.join(grown(both), ["a", "b"], "left").where(apart).select("a", "b"))


def _classes(pairs: DataFrame) -> DataFrame:
    """(k, v): each word of the pairs and the smallest word that it is connected with."""
    spark = pairs.sparkSession
    few = pairs.limit(SMALL + 1).collect()
    if len(few) > SMALL:
        pairs = cut(pairs)
        named = pairs.withColumn("key", F.concat_ws(" ", "a", "b"))
        edges = named.select(F.col("a").alias("record"), "key").unionByName(named.select(F.col("b").alias("record"), "key"))
        return components(edges, edges.select("record").distinct()).select(F.col("record").alias("k"), F.col("component").alias("v"))
    root: dict[str, str] = {}

    def find(w: str) -> str:
        while root.get(w, w) != w:
            w = root[w]
        return w

    for a, b in sorted(tuple(r) for r in few):
        x, y = sorted((find(a), find(b)))
        root[y] = root[x] = x
    return spark.createDataFrame([(w, find(w)) for w in sorted(root)], "k string, v string")


def learn(
    df: DataFrame, key: str, text: str, read: Callable[[str], tuple[list[str], float | None, float | None]], stop: frozenset[str], rounds: int = 1
) -> DataFrame:
    """(key, bag) of every row with a text: sorted canonical words, with misspellings, implied words and synonyms resolved.

    Words of `stop` are left out after spelling is read; a text of such words alone is known by them.
    """
    rows, docs = read_texts(df, key, text, read)
    words = cut(word_counts(docs, "tokens"))
    docs = replaced(docs, "tokens", corrections(words).unionByName(misspellings(docs, words)))
    release(df.sparkSession)
    bare = F.array_except("tokens", F.array(*[F.lit(w) for w in sorted(stop)]))
    docs = cut(docs.select("doc", F.when(F.size(bare) > 0, bare).otherwise(F.array_distinct("tokens")).alias("bag"), "lo", "hi"))
    release(df.sparkSession)
    docs = cut(without_implied(docs, word_counts(docs, "bag")))
    n_docs = docs.count()
    release(df.sparkSession)
    for _ in range(rounds):
        docs = replaced(docs, "bag", synonyms(docs, cut(word_counts(docs, "bag")), n_docs))
        docs = cut(docs.withColumn("bag", F.array_distinct("bag")))
    return cut(rows.join(grown(docs.select("doc", F.sort_array("bag").alias("bag"))), "doc").select(key, "bag"))


def _shared_at_most(x: str, y: str) -> Column:
    """A bound on the words that two bags share: a bit of one sketch that the other lacks is a word that the other lacks."""
    def lacks(p: str, q: str) -> Column:
        return sum((F.bit_count(F.col(f"{p}.s{i}").bitwiseAND(F.bitwise_not(F.col(f"{q}.s{i}")))) for i in (0, 1)), F.lit(0))

    return F.least(F.col(f"{x}.n") - lacks(x, y), F.col(f"{y}.n") - lacks(y, x))


def _pairs_of(words: str) -> str:
    """SQL: of all pairs of the array `words`, in order, the hash and how many words of the bag there are from the pair on."""
    pair = f"struct(xxhash64(2, get({words}, i), get({words}, j)) AS w, n - j + 1 AS r)"
    return f"flatten(transform(sequence(0, size({words}) - 2), i -> transform(sequence(i + 1, size({words}) - 1), j -> {pair})))"


def _postings(sized: DataFrame, me: str, need: Column, block: str, singles: Column, pairs: Column) -> DataFrame:
    """(w, block, me): each bag under pairs of its rarest words of which it must share one to share `need` words, two at least,
    where `pairs` holds; and where `singles` holds under single ones. `r` of a bag is what it can share if the key is the
    first that it shares."""
    whole = F.struct("n", "id", "s0", "s1", F.col("k.r").alias("r"), need.cast("int").alias("need")).alias(me)
    first = sized.withColumn("one", F.slice("bag", F.lit(1), F.greatest(F.col("n") - need + 1, F.lit(0)).cast("int")))
    first = first.withColumn("two", F.slice("bag", F.lit(1), F.greatest(F.col("n") - F.greatest(need, F.lit(2)) + 2, F.lit(0)).cast("int")))
    single = F.transform("one", lambda w, i: F.struct(F.xxhash64(F.lit(1), w).alias("w"), (F.col("n") - i).alias("r")))
    ones = first.where(singles).withColumn("k", F.explode(single))
    twos = first.where(pairs & (F.size("two") > 1)).withColumn("k", F.explode(F.expr(_pairs_of("two"))))
    return ones.unionByName(twos).select(whole, F.col("k.w").alias("w")).withColumn(block, F.xxhash64(f"{me}.id"))


def similar(
    bags: DataFrame, key: str, least_jaccard: float, contained: float = 0.0, shared: int = 1, sure: float | None = None, short: float | None = None
) -> DataFrame:
    """(a, b, jaccard, contained, shared): all pairs of `key` a < b of similar distinct bags; `bags` has one row for each bag.

    Pairs of a Jaccard similarity of `least_jaccard` are similar if they share `contained` of the smaller bag and `shared`
    words, or have a Jaccard similarity of `sure`. Of a smaller bag of up to three words they share `short`, if it is given.
    """
    inside = lambda n: F.lit(contained) if short is None else F.when(n <= 3, short).otherwise(contained)
    sized = _sized(bags, key)
    least = lambda share: F.ceil(F.col("n") * share - 1e-9)
    as_small = F.greatest(least(inside(F.col("n"))), least(2 * least_jaccard / (1 + least_jaccard)), F.lit(max(shared, 1)))
    as_large = F.greatest(least(least_jaccard), F.lit(max(shared, 1)))
    if sure is not None:
        as_small = F.least(as_small, F.greatest(least(2 * sure / (1 + sure)), F.lit(1)))
        as_large = F.least(as_large, F.greatest(least(sure), F.lit(1)))
    # Pairs of words are the keys, except where one common word is enough or the larger bag is long.
    lone = (F.col("n") > LONG) | (as_large < 2)
    small = _postings(sized, "x", as_small, "i", (F.col("n") >= least_jaccard * LONG) | (as_small < 2), F.lit(True))
    large = _postings(sized, "y", as_large, "k", lone, F.col("n") <= LONG)
    # The bags of a word meet in pairs of blocks; most words have one block.
    blocks = (
        small.select("w", F.lit(1).alias("p"), F.lit(0).alias("q"))
        .unionByName(large.select("w", F.lit(0).alias("p"), F.lit(1).alias("q")))
        .groupBy("w")
        .agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
        .where((F.col("p") > 0) & (F.col("q") > 0))
        .select("w", F.ceil(F.col("p") / BLOCK).alias("of_i"), F.ceil(F.col("q") / BLOCK).alias("of_k"))
    )
    blocks = cut(blocks)
    cells = blocks.agg(F.sum(F.col("of_i") * F.col("of_k"))).first()[0] or 0
    many = max(2 * bags.sparkSession.sparkContext.defaultParallelism, cells // CELLS)

    def placed(rows: DataFrame, mine: str, other: str) -> DataFrame:
        all_of = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"of_{other}") - 1))
        rows = rows.join(grown(blocks), "w").withColumn(mine, F.pmod(mine, f"of_{mine}")).withColumn(other, all_of)
        return rows.drop("of_i", "of_k").repartition(many, "w", "i", "k")

    def enough(n: Column, na: Column, nb: Column) -> Column:
        jaccard = n / (na + nb - n)
        alike = (n >= inside(F.least(na, nb)) * F.least(na, nb) - 1e-9) & (n >= shared)
        return (jaccard >= least_jaccard) & (alike if sure is None else alike | (jaccard >= sure))

    order = lambda me: F.struct(F.col(f"{me}.n"), F.col(f"{me}.id"))
    # On the first key that two bags share, what follows it must be enough for the smaller bag.
    reach = F.least("x.r", "y.r") >= F.col("x.need")
    met = placed(small, "i", "k").join(grown(placed(large, "k", "i")), ["w", "i", "k"]).where(reach & (order("x") < order("y")))
    pairs = (
        met.where(enough(_shared_at_most("x", "y"), F.col("x.n"), F.col("y.n")))
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )
    left = sized.select(F.col("id").alias("a"), F.col("bag").alias("bag_a"))
    right = sized.select(F.col("id").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.join(grown(left), "a").join(grown(right), "b").withColumn("n", F.size(F.array_intersect("bag_a", "bag_b")))
    na, nb = F.size("bag_a"), F.size("bag_b")
    return both.where(enough(F.col("n"), na, nb)).select(
        "a", "b", (F.col("n") / (na + nb - F.col("n"))).alias("jaccard"), (F.col("n") / F.least(na, nb)).alias("contained"),
        F.col("n").alias("shared"),
    )


def _sized(bags: DataFrame, key: str) -> DataFrame:
    """(id, bag, n, s0, s1): the words of every bag, rarest first, their number and a sketch of 128 bits."""
    words = bags.select(F.col(key).alias("id"), F.explode(F.array_distinct("bag")).alias("w"))
    ranked = words.join(grown(words.groupBy("w").agg(F.count("*").alias("df"))), "w")
    ranked = ranked.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("ws"))
    bit = "aggregate(bag, 0L, (s, w) -> s | if(pmod(xxhash64(w), 128) div 64 = {0}, shiftleft(1L, cast(pmod(xxhash64(w), 64) as int)), 0L))"
    return cut(
        ranked.select("id", F.transform("ws", lambda x: x["w"]).alias("bag"), F.size("ws").alias("n"))
        .select("id", "bag", "n", F.expr(bit.format(0)).alias("s0"), F.expr(bit.format(1)).alias("s1"))
    )


def within(bags: DataFrame, key: str, least: float, shared: int, sure: float) -> DataFrame:
    """(a, b, share): all pairs of `key` of which the bag of a is a proper part of that of b; `bags` has one row for each bag.

    The part must be `least` of the whole and hold `shared` words, or be `sure` of it. A part of at least `NEAR` of the whole
    has its three rarest words among the first few of the whole, a smaller part its two rarest, so these are the keys by
    which bags meet: a word of every second bag is no key by itself.
    """
    sized = _sized(bags, key)
    n = F.col("n")
    larger = sized.agg(F.max("n")).first()[0] or 0
    share = lambda x: F.ceil(n * x - 1e-9).cast("int")
    ws = "slice(bag, 1, m)"
    threes = (
        f"flatten(transform(sequence(0, m - 3), i -> flatten(transform(sequence(i + 1, m - 2), j -> "
        f"transform(sequence(j + 1, m - 1), k -> xxhash64(3, get({ws}, i), get({ws}, j), get({ws}, k)))))))"
    )
    twos = f"flatten(transform(sequence(0, m - 2), i -> transform(sequence(i + 1, m - 1), j -> xxhash64(2, get({ws}, i), get({ws}, j)))))"
    whole = F.struct("n", "id", "s0", "s1")
    near = sized.where((n >= 4) & (n <= LONG)).withColumn("m", n - share(NEAR) + 3).select(F.explode(F.expr(threes)).alias("h"), whole.alias("y"))
    far_least = F.greatest(share(least), F.lit(shared))
    far = sized.where((far_least < share(NEAR)) & (n <= LONG)).withColumn("m", n - far_least + 2).select(F.explode(F.expr(twos)).alias("h"), whole.alias("y"))
    first = lambda k: [F.get("bag", F.lit(i)) for i in range(k)]
    parts = sized.where(n >= 3).select(F.xxhash64(F.lit(3), *first(3)).alias("h"), whole.alias("x"))
    if shared >= 2:
        small = sized.where((n >= shared) & (n < F.lit(NEAR * larger)))
        parts = parts.unionByName(small.select(F.xxhash64(F.lit(2), *first(2)).alias("h"), whole.alias("x")))
    # A long whole holds the rarest word of its part among the words that leave enough after them.
    parts = parts.unionByName(sized.where(n >= least * LONG).select(F.xxhash64(F.lit(1), *first(1)).alias("h"), whole.alias("x")))
    held = F.slice("bag", F.lit(1), n - F.greatest(share(least), F.lit(1)) + 1)
    long_ = sized.where(n > LONG).select(F.explode(F.transform(held, lambda w: F.xxhash64(F.lit(1), w))).alias("h"), whole.alias("y"))
    lacks = lambda i: F.col(f"x.s{i}").bitwiseAND(F.bitwise_not(F.col(f"y.s{i}"))) == 0
    ratio = F.col("x.n") / F.col("y.n")
    enough = ((ratio >= least - 1e-9) & (F.col("x.n") >= shared)) | (ratio >= sure - 1e-9)
    many = tasks(bags)
    met = parts.repartition(many, "h").join(grown(near.unionByName(far).unionByName(long_).repartition(many, "h")), "h")
    pairs = met.where((F.col("x.n") < F.col("y.n")) & lacks(0) & lacks(1) & enough).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    both = pairs.join(grown(sized.select(F.col("id").alias("a"), F.col("bag").alias("part"))), "a").join(
        grown(sized.select(F.col("id").alias("b"), F.col("bag").alias("whole"))), "b"
    )
    return both.where(F.size(F.array_except("part", "whole")) == 0).select("a", "b", (F.size("part") / F.size("whole")).alias("share"))
