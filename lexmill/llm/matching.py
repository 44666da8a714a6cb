"""Records of different sources that are the same work, matched without labels.

Each pair of candidate papers gets a vector of similarities (title, identifiers, year, authors, kind of part); what one of
the two does not know is missing from the vector. Two Gaussians with full covariances, of matched and of unmatched vectors,
are fitted by expectation maximisation over what each vector holds. The covariances are regularised by the squared
distance of the means, so that a similarity that hardly varies cannot collapse a component. The fit begins with nothing but
the identifiers: the first estimates are those of pairs that share one and of pairs whose identifiers differ; all others
are open and take part from the second step on, when every posterior is free.
Vectors are rounded to a bounded grid, so the fit runs on counts of its cells, whatever the number of pairs.

In every round the transitivity constraint is enforced: if a-b and b-c match, a-c must; pairs missing from the candidates
are added and measured, and a match contradicted by more neighbours than support it loses confidence. What that leaves of
the posteriors is where the next round of the fit begins; the rounds end when the matches stay. The outputs are the posteriors.

Candidates have similar canonical title words (see `bags`), or an identifier in common and some title words, and one thing
more: a word of the authors' names or an identifier, or the year (give or take one) where one of the two names no authors.
No identifier and no title proposes a pair by itself, so frequent ones need no other treatment than rare ones.

Defined results: nulls, blanks, impossible years and malformed identifiers count as unknown, not as different; a paper
without title, doi and pmid is in no pair; papers that agree in a title alone are in no pair; repeated rows of a paper count once; a paper's own source is never matched;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm import bags
from lexmill.llm.names import fold
from lexmill.session import cut, grown, release

FIRST_YEAR, LAST_YEAR = 1800, 2025
#: Part of the dois of preprint servers; a preprint and its publication have different dois.
PREPRINT = r"/(arxiv|biorxiv|medrxiv|preprints?)\."
#: Function words of titles.
STOP = frozenset("a an the of in on for with and to from using through by towards toward can support at via is are be or as into amp".split())
#: What makes a part, an edition, a protocol or a version for other readers, which are works of their own.
KINDS = re.compile(
    r"\bpart (?:[ivx]+|\d+|one|two|three|four)\b|\b(?:\d{4}|\d+(?:st|nd|rd|th)|first|second|third|revised|extended|updated) edition\b"
    r"|\bversion for \w+\b|\b(?:study |trial )?protocol$|\b(?:\w+ )?(?:month|week|year) (?:outcomes|results|follow up)$|\berratum\b|\bcorrigendum\b"
)
FEATURES = ("contained", "shared", "doi", "pmid", "year", "people", "kind")
#: Steps of the grid for each similarity; with the missing ones it has some 220,000 cells at most.
GRID = (20, 6, 10, 1, 20, 10, 1)
#: Regularisation of the variances: share of the squared distance of the means, and the least variance.
REGULAR, LEAST_VARIANCE, STEPS, MOVED = 0.03, 5e-3, 200, 1e-4
#: First posteriors: pairs that share an identifier, pairs whose identifiers differ, and all pairs where one of these lacks.
SHARED_ID, OTHER_ID, OPEN = 0.95, 0.05, 0.5
#: The rounds end when at most this share of the matches changes, and after so many.
SETTLED, ROUNDS = 0.001, 6
#: Titles that share so many words share enough, and so do lists of authors.
ENOUGH, ENOUGH_NAMES = 6, 2
#: A word of a name is misspelt if it is rare and another is so many times as frequent.
NAME_RARER = 4


def title_words(text: str) -> list[str]:
    plain = re.sub(r"&\w+;|<[^<>]{1,20}>", " ", fold(text))
    cut_off = re.sub(r"\S*(?:\.\.\.|…)\s*$", "", plain)
    return re.findall(r"[^\W_]+", cut_off)


def doi_of(column: Column) -> Column:
    low = F.lower(F.regexp_replace(column, "%2[fF]", "/"))
    found = F.regexp_extract(low, r"(10\.\d{4,9}/[^\s\"<>]+)", 1)
    return F.nullif(F.regexp_replace(found, r"[.,;:)\]]+$", ""), F.lit(""))


def pmid_of(column: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(column, r"(\d{4,})", 1), "^0+", ""), F.lit(""))


def papers(df: DataFrame, last_year: int = LAST_YEAR) -> DataFrame:
    """One row for each paper_id, by one aggregation with map-side combine."""
    year = F.when(F.col("year").between(FIRST_YEAR, last_year), F.col("year"))
    # A doi without any number but a year names a volume or a venue, not a work.
    doi = doi_of(F.col("doi"))
    work = F.when(F.regexp_replace(F.regexp_replace(doi, "^[^/]*/", ""), r"\b(?:19|20)\d{2}\b", "").rlike(r"\d"), doi)
    people = F.when(F.size("authors") > 0, F.col("authors"))
    title = F.nullif(F.trim("title"), F.lit(""))
    return df.where(F.col("paper_id").isNotNull()).groupBy("paper_id").agg(
        F.min("source").alias("source"),
        F.min(work).alias("doi"),
        F.min(pmid_of(F.col("pmid"))).alias("pmid"),
        F.max_by(year, F.struct(year.isNotNull(), "retrieved_at")).alias("year"),
        F.max_by(title, F.struct(F.length(title), title)).alias("title"),
        F.max_by(people, F.struct(F.size(people), F.to_json(people))).alias("authors"),
    )


def _read_titles(rows: DataFrame) -> DataFrame:
    """(paper_id, kind, bag): kind of part and canonical words of every title; titles of one doi show synonyms."""
    papers_, docs = bags.read_texts(rows, "paper_id", "title", lambda t: (title_words(t), None, None))
    counts = cut(bags.word_counts(docs, "tokens"))
    docs = bags.replaced(docs, "tokens", bags.corrections(counts).unionByName(bags.misspellings(docs, counts)))
    text = F.array_join("tokens", " ")
    kind = F.array_join(F.array_sort(F.regexp_extract_all(text, F.lit(KINDS.pattern), F.lit(0))), " ")
    words = F.split(F.regexp_replace(text, KINDS.pattern, " "), " +")
    docs = docs.select("doc", kind.alias("kind"), F.array_sort(F.array_except(words, F.array(*[F.lit(w) for w in sorted(STOP | {""})]))).alias("bag"))
    known = papers_.join(grown(rows.select("paper_id", F.xxhash64("doi").cast("double").alias("id"), F.col("doi").isNotNull().alias("has"))), "paper_id")
    told = known.where("has").groupBy("doc").agg(F.max("id").alias("lo"), F.min("id").alias("hi"))
    docs = cut(docs.join(grown(told), "doc", "left"))
    docs = bags.replaced(docs, "bag", bags.synonyms(docs, cut(bags.word_counts(docs, "bag")), docs.count()))
    return papers_.join(grown(docs.select("doc", "kind", F.array_sort(F.array_distinct("bag")).alias("bag"))), "doc").drop("doc")


def _name_tokens(authors: Column) -> Column:
    """The folded words of an author list."""
    plain = F.translate(F.lower(F.concat_ws(" ", authors)), "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ", "aaaaaaceeeeiiiinoooooouuuuyy")
    return F.filter(F.array_distinct(F.split(plain, r"[^\p{L}]+")), lambda w: F.length(w) > 1)


def _ids() -> list[Column]:
    """Keys of the identifiers; null where unknown."""
    return [F.concat(F.lit("d:"), "doi"), F.concat(F.lit("m:"), "pmid")]


def _evidence(rows: DataFrame, ids: list[Column], turned: bool) -> tuple[DataFrame, DataFrame]:
    """What two papers must share besides a title, as (paper_id, node, key) for one and for the other: names, `ids`, or a year
    give or take one where the one (or, `turned`, either) has no authors."""
    none = F.array().cast("array<string>")
    named = F.coalesce(F.transform("who", lambda w: F.concat(F.lit("p:"), w)), none)
    shared = F.concat(named, F.array_compact(F.array(*ids)))
    lacks = F.coalesce(F.size("who"), F.lit(0)) < 1
    year = lambda kind, d: F.concat(F.lit(kind), (F.col("year") + d).cast("string"))
    at = lambda kind: F.when(F.col("year").isNotNull(), F.array(year(kind, 0))).otherwise(none)
    about = lambda kind: F.when(lacks & F.col("year").isNotNull(), F.array(*[year(kind, d) for d in (-1, 0, 1)])).otherwise(none)
    one, other = [shared, about("y:")], [shared, at("y:")]
    if turned:
        one, other = [*one, at("z:")], [*other, about("z:")]
    return tuple(rows.select("paper_id", "node", F.explode(F.concat(*keys)).alias("key")) for keys in (one, other))


def _candidates(rows: DataFrame) -> DataFrame:
    """(a, b): pairs of paper_id a < b, see the module's description.

    The steps are cut, for the driver plans all of a job again and describes it at every stage that ends, so what it needs
    grows with the square of a plan.
    """
    titled = cut(rows.where(F.size("bag") > 0).withColumn("node", F.xxhash64(F.concat_ws(" ", "bag"))))
    nodes = cut(titled.groupBy("node").agg(F.first("bag").alias("bag")))
    near = cut(bags.similar(nodes, "node", 0.35, contained=0.75, short=0.66).select("a", "b"))
    release(rows.sparkSession)
    ids = titled.select("node", "bag", F.explode(F.array_compact(F.array(*_ids()))).alias("id"))
    items = ids.groupBy("id", "node").agg(F.first("bag").alias("bag"))
    several = items.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    # Within an identifier the words are its own, so only titles under one identifier meet.
    items = cut(items.join(grown(several), "id").select(F.xxhash64("id", "node").alias("item"), "node", F.transform("bag", lambda w: F.concat("id", F.lit("|"), w)).alias("bag")))
    under = cut(bags.similar(items.select("item", "bag"), "item", 0.2, contained=0.4).select("a", "b"))
    release(rows.sparkSession)
    under = under.join(grown(items.select(F.col("item").alias("a"), F.col("node").alias("na"))), "a").join(grown(items.select(F.col("item").alias("b"), F.col("node").alias("nb"))), "b")
    linked = cut(near.unionByName(under.select(F.col("na").alias("a"), F.col("nb").alias("b"))).distinct())
    # Each title with itself and, both ways, with those like it.
    titles = linked.union(linked.select("b", "a")).union(nodes.select("node", "node")).toDF("node", "other")
    found = _met(titled, titles).unionByName(_untitled(rows))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _met(titled: DataFrame, titles: DataFrame) -> DataFrame:
    """Pairs of papers under titles that are alike, with evidence."""
    one, other = _evidence(titled, _ids(), turned=False)
    one = one.join(grown(titles), "node").select(F.col("other").alias("node"), "key", F.col("paper_id").alias("a"))
    # Titles are held both ways, so of two papers with like evidence one way is enough; of years one is that of a paper without authors.
    way = (F.col("a") < F.col("b")) | (F.col("key").startswith("y:") & (F.col("a") != F.col("b")))
    return one.join(grown(other.withColumnRenamed("paper_id", "b")), ["node", "key"]).where(way).select("a", "b")


def _untitled(rows: DataFrame) -> DataFrame:
    """Pairs of a paper without a title: one identifier and one thing more."""
    doi, pmid = _ids()
    by = F.filter(F.array(F.struct(doi.alias("node"), pmid.alias("rest")), F.struct(pmid.alias("node"), doi.alias("rest"))), lambda x: x["node"].isNotNull())
    with_id = rows.select("paper_id", "year", "who", (F.coalesce(F.size("bag"), F.lit(0)) < 1).alias("bare"), F.explode(by).alias("by"))
    with_id = with_id.select("*", "by.node", "by.rest")
    one, _ = _evidence(with_id.where("bare"), [F.col("rest")], turned=True)
    _, other = _evidence(with_id, [F.col("rest")], turned=True)
    pairs = one.withColumnRenamed("paper_id", "a").join(grown(other.withColumnRenamed("paper_id", "b")), ["node", "key"])
    return pairs.where(F.col("a") != F.col("b")).select("a", "b")


def _measured(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b, cell): the rounded similarity vector of every pair from two sources."""
    def side(s: str) -> DataFrame:
        names = ["source", "doi", "pmid", "year", "kind", "bag", "people"]
        return rows.select(F.col("paper_id").alias(s), *[F.col(n).alias(f"{n}_{s}") for n in names])

    both = pairs.join(grown(side("a")), "a").join(grown(side("b")), "b").where(F.col("source_a") != F.col("source_b"))
    x = lambda n: (F.col(f"{n}_a"), F.col(f"{n}_b"))

    def overlap(name: str) -> tuple[Column, Column]:
        p, q = x(name)
        sizes = [F.coalesce(F.size(s), F.lit(0)) for s in (p, q)]
        return F.coalesce(F.size(F.array_intersect(p, q)), F.lit(0)), F.least(*sizes)

    n, least_n = overlap("bag")
    m, least_m = overlap("people")
    titled = least_n > 0
    da, db = x("doi")
    torn = (F.least(F.length(da), F.length(db)) >= 12) & (da.startswith(db) | db.startswith(da))
    preprint = da.rlike(PREPRINT) != db.rlike(PREPRINT)
    pa, pb = x("pmid")
    ya, yb = x("year")
    gap = F.abs(ya - yb)
    ka, kb = x("kind")
    # What is not known is null; dois of a preprint and of its publication say nothing.
    vector = {
        "contained": F.when(titled, n / least_n),
        "shared": F.when(titled, F.least(n / F.lit(ENOUGH), F.lit(1.0))),
        "doi": F.when(da == db, 1.0).when(torn, 0.9).when(~preprint, 0.0),
        "pmid": F.when(pa.isNotNull() & pb.isNotNull(), (pa == pb).cast("double")),
        "year": F.when(gap == 0, 1.0).when(gap == 1, 0.75).when(gap == 2, 0.4).when(gap > 2, 0.0),
        "people": F.when(least_m > 0, F.least(m / F.least(least_m, F.lit(ENOUGH_NAMES)), F.lit(1.0))),
        "kind": F.when(titled, (ka == kb).cast("double")),
    }
    cells = [F.coalesce(F.round(vector[f] * steps), F.lit(-1)).cast("int") for f, steps in zip(FEATURES, GRID)]
    return both.select("a", "b", F.array(*cells).alias("cell"))


class Mixture:
    """Two Gaussians with full covariances over cells of the grid, fitted by expectation maximisation; NaN is missing.

    Of a vector with missing parts the likelihood is that of the rest, and the expected missing parts, with what is left
    of their covariance, enter the estimates.
    """

    def __init__(self) -> None:
        self.weight = 0.5
        self.means = np.full((2, len(FEATURES)), 0.5)
        self.covariances = np.array([np.eye(len(FEATURES)) * 0.1] * 2)

    @staticmethod
    def start(x: np.ndarray) -> np.ndarray:
        """First posteriors, from the identifiers alone; NaN is open."""
        ids = x[:, 2:4]
        shared, other = (ids >= 0.9).any(1), (ids < 0.1).any(1)
        rest = np.nan if shared.any() and (other & ~shared).any() else OPEN
        return np.where(shared, SHARED_ID, np.where(other, OTHER_ID, rest))

    @staticmethod
    def patterns(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, known, missing) of every pattern of missing parts."""
        known = ~np.isnan(x)
        kinds, at = np.unique(known, axis=0, return_inverse=True)
        at = at.reshape(-1)
        return [(np.flatnonzero(at == i), np.flatnonzero(k), np.flatnonzero(~k)) for i, k in enumerate(kinds)]

    def _density(self, x: np.ndarray, patterns: list, c: int) -> np.ndarray:
        out = np.zeros(len(x))
        for rows, known, _ in patterns:
            if len(known):
                part = self.covariances[c][np.ix_(known, known)]
                d = x[np.ix_(rows, known)] - self.means[c][known]
                out[rows] = -0.5 * ((d @ np.linalg.inv(part) * d).sum(1) + np.linalg.slogdet(part)[1] + len(known) * np.log(2 * np.pi))
        return out

    def _moments(self, x: np.ndarray, weights: np.ndarray, patterns: list, c: int) -> tuple[np.ndarray, np.ndarray]:
        mean, covariance = self.means[c], self.covariances[c]
        filled, rest = x.copy(), np.zeros_like(covariance)
        for rows, known, missing in patterns:
            if len(missing):
                slope = covariance[np.ix_(missing, known)] @ np.linalg.inv(covariance[np.ix_(known, known)])
                filled[np.ix_(rows, missing)] = mean[missing] + (x[np.ix_(rows, known)] - mean[known]) @ slope.T
                rest[np.ix_(missing, missing)] += weights[rows].sum() * (covariance[np.ix_(missing, missing)] - slope @ covariance[np.ix_(known, missing)])
        total = weights.sum()
        mean = (weights[:, None] * filled).sum(0) / total
        d = filled - mean
        return mean, (rest + (weights[:, None] * d).T @ d) / total

    def fit(self, x: np.ndarray, n: np.ndarray, posterior: np.ndarray) -> np.ndarray:
        patterns = self.patterns(x)
        for _ in range(STEPS):
            told = ~np.isnan(posterior)
            p = np.where(told, posterior, 0.5)
            self.weight = float(np.clip((n * p)[told].sum() / n[told].sum(), 1e-6, 1 - 1e-6))
            both = [self._moments(x, n * told * w + 1e-12, patterns, c) for c, w in enumerate((p, 1 - p))]
            self.means = np.array([m for m, _ in both])
            ridge = np.diag(REGULAR * (self.means[0] - self.means[1]) ** 2 + LEAST_VARIANCE)
            self.covariances = np.array([s + ridge for _, s in both])
            odds = np.log(self.weight / (1 - self.weight)) + self._density(x, patterns, 0) - self._density(x, patterns, 1)
            after = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
            moved, posterior = np.abs(after - p).max(), after
            if moved < MOVED:
                break
        return posterior


def _fit(measured: DataFrame, mixture: Mixture, adjusted: DataFrame | None = None) -> DataFrame:
    """(a, b, cell, p): one round of the fit over the grid's cells; `adjusted` posteriors enter its first step."""
    spark = measured.sparkSession
    source = measured.withColumn("p", F.lit(None).cast("double")) if adjusted is None else adjusted
    cells = source.groupBy("cell").agg(F.count("*").alias("n"), F.avg("p").alias("p")).orderBy("cell").collect()
    if not cells:
        return measured.withColumn("p", F.lit(0.0))
    x = np.array([r["cell"] for r in cells], dtype=float)
    x = np.where(x < 0, np.nan, x / GRID)
    n = np.array([r["n"] for r in cells], dtype=float)
    first = mixture.start(x)
    if adjusted is not None:
        first = np.array([r["p"] if r["p"] is not None else s for r, s in zip(cells, first)])
    p = mixture.fit(x, n, first)
    scored = spark.createDataFrame([(r["cell"], float(v)) for r, v in zip(cells, p)], "cell array<int>, p double")
    # The grid bounds what is sent here and back.
    return measured.join(F.broadcast(scored), "cell").select("a", "b", "cell", "p")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b", "p").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "p"))


def _wedges(edges: DataFrame) -> DataFrame:
    """(a, m, c): a < c with matches a-m and m-c."""
    both = _both_ways(edges)
    left = both.select(F.col("b").alias("m"), "a", F.col("p").alias("p_a"))
    right = both.select(F.col("a").alias("m"), F.col("b").alias("c"), F.col("p").alias("p_c"))
    return left.join(grown(right), "m").where(F.col("a") < F.col("c"))


def match(df: DataFrame, last_year: int = LAST_YEAR) -> DataFrame:
    """(paper_id_a, paper_id_b, confidence): pairs of the same work, the smaller id first, confidence at least 0.5."""
    base = cut(papers(df, last_year))
    titles = cut(_read_titles(base))
    release(df.sparkSession)
    people = F.filter("who", lambda w: F.length(w) > 4)
    rows = base.join(grown(titles), "paper_id", "left").select("paper_id", "source", "doi", "pmid", "year", "kind", "bag", _name_tokens(F.col("authors")).alias("who"))
    # Names are of many kinds and few papers each, so a few times as frequent is enough for the right spelling of one.
    names = rows.select(F.col("paper_id").alias("doc"), F.coalesce("who", F.array().cast("array<string>")).alias("who"))
    names = bags.replaced(names, "who", bags.corrections(cut(bags.word_counts(names, "who")), NAME_RARER))
    rows = rows.drop("who").join(grown(names.select(F.col("doc").alias("paper_id"), F.array_distinct("who").alias("who"))), "paper_id")
    rows = cut(rows.withColumn("people", people))
    release(df.sparkSession)
    measured = cut(_measured(_candidates(rows), rows))
    mixture = Mixture()
    adjusted, before = None, None
    for _ in range(ROUNDS):
        release(df.sparkSession)
        scored = cut(_fit(measured, mixture, adjusted))
        edges = scored.where(F.col("p") >= 0.5)
        held = cut(_constrained(scored))
        now = held.where(F.col("p") >= 0.5).select("a", "b")
        count = now.count()
        if before is not None:
            stayed = now.join(grown(before[0]), ["a", "b"]).count()
            if count + before[1] - 2 * stayed <= SETTLED * max(count, 1):
                break
        before = (now, count)
        # Transitivity: what two matches imply is measured like any other candidate, and conflicts weaken a match.
        implied = _wedges(edges).select("a", F.col("c").alias("b")).distinct()
        more = cut(_measured(implied.join(grown(measured.select("a", "b")), ["a", "b"], "left_anti"), rows))
        measured = cut(measured.unionByName(more))
        adjusted = held.select("a", "b", "cell", "p").unionByName(more.withColumn("p", F.lit(None).cast("double")))
    final = held.where(F.col("p") >= 0.5)
    return final.select(F.col("a").alias("paper_id_a"), F.col("b").alias("paper_id_b"), F.round("p", 6).alias("confidence"))


def _constrained(scored: DataFrame) -> DataFrame:
    """The posteriors under the transitivity constraint.

    For a match a-b, every neighbour of one end either matches the other end (support) or does not (conflict). With more
    conflicts than support the posterior is scaled by (support + 1) / (support + conflict + 1).
    """
    edges = scored.where(F.col("p") >= 0.5)
    both = _both_ways(edges)
    degree = both.groupBy("a").agg(F.count("*").alias("d"))
    closed = _wedges(edges).select("a", F.col("c").alias("b"), "m")
    support = closed.join(grown(edges.select("a", "b")), ["a", "b"]).groupBy("a", "b").agg(F.count("*").alias("s"))
    counted = (
        edges.join(grown(degree.withColumnRenamed("d", "da")), "a")
        .join(grown(degree.select(F.col("a").alias("b"), F.col("d").alias("db"))), "b")
        .join(grown(support), ["a", "b"], "left")
        .withColumn("s", F.coalesce("s", F.lit(0)))
        .withColumn("k", F.col("da") + F.col("db") - 2 - 2 * F.col("s"))
    )
    scale = F.when(F.col("k") > F.col("s"), (F.col("s") + 1) / (F.col("s") + F.col("k") + 1)).otherwise(1.0)
    held = counted.select("a", "b", "cell", (F.col("p") * scale).alias("p"))
    return held.unionByName(scored.where(F.col("p") < 0.5).select("a", "b", "cell", "p"))
