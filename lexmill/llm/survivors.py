"""One surviving record for each group of records that repeat a key, built from consistent bundles of fields.

Every value of a field gets a trust from rules that look only at the value and its row: a complete text outranks a cut
one and a filler, a venue's full name outranks its short forms, a possible year outranks an impossible one and a later
retrieval an earlier one, a complete list of authors outranks a part of it. Values of one grade (two full names, say)
are of nearly equal trust, those of a lower grade of much less. Venue and record type depend on each other: a venue has one
category, and a record's type must not contradict it. So the two are chosen as a whole: of several full names the one
survives whose category the types of the group confirm, though another is longer; a full name never yields to a short form.

Within a group and a bundle only the best value of each dependency class can be part of an optimum, so one aggregation
with map-side combine leaves at most as many candidates as there are classes (five categories at most), however large
the group is. Whole bundles are then chosen by branch and bound: bundles in order, candidates by falling trust, and a
branch is left as soon as its trust plus the best of the remaining bundles cannot beat the best choice found.

Defined results: null is a value like any other, of lowest trust; ties go to the smallest `rec_id`; repeated rows change
nothing; groups of one row survive as they are; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands for a missing value.
FILLER = r"^\W*(no abstract( is)?( available)?|(the )?abstract( is)?( not available| unavailable| missing|:? none)|not available|unknown|none|null|n/?a|tba|tbd)?\W*$"
CUT = r"(\.\.\.|…|[\[(]\s*(\.\.\.|…|[A-Za-z ]*([Tt]runcated|TRUNCATED|abridged|more)[A-Za-z0-9 ]*)\s*[\])])\s*$"
FIRST_YEAR, LAST_YEAR = 1800, 2025
FIELDS = ("abstract", "venue", "year", "authors")
NAMES = (*FIELDS, "document_type")
#: A record's type that is compatible with a venue of any category.
ANY_TYPE = ("article",)
#: Trust of the best value of a field; one grade less halves it, and a place less within a grade costs little. A type can
#: decide between venues of one grade only.
WEIGHT = {"abstract": 4.0, "venue": 4.0, "year": 4.0, "authors": 4.0, "document_type": 1.0}
PLACE = 0.01


def _candidates(df: DataFrame, group: str, row: str, at: str, venues: DataFrame, last_year: int = LAST_YEAR) -> DataFrame:
    """(group, field, value, class, rank, row, trust): every value of every row, without the texts themselves."""
    text, venue, year, people = F.col("abstract"), F.col("venue"), F.col("year"), F.col("authors")
    real_people = F.filter(people, lambda x: x.isNotNull() & ~F.lower(F.trim(x)).isin("", "et al.", "et al"))
    known = venues.groupBy(F.col("venue").alias("__name")).agg(F.min("venue_category").alias("__category"))
    rows = df.join(known, venue == F.col("__name"), "left")
    moment = F.coalesce(F.unix_micros(F.col(at).cast("timestamp")).cast("double"), F.lit(0.0))
    zero = F.lit(0.0)
    possible = year.between(FIRST_YEAR, last_year)

    def value(name: str, digest: Column, cls: Column, *rank: Column) -> Column:
        ranks = [F.coalesce(r.cast("double"), zero) for r in rank]
        ranks += [zero] * (4 - len(ranks))
        return F.struct(
            F.lit(name).alias("field"), digest.alias("value"), cls.alias("class"), F.array(*ranks).alias("rank")
        )

    nothing = F.lit("")
    filler = text.isNull() | F.lower(text).rlike(FILLER)
    no_venue = venue.isNull() | F.lower(venue).rlike(FILLER)
    given = F.array(
        value(
            "abstract", F.md5(text), nothing,
            F.when(filler, 0).otherwise(1), F.when(filler, 0).otherwise(F.length(text) - F.when(text.rlike(CUT), 40).otherwise(0)),
            F.length(text),
        ),
        value(
            "venue", venue, F.coalesce(F.col("__category"), nothing),
            F.when(F.col("__category").isNotNull(), 2).when(no_venue, 0).otherwise(1), F.length(venue),
        ),
        value("year", year.cast("string"), nothing, possible.cast("int"), moment, F.col(row)),
        value(
            "authors", F.md5(F.to_json(F.struct(people))), nothing,
            F.size(real_people), F.when(F.size(people) == F.size(real_people), 1).otherwise(0), people.isNotNull().cast("int"),
        ),
        value("document_type", F.col("document_type"), F.coalesce(F.col("document_type"), nothing), F.col("document_type").isNotNull().cast("int")),
    )
    return rows.select(group, F.col(row).alias("row"), F.explode(given).alias("v")).select(group, "row", "v.*")


def _best(df: DataFrame, group: str) -> DataFrame:
    """(group, field, distinct values, candidates of each dependency class), by two aggregations with map-side combine."""
    values = df.groupBy(group, "field", "value", "class").agg(F.max("rank").alias("rank"), F.min("row").alias("row"))
    classes = values.groupBy(group, "field", "class").agg(
        F.max(F.struct("rank", (-F.col("row")).alias("minus"))).alias("best"), F.count("*").alias("n")
    )
    return classes.select(group, "field", "class", F.col("best.rank").alias("rank"), (-F.col("best.minus")).alias("row"), "n")


def branch_and_bound(bundles: list[list[tuple[float, str, int]]], excluded) -> tuple[float, list[int]]:
    """The choice of one (trust, class, row) of every bundle with the greatest sum of trusts.

    `excluded(i, a, j, b)`: the classes a of bundle i and b of bundle j contradict each other. If every choice
    contradicts, bundles later in order give way. Ties keep the choice found first, which has the smaller rows.
    """
    order = [sorted(b, key=lambda c: (-c[0], c[2])) for b in bundles]
    rest = [0.0] * (len(order) + 1)
    for i in range(len(order) - 1, -1, -1):
        rest[i] = rest[i + 1] + (order[i][0][0] if order[i] else 0.0)
    best: tuple[float, list[int]] = (float("-inf"), [])
    chosen: list[tuple[float, str, int]] = []

    def go(i: int, trust: float) -> None:
        nonlocal best
        if trust + rest[i] <= best[0]:
            return
        if i == len(order):
            best = (trust, [c[2] for c in chosen])
            return
        for c in order[i]:
            if not any(excluded(j, d[1], i, c[1]) for j, d in enumerate(chosen)):
                chosen.append(c)
                go(i + 1, trust + c[0])
                chosen.pop()

    go(0, 0.0)
    return best if best[1] or not order else (0.0, [b[0][2] for b in order])


def trusted(cells: list[tuple[tuple, str, int]], weight: float) -> list[tuple[float, str, int]]:
    """(trust, class, row) of the (rank, class, row) of one field; the first part of a rank is its grade."""
    ranked = sorted(cells, key=lambda c: (c[0], -c[2]), reverse=True)
    grades = sorted({c[0][0] for c in ranked}, reverse=True)
    return [(max(weight / 2 ** grades.index(rank[0]) - PLACE * k, 0.0), cls, row) for k, (rank, cls, row) in enumerate(ranked)]


def contradicts(i: int, a: str, j: int, b: str) -> bool:
    """Do the venue category and the record type of two chosen values exclude each other?"""
    chosen = {NAMES[i]: a, NAMES[j]: b}
    category, kind = chosen.get("venue"), chosen.get("document_type")
    return bool(category) and bool(kind) and kind not in ANY_TYPE and kind != category


def survivors(df: DataFrame, group: str, row: str, at: str, venues: DataFrame, last_year: int = LAST_YEAR, names: tuple = FIELDS) -> DataFrame:
    """(group, field, rec_id, n_values) for every group and each field of `names`: the row whose value survives.

    rec_id is null where a group keeps no record type, since every type contradicts its venue.
    """
    best = _best(_candidates(df, group, row, at, venues, last_year), group)

    def choose(lists: pd.Series) -> pd.Series:
        out = []
        for cells in lists:
            by: dict[str, list] = {n: [] for n in NAMES}
            for c in cells:
                by[c["field"]].append((tuple(c["rank"]), c["class"], int(c["row"])))
            bundles = [trusted(by[n], WEIGHT[n]) for n in NAMES]
            bundles[-1].append((0.0, "", -1))  # no type at all contradicts nothing
            rows = branch_and_bound(bundles, contradicts)[1]
            out.append([None if n == "document_type" and r == -1 else r for n, r in zip(NAMES, rows)])
        return pd.Series(out)

    cell = F.struct("field", "class", "rank", "row")
    grouped = best.groupBy(group).agg(
        F.collect_list(cell).alias("cells"),
        *[F.sum(F.when(F.col("field") == f, F.col("n"))).alias(f"n_{f}") for f in NAMES],
    )
    chosen = grouped.withColumn("rows", F.pandas_udf(choose, "array<long>")("cells"))
    fields = [
        F.struct(F.lit(f).alias("field"), F.col("rows")[i].alias("rec_id"), F.col(f"n_{f}").alias("n_values"))
        for i, f in enumerate(NAMES)
        if f in names
    ]
    return chosen.select(group, F.explode(F.array(*fields)).alias("f")).select(group, "f.*")


def golden(df: DataFrame, group: str, row: str, at: str, venues: DataFrame) -> DataFrame:
    """One record of each group: the best value of every field and a record type that agrees, and the row each came from."""
    chosen = survivors(df, group, row, at, venues, names=NAMES)
    wide = chosen.groupBy(group).agg(*[F.max(F.when(F.col("field") == f, F.col("rec_id"))).alias(f"{f}_rec") for f in NAMES])
    held = df.select(row, *[F.struct(f).alias(f) for f in NAMES])
    back = chosen.select(group, F.col("rec_id").alias(row), "field").join(held, row)
    # A struct around a value keeps a null that was chosen.
    cells = back.groupBy(group).agg(*[F.first(F.when(F.col("field") == f, F.col(f)), ignorenulls=True)[f].alias(f) for f in NAMES])
    return wide.join(cells, group)
