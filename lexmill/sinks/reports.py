"""Reports as tables of lines, and their text.

A report is a DataFrame (part, place, line): the lines are made on the executors, and only a report of bounded size is
brought to the driver as text. Larger ones are written as text files, one for each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines that `as_text` brings to the driver; longer reports have to be written with `write`.
MOST_LINES = 20_000


def table_lines(df: DataFrame, part: str, order: list[Column], columns: list[str]) -> DataFrame:
    """Markdown lines of a table of counts, in order."""
    from pyspark.sql import Window

    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), F.lit(" |"))
    rows = df.select(F.lit(part).alias("part"), (F.row_number().over(Window.orderBy(*order)) + 2).cast("long").alias("place"), cells.alias("line"))
    head = [(part, 1, f"| {' | '.join(columns)} |"), (part, 2, f"|{'---|' * len(columns)}")]
    return df.sparkSession.createDataFrame(head, "part string, place long, line string").unionByName(rows)


def bullet_lines(df: DataFrame, part: str, place: Column, text: Column) -> DataFrame:
    return df.select(F.lit(part).alias("part"), place.cast("long").alias("place"), F.concat(F.lit("- "), text).alias("line"))


def as_text(report: DataFrame) -> str:
    """The report's text; refuses reports that are too long for the driver."""
    rows = report.orderBy("part", "place").limit(MOST_LINES + 1).collect()
    if len(rows) > MOST_LINES:
        raise ValueError("the report is too long for the driver; use write")
    out, part = [], None
    for r in rows:
        if r.part != part:
            out += ([""] if out else []) + [f"## {r.part}", ""]
            part = r.part
        out.append(r.line)
    return "\n".join(out) + "\n"


def write(report: DataFrame, path: str) -> None:
    """One folder of sorted text for each part."""
    sorted_ = report.repartition("part").sortWithinPartitions("part", "place").select("part", F.col("line").alias("value"))
    sorted_.write.mode("overwrite").partitionBy("part").text(path)


def bibtex_text(df: DataFrame) -> DataFrame:
    """(key, entry) of records with kind, key, title, authors, year, venue and doi; empty fields are left out."""
    def line(name: str, value: Column) -> Column:
        return F.when(F.trim(value) != "", F.concat(F.lit(f"  {name} = {{"), F.regexp_replace(value, r"[{}]", ""), F.lit("},\n"))).otherwise("")

    place = F.when(F.col("kind") == "inproceedings", line("booktitle", F.col("venue"))).otherwise(line("journal", F.col("venue")))
    body = F.concat(
        line("title", F.coalesce("title", F.lit(""))), line("author", F.coalesce(F.array_join("authors", " and "), F.lit(""))),
        line("year", F.coalesce(F.col("year").cast("string"), F.lit(""))), F.coalesce(place, F.lit("")), line("doi", F.coalesce("doi", F.lit(""))),
    )
    return df.select("key", F.concat(F.lit("@"), F.col("kind"), F.lit("{"), F.col("key"), F.lit(",\n"), body, F.lit("}\n")).alias("entry"))


def selection_report(canonical: DataFrame) -> DataFrame:
    """Counts by source, by year and by reason of exclusion."""
    by_source = canonical.groupBy("source").agg(F.count("*").alias("records"), F.count_distinct("paper_id").alias("papers"))
    years = canonical.where(F.col("year").between(1900, 2025)).groupBy("year").agg(F.count("*").alias("records"))
    return table_lines(by_source, "Records by source", [F.desc("records"), F.col("source")], ["source", "records", "papers"]).unionByName(
        table_lines(years, "Records by year", [F.desc("year")], ["year", "records"])
    )


def evidence_cards(evidences: DataFrame, concepts: DataFrame, top: int = 3) -> DataFrame:
    """Of each concept its best passages of different papers, ready to print."""
    from lexmill.operators.ranking import top_per_group

    good = evidences.where(F.col("similarity").between(0.35, 1.0) & (F.trim("text") != ""))
    best = good.groupBy("concept_id", "doc_id").agg(F.max_by(F.struct("text", "evidence_id", "similarity"), F.struct("similarity", -F.col("evidence_id"))).alias("b"))
    ranked = top_per_group(best.select("concept_id", "doc_id", "b.*"), ["concept_id"], [F.desc("similarity"), F.col("evidence_id")], top)
    named = ranked.join(concepts.select("concept_id", "concept_name"), "concept_id")
    line = F.concat(F.lit("- "), F.col("text"), F.lit(" ["), F.col("doc_id"), F.lit("]"))
    return named.select(F.concat_ws(" ", F.lpad(F.col("concept_id").cast("string"), 3, "0"), "concept_name").alias("part"), F.col("rank").cast("long").alias("place"), line.alias("line"))


def notebooks(packed: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Blocks of packed papers (text_id, container), their text cut to a number of words."""
    from lexmill.functions import text as X

    body = F.when(X.word_count(F.col("full_text")) > words, X.first_words(F.col("full_text"), words)).otherwise(F.col("full_text"))
    block = F.concat(F.lit("TITLE: "), F.coalesce("title", F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit("")))
    return packed.join(texts, "text_id").select(F.concat(F.lit("notebook "), F.col("container").cast("string")).alias("part"), F.col("place"), block.alias("line"))
