"""Exports of tagged records: one tag a line, indented lines go on with the tag before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as X

#: Tags of the two formats: a letter and one to three more, or two to four letters before a dash.
PLAIN = r"^([A-Z][A-Z0-9]{1,3})\s+(.*)$"
DASHED = r"^([A-Za-z]{2,4})\s*[-–]\s*(.*)$"


def sniff(first_line: Column) -> Column:
    """'tsv' if the first line has at least five tab fields and begins with a known tag, else 'tagged'."""
    cells = F.split(first_line, "\t")
    known = F.regexp_replace(cells[0], "[\ufeff ]", "").isin("PT", "AU", "TI", "SO", "AB", "DI", "UT")
    return F.when((F.size(cells) >= 5) & known, "tsv").otherwise("tagged")


def read_records(spark: SparkSession, path: str, separator: str = "\nER\n") -> DataFrame:
    """(record, file): the records of all files under a path or glob."""
    return spark.read.text(path, lineSep=separator).select(F.col("value").alias("record"), F.input_file_name().alias("file"))


def tag_lines(record: Column, pattern: str) -> Column:
    """Array of (tag, value) of a record's lines, continuation lines with the tag before them; one pass over the lines."""
    lines = F.split(F.regexp_replace(record, "\r", ""), "\n")
    cell = "array<struct<tag:string,value:string>>"
    start = F.struct(F.lit("").alias("tag"), F.array().cast(cell).alias("items"))

    def step(state: Column, line: Column) -> Column:
        tag = F.upper(F.regexp_extract(line, pattern, 1))
        here = F.when(tag != "", tag).otherwise(state["tag"])
        value = F.when(tag != "", F.trim(F.regexp_extract(line, pattern, 2))).otherwise(F.trim(line))
        keep = (here != "") & (value != "")
        items = F.when(keep, F.concat(state["items"], F.array(F.struct(here.alias("tag"), value.alias("value"))))).otherwise(state["items"])
        return F.struct(here.alias("tag"), items.alias("items"))

    return F.aggregate(lines, start, step)["items"]


def values(items: Column, tag: str) -> Column:
    return F.transform(F.filter(items, lambda x: x["tag"] == tag), lambda x: x["value"])


def joined(items: Column, tag: str) -> Column:
    return X.normalize_text(F.array_join(values(items, tag), " "))


def plain_records(records: DataFrame) -> DataFrame:
    """Records of the plain format: authors one a line, texts joined, keywords of both fields sorted and distinct."""
    rows = records.withColumn("items", tag_lines(F.col("record"), PLAIN))
    items = F.col("items")
    keywords = F.split(F.concat_ws(";", F.array_join(values(items, "DE"), " "), F.array_join(values(items, "ID"), " ")), ";")
    doi = X.normalize_doi(F.array_join(values(items, "DI"), ""))
    return rows.select(
        X.normalized_title(joined(items, "TI")).alias("title"), joined(items, "AB").alias("abstract"), values(items, "AU").alias("authors"),
        F.array_sort(F.array_distinct(F.filter(F.transform(keywords, lambda k: F.trim(k)), lambda k: k != ""))).alias("keywords"),
        X.safe_int(joined(items, "PY")).alias("year"), joined(items, "SO").alias("venue"), doi.alias("doi"), joined(items, "LA").alias("language"),
        F.nullif(joined(items, "PM"), F.lit("")).alias("pmid"), F.nullif(joined(items, "UT"), F.lit("")).alias("accession_number"),
    ).where(F.length("title") >= 5)


def dashed_records(records: DataFrame) -> DataFrame:
    """Records of the dashed format; records with a short title or abstract are skipped, as the service's stubs are."""
    rows = records.withColumn("items", tag_lines(F.col("record"), DASHED))
    items = F.col("items")
    full, short = values(items, "FAU"), values(items, "AU")
    return rows.select(
        X.normalized_title(joined(items, "TI")).alias("title"), joined(items, "AB").alias("abstract"),
        F.when(F.size(full) > 0, full).otherwise(short).alias("authors"), values(items, "MH").alias("keywords"),
        F.regexp_extract(joined(items, "DP"), r"(\d{4})", 1).try_cast("int").alias("year"), joined(items, "JT").alias("venue"),
        X.normalize_doi(F.split(joined(items, "LID"), " ")[0]).alias("doi"), F.nullif(joined(items, "PMID"), F.lit("")).alias("pmid"),
    ).where((F.length("title") >= 10) & (F.length("abstract") >= 50))
