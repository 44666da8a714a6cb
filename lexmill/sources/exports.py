"""Exports in delimited files, read into one set of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as X

SHORT_ABSTRACT = 100
#: The column of each export that holds each field; the first that is there and not blank counts.
COLUMNS = {
    "wos": {"title": ["TI"], "abstract": ["AB"], "doi": ["DI"], "year": ["PY"], "venue": ["SO"], "authors": ["AU"], "keywords": ["DE", "ID"],
            "document_type": ["DT", "PT"], "language": ["LA"], "pmid": ["PM"], "citation_count": ["TC"]},
    "scopus": {"title": ["Title"], "abstract": ["Abstract"], "doi": ["DOI"], "year": ["Year"], "venue": ["Source title"], "authors": ["Authors"],
               "keywords": ["Author Keywords"], "document_type": ["Document Type"], "language": ["Language of Original Document"],
               "pmid": ["PubMed ID"], "citation_count": ["Cited by"]},
    "ieee": {"title": ["Document Title"], "abstract": ["Abstract"], "doi": ["DOI"], "year": ["Publication Year"],
             "venue": ["Publication Title", "Conference"], "authors": ["Authors"], "keywords": ["Author Keywords"],
             "document_type": ["Document Identifier"], "citation_count": ["Article Citation Count"]},
    "acm": {"title": ["Titulo"], "abstract": ["Abstract"], "doi": ["DOI"], "venue": ["Proceedings", "Venue"]},
    "arxiv": {"title": ["Titulo"], "abstract": ["Abstract"], "doi": ["DOI"], "landing_page": ["URL"], "source_id": ["arXiv_ID"]},
    "scholar": {"title": ["Title"], "abstract": ["Abstract"], "doi": ["DOI"], "year": ["Year"], "venue": ["Source"], "authors": ["Authors"],
                "citation_count": ["Cites"]},
}
DELIMITER = {"wos": "\t", "scopus": ",", "ieee": ",", "acm": ";", "arxiv": ";", "scholar": ","}
AUTHOR_SEPARATOR = {"wos": ";", "scopus": ";", "ieee": ";", "scholar": ","}


def read_export(spark: SparkSession, source: str, path: str) -> DataFrame:
    """The records of all of a source's files under a path or glob."""
    raw = (
        spark.read.option("header", True).option("sep", DELIMITER[source]).option("multiLine", source != "wos").option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    )
    clean = {c: c.replace("\ufeff", "").strip() for c in raw.columns}
    return export_records(raw.toDF(*clean.values()).withColumn("file", F.input_file_name()), source)


def export_records(raw: DataFrame, source: str) -> DataFrame:
    """The common columns of an export's rows; rows without a title of five characters are skipped."""
    names = COLUMNS[source]

    def field(name: str) -> Column:
        held = [F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in names.get(name, []) if c in raw.columns]
        return F.coalesce(*held) if held else F.lit(None).cast("string")

    abstract = X.normalize_text(field("abstract"))
    if source == "ieee":
        abstract = X.strip_prefixes(abstract, X.ABSTRACT_PREFIXES[:1])
    authors = F.split(F.coalesce(field("authors"), F.lit("")), AUTHOR_SEPARATOR.get(source, ";"))
    if source == "wos":
        held = [F.coalesce(F.col(c), F.lit("")) for c in names["keywords"] if c in raw.columns]
        packed = F.concat_ws(";", *held) if held else F.lit("")
        keywords = F.array_sort(F.array_distinct(X.split_keywords(packed)))
    else:
        keywords = X.split_keywords(F.coalesce(field("keywords"), F.lit("")))
    doi = X.normalize_doi(field("doi"))
    page = F.coalesce(field("landing_page"), F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)))
    title = X.normalize_text(field("title"))
    return raw.select(
        F.lit(source).alias("source"), title.alias("title"), X.normalized_title(title).alias("normalized_title"), abstract.alias("abstract"),
        (X.needs_recovery(abstract) | (F.length(abstract) < SHORT_ABSTRACT)).alias("abstract_truncated"),
        F.filter(F.transform(authors, lambda a: F.trim(a)), lambda a: a != "").alias("authors"), keywords.alias("keywords"),
        X.safe_int(field("year")).alias("year"), X.normalize_text(field("venue")).alias("venue"), doi.alias("doi"),
        F.coalesce(field("document_type"), F.lit("article")).alias("document_type"), F.coalesce(field("language"), F.lit("unknown")).alias("language"),
        field("pmid").alias("pmid"), X.safe_int(field("citation_count")).alias("citation_count"), page.alias("landing_page"),
        F.replace(page, F.lit("/abs/"), F.lit("/pdf/")).alias("pdf_url") if source == "arxiv" else F.lit(None).cast("string").alias("pdf_url"),
        X.arxiv_id(field("source_id")).alias("source_id") if source == "arxiv" else F.lit(None).cast("string").alias("source_id"),
    ).where(F.length("title") >= 5)


def number_sources(records: DataFrame, order: list[str]) -> DataFrame:
    """Running ids `{source}_{n}` over all files of a source; skipped rows leave no gap."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("source").orderBy(*order))
    return records.withColumn("paper_id", F.concat_ws("_", "source", place.cast("string")))
