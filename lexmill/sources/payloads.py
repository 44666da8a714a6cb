"""Answers of services, kept as raw text: JSON and XML payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as X

OPENALEX = """id string, doi string, title string, publication_year int, cited_by_count int, language string, type string,
abstract_inverted_index map<string,array<int>>, open_access struct<is_oa:boolean,oa_url:string>, authorships array<struct<author:struct<display_name:string>>>,
primary_location struct<source:struct<display_name:string>>"""


def from_inverted(index: Column) -> Column:
    """The text of an index of words and their places."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("pos"), e["key"].alias("word")))))
    return F.coalesce(F.array_join(F.transform(F.array_sort(placed), lambda x: x["word"]), " "), F.lit(""))


def openalex_works(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Works of pages of results, or single works, as JSON; broken payloads give no row."""
    page = F.from_json(F.col(payload), f"results array<struct<{OPENALEX.replace(' string', ':string').replace(' int', ':int').replace(' map', ':map').replace(' struct', ':struct').replace(' array', ':array')}>>")
    works = F.when(page["results"].isNotNull(), page["results"]).otherwise(F.array(F.from_json(F.col(payload), OPENALEX)))
    flat = raw.select(F.explode(works).alias("w")).where(F.col("w.title").isNotNull())
    return flat.select(
        F.regexp_replace("w.id", "^.*/", "").alias("source_id"), X.normalize_doi(F.col("w.doi")).alias("doi"), F.col("w.title").alias("title"),
        from_inverted(F.col("w.abstract_inverted_index")).alias("abstract"), F.col("w.publication_year").alias("year"),
        F.transform("w.authorships", lambda a: a["author"]["display_name"]).alias("authors"), F.col("w.primary_location.source.display_name").alias("venue"),
        F.col("w.cited_by_count").alias("citation_count"), F.col("w.open_access.oa_url").alias("pdf_url"), F.col("w.language").alias("language"),
    )


def pubmed_articles(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Articles of an XML set; identifiers are the article's own, never those of its reference list."""
    articles = F.expr(f"regexp_extract_all({payload}, '(?s)(<PubmedArticle[ >].*?</PubmedArticle>)', 1)")
    rows = raw.select(F.explode(articles).alias("x"))

    def at(path: str) -> Column:
        return F.nullif(F.trim(F.expr(f"xpath_string(x, '{path}')")), F.lit(""))

    def all_at(path: str) -> Column:
        return F.expr(f"xpath(x, '{path}')")

    own = "/PubmedArticle/PubmedData/ArticleIdList/ArticleId"
    doi = F.coalesce(at(f'{own}[@IdType="doi"]'), at('/PubmedArticle/MedlineCitation/Article/ELocationID[@EIdType="doi"]'))
    base = "/PubmedArticle/MedlineCitation"
    year = F.coalesce(at(f"{base}/Article/Journal/JournalIssue/PubDate/Year"), F.regexp_extract(at(f"{base}/Article/Journal/JournalIssue/PubDate/MedlineDate"), r"(\d{4})", 1))
    names = F.zip_with(all_at(f"{base}/Article/AuthorList/Author/LastName/text()"), all_at(f"{base}/Article/AuthorList/Author/ForeName/text()"), lambda a, b: F.concat_ws(", ", a, b))
    keywords = F.array_sort(F.array_distinct(F.concat(all_at(f"{base}/KeywordList/Keyword/text()"), all_at(f"{base}/MeshHeadingList/MeshHeading/DescriptorName/text()"))))
    return rows.select(
        at(f"{base}/PMID").alias("pmid"), X.normalize_doi(doi).alias("doi"), at(f'{own}[@IdType="pmc"]').alias("pmcid"), at(f"{base}/Article/ArticleTitle").alias("title"),
        X.normalize_text(F.array_join(all_at(f"{base}/Article/Abstract/AbstractText/text()"), " ")).alias("abstract"), year.try_cast("int").alias("year"),
        names.alias("authors"), keywords.alias("keywords"), at(f"{base}/Article/Journal/Title").alias("venue"),
    )


def atom_entries(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Entries of an Atom feed, ids without versions."""
    plain = F.regexp_replace(F.col(payload), r'\sxmlns(:\w+)?="[^"]*"', "")
    rows = raw.select(F.explode(F.regexp_extract_all(plain, F.lit(r"(?s)(<entry>.*?</entry>)"), 1)).alias("x"))
    at = lambda p: X.normalize_text(F.expr(f"xpath_string(x, '{p}')"))
    return rows.select(
        X.arxiv_id(at("/entry/id")).alias("source_id"), at("/entry/title").alias("title"), at("/entry/summary").alias("abstract"),
        F.substring(at("/entry/published"), 1, 4).try_cast("int").alias("year"), F.expr("xpath(x, '/entry/author/name/text()')").alias("authors"),
    )


def latest_snapshots(store: DataFrame) -> DataFrame:
    """The latest payload of each (source, query); earlier ones stay in the append-only store."""
    return store.groupBy("source", F.substring(F.sha1("query"), 1, 12).alias("query_hash")).agg(
        F.max_by("payload", F.struct("fetched_at", "payload")).alias("payload"), F.max("fetched_at").alias("fetched_at")
    )


def balanced_json(text: str | None) -> str | None:
    """The first balanced JSON object or array in a text, for answers of models that wrap it in prose."""
    if not text:
        return None
    for start, open_ in ((i, c) for i, c in enumerate(text) if c in "{["):
        depth, quoted, escaped = 0, False, False
        for i in range(start, len(text)):
            c = text[i]
            if quoted:
                escaped = not escaped and c == "\\"
                if c == '"' and text[i - 1] != "\\":
                    quoted = False
            elif c == '"':
                quoted = True
            elif c in "{[":
                depth += 1
            elif c in "}]":
                depth -= 1
                if not depth:
                    return text[start : i + 1]
        return None
    return None
