"""News articles from JSON answers and RSS feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as X

LEAST_TEXT, MOST_TEXT = 100, 5000


def _articles(rows: DataFrame) -> DataFrame:
    text = X.normalize_text(F.regexp_replace("text", "<[^<>]*>", " "))
    return rows.select(
        F.substring(F.md5(F.coalesce("url", "title")), 1, 8).alias("doc_id"), X.normalize_text(F.col("title")).alias("title"),
        F.substring(text, 1, MOST_TEXT).alias("text"), "url", "published",
    ).where(F.length("text") >= LEAST_TEXT)


def json_articles(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Articles of answers {articles: [{title, description, content, url, publishedAt}]}; short ones are dropped."""
    schema = "articles array<struct<title:string,description:string,content:string,url:string,publishedAt:string>>"
    flat = raw.select(F.explode(F.from_json(F.col(payload), schema)["articles"]).alias("a"))
    return _articles(flat.select("a.title", F.concat_ws(" ", "a.description", "a.content").alias("text"), "a.url", F.col("a.publishedAt").alias("published")))


def rss_articles(raw: DataFrame, payload: str = "payload") -> DataFrame:
    items = raw.select(F.explode(F.regexp_extract_all(F.col(payload), F.lit(r"(?s)(<item>.*?</item>)"), 1)).alias("x"))
    at = lambda p: F.expr(f"xpath_string(x, '/item/{p}')")
    return _articles(items.select(at("title").alias("title"), at("description").alias("text"), at("link").alias("url"), at("pubDate").alias("published")))


def degrade(api: DataFrame | None, files: DataFrame) -> DataFrame:
    """What a service returned, else what its files hold: the rows of the first that has any."""
    if api is None or api.isEmpty():
        return files.withColumn("origin", F.lit("file"))
    return api.withColumn("origin", F.lit("api"))
