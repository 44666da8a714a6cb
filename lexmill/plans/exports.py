"""Exports and payloads: tables written in the form of each source, read by its reader, and held against the tables.

The SQL twins say directly what a reader must give; they share nothing with the readers.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.plans.base import Plans
from lexmill.session import table
from lexmill.sources import exports, manuscripts, news, payloads, tagged

plans = Plans()
QUERIES, SQL, query = plans.queries, plans.sql, plans.query

_LINE = r"coalesce(trim(regexp_replace({0}, '[ \t\n\r\f\x0b\x{{00a0}}]+', ' ', 'g')), '')"
_KEYS = """list_filter(list_transform(CASE WHEN contains({0}, ';') THEN string_split({0}, ';') WHEN contains({0}, '|') THEN string_split({0}, '|')
 ELSE string_split({0}, ',') END, lambda x: trim(x)), lambda x: x <> '')"""
_AUTHORS = "list_filter(list_transform(string_split(coalesce(trim({0}), ''), '{1}'), lambda x: trim(x)), lambda x: x <> '')"


def _line(x: str) -> str:
    return _LINE.format(x)


def _delimited(rows: DataFrame, columns: dict[str, Column], separator: str) -> DataFrame:
    """The columns written as one delimited line and read again, with quotes around what needs them."""
    options = {"sep": separator, "quote": '"', "escape": '"', "emptyValue": ""}
    row = F.struct(*[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in columns.items()])
    schema = ", ".join(f"`{n}` string" for n in columns)
    line = rows.select(F.to_csv(row, options).alias("line"))
    return line.select(F.from_csv("line", F.lit(schema), options).alias("r")).select("r.*")


def _flat(name: str) -> Column:
    """A text without the line ends that a line of an export cannot hold."""
    return F.regexp_replace(F.col(name), "[\r\n]+", " ")


@query(
    "export_scopus",
    f"""SELECT hit_id::VARCHAR AS pmid, {_line('title')} AS title, md5({_line('abstract')}) AS abstract_md5, {_AUTHORS.format('authors_', ';')} AS authors,
{_KEYS.format('keywords_')} AS keywords, year, {_line('venue')} AS venue FROM (
SELECT *, regexp_replace(authors, '[\\r\\n]+', ' ', 'g') AS authors_, coalesce(trim(regexp_replace(keywords, '[\\r\\n]+', ' ', 'g')), '') AS keywords_ FROM search_records) WHERE length({_line('title')}) >= 5""",
)
def export_scopus(spark: SparkSession, sf: str) -> DataFrame:
    hits = table(spark, sf, "search_records")
    raw = _delimited(
        hits,
        {"Title": _flat("title"), "Abstract": _flat("abstract"), "DOI": F.col("doi"), "Year": F.col("year"), "Source title": F.col("venue"), "Authors": _flat("authors"),
         "Author Keywords": _flat("keywords"), "PubMed ID": F.col("hit_id")},
        ",",
    )
    return exports.export_records(raw, "scopus").select("pmid", "title", F.md5("abstract").alias("abstract_md5"), "authors", "keywords", "year", "venue")


@query(
    "export_wos",
    f"""SELECT hit_id::VARCHAR AS pmid, {_line('title')} AS title, {_AUTHORS.format('authors_', ';')} AS authors,
list_sort(list_distinct({_KEYS.format('both_')})) AS keywords, year FROM (
SELECT *, regexp_replace(authors, '[\\r\\n\\t]+', ' ', 'g') AS authors_, coalesce(trim(regexp_replace(keywords, '[\\r\\n\\t]+', ' ', 'g')), '') || ';' || coalesce(trim(venue), '') AS both_
FROM search_records) WHERE length({_line('title')}) >= 5""",
)
def export_wos(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-separated; keywords of two columns, joined, sorted and distinct."""
    flat = lambda c: F.regexp_replace(F.col(c), "[\r\n\t]+", " ")
    raw = _delimited(
        table(spark, sf, "search_records"),
        {"TI": flat("title"), "AB": flat("abstract"), "DI": F.col("doi"), "PY": F.col("year"), "AU": flat("authors"), "DE": F.trim(flat("keywords")), "ID": F.trim(flat("venue")),
         "PM": F.col("hit_id")},
        "\t",
    )
    return exports.export_records(raw, "wos").select("pmid", "title", "authors", "keywords", "year")


@query(
    "export_ieee",
    f"""SELECT hit_id::INT AS citation_count, {_line('title')} AS title, md5(regexp_replace({_line('abstract')}, '^abstract[\\s:.—-]*', '', 'i')) AS abstract_md5,
CASE WHEN coalesce(trim(venue), '') <> '' THEN {_line('venue')} ELSE source END AS venue FROM search_records WHERE length({_line('title')}) >= 5""",
)
def export_ieee(spark: SparkSession, sf: str) -> DataFrame:
    """Leading "Abstract" is stripped; the conference stands in for a missing publication."""
    raw = _delimited(
        table(spark, sf, "search_records"),
        {"Document Title": _flat("title"), "Abstract": _flat("abstract"), "Publication Title": F.col("venue"), "Conference": F.col("source"), "Article Citation Count": F.col("hit_id")},
        ",",
    )
    return exports.export_records(raw, "ieee").select("citation_count", "title", F.md5("abstract").alias("abstract_md5"), "venue")


@query(
    "export_acm",
    f"""SELECT '10.1000/h' || hit_id AS doi, {_line('title')} AS title,
(abstract IS NULL OR {_line('abstract')} = '' OR contains({_line('abstract')}, '…') OR {_line('abstract')} LIKE '%...' OR length({_line('abstract')}) < 100) AS abstract_truncated
FROM search_records WHERE length({_line('title')}) >= 5""",
)
def export_acm(spark: SparkSession, sf: str) -> DataFrame:
    """Separated by semicolons; short and visibly cut abstracts are marked."""
    raw = _delimited(
        table(spark, sf, "search_records"),
        {"Titulo": _flat("title"), "Abstract": _flat("abstract"), "DOI": F.concat(F.lit("https://doi.org/10.1000/H"), F.col("hit_id").cast("string"))},
        ";",
    )
    return exports.export_records(raw, "acm").select("doi", "title", "abstract_truncated")


@query(
    "export_arxiv",
    f"""SELECT (1000 + hit_id % 9000)::VARCHAR || '.' || hit_id AS source_id, {_line('title')} AS title,
'https://arxiv.org/pdf/' || (1000 + hit_id % 9000) || '.' || hit_id || 'v2' AS pdf_url FROM search_records WHERE length({_line('title')}) >= 5""",
)
def export_arxiv(spark: SparkSession, sf: str) -> DataFrame:
    """Ids without prefix and version; the page's address gives that of the file."""
    own = F.concat((F.lit(1000) + F.col("hit_id") % 9000).cast("string"), F.lit("."), F.col("hit_id").cast("string"))
    raw = _delimited(
        table(spark, sf, "search_records"),
        {"Titulo": _flat("title"), "URL": F.concat(F.lit("https://arxiv.org/abs/"), own, F.lit("v2")), "arXiv_ID": F.concat(F.lit("arXiv:"), own, F.lit("v2"))},
        ";",
    )
    return exports.export_records(raw, "arxiv").select("source_id", "title", "pdf_url")


@query(
    "export_scholar",
    f"""SELECT hit_id::INT AS citation_count, {_line('title')} AS title, {_AUTHORS.format("regexp_replace(authors, '[\\r\\n]+', ' ', 'g')", ',')} AS authors, year
FROM search_records WHERE length({_line('title')}) >= 5""",
)
def export_scholar(spark: SparkSession, sf: str) -> DataFrame:
    raw = _delimited(
        table(spark, sf, "search_records"),
        {"Title": _flat("title"), "Year": F.col("year"), "Authors": _flat("authors"), "Cites": F.col("hit_id")},
        ",",
    )
    return exports.export_records(raw, "scholar").select("citation_count", "title", "authors", "year")


@query(
    "export_sniffed",
    """SELECT hit_id, CASE WHEN hit_id % 3 = 0 THEN 'tsv' ELSE 'tagged' END AS kind FROM search_records""",
)
def export_sniffed(spark: SparkSession, sf: str) -> DataFrame:
    """Which form a file has, by its first line."""
    line = F.when(F.col("hit_id") % 3 == 0, F.lit("﻿PT\tAU\tTI\tSO\tAB\tDI")).when(F.col("hit_id") % 3 == 1, F.lit("PT J")).otherwise(F.lit("a\tb\tc\td\te\tf"))
    return table(spark, sf, "search_records").select("hit_id", tagged.sniff(line).alias("kind"))


@query(
    "export_medline",
    f"""WITH r AS (SELECT hit_id, {_line('title')} AS t, {_line('abstract')} AS a, year, doi FROM search_records)
SELECT hit_id::VARCHAR AS pmid, md5(a) AS abstract_md5, ['Doe, Ann', 'Roe, Bob'] AS authors, year, '10.1000/m' || hit_id AS doi FROM r
WHERE length(trim(regexp_replace(regexp_replace(lower(strip_accents(t)), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))) >= 10 AND length(a) >= 50""",
)
def export_medline(spark: SparkSession, sf: str) -> DataFrame:
    """Dashed tags with lines that go on; full names before short ones; the doi is the first word of its line."""
    one = lambda c: F.coalesce(F.trim(F.regexp_replace(F.col(c), r"[ \t\n\r\f\x0b\x{00a0}]+", " ")), F.lit(""))
    text = one("abstract")
    at = F.coalesce(F.nullif(F.locate(" ", text, 60), F.lit(0)), F.length(text) + 1)
    broken = F.concat(F.substr(text, F.lit(1), at - 1), F.lit("\n      "), F.substr(text, at + 1))
    record = F.concat(
        F.lit("PMID- "), F.col("hit_id").cast("string"), F.lit("\nTI  - "), one("title"), F.lit("\nAB  - "), broken,
        F.lit("\nFAU - Doe, Ann\nAU  - Doe A\nFAU - Roe, Bob\nLID - 10.1000/M"), F.col("hit_id").cast("string"), F.lit(" [doi]\nDP  - "), F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit(" Jan"),
    )
    return tagged.dashed_records(table(spark, sf, "search_records").select(record.alias("record"))).select("pmid", F.md5("abstract").alias("abstract_md5"), "authors", "year", "doi")


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


_PRINTABLE = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


@query(
    "payload_pubmed",
    f"""SELECT rec_id::VARCHAR AS pmid, '10.1000/own' || rec_id AS doi, {_line('abstract')} <> '' AS has_abstract,
CASE WHEN rec_id % 2 = 0 THEN year ELSE try_cast(nullif(regexp_extract(year::VARCHAR, '([0-9]{{4}})', 1), '') AS INT) END AS year FROM canonical WHERE title IS NOT NULL""",
)
def payload_pubmed(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers are the article's own, not those of the papers it cites; a missing year comes from the free date."""
    clean = lambda c: _escaped(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), _PRINTABLE, ""))
    key = F.col("rec_id").cast("string")
    date = F.when(F.col("rec_id") % 2 == 0, F.concat(F.lit("<Year>"), F.col("year").cast("string"), F.lit("</Year>"))).otherwise(
        F.concat(F.lit("<MedlineDate>"), F.col("year").cast("string"), F.lit(" Jan-Feb</MedlineDate>"))
    )
    xml = F.concat(
        F.lit("<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>"), key, F.lit("</PMID><Article><Journal><JournalIssue><PubDate>"), F.coalesce(date, F.lit("")),
        F.lit("</PubDate></JournalIssue></Journal><ArticleTitle>"), clean("title"), F.lit("</ArticleTitle><Abstract><AbstractText>"), clean("abstract"),
        F.lit("</AbstractText></Abstract></Article></MedlineCitation><PubmedData><ReferenceList><Reference><ArticleIdList><ArticleId IdType=\"doi\">10.9/cited</ArticleId></ArticleIdList></Reference></ReferenceList>"
              "<ArticleIdList><ArticleId IdType=\"doi\">10.1000/OWN"), key, F.lit("</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"),
    )
    rows = table(spark, sf, "canonical").where(F.col("title").isNotNull()).select(xml.alias("payload"))
    return payloads.pubmed_articles(rows).select("pmid", "doi", (F.col("abstract") != "").alias("has_abstract"), "year")


@query("payload_atom", "SELECT (1000 + rec_id % 9000)::VARCHAR || '.' || rec_id AS source_id, try_cast(left(year || '-01', 4) AS INT) AS year, ['Ann Doe', 'Bob Roe'] AS authors FROM canonical WHERE title IS NOT NULL")
def payload_atom(spark: SparkSession, sf: str) -> DataFrame:
    own = F.concat((F.lit(1000) + F.col("rec_id") % 9000).cast("string"), F.lit("."), F.col("rec_id").cast("string"))
    clean = lambda c: _escaped(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), _PRINTABLE, ""))
    xml = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/'), own, F.lit("v3</id><title>"), clean("title"), F.lit("</title><published>"),
        F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit("-01-02T00:00:00Z</published><author><name>Ann Doe</name></author><author><name>Bob Roe</name></author></entry></feed>"),
    )
    rows = table(spark, sf, "canonical").where(F.col("title").isNotNull()).select(xml.alias("payload"))
    return payloads.atom_entries(rows).select("source_id", "year", "authors")


@query(
    "payload_json_found",
    "SELECT rec_id, '{\"n\": ' || rec_id || ', \"deep\": {\"quote\": \"a } brace\"}}' AS found FROM canonical",
)
def payload_json_found(spark: SparkSession, sf: str) -> DataFrame:
    """The first balanced object in an answer that wraps it in prose."""
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(payloads.balanced_json)

    key = F.col("rec_id").cast("string")
    answer = F.concat(F.lit("Sure, here it is:\n```json\n"), F.lit('{"n": '), key, F.lit(', "deep": {"quote": "a } brace"}}'), F.lit("\n``` and [more]"))
    return table(spark, sf, "canonical").select("rec_id", F.pandas_udf(run, "string")(answer).alias("found"))


@query(
    "bibtex_read",
    f"""SELECT 'k' || rec_id AS key, 'article' AS kind, year::VARCHAR AS year, 'Notes, {{with}} commas'.replace('{{', '').replace('}}', '') AS note FROM canonical WHERE year IS NOT NULL
UNION ALL SELECT 'c' || rec_id, 'inproceedings', NULL, 'of k' || rec_id FROM canonical WHERE year IS NOT NULL""",
)
def bibtex_read(spark: SparkSession, sf: str) -> DataFrame:
    """Entries with nested braces and quotes; a cross-referenced entry lends its title."""
    key = F.col("rec_id").cast("string")
    text = F.concat(
        F.lit("@comment{ignored}\n@article{k"), key, F.lit(", title = {of k"), key, F.lit("}, year = "), F.col("year").cast("string"), F.lit(', note = "Notes, {with} commas"}\n@inproceedings{c'), key,
        F.lit(", crossref = {k"), key, F.lit("}}\n"),
    )
    read = manuscripts.read_bibtex(table(spark, sf, "canonical").where(F.col("year").isNotNull()).select(text.alias("text")))
    field = lambda n: F.try_element_at("fields", F.lit(n))
    return read.select("key", "kind", field("year").alias("year"), F.coalesce(field("note"), field("booktitle")).alias("note"))


@query(
    "citation_contexts_read",
    """WITH r AS (SELECT rec_id, unnest(['a', 'b', 'c']) AS x FROM canonical)
SELECT x || rec_id AS key, CASE x WHEN 'c' THEN 'As in \\parencite[p. 3]{c' || rec_id || '}, it helps.' ELSE 'See e.g. \\citep{a' || rec_id || ', b' || rec_id || '} for number ' || rec_id || '.' END AS context FROM r""",
)
def citation_contexts_read(spark: SparkSession, sf: str) -> DataFrame:
    """The sentence around each citation, whatever command cites; abbreviations do not end a sentence."""
    key = F.col("rec_id").cast("string")
    text = F.concat(
        F.lit("First sentence. See e.g. \\citep{a"), key, F.lit(", b"), key, F.lit("} for number "), key, F.lit(". As in \\parencite[p. 3]{c"), key, F.lit("}, it helps. Last one."),
    )
    return manuscripts.read_contexts(table(spark, sf, "canonical").select(text.alias("text")))


@query(
    "news_read",
    f"""SELECT 'u' || doc_id AS url, least(length(t), 5000)::INT AS n FROM (
SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL) WHERE length(t) >= 100""",
)
def news_read(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of a JSON answer: markup goes, short ones are dropped, long ones keep their first 5,000 characters."""
    plain = F.trim(F.regexp_replace(F.regexp_replace("text", "[^a-zA-Z0-9 ]", " "), " +", " "))
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull())
    article = F.struct(F.lit("t").alias("title"), F.concat(F.lit("<b>"), plain, F.lit("</b>")).alias("description"), F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("url"))
    answer = F.to_json(F.struct(F.array(article).alias("articles")))
    return news.json_articles(rows.select(answer.alias("payload"))).select("url", F.length("text").alias("n"))
