"""Texts that stop before their end, found from word trigrams in pure SQL.

Over all distinct texts the operator counts, for every trigram, how often it is followed by more words of its sentence
and how often it closes one. The last trigram of each text is joined with these counts:

* the trigram goes on elsewhere, or its last word is the beginning of a longer word that follows the same two words,
  but it almost never closes a sentence: the text was cut;
* it was never seen elsewhere: the last two words decide, then the last word;
* nothing is known of the last word: the text was cut, unless several different texts end alike.

A visible mark of cutting (ellipsis, "[truncated]", a torn entity or character) also shows a cut, and so does a bracket
that never closes in a text that ends without a sentence mark. A text that ends with a sentence mark counts as whole unless its last trigram goes on often elsewhere and
never closes any sentence.

Defined results: null, blank and filler texts are not cut; copies of a text count once in the statistics and get the
same answer; a text of one or two words is judged by these; an empty table gives an empty result; other columns and
their names do not matter, since only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lexmill.session import cut as keep_cut

#: What stands for a missing text.
FILLER = r"^\W*(no abstract( is)?( available)?|(the )?abstract( is)?( not available| unavailable| missing|:? none)|not available|none|null|n/?a|tba|tbd)?\W*$"
#: Visible marks of a cut at the end of a text.
MARK = r"(\.\.\.|…|[\[(]\s*(\.\.\.|…|[a-z ]*(truncated|abridged|continued|cut|more)[a-z0-9 ]*)\s*[\])]|read more|�|&[a-z]{0,6}|&#[0-9]{0,5}|<[a-z/]{0,6})\s*$"
STOP_MARK = r"[.!?][\"')\]”’]*\s*$"
#: A last trigram shows a cut if it closes at most this share of what is seen of it.
MOST_CLOSING = 0.1
#: Sentence-marked ends need this many continuations, and no closing elsewhere, to be doubted.
LEAST_DOUBT = 5
#: So many different texts with the same last words show a usual ending.
USUAL = 3

_WORDS = r"""
WITH texts AS (
  SELECT __text, lower(__text) AS low FROM {source} WHERE __text IS NOT NULL GROUP BY __text
), judged AS (
  SELECT __text, low, md5(__text) AS id,
         low RLIKE :mark AS marked,
         low RLIKE :stop AS stopped,
         length(regexp_replace(low, '[^(]', '')) > length(regexp_replace(low, '[^)]', '')) AS open
  FROM texts WHERE NOT low RLIKE :filler
), words AS (
  SELECT id, marked, stopped, open,
         filter(transform(split(regexp_replace(low, :mark, ''), '\\s+'),
           w -> struct(regexp_replace(regexp_replace(regexp_replace(w, '[0-9]+', '#'), '^[^\\p{{L}}\\p{{N}}#]+', ''), '[^\\p{{L}}\\p{{N}}#%]+$', '') AS w,
                       w RLIKE '[.!?][\"\')\\]”’]*$' AS s)), x -> x.w <> '') AS ws
  FROM judged
)
SELECT * FROM words WHERE size(ws) > 0
"""

_GRAMS = r"""
WITH placed AS (
  SELECT id, size(ws) AS n, p.pos AS pos, p.col.w AS c, p.col.s AS s,
         CASE WHEN p.pos > 0 THEN ws[p.pos - 1].w ELSE '' END AS b,
         CASE WHEN p.pos > 1 THEN ws[p.pos - 2].w ELSE '' END AS a
  FROM __cut_words LATERAL VIEW posexplode(ws) p AS pos, col
)
SELECT a, b, c, count_if(NOT s AND pos < n - 1) AS goes, count_if(s) AS closes, count_if(NOT s AND pos = n - 1) AS bare
FROM placed GROUP BY a, b, c
"""

# A torn word meets the longer words that begin like it; they share their first letter, which splits frequent contexts.
_DECIDED = r"""
WITH finals AS (
  SELECT id, marked, stopped, open AND NOT stopped AS open, ws[size(ws) - 1].w AS c,
         CASE WHEN size(ws) > 1 THEN ws[size(ws) - 2].w ELSE '' END AS b,
         CASE WHEN size(ws) > 2 THEN ws[size(ws) - 3].w ELSE '' END AS a
  FROM __cut_words
), pairs AS (
  SELECT b, c, sum(goes) AS goes, sum(closes) AS closes, sum(bare) AS bare FROM __cut_grams GROUP BY b, c
), singles AS (
  SELECT c, sum(goes) AS goes, sum(closes) AS closes, sum(bare) AS bare FROM pairs GROUP BY c
), asked AS (
  SELECT DISTINCT a, b, c, left(c, 1) AS l FROM finals WHERE NOT marked AND NOT open
), longer3 AS (
  SELECT q.a, q.b, q.c, sum(g.goes + g.closes) AS n
  FROM asked q JOIN __cut_grams g ON q.a = g.a AND q.b = g.b AND q.l = left(g.c, 1) AND startswith(g.c, q.c) AND g.c <> q.c
  GROUP BY 1, 2, 3
), by3 AS (
  SELECT q.a, q.b, q.c, coalesce(g.goes, 0) + coalesce(l.n, 0) AS goes, coalesce(g.closes, 0) AS closes, coalesce(g.bare, 0) AS bare
  FROM asked q LEFT JOIN __cut_grams g ON q.a = g.a AND q.b = g.b AND q.c = g.c LEFT JOIN longer3 l ON q.a = l.a AND q.b = l.b AND q.c = l.c
), asked2 AS (
  SELECT DISTINCT b, c, l FROM asked
), longer2 AS (
  SELECT q.b, q.c, sum(g.goes + g.closes) AS n
  FROM asked2 q JOIN pairs g ON q.b = g.b AND q.l = left(g.c, 1) AND startswith(g.c, q.c) AND g.c <> q.c
  GROUP BY 1, 2
), by2 AS (
  SELECT q.b, q.c, coalesce(g.goes, 0) + coalesce(l.n, 0) AS goes, coalesce(g.closes, 0) AS closes
  FROM asked2 q LEFT JOIN pairs g ON q.b = g.b AND q.c = g.c LEFT JOIN longer2 l ON q.b = l.b AND q.c = l.c
), counted AS (
  SELECT f.id, f.marked, f.stopped, f.open, t.goes AS g3, t.closes - CAST(f.stopped AS INT) AS s3, t.bare AS e3,
         d.goes AS g2, d.closes - CAST(f.stopped AS INT) AS s2, s.goes AS g1, s.closes - CAST(f.stopped AS INT) AS s1
  FROM finals f
  LEFT JOIN by3 t ON f.a = t.a AND f.b = t.b AND f.c = t.c
  LEFT JOIN by2 d ON f.b = d.b AND f.c = d.c
  LEFT JOIN singles s ON f.c = s.c
), decided AS (
  SELECT id, CASE
    WHEN marked THEN 'mark'
    WHEN open THEN 'open bracket'
    WHEN stopped THEN CASE WHEN g3 >= {doubt} AND s3 = 0 AND g2 >= {doubt} AND s2 = 0 THEN 'goes on' END
    WHEN g3 + s3 > 0 THEN CASE WHEN s3 <= {most} * (g3 + s3) THEN 'goes on' END
    WHEN e3 >= {usual} THEN NULL
    WHEN g2 + s2 > 0 THEN CASE WHEN s2 <= {most} * (g2 + s2) THEN 'goes on' END
    WHEN g1 + s1 > 0 THEN CASE WHEN s1 <= {most} * (g1 + s1) THEN 'goes on' END
    ELSE 'torn word' END AS why
  FROM counted
)
SELECT id AS __id, why AS __why FROM decided WHERE why IS NOT NULL
"""


def truncated(df: DataFrame, key: str, text: str) -> DataFrame:
    """(`key`, why) of every row whose `text` was cut."""
    from pyspark.sql import functions as F

    spark = df.sparkSession
    rows = df.select(F.col(key), F.col(text).alias("__text"))
    rows.createOrReplaceTempView("__cut_source")
    args = {"mark": MARK, "stop": STOP_MARK, "filler": FILLER}
    # The words of every different text are worked out once, the counts are read several times.
    for name, sql, used in (("__cut_words", _WORDS, args), ("__cut_grams", _GRAMS, None)):
        keep_cut(spark.sql(sql.format(source="__cut_source") if used else sql, args=used)).createOrReplaceTempView(name)
    cut = spark.sql(_DECIDED.format(doubt=LEAST_DOUBT, most=MOST_CLOSING, usual=USUAL))
    return (
        rows.where(F.col("__text").isNotNull())
        .select(key, F.md5("__text").alias("__id"))
        .join(cut, "__id")
        .select(key, F.col("__why").alias("why"))
    )


def cut_share(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Of each source: rows, rows with a text, cut rows and their share of the rows with a text."""
    from pyspark.sql import functions as F

    cut = truncated(df, key, text).select(F.col(key).alias("__key"), F.lit(1).alias("__cut"))
    low = F.lower(F.col(text))
    held = F.col(text).isNotNull() & ~low.rlike(FILLER)
    return (
        df.select(key, source, held.alias("__held"))
        .join(cut, F.col(key) == F.col("__key"), "left")
        .groupBy(source)
        .agg(
            F.count("*").alias("n_records"),
            F.count_if(F.col("__held")).alias("n_texts"),
            F.count_if(F.col("__cut") == 1).alias("n_cut"),
        )
        .withColumn("share", F.round(F.col("n_cut") / F.greatest(F.col("n_texts"), F.lit(1)), 6))
    )
