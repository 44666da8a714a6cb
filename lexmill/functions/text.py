"""Scalar text functions as Column expressions; every one stays in the JVM.

`SQL` holds the same functions as macros of ANSI-like SQL, which the tests run on another engine.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F



def _letters() -> dict[str, str]:
    """Lower-case letters and digits whose compatibility decomposition is one ASCII letter or digit and marks."""
    found = {}
    for c in map(chr, [*range(0xAA, 0x2C60), *range(0xFF10, 0xFF5B)]):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if c.lower() == c and len(plain) == 1 and re.fullmatch("[a-z0-9]", plain):
            found[c] = plain
    return found


_FOUND = _letters()
ACCENTED, PLAIN = "".join(_FOUND), "".join(_FOUND.values())
#: Ligatures of letters, which decompose into several.
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "ǆ": "dz", "ǉ": "lj", "ǌ": "nj"}
#: Prefixes of resolvers and what may follow an identifier.
DOI_PREFIX = r"^(https?://(dx\.)?doi\.org/|doi:)\s*"
DOI_TAIL = r"[.,;)\]}>'\"]+$"
#: Leading words that some exports put before an abstract.
ABSTRACT_PREFIXES = ["abstract", "summary", "background", "objective", "methods", "introduction"]
#: Stems that announce a result.
CLAIM_STEMS = (
    "result", "find", "show", "demonstrate", "evaluate", "outperform", "fail", "improve", "achieve", "significantly",
    "conclusion", "propose", "validate", "performance",
)


def plain_letters(text: Column) -> Column:
    """Lower case in compatibility decomposition, without marks; letters that do not decompose (ø, ß) stay."""
    out = F.regexp_replace(F.lower(text), r"\p{M}+", "")
    for a, b in LIGATURES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.translate(out, ACCENTED, PLAIN)


def normalized_title(text: Column) -> Column:
    """Lower-case ASCII letters and digits, single blanks; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(plain_letters(text), r"[^a-z0-9\s]", " "), r"\s+", " ")), F.lit(""))


def normalize_text(text: Column) -> Column:
    """One line with single blanks; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0b\x{00a0}]+", " ")), F.lit(""))


def normalize_doi(doi: Column) -> Column:
    """The identifier itself, lower case, without resolver, trailing metadata and punctuation; null gives ''."""
    low = F.lower(F.trim(doi))
    found = F.regexp_extract(low, r"(10\.[0-9]{4,9}/[^\s]+)", 1)
    own = F.when(found != "", found).otherwise(F.regexp_replace(low, DOI_PREFIX, ""))
    return F.coalesce(F.regexp_replace(own, DOI_TAIL, ""), F.lit(""))


def safe_int(text: Column) -> Column:
    return F.when(F.trim(text).rlike(r"^[+-]?[0-9]+$"), F.trim(text)).otherwise(F.lit(None)).try_cast("int")


def safe_filename(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(plain_letters(text), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def split_keywords(text: Column) -> Column:
    """Values between the first of ';', '|' and ',' that occurs; blank values are dropped."""
    by = F.when(F.contains(text, F.lit(";")), F.split(text, ";")).when(F.contains(text, F.lit("|")), F.split(text, r"\|")).otherwise(F.split(text, ","))
    return F.filter(F.transform(by, lambda x: F.trim(x)), lambda x: x != "")


def strip_prefixes(text: Column, prefixes: list[str]) -> Column:
    """The text without the first of the given leading words that it begins with."""
    alternatives = "|".join(prefixes)
    return F.regexp_replace(F.trim(text), rf"(?i)^({alternatives})[\s:.—-]*", "")


def title_tokens(text: Column, least: int = 2) -> Column:
    return F.filter(F.array_distinct(F.split(normalized_title(text), " ")), lambda t: F.length(t) >= least)


def token_overlap(a: Column, b: Column) -> Column:
    """Shared tokens over the smaller number of tokens; 0 where a side has none."""
    x, y = title_tokens(a), title_tokens(b)
    least = F.least(F.size(x), F.size(y))
    return F.when(least > 0, F.size(F.array_intersect(x, y)) / least).otherwise(F.lit(0.0))


def domain_of(url: Column) -> Column:
    """Host name without scheme, 'www.', path and port."""
    host = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z]+://", "")
    return F.regexp_replace(F.regexp_replace(host, r"[/:?#].*$", ""), r"^www\.", "")


def arxiv_id(text: Column) -> Column:
    own = F.regexp_replace(F.trim(text), r"^.*/abs/", "")
    return F.regexp_replace(F.regexp_replace(own, r"(?i)^arxiv:", ""), r"v[0-9]+$", "")


def needs_recovery(text: Column) -> Column:
    """Is the text missing or visibly cut?"""
    return text.isNull() | (text == "") | F.contains(text, F.lit("…")) | F.rtrim(text).endswith("...")


def word_count(text: Column) -> Column:
    clean = normalize_text(text)
    return F.when(clean == "", F.lit(0)).otherwise(F.size(F.split(clean, " ")))


def first_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(normalize_text(text), " "), 1, n), " ")


def hits(text: Column, terms: list[str] | tuple[str, ...]) -> Column:
    """How many of the terms occur in the lower-case text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a + b, [F.contains(low, F.lit(t)).cast("int") for t in terms])


def ladder(value: Column, steps: list[tuple[str, object]], default: object) -> Column:
    """The result of the first step whose word occurs in the value."""
    out = F.lit(default)
    for word, result in reversed(steps):
        out = F.when(F.contains(value, F.lit(word)), F.lit(result)).otherwise(out)
    return out


# The same functions in SQL of another engine ---------------------------------------------------------------------


def sql_plain(x: str) -> str:
    out = f"lower({x})"
    for a, b in LIGATURES.items():
        out = f"replace({out}, '{a}', '{b}')"
    return f"strip_accents({out})"


def sql_title(x: str) -> str:
    return f"coalesce(trim(regexp_replace(regexp_replace({sql_plain(x)}, '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), '')"


def sql_text(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, '[ \\t\\n\\r\\f\\x0b\\x{{00a0}}]+', ' ', 'g')), '')"


def sql_doi(x: str) -> str:
    low = f"lower(trim({x}))"
    found = f"regexp_extract({low}, '(10\\.[0-9]{{4,9}}/[^\\s]+)', 1)"
    prefix, tail = DOI_PREFIX, DOI_TAIL.replace("'", "''")
    return f"coalesce(regexp_replace(CASE WHEN {found} <> '' THEN {found} ELSE regexp_replace({low}, '{prefix}', '') END, '{tail}', ''), '')"


def sql_hits(x: str, terms) -> str:
    return " + ".join(f"(CASE WHEN contains(lower(coalesce({x}, '')), '{t}') THEN 1 ELSE 0 END)" for t in terms)
