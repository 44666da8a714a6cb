"""Split fields that pack several values into one string.

A finite-state tokenizer reads a field once. Its state is (inside quotes, nesting depth); delimiters count only
outside quotes and at depth 0. A doubled quote or a backslash inside quotes is an escape. The tokenizer emits the
values together with their ordinals.

Defined results:

* null, empty and blank fields, and fields that hold only delimiters, give no row;
* empty pieces take no ordinal; repeated values are kept, each with its own ordinal;
* an unclosed quote is an ordinary character, so no value is lost;
* a field that is one bracketed list of quoted values (``["a", "b"]``) is read at depth 1;
* very long fields are read in one pass, in time linear in their length.

Commas are ambiguous, since a name may be written ``Last, First`` and a term may hold a comma. Where a stronger
delimiter stands outside quotes, a comma of a term belongs to the value. In name lists a comma joins a lone family
name, or any name before bare initials, with what follows it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRONG = ";|•·\n\t\r"
OPEN, CLOSE = "([{", ")]}"
NAME_WORDS = ("and", "&")
SUFFIXES = frozenset("phd md msc bsc jr sr ii iii iv dr prof mph rn pt".split())
_SPECIAL = re.compile(r'["\\()\[\]{};|•·\n\t\r,]')
_INITIALS = re.compile(r"(?:[^\W\d_]\.?[\s-]?){1,4}\Z")
_AND = re.compile(r"(?:^|(?<=[\s,]))(?:and|&)\s+", re.I)


def scan(text: str, delimiters: frozenset[str], base: int = 0) -> Iterator[tuple[str, str, bool]]:
    """Raw pieces with the delimiter that ended each and whether it was quoted; quotes and escapes are resolved."""
    out: list[str] = []
    at, depth, blank, quoted = 0, base, True, False
    last = {c: text.rfind(c) for c in CLOSE}
    opened: list[str] = []
    while found := _SPECIAL.search(text, at):
        i = found.start()
        out.append(text[at:i])
        blank = blank and not text[at:i].strip()
        ch = text[i]
        at = i + 1
        if ch == '"' and blank:
            end, inner = _quoted(text, at)
            if end >= 0:
                out, at, quoted, blank = [inner], end, True, False
                continue
        elif ch in OPEN:
            close = CLOSE[OPEN.index(ch)]
            if last[close] > i:
                depth += 1
                opened.append(close)
        elif ch in CLOSE:
            if opened and opened[-1] == ch:
                opened.pop()
                depth -= 1
        elif ch in delimiters and depth == base:
            yield "".join(out), ch, quoted
            out, blank, quoted = [], True, False
            continue
        out.append(ch)
        blank = False
    yield "".join(out) + text[at:], "", quoted


def _quoted(text: str, at: int) -> tuple[int, str]:
    """End and content of the quoted string whose opening quote stands before `at`; -1 if it never closes."""
    out: list[str] = []
    n = len(text)
    while at < n:
        q, b = text.find('"', at), text.find("\\", at)
        if q < 0:
            return -1, ""
        if 0 <= b < q:
            out.append(text[at:b] + text[b + 1 : b + 2])
            at = b + 2
        elif text[q + 1 : q + 2] == '"':
            out.append(text[at:q] + '"')
            at = q + 2
        else:
            out.append(text[at:q])
            return q + 1, "".join(out)
    return -1, ""


def split_packed(text: str | None, names: bool = False, known: frozenset[str] = frozenset()) -> list[str]:
    """The values of one field in order of writing. `names`: a list of people; `known`: terms that hold commas."""
    if text is None or not text.strip():
        return []
    body = text.strip()
    if body[0] == "[" and body[-1] == "]" and '"' in body:
        return [v for v in (x.strip() for x, _, _ in scan(body[1:-1], frozenset(",;"))) if v]
    pieces = list(scan(text, frozenset(STRONG)))
    plain = [v.strip() for v, _, q in pieces if v.strip() and (q or v.strip(" ,;|"))]
    if not names:
        if len([1 for _, d, _ in pieces if d]) or (len(pieces) == 1 and (pieces[0][2] and "," not in _outside(text))):
            return plain
        if plain and plain[0].lower() in known:
            return plain
        return [v for v in (x.strip() for x, _, _ in scan(text, frozenset(","))) if v]
    out: list[str] = []
    for value, quoted in _requote(text):
        if quoted:
            out.append(value.strip())
            continue
        for part in _AND.split(value):
            out += _names(part)
    return [v for v in out if v]


def _outside(text: str) -> str:
    return re.sub(r'"(?:[^"\\]|""|\\.)*"', "", text)


def _requote(text: str) -> Iterator[tuple[str, bool]]:
    """Pieces between strong delimiters; a piece that holds quoted values is cut at its commas as well."""
    wide = list(scan(text, frozenset(STRONG + ",")))
    run = ""
    for value, ended, quoted in wide:
        if quoted:
            if run.strip(" ,"):
                yield run.rstrip(" ,"), False
            run = ""
            yield value, True
            continue
        run += value
        if ended == ",":
            run += ","
        else:
            if run.strip(" ,"):
                yield run, False
            run = ""
    if run.strip(" ,"):
        yield run, False


def _names(part: str) -> list[str]:
    tokens = [t.strip() for t in part.split(",")]
    tokens = [t for t in tokens if t]
    out: list[str] = []
    i = 0
    while i < len(tokens):
        token = tokens[i]
        if i + 1 < len(tokens) and (" " not in token or _INITIALS.match(tokens[i + 1])) and _given(tokens[i + 1]):
            token = f"{token}, {tokens[i + 1]}"
            i += 1
        while i + 1 < len(tokens) and tokens[i + 1].replace(".", "").lower() in SUFFIXES:
            token = f"{token}, {tokens[i + 1]}"
            i += 1
        out.append(token)
        i += 1
    return out


def _given(token: str) -> bool:
    return token.replace(".", "").lower() not in SUFFIXES


def _splitter(names: bool):
    def values(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_packed(t, names))

    return F.pandas_udf(values, "array<string>")


def split_values(df: DataFrame, keys: list[str], fields: dict[str, bool], known: DataFrame | None = None) -> DataFrame:
    """One row (`keys`, field, pos, item) for each value of the packed `fields`; {field: is it a list of names}.

    `known`: one column of terms that hold a comma, which grows with the terms and not with the rows; where it is
    given, an undelimited field equal to such a term stays whole.
    """
    frames = []
    for field, names in fields.items():

        split = _splitter(names)
        source: Column = F.col(field)
        rows = df.where(source.isNotNull() & (F.length(F.trim(source)) > 0)).select(*keys, source.alias("__text"))
        if known is not None and not names:
            term = known.toDF("__term").where(F.col("__term").isNotNull()).distinct()
            rows = rows.join(term, F.lower(F.trim("__text")) == F.col("__term"), "left")
            items = F.when(F.col("__term").isNotNull(), F.array(F.trim("__text"))).otherwise(split("__text"))
        else:
            items = split("__text")
        frames.append(rows.select(*keys, F.lit(field).alias("field"), F.posexplode(items).alias("pos", "item")))
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out.withColumn("pos", F.col("pos") + 1)
