"""BibTeX files and LaTeX manuscripts: balanced braces and sentences around citations need a scan of characters."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ABBREVIATIONS = ("e.g.", "i.e.", "al.", "fig.", "eq.", "cf.", "vs.", "sec.", "no.", "dr.")
CONTEXT = 700


def bibtex_entries(text: str) -> list[tuple[str, str, dict[str, str]]]:
    """(type, key, fields) of the entries of a BibTeX text; unbalanced entries end the scan."""
    out, at = [], 0
    while m := re.compile(r"@(\w+)\s*\{").search(text, at):
        depth, i = 1, m.end()
        while i < len(text) and depth:
            depth += (text[i] == "{") - (text[i] == "}")
            i += 1
        if depth:
            break
        body, at = text[m.end() : i - 1], i
        if m.group(1).lower() in ("comment", "string", "preamble"):
            continue
        parts = _top_level(body, ",")
        fields = {}
        for part in parts[1:]:
            name, _, value = part.partition("=")
            if value:
                fields[name.strip().lower()] = _plain(value.strip())
        out.append((m.group(1).lower(), parts[0].strip(), fields))
    by_key = {k: f for _, k, f in out}
    for _, _, fields in out:
        parent = by_key.get(fields.get("crossref", ""))
        if parent and "booktitle" not in fields and "title" in parent:
            fields["booktitle"] = parent["title"]
    return out


def _top_level(text: str, separator: str) -> list[str]:
    out, depth, quoted, start = [], 0, False, 0
    for i, c in enumerate(text):
        if c == '"' and depth == 0 and (i == 0 or text[i - 1] != "\\"):
            quoted = not quoted
        elif c == "{":
            depth += 1
        elif c == "}":
            depth -= 1
        elif c == separator and depth == 0 and not quoted:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]


def _plain(value: str) -> str:
    value = value.strip()
    while len(value) > 1 and ((value[0] == "{" and value[-1] == "}") or (value[0] == value[-1] == '"')):
        value = value[1:-1].strip()
    return re.sub(r"\s+", " ", re.sub(r"\\[a-zA-Z]+\s*|[{}\\]", "", value))


def citation_contexts(text: str) -> list[tuple[str, str]]:
    """(key, sentence) of every citation; the sentence is capped, and equal beginnings count once for a key."""
    out, seen = [], set()
    for m in re.finditer(r"\\(?:[cC]ite|[pP]arencite|[tT]extcite|[aA]utocite|[fF]ootcite|[sS]martcite|[fF]ullcite)[a-z]*\*?(?:\[[^\]]*\])*\{([^}]*)\}", text):
        start = _boundary(text, m.start(), -1)
        end = _boundary(text, m.end(), 1)
        sentence = re.sub(r"\s+", " ", text[start:end]).strip()[:CONTEXT]
        for key in filter(None, (k.strip() for k in m.group(1).split(","))):
            mark = (key, hashlib.sha1(sentence[:200].encode()).hexdigest())
            if mark not in seen:
                seen.add(mark)
                out.append((key, sentence))
    return out


def _boundary(text: str, at: int, step: int) -> int:
    """The nearest end of a sentence before or after a place; dots of abbreviations and numbers do not end one."""
    i = at if step > 0 else at - 1
    while 0 <= i < len(text):
        if text[i] in ".!?" and (i + 1 >= len(text) or text[i + 1].isspace()):
            word = re.search(r"\S*\Z", text[max(0, i - 12) : i + 1]).group(0).lower().lstrip("(")
            if word not in ABBREVIATIONS:
                return i + 1
        if text[i : i + 2] == "\n\n":
            return i if step > 0 else i + 2
        i += step
    return max(0, i) if step < 0 else len(text)


def read_bibtex(df: DataFrame, text: str = "text") -> DataFrame:
    """(kind, key, fields) of the entries in a column of BibTeX texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [e for t in batch[text] if t for e in bibtex_entries(t)]
            yield pd.DataFrame(rows, columns=["kind", "key", "fields"])

    return df.select(text).mapInPandas(run, "kind string, key string, fields map<string,string>")


def read_contexts(df: DataFrame, text: str = "text") -> DataFrame:
    """(key, context) of the citations in a column of LaTeX texts."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"key": k, "context": c} for k, c in citation_contexts(t or "")])

    found = F.pandas_udf(run, "array<struct<key:string,context:string>>")
    return df.select(F.explode(found(text)).alias("c")).select("c.key", "c.context").distinct()
