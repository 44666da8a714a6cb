"""Statistics of each document, and whether it is prose, a list, a table or junk.

Structure is read from the lines: delimiters that stand in the same number on neighbouring lines, or cells between
columns of blanks that begin or end at the same places there, show a table; a repeated indentation or marker, and short lines without a stop, show a list; the
autocorrelation of line lengths tells wrapped prose (even, full lines) from entries of their own length. Word, symbol,
punctuation and common-word ratios tell readable text from junk. The main class is that of most of the text: prose with
a short list or table in it stays prose.

Defined results: null, empty and blank texts have zero counts and no kind (null); any line end is one; very long texts
are read whole, in time linear in their length; words are matched to the common words of all languages, since `lang` is
often wrong; a document stands alone, so hot groups and repeated rows cost nothing extra.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import spread

WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
TOKEN = re.compile(r"\S+")
NUMBER = re.compile(r"[<>~±+-]?\d+(?:[.,]\d+)*%?(?:\s*\(\d+(?:[.,]\d+)*\))?$")
MARKER = re.compile(r"\s*(?:[-*•‣▪–—·+o]\s+|\[\s?[xX]?\s?\]\s+|\[\d+\]\s+|\(?\d{1,3}[.)]\s+|\(?[a-zA-Z][.)]\s+|\(?[ivxIVX]{1,5}[.)]\s+)\S")
LEADER = re.compile(r"(?:\.\s?){4,}\s*\d+\s*$|\t+\d+\s*$|\s{3,}\d{1,4}\s*$")
REFERENCE = re.compile(r"\bvol\.|\bpp\.\s*\d|\(\d{4}\)\.|,\s*\d{4}\.\s*$|\bdoi\b|\bin proc\b", re.I)
COMMA = re.compile(r",(?=\S)")
NO_ALNUM = re.compile(r"[\W_]+")
GAP = re.compile(r"(?<=\S)\s{2,}(?=\S)")
STOPPED = re.compile(r"[.!?:;]['\")\]»”’]*\s*$")
MARKUP = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|\\[a-zA-Z]+\b|&[a-z]+;|[{}$]|\^\{|_\{")
BROKEN = re.compile(r"[�\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x84\x86-\x9f]|[ÂÃÅâ][\x80-\xbf€™œ\x9d¡¢©±ÂÃÅâ ]")
#: Words of page furniture.
FURNITURE = frozenset(
    """home print share login logout contact about sitemap rss privacy cookie cookies settings cart next previous back top
    skip content cite menu search download pdf register subscribe terms imprint help faq feedback follow tweet email
    accept click scripts javascript enable navigation sign account newsletter advertisement copyright""".split()
)
STATISTICS = (
    "n_words long, mean_word_length double, symbol_ratio double, stopped_lines double, common_words double, "
    "aligned_lines double, marked_lines double, length_autocorrelation double, indent_period double, kind string"
)


def _cells(line: str) -> dict[str, tuple]:
    """What the delimiters of a line show of its columns: their number, or for gaps the places where the cells after them begin and end."""
    out: dict[str, tuple] = {}
    for name, n in (("tab", line.count("\t")), ("bar", line.count("|")), ("comma", len(COMMA.findall(line)) if "," in line else 0)):
        if n:
            out[name] = (n,)
    if "  " in line or "\t" in line:
        plain = line.rstrip().expandtabs(2)
        gaps = [m.span() for m in GAP.finditer(plain)]
        if gaps:
            ends = [a for a, _ in gaps[1:]] + [len(plain)]
            out["gap"] = tuple((b, end) for (_, b), end in zip(gaps, ends))
    return out


def _columns(name: str, cells: tuple, other: tuple | None) -> bool:
    """Do two lines have the same columns? Cells between gaps are, if most of them begin or end at the same place."""
    if other is None or len(cells) != len(other):
        return False
    if name != "gap":
        return cells == other
    met = sum(a == c or b == d for (a, b), (c, d) in zip(cells, other))
    return met >= 0.6 * len(cells)


def _autocorrelation(values: list[int]) -> float:
    n = len(values)
    if n < 3:
        return 0.0
    mean = sum(values) / n
    spread_ = sum((v - mean) ** 2 for v in values)
    if not spread_:
        return 1.0
    return sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / spread_


def _leads(line: str) -> bool:
    """Does the line end in a page number after leaders or a gap?"""
    return line.rstrip()[-1:].isdigit() and LEADER.search(line) is not None


def _cites(line: str) -> bool:
    """Does the line hold what marks a reference? Most lines hold none of the signs that the pattern needs."""
    low = line.lower()
    signs = ")." in low or "vol." in low or "pp." in low or "doi" in low or "in proc" in low or low.rstrip()[-2:-1].isdigit()
    return signs and REFERENCE.search(line) is not None


def _period(indents: list[int]) -> float:
    """Share of lines whose indentation repeats that of the line one, two or three before, if any line is indented."""
    if len(indents) < 4 or not any(indents):
        return 0.0
    return max(sum(a == b for a, b in zip(indents, indents[k:])) / (len(indents) - k) for k in (1, 2, 3))


def describe(text: str | None, common: frozenset[str]) -> tuple:
    """The statistics of one document, in the order of `STATISTICS`."""
    if text is None or not text.strip():
        return (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, None)
    lines = [x for x in text.splitlines() if x.strip()]
    n_lines = len(lines)
    words = WORD.findall(text)
    n = len(words)
    low = [w.lower() for w in words]
    inside = sum(w in common for w in low)
    letters = sum(map(len, words))
    solid = len("".join(text.split()))
    alnum = len(NO_ALNUM.sub("", text))
    symbols = 1 - alnum / solid
    stops = [STOPPED.search(x) is not None for x in lines]
    leads = [_leads(x) for x in lines]
    cites = [_cites(x) for x in lines]
    stopped = sum(stops) / n_lines
    share = inside / n if n else 0.0

    # Vertical alignment: the columns of a line against those of its neighbours.
    cells = [_cells(x) for x in lines]
    table_chars = list_chars = prose_chars = total = 0
    aligned = marked = 0
    delimiters = Counter()
    for c in cells:
        delimiters.update(c.keys())
    usable = {d for d, k in delimiters.items() if k >= 0.6 * n_lines}
    lengths = [len(x) for x in lines]
    auto = _autocorrelation(lengths)
    period = _period([len(x) - len(x.lstrip()) for x in lines])
    # Wrapped prose fills its lines evenly; entries have lengths of their own.
    full = lengths[:-1]
    mean_length = sum(full) / max(1, len(full))
    wrapped = n_lines >= 4 and mean_length > 45 and sum(abs(v - mean_length) for v in full) < 0.15 * mean_length * len(full)
    indented = period >= 0.8
    for i, line in enumerate(lines):
        size = len(line)
        total += size
        tokens = TOKEN.findall(line)
        own = [w.lower() for w in WORD.findall(line)]
        known = sum(w in common for w in own)
        numbers = sum(NUMBER.match(t) is not None for t in tokens if t[-1] in "0123456789%)")
        around = [cells[j] for j in (i - 1, i + 1) if 0 <= j < n_lines]
        in_columns = any(
            any(_columns(d, c, o.get(d)) for o in around)
            for d, c in cells[i].items()
            if d in usable and (d in ("tab", "gap") and (d == "tab" or len(c) >= 2) or d not in ("tab", "gap") and c[0] >= 2)
        )
        all_numbers = len(tokens) >= 3 and numbers >= 0.8 * len(tokens)
        leader, cited, stop = leads[i], cites[i], stops[i]
        sentence = len(own) >= 5 and known >= 0.18 * len(own) and not (leader or cited)
        is_marked = leader or cited or MARKER.match(line) is not None
        marked += is_marked
        told = len(own) >= 6 and known >= 0.18 * len(own) and stop
        if all_numbers or (in_columns and not told and not (is_marked and cited)):
            aligned += 1
            table_chars += size
        elif is_marked and not (sentence and len(own) > 14 and stop):
            list_chars += size
        elif sentence:
            prose_chars += size
        elif len(own) <= 8 and (not stop or indented) and not wrapped:
            list_chars += size
        elif len(own) >= 4 and (known or n_lines > 1):
            prose_chars += size
    kind = _kind(text, lines, sum(a or b for a, b in zip(leads, cites)), low, share, symbols, letters, solid, table_chars / total, list_chars / total, prose_chars / total, auto)
    return (
        n, round(letters / n, 6) if n else 0.0, round(symbols, 6), round(stopped, 6), round(share, 6), round(aligned / n_lines, 6),
        round(marked / n_lines, 6), round(auto, 6), round(period, 6), kind,
    )


def _kind(text, lines, entries, low, share, symbols, letters, solid, table, listed, prose, auto) -> str:
    n, n_lines = len(low), len(lines)
    if n < 3 and not table:
        return "prose" if n and letters >= 0.7 * solid and n_lines == 1 and not _code(text) else "junk" if solid > 3 else "prose"
    # Repetition: one line, or one run of words, is most of the text.
    if n_lines >= 4 and Counter(x.strip() for x in lines).most_common(1)[0][1] >= max(3, 0.5 * n_lines):
        return "junk"
    if n_lines >= 3 and entries >= 0.6 * n_lines and share < 0.2 and table < 0.5:
        return "list"
    different = len(set(low))
    if n >= 20 and different <= 10 and Counter(zip(low, low[1:])).most_common(1)[0][1] >= 0.1 * n or n >= 8 and different <= min(10, n / 4) and n_lines < 3:
        return "junk"
    mean = letters / n if n else 0
    vowels = sum(map("".join(low).count, "aeiouyàáâäåæèéêëìíîïòóôöøùúûüý"))
    if (symbols > 0.3 and mean < 3 and table < 0.6) or (n >= 8 and share < 0.1 and vowels < 0.25 * letters and "".join(low).isascii()):
        return "junk"
    if listed >= 0.8 and n_lines >= 3 and share < 0.2 and mean >= 3 and table < 0.3:
        bits = [set(WORD.findall(x.lower())) for x in lines]
        return "junk" if sum(bool(b & FURNITURE) for b in bits) >= 0.6 * n_lines else "list"
    broken = len(BROKEN.findall(text))
    markup = sum(map(len, MARKUP.findall(text)))
    if broken >= 0.08 * solid or (markup >= 0.2 * solid and share < 0.3):
        return "junk"
    if table >= 0.6 and symbols < 0.45:
        return "table"
    if letters < 0.55 * solid and table < 0.5 and listed < 0.5:
        return "junk"
    if symbols > 0.3 and table < 0.6 and share < 0.1 and listed < 0.9:
        return "junk"
    if _code(text):
        return "junk"
    pieces = [p.strip().lower() for x in lines for p in re.split(r"[|•·>»]|\s-\s", x) if p.strip()]
    bits = [set(WORD.findall(p)) for p in pieces if len(p) < 40]
    if len(bits) >= 4 and len(bits) >= 0.7 * len(pieces) and sum(bool(b & FURNITURE) for b in bits) >= 0.5 * len(bits):
        return "junk"
    if symbols > 0.3 and share < 0.1:
        return "junk"
    if prose >= max(table, listed):
        # One line of terms between delimiters is a list.
        parts = [p for p in re.split(r"[;|•·]|,\s", text) if p.strip()]
        if share < 0.2 and len(parts) >= 4 and n / len(parts) <= 5:
            return "list"
        return "prose"
    if table >= listed:
        return "table" if table >= 0.5 else "prose" if share >= 0.15 else "list"
    # Where prose and entries are mixed, paragraphs show in line lengths that follow each other.
    if share >= 0.22 and prose >= 0.3 or n_lines >= 6 and auto >= 0.5 and prose >= 0.8 * listed and share >= 0.12:
        return "prose"
    if listed >= 0.5 and n_lines == 1:
        parts = [p for p in re.split(r"[;|•·]|,\s", text) if p.strip()]
        return "list" if len(parts) >= 4 else "prose"
    return "list" if n_lines >= 3 else "prose"


def _code(text: str) -> bool:
    """Long runs without blanks that are no words: encoded bytes."""
    tokens = text.split()
    long = [t for t in tokens if len(t) >= 40 and not t.startswith(("http", "www"))]
    return sum(map(len, long)) >= 0.5 * sum(map(len, tokens))


def statistics(df: DataFrame, key: str, text: str, common_words: DataFrame) -> DataFrame:
    """(key, statistics..., kind) of every row; `common_words` is a fixed table of about a hundred words."""
    words = frozenset(r[0].lower() for r in common_words.select("word").where(F.col("word").isNotNull()).distinct().collect())
    shared = df.sparkSession.sparkContext.broadcast(words)
    names = [c.split()[0] for c in STATISTICS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = shared.value
        for batch in batches:
            rows = [describe(t, common) for t in batch[text]]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    kind = dict(df.dtypes)[key]
    return spread(df.select(key, text)).mapInPandas(run, f"{key} {kind}, {STATISTICS}")


def not_prose(df: DataFrame, key: str, text: str, common_words: DataFrame) -> DataFrame:
    """(key, kind) of every document that is a list, a table or junk."""
    found = statistics(df, key, text, common_words)
    return found.where(F.col("kind").isNotNull() & (F.col("kind") != "prose")).select(key, "kind")
