"""Repair of texts read from scanned pages, and the places where they were at fault.

The lines of a text are first told apart: running headers (a venue's name or the beginning of the paper's own title,
with or without a page number), page numbers alone, headings and body. The body is then read as one stream without its
line ends. Over it lies a lattice: every token may stand as it is, be a word with confused characters, be two words run
together, be joined with the next ones (letters and pieces set apart), or, at a hyphen before a line end, make one word with
the next token or a compound with its own hyphen. Every edge has a cost, the surprise of its words by their counts over the
corpus' different texts and a price for what went wrong, and the cheapest path gives the text and the faults (see `stream`).
Confusions are looked up by a skeleton, in which characters that are taken for each other are written alike, so any number
of them in a word costs one lookup. Paragraph boundaries are chosen by dynamic programming over the lines, from blank
lines, full stops, line widths and headings, with a cost for very short paragraphs.

A word of the lexicon has `LEAST` occurrences, whatever the size of the corpus. Such a word is taken for a confusion only
of one that is `FAR` times as frequent, so real words that are rare ("ear" beside "car") stay. The lexicon is broadcast
after its size is checked (`LEXICON`); a larger one is an error, not a smaller lexicon.

Defined results: null and blank texts have no faults and an empty repaired text; a text without line breaks is line 1;
a field is read whole, whatever its length, in linear time; repeated rows give the same faults; empty tables give empty
results; a line has each kind of fault once.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import spread

#: A word of the lexicon has so many occurrences at least; the lexicon has so many words at most.
LEAST, LEXICON = 3, 5_000_000
#: A token outside the lexicon is a confusion of a word that is so many times as frequent, a word of it of a far more frequent one.
CONFUSED, FAR = 15, 60
#: Prices of joining pieces and of parting words that run together, in nats.
JOINING, PARTING = 4.0, 0.5
#: How characters are taken for each other; both sides are written alike in a skeleton.
ALIKE = str.maketrans({
    "m": "rrl", "n": "rl", "d": "cl", "h": "ll", "u": "ll", "w": "vv", "0": "o", "1": "l", "i": "l", "!": "l", "|": "l", "5": "s", "9": "g",
    "†": "t", "e": "c", "€": "c", "8": "b", "6": "b", "$": "s", "@": "a", "2": "z",
})
#: Letters read as one sign.
JOINED = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl"}
LIGATURES = str.maketrans(JOINED)
#: Hyphens, the last two of which only break words.
HYPHENS = "-‐‑¬\u00ad"
STRIP = ".,;:()[]{}\"'“”‘’?…"
ROMAN = r"[ivxlIVXL]{1,7}"
DIGITS = r"[\dlOoI|!SZB]{1,5}"
PAGE = re.compile(
    rf"\W*(?:[Pp]a[gq9][ec]|PAGE|[Pp]{{1,2}}\.?|[Ss]eite|[Ss]\.)?\s*(?:{ROMAN}|{DIGITS})(?:\s*(?:[o0]f|/|von|de)\s*{DIGITS})?[^\w.,;:?!%)]*\Z"
)
MIXED = re.compile(r"(?=.*\d)(?=.*[lOoI|!SZB])[\dlOoI|!SZB]+\Z")
NUMBER = re.compile(r"[<>=~±+-]*\d[\d.,:/–-]*%?\Z")
ENDS = re.compile(r"[.!?:][)\]\"'”’]*\s*\Z")
TAIL = re.compile(r"[\s|·•–—-]*(?:\d+|(?:vol|no|p|pp)\b\.?\s*[\w]+,?|[lOoI|!SZB\d]{1,5}|[ivxl]{1,6})?\Z", re.I)
FAULTS = "field string, line_no int, kind string"


def skeleton(word: str) -> str:
    return word.lower().translate(ALIKE)


def broken(line: str) -> bool:
    """Does the line end inside a word?"""
    return len(line) > 1 and line[-1] in HYPHENS and (line[-2].isalpha() or line[-2] in "†!|0159")


class Reader:
    """The lexicon of a corpus and the decoder that reads with it."""

    def __init__(self, counts: dict[str, int], venues: list[str]):
        self.counts = counts
        self.total = sum(counts.values()) or 1
        self.by_skeleton: dict[str, tuple[str, int]] = {}
        for w, n in counts.items():
            s = skeleton(w)
            if n > self.by_skeleton.get(s, ("", 0))[1]:
                self.by_skeleton[s] = (w, n)
        self.venues = {skeleton(re.sub(r"[^\w]+", "", v)) for v in venues}
        self.heads = {skeleton(v.split()[0].strip(".")) for v in venues if v.split()}
        self.memo: dict[str, tuple[str, str] | None] = {}
        self.clean: set[str] = set()  # raw tokens known to stand as they are

    # Words -------------------------------------------------------------------------------------------------------

    def count(self, word: str) -> int:
        return self.counts.get(word, 0)

    def correct(self, word: str) -> str | None:
        """The lexicon word that `word` misreads, or None."""
        own = self.count(word)
        found = self.by_skeleton.get(skeleton(word))
        if found and found[0] != word and found[1] >= (FAR if own >= LEAST else CONFUSED) * max(own, 1):
            return found[0]
        return None

    def cost(self, word: str) -> float:
        """Surprise of a word, in nats; an unknown one is as rare as one occurrence."""
        return math.log(self.total / max(self.count(word), 1))

    def read(self, token: str) -> tuple[str, str] | None:
        """None if the raw token stands as it is, else (its repair, 'misread')."""
        if token in self.memo:
            return self.memo[token]
        if len(self.memo) > 300_000:
            self.memo.clear()
            self.clean.clear()
        found = self.memo[token] = self._read(token)
        if found is None:
            self.clean.add(token)
        return found

    def _read(self, token: str) -> tuple[str, str] | None:
        apart = token.translate(LIGATURES)
        if apart != token:
            further = self._read(apart)
            return further or (apart, "misread")
        core = token.strip(STRIP)
        low = core.lower()
        if not core or NUMBER.match(core):
            return None
        own = self.count(low)
        if own >= CONFUSED * LEAST and not any(c in "†!|€" for c in core):
            better = self.by_skeleton.get(skeleton(low))
            if not better or better[1] < CONFUSED * own or better[0] == low:
                return None
        fixed = self.correct(low)
        if fixed is None and own == 0 and any(h in core for h in HYPHENS):
            parts = re.split(f"([{HYPHENS}])", core)
            reads = [self._read(p) if k % 2 == 0 and len(p) > 1 else None for k, p in enumerate(parts)]
            if any(reads):
                return token.replace(core, "".join(r[0] if r else p for r, p in zip(reads, parts))), "misread"
            return None
        if fixed is None:
            if MIXED.match(core) and own == 0:
                digits = core.translate(str.maketrans("lI|!OoSZB", "1111005" + "28"))
                return token.replace(core, digits), "misread"
            if own == 0 and re.search(r"[†€]|\w[!|]\w|^[!|]\w", core):
                return token.replace(core, re.sub("[!|]", "i", core.replace("†", "t").replace("€", "e"))), "misread"
            return None
        if core[:1].isupper():
            fixed = fixed.upper() if core.isupper() and len(core) > 1 else fixed[:1].upper() + fixed[1:]
        return token.replace(core, fixed), "misread"

    def join(self, head: str, tail: str) -> tuple[str, str, bool, bool] | None:
        """Parts of a word on both sides of a hyphen and a line end: (repair, kind, misread in head, in tail)."""
        plain_head, plain_tail = head.translate(LIGATURES), tail.translate(LIGATURES)
        if plain_head != head or plain_tail != tail:
            found = self.join(plain_head, plain_tail)
            return found and (found[0], found[1], found[2] or plain_head != head, found[3] or plain_tail != tail)
        a, b = head.rstrip(HYPHENS).lstrip(STRIP), tail.strip(STRIP)
        lead, trail = b, ""
        inner = re.match(rf"([^{HYPHENS}]+)([{HYPHENS}].*)\Z", b)
        if inner:
            lead, trail = inner.groups()
        stem = re.split(f"[{HYPHENS}]", a)[-1]
        before = a[: len(a) - len(stem)]
        la, lb = stem.lower(), lead.lower()
        if not la or not lb:
            return None
        whole, parts = la + lb, f"{la}-{lb}"
        best = None
        for text, kind in ((whole, "hyphen"), (parts, "compound")):
            n, fixed = self.count(text), text
            sure = n
            better = self.by_skeleton.get(skeleton(text))
            if better and better[1] >= CONFUSED * max(n, 1):
                fixed, sure = better[0], better[1] / 4
            if sure and (best is None or sure > best[0]):
                best = (sure, fixed, kind, text)
        if best is None and before:  # a compound of several parts, broken inside its last part
            full = (before + whole).lower()
            if self.count(full):
                best = (self.count(full), whole, "hyphen", whole)
        if best is None:
            # A compound may be seen here only once: both of its parts are words then.
            known = self.count(la) >= LEAST and self.count(lb) >= LEAST
            if known or lb in ("and", "or", "to") or not lb[0].isalpha():
                return head + tail, "compound", False, False
            return before + stem + tail, "hyphen", False, False
        _, fixed, kind, text = best
        plain = fixed.replace("-", "")
        wrong = fixed != text
        in_head = wrong and not plain.startswith(la)
        in_tail = wrong and not plain.endswith(lb)
        repaired = fixed if stem[:1].islower() else fixed[:1].upper() + fixed[1:]
        return before + repaired + trail + tail[len(tail.rstrip(STRIP)) :], kind, in_head, in_tail

    # Lines -------------------------------------------------------------------------------------------------------

    def furniture(self, line: str, title: str) -> str | None:
        """'header', 'page_number' or None for one stripped line."""
        if len(line) <= 24 and PAGE.match(line) and re.search(r"\d|[ivxlIVXL]", line):
            if not re.search(r"[A-Za-z]{3}", re.sub(rf"(?i)pa[gq9][ec]|seite|\b{ROMAN}\b", "", line)):
                return "page_number"
        if re.fullmatch(r"[lOoI|!]{2,4}", line) and not self.count(line.lower()):
            return "page_number"
        if len(line) > 150 or len(line) < 4:
            return None
        # Most lines cannot be headers: they bear no mark of a page and begin like neither a venue nor the title.
        if "  " not in line and "|" not in line and not line[0].isdigit():
            first = skeleton(line.split(None, 1)[0].strip("."))
            if first not in self.heads and not (title and first[:3] and title.startswith(re.sub(r"\W+", "", first))):
                return None
        bare = re.sub(rf"\A\W*(?:{DIGITS}|{ROMAN})(?:\s{{2,}}|\s*[|·•–—]\s*)", "", line)
        bare = re.sub(r"(?i)[\s,]+v[o0][l1!i|]\.?\s*\w+,?\s*(?:n[o0]\.?\s*\w+)?\W*\Z", "", bare)
        tail = re.sub(rf"(?:\s{{2,}}|\s*[|·•–—]\s*)(?:{DIGITS}|{ROMAN})\W*\Z", "", bare)
        for text in {line, bare, tail, re.sub(rf"\s+{DIGITS}\Z", "", tail)}:
            key = skeleton(re.sub(r"[^\w†!|]+", "", text))
            if key and key in self.venues:
                return "header"
        marked = tail != line
        words = tail.split()
        if marked and tail != bare or bare != line and re.match(r"\W*\w{1,5}(?:\s{2,}|\s*[|·•–—])", line):
            if len(words) >= 3 and words[0][:1].isupper() and not ENDS.search(tail) and len(line) < 100:
                return "header"
        key = skeleton(re.sub(r"[^\w†!|]+", "", re.sub(r"(?:\.\.\.|…)\W*\Z", "", tail)))
        if title and len(key) >= 12 and title.startswith(key):
            upper = tail.upper() == tail
            if marked or upper or tail.endswith(("...", "…")) or len(tail.split()) >= 3:
                return "header"
        return None

    def classes(self, lines: list[str], title: str, seen: dict[str, str] | None = None) -> list[str]:
        """'blank', 'header', 'page_number' or 'body' of each line; `seen` keeps the answers of a paper's lines."""
        out = []
        seen = {} if seen is None else seen
        for line in lines:
            kind = seen.get(line)
            if kind is None:
                text = line.strip()
                kind = seen[line] = "blank" if not text else self.furniture(text, title) or "body"
            out.append(kind)
        if not title:
            self._untitled(lines, out)
        return out

    def _untitled(self, lines: list[str], kinds: list[str]) -> None:
        """Without a title, a capitalised line that stands several times and interrupts a sentence is a header."""
        body = [i for i, k in enumerate(kinds) if k == "body"]
        times = Counter(skeleton(lines[i].strip()) for i in body)
        interrupts: Counter = Counter()
        for before, i, after in zip(body, body[1:], body[2:]):
            line = lines[i].strip()
            if times[skeleton(line)] > 1 and line[:1].isupper() and len(line.split()) >= 3 and not ENDS.search(line):
                held = lines[before].rstrip()
                if not ENDS.search(held) and len(held.split()) > 3 and lines[after].strip()[:1].islower():
                    interrupts[skeleton(line)] += 1
        for i in body:
            if (n := interrupts[skeleton(lines[i].strip())]) and n == times[skeleton(lines[i].strip())]:
                kinds[i] = "header"

    def faults(self, text: str, title: str, seen: dict[str, str] | None = None) -> list[tuple[int, str]]:
        """(line_no, kind) of a text with line breaks."""
        lines = text.split("\n")
        kinds = self.classes(lines, title, seen)
        found: set[tuple[int, str]] = set()
        body = []
        for i, k in enumerate(kinds):
            if k == "body":
                body.append(i)
            elif k != "blank":
                found.add((i + 1, k))
        tokens, numbers = [], []
        for i in body:
            line = lines[i].split()
            tokens += line
            numbers += [i + 1] * len(line)
        found.update(self.stream(tokens, numbers)[1])
        return sorted(found)

    # The stream ------------------------------------------------------------------------------------------------

    def stream(self, tokens: list[str], numbers: list[int]) -> tuple[list[str], set[tuple[int, str]]]:
        """(words, faults as (line number, kind)) of the cheapest path through the lattice over the tokens of the body.

        Costs do not depend on the neighbours, so a token that stands as it is and that no edge of several tokens covers is on
        the path anyway; only the stretches around all others are searched.
        """
        clean, last = self.clean, len(tokens) - 1
        words: list[str] = []
        found: set[tuple[int, str]] = set()
        done = 0
        for start, end in self._stretches(tokens, numbers):
            words += tokens[done:start]
            for text, kinds in self._cheapest(tokens, numbers, start, end):
                words.append(text)
                found.update(kinds)
            done = end
        words += tokens[done:]
        if tokens and tokens[last] not in clean and tokens[last][-1] in "¬\u00ad" and broken(tokens[last]):
            found.add((numbers[last], "hyphen"))
        return words, found

    def _stretches(self, tokens: list[str], numbers: list[int]) -> Iterator[tuple[int, int]]:
        """Stretches of tokens that some edge other than standing as it is covers, with a token around."""
        clean, n = self.clean, len(tokens)
        start = end = -1
        for i, t in enumerate(tokens):
            if t in clean and len(t) > 1 and t[-1] not in HYPHENS:
                continue
            at_end = i + 1 < n and numbers[i + 1] != numbers[i] and broken(t)
            if not at_end and self.read(t) is None and self._stands(t):
                if len(t) > 1 or not (t.isalpha() and i + 1 < n and len(tokens[i + 1].strip(STRIP)) == 1):
                    continue
            a, b = max(i - 1, 0), min(i + 2, n)
            if a > end:
                if start >= 0:
                    yield start, end
                start = a
            end = b
        if start >= 0:
            yield start, end

    def _stands(self, token: str) -> bool:
        core = token.strip(STRIP)
        return not core or not core.isalpha() or self.count(core.lower()) > 0

    def _cheapest(self, tokens: list[str], numbers: list[int], start: int, end: int) -> list[tuple[str, list[tuple[int, str]]]]:
        """(text, faults) of the edges of the cheapest path from `start` to `end`."""
        best: list[float] = [0.0] + [math.inf] * (end - start)
        back: list[tuple[int, str, list[tuple[int, str]]] | None] = [None] * (end - start + 1)

        def edge(i: int, j: int, cost: float, text: str, kinds: list[tuple[int, str]]) -> None:
            if j <= end and best[i - start] + cost < best[j - start]:
                best[j - start], back[j - start] = best[i - start] + cost, (i, text, kinds)

        for i in range(start, end):
            token = tokens[i]
            core = token.strip(STRIP)
            low = core.lower()
            fixed = self.read(token)
            alone = self.cost(low)
            if fixed is None:
                edge(i, i + 1, alone, token, [])
                parted = self.split(token)
                if parted != token:
                    edge(i, i + 1, alone - PARTING, parted, [])
            else:
                edge(i, i + 1, min(alone, self.cost(fixed[0].strip(STRIP).lower()) + math.log(CONFUSED)), fixed[0], [(numbers[i], "misread")])
            if i + 1 < end and numbers[i + 1] != numbers[i] and broken(token):
                joined = self.join(token, tokens[i + 1])
                if joined:
                    text, kind, in_head, in_tail = joined
                    kinds = [(numbers[i], "hyphen")] if kind == "hyphen" else []
                    kinds += [(numbers[i], "misread")] * in_head + [(numbers[i + 1], "misread")] * in_tail
                    # One word, or a compound of which both parts are: no dearer than what stands apart.
                    after = self.cost(tokens[i + 1].strip(STRIP).lower())
                    edge(i, i + 2, min(self.cost(text.strip(STRIP).lower()), alone + after - PARTING), text, kinds)
            self._joined(tokens, i, end, edge)
        path, at = [], end
        while at > start:
            i, text, kinds = back[at - start]
            path.append((text, kinds))
            at = i
        return path[::-1]

    def _joined(self, tokens: list[str], i: int, end: int, edge) -> None:
        """Edges of pieces set apart that make a known word: two pieces of which one is unknown, or a run of letters."""
        if tokens[i][-1:] and not tokens[i][-1].isalpha():
            return
        j, letters = i + 1, len(tokens[i].strip(STRIP)) == 1
        while j < end and tokens[j].lstrip(STRIP)[:1].isalpha() and (j == i + 1 or letters):
            letters = letters and len(tokens[j].strip(STRIP)) == 1
            word = "".join(tokens[i : j + 1])
            low = word.strip(STRIP).lower()
            pieces = [t.strip(STRIP).lower() for t in tokens[i : j + 1]]
            if low.isalpha() and (letters and j - i >= 2 or not letters and j == i + 1 and min(map(self.count, pieces)) == 0):
                known = self.count(low) >= LEAST
                fixed = word if known else (self.correct(low) if letters else None)
                if fixed:
                    read = self.read(word) if not known else None
                    edge(i, j + 1, self.cost(low if known else fixed) + JOINING, read[0] if read else word, [])
            if not tokens[j][-1].isalpha():
                break
            j += 1

    def joined_faults(self, text: str, title: str, source: str | None, seen: dict[str, str] | None = None) -> list[str]:
        """Kinds of fault of a text whose line breaks were lost; `source` is the text with its lines, if there is one."""
        found: set[str] = set()
        rest = " " + re.sub(r"\s+", " ", text) + " "
        lines = source.split("\n") if source else []
        kinds = self.classes(lines, title, seen)
        full = [i for i, k in enumerate(kinds) if k != "blank"]
        # Furniture is found between the words that stand around it, so a bare number in the body is not taken for it.
        for k in range(len(full)):
            i = full[k]
            if kinds[i] not in ("header", "page_number"):
                continue
            own = " ".join(lines[i].split())
            before = " ".join(lines[full[k - 1]].split()[-1:]) if k else ""
            after = " ".join(lines[full[k + 1]].split()[:1]) if k + 1 < len(full) else ""
            if kinds[i] == "header":
                places = [f" {own} "]
            else:
                places = [f" {before} {own} {after} "]
            for place in places:
                place = re.sub(" +", " ", place)
                at = rest.find(place)
                if at >= 0:
                    found.add(kinds[i])
                    a = at + (len(before) + 1 if kinds[i] == "page_number" and before and place.startswith(f" {before} ") else 0)
                    rest = rest[:a] + " " + rest[a + len(own) + 1 :]
                    break
        if not source:
            for m in re.finditer(r" (— \d+ —|- \d+ -|[Pp]age \d+(?: of \d+)?|p\. \d+) ", rest):
                found.add("page_number")
                rest = rest.replace(m.group(0), " ")
        # The lines are lost: every token may end one.
        tokens = rest.split()
        found.update(kind for _, kind in self.stream(tokens, list(range(len(tokens))))[1])
        return sorted(found)

    # Repair ------------------------------------------------------------------------------------------------------

    def repair(self, text: str | None, title: str) -> str:
        """Continuous paragraphs, separated by blank lines."""
        if not text or not text.strip():
            return ""
        lines = text.split("\n")
        kinds = self.classes(lines, title)
        rows: list[tuple[str, bool]] = []  # body lines, and whether a blank line stands before
        gap = False
        for line, kind in zip(lines, kinds):
            if kind == "blank":
                gap = True
            elif kind == "body":
                rows.append((line.strip(), gap))
                gap = False
        if not rows:
            return ""
        breaks = self.paragraphs(rows)
        paragraphs: list[list[str]] = []
        for (line, _), new in zip(rows, breaks):
            if new or not paragraphs:
                paragraphs.append([])
            paragraphs[-1].append(line)
        return "\n\n".join(self.decode(p) for p in paragraphs)

    def decode(self, lines: list[str]) -> str:
        """The words of the lines read as one stream."""
        tokens, numbers = [], []
        for i, line in enumerate(lines):
            words = line.split()
            tokens += words
            numbers += [i] * len(words)
        return " ".join(self.stream(tokens, numbers)[0])

    def split(self, token: str) -> str:
        """Two words run together, if that is likelier than an unknown one."""
        core = token.strip(STRIP)
        low = core.lower()
        if len(core) < 6 or not core.isalpha() or self.count(low):
            return token
        best = None
        for k in range(2, len(core) - 1):
            a, b = self.count(low[:k]), self.count(low[k:])
            if a >= LEAST and b >= LEAST:
                cost = -math.log(a / self.total) - math.log(b / self.total)
                if best is None or cost < best[0]:
                    best = (cost, k)
        # An unknown word is taken to be as rare as one occurrence, and rarer with each letter.
        if best and best[0] < math.log(self.total) + 2.0 * len(core):
            return token.replace(core, core[: best[1]] + " " + core[best[1] :])
        return token

    def paragraphs(self, rows: list[tuple[str, bool]]) -> list[bool]:
        """Does a paragraph begin at each line? Dynamic programming over break or no break before each line."""
        width = sorted(len(x) for x, _ in rows)[int(0.8 * (len(rows) - 1))] or 1
        short = 2  # lines below which a paragraph costs extra

        def heading(x: str) -> bool:
            return len(x) < 0.6 * width and not ENDS.search(x) and x[:1].isupper() and len(x.split()) <= 6

        cost = {0: 0.0}  # lines of the open paragraph so far (capped) -> least cost
        back: list[dict[int, tuple[int, bool]]] = []
        for i, (line, gap) in enumerate(rows):
            before = rows[i - 1][0] if i else ""
            score = 0.0  # for a break: negative is likely
            if i:
                score += -2.5 if gap else 1.0
                ended = ENDS.search(before) is not None
                score += -0.7 if ended else 2.5
                score += -1.5 if ended and len(before) < 0.8 * width else 0.0
                score += 2.0 if line[:1].islower() else -0.3
                score += -3.5 if heading(before) or heading(line) else 0.0
            step: dict[int, tuple[float, int, bool]] = {}
            for n, c in cost.items():
                for new in (True, False):
                    if i == 0 and not new:
                        continue
                    extra = (score if new and i else 0.0) + (0.8 if new and 0 < n < short and not heading(before) else 0.0)
                    m = 1 if new else min(n + 1, short)
                    if m not in step or c + extra < step[m][0]:
                        step[m] = (c + extra, n, new)
            back.append({m: (n, new) for m, (_, n, new) in step.items()})
            cost = {m: c for m, (c, _, _) in step.items()}
        at = min(cost, key=cost.get)
        out: list[bool] = []
        for i in range(len(rows) - 1, -1, -1):
            at, new = back[i][at]
            out.append(new)
        return out[::-1]


def _words(text: str, counts: Counter) -> None:
    """Add the words of a text, without the parts of words at broken line ends."""
    after = False
    tokens: list[str] = []
    for line in text.split("\n"):
        new = line.split()
        if not new:
            continue
        if after:
            new = new[1:]
        after = broken(line.rstrip())
        tokens += new[:-1] if after else new
    counts.update(tokens)


def lexicon(df: DataFrame, text: str) -> dict[str, int]:
    """Word -> count over all different texts, of the words with `LEAST` occurrences."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch[text]:
                if t:
                    _words(t, counts)
            if len(counts) > 400_000:
                yield _folded(counts)
                counts = Counter()
        yield _folded(counts)

    # Copies of a text count once.
    cores = df.sparkSession.sparkContext.defaultParallelism
    different = df.where(F.col(text).isNotNull()).select(F.md5(text).alias("h"), text).repartition(2 * cores, "h").dropDuplicates(["h"])
    words = different.select(text).mapInPandas(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    kept = words.where(F.col("n") >= LEAST).limit(LEXICON + 1).collect()
    if len(kept) > LEXICON:
        raise ValueError(f"the lexicon has more than {LEXICON} words; raise LEXICON if executors can hold it")
    return {r[0]: r[1] for r in kept}


def _folded(counts: Counter) -> pd.DataFrame:
    folded: Counter = Counter()
    for token, n in counts.items():
        word = token.strip(STRIP).lower()
        if word and not NUMBER.match(word):
            folded[word] += n
    return pd.DataFrame({"w": pd.Series(list(folded), dtype=object), "n": pd.Series(list(folded.values()), dtype="int64")})


def title_key(title: str | None) -> str:
    return skeleton(re.sub(r"[^\w†!|]+", "", title or ""))


_readers: dict[str, Reader] = {}


def _reader(shared, name: str) -> Reader:
    """The reader of a broadcast lexicon, one for each worker process; `name` is the lexicon's own."""
    if name not in _readers:
        _readers.clear()
        _readers[name] = Reader(*shared.value)
    return _readers[name]


def _shared(papers: DataFrame, venues: DataFrame):
    names = [x for r in venues.select("venue", "short_name").collect() for x in r if x]
    return papers.sparkSession.sparkContext.broadcast((lexicon(papers, "full_text"), names)), uuid.uuid4().hex


def faults(papers: DataFrame, venues: DataFrame) -> DataFrame:
    """(text_id, field, line_no, kind) of every fault in full_text, clean_text and clean_sections.

    `venues` is a fixed table of a few hundred names.
    """
    shared, name = _shared(papers, venues)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _reader(shared, name)
        for batch in batches:
            rows = []
            for i, title, full, clean, sections in zip(
                batch["text_id"], batch["title"], batch["full_text"], batch["clean_text"], batch["sections"]
            ):
                key, seen = title_key(title), {}
                texts = [("full_text", full), ("clean_text", clean)]
                texts += [(f"clean_sections.{s['key']}", s["value"]) for s in (sections if sections is not None else [])]
                for field, text in texts:
                    if not text or not text.strip():
                        continue
                    if "\n" in text:
                        rows += [(i, field, n, k) for n, k in reader.faults(text, key, seen)]
                    else:
                        rows += [(i, field, 1, k) for k in reader.joined_faults(text, key, full if field != "full_text" else None, seen)]
            yield pd.DataFrame(rows, columns=["text_id", "field", "line_no", "kind"])

    rows = papers.select("text_id", "title", "full_text", "clean_text", F.map_entries("clean_sections").alias("sections"))
    return spread(rows).mapInPandas(run, f"text_id long, {FAULTS}")


def repaired(papers: DataFrame, venues: DataFrame) -> DataFrame:
    """(text_id, paper_id, text): each full_text, else clean_text, as continuous readable paragraphs."""
    shared, name = _shared(papers, venues)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _reader(shared, name)
        for batch in batches:
            made = [reader.repair(t, title_key(title)) for t, title in zip(batch["text"], batch["title"])]
            yield pd.DataFrame({"text_id": batch["text_id"], "paper_id": batch["paper_id"], "text": made})

    text = F.coalesce(F.nullif("full_text", F.lit("")), "clean_text")
    rows = papers.select("text_id", "paper_id", "title", text.alias("text"))
    return spread(rows).mapInPandas(run, "text_id long, paper_id string, text string")
