"""Boolean queries over text columns, compiled to a predicate that the optimizer sees.

Grammar: OR binds weaker than AND, AND may be left out, parentheses nest, "quoted phrases" match as they are, a star
stands for any characters, other terms match as whole words. Matching ignores case.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r'"[^"]*"|[()|]|[^\s()"|]+')


class _Parser:
    def __init__(self, query: str):
        self.tokens = _TOKEN.findall(query)
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def either(self) -> list[frozenset[str]]:
        out = self.both()
        while self.peek().upper() == "OR" or self.peek() == "|":
            self.take()
            out += [g for g in self.both() if g not in out]
        return out

    def both(self) -> list[frozenset[str]]:
        out: list[frozenset[str]] = [frozenset()]
        while self.peek() and self.peek() != ")" and self.peek().upper() != "OR" and self.peek() != "|":
            if self.peek().upper() == "AND":
                self.take()
                continue
            if self.peek() == "(":
                self.take()
                part = self.either()
                if self.peek() == ")":
                    self.take()
            else:
                part = [frozenset([self.take()])]
            out = [a | b for a in out for b in part]
        return out


def to_dnf(query: str) -> list[list[str]]:
    """Groups of terms: all terms of some group must match. An empty query is one empty group, which matches everything."""
    return [sorted(g) for g in _Parser(query).either()]


def term_pattern(term: str) -> str:
    if term.startswith('"'):
        return re.escape(term.strip('"').lower())
    parts = [re.escape(p) for p in term.lower().split("*")]
    body = ".*".join(parts)
    return rf"\b{body}\b" if "*" not in term else body


def matches(text: Column, query: str) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    groups = []
    for group in to_dnf(query):
        groups.append(reduce(lambda a, b: a & b, [low.rlike(term_pattern(t)) for t in group], F.lit(True)))
    return reduce(lambda a, b: a | b, groups)
