"""Answers of language models: a chain of models with retries, cleaned and repaired, behind replaceable functions."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.sources.payloads import balanced_json

#: A model is a function from a prompt to its answer; it may raise OSError or TimeoutError.
Model = Callable[[str], str]


def cleaned(answer: str | None) -> str:
    """The answer without what a model thinks aloud and without fences around it."""
    text = re.sub(r"(?is)<think(?:ing)?>.*?(?:</think(?:ing)?>|\Z)", "", answer or "")
    text = re.sub(r"(?im)^\s*```[a-z]*\s*$", "", text)
    return text.strip()


def repaired_json(answer: str | None):
    """The first object or array of an answer, also where commas trail, quotes are curly or its end was cut; else None."""
    text = cleaned(answer)
    found = balanced_json(text)
    if found is None:
        start = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
        if start < 0:
            return None
        found = text[start:] + _closing(text[start:])
    for attempt in (found, re.sub(r",\s*([}\]])", r"\1", found.translate(str.maketrans("“”„", '"""')))):
        try:
            return json.loads(attempt)
        except ValueError:
            continue
    return None


def _closing(text: str) -> str:
    """What closes the open strings, objects and arrays of a text that was cut."""
    open_: list[str] = []
    quoted = escaped = False
    for c in text:
        if quoted:
            quoted = c != '"' or escaped
            escaped = c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c in "{[":
            open_.append("}" if c == "{" else "]")
        elif c in "}]" and open_:
            open_.pop()
    return ('"' if quoted else "") + "".join(reversed(open_))


@dataclass
class Chain:
    """Models in order: each is tried again where it fails, and the next one takes over where it stays without an answer."""

    models: list[Model]
    retries: int = 2
    backoff: float = 1.0
    wait: Callable[[float], None] = field(default=time.sleep)

    def ask(self, prompt: str) -> str:
        for model in self.models:
            for tried in range(self.retries + 1):
                try:
                    if answer := cleaned(model(prompt)):
                        return answer
                    break  # an empty answer stays empty; the next model may have one
                except (OSError, TimeoutError):
                    if tried < self.retries:
                        self.wait(self.backoff * (tried + 1))
        return ""

    def ask_json(self, prompt: str, default):
        found = repaired_json(self.ask(prompt))
        return default if found is None else found


def answered(prompt: Column, chain: Callable[[], Chain]) -> Column:
    """The chain's answer to each prompt, in Arrow batches; `chain` makes it once in each task."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = chain()
        for batch in batches:
            yield batch.map(lambda p: own.ask(p) if p else "")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(prompt)


#: Zones that a model may answer with when a rule is unsure.
ZONES = ("background", "gap", "method", "claim", "evidence", "future_work")
UNSURE, LEAST_CHARACTERS = 0.6, 100


def refined_zone(zone: Column, confidence: Column, text: Column, chain: Callable[[], Chain]) -> Column:
    """The zone of a model where the rule is unsure and the text long enough; any other answer leaves the rule's zone."""
    unsure = (confidence < UNSURE) & (F.length(text) > LEAST_CHARACTERS)
    prompt = F.when(unsure, F.concat(F.lit(f"Answer with one of {', '.join(ZONES)}: "), text))
    found = F.lower(F.regexp_extract(answered(prompt, chain), r"(?i)\b(" + "|".join(ZONES) + r")\b", 1))
    return F.when(found != "", found).otherwise(zone)


def expanded_queries(chain: Chain, query: str, most: int = 7) -> list[str]:
    """The query and further phrasings of it, different ones, up to `most` in all."""
    found = chain.ask_json(f"Give a JSON list of short search phrases for: {query}", [])
    phrases = [query, *[p.strip() for p in found if isinstance(p, str) and p.strip()]]
    return list({p.lower(): p for p in reversed(phrases)}.values())[::-1][:most]


def deep_merge(base: dict, over: dict) -> dict:
    """Configuration `over` laid over `base`: objects merge, everything else replaces."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, dict) else v
    return out
