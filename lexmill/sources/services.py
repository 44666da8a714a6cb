"""Services over HTTP behind a replaceable transport: a client with retries, pages of results, resolvers and downloads.

A transport is a function (url, params) -> (status, body); tests and offline runs give their own. On a cluster the client
runs inside Arrow batches (`fetched`), so requests are spread like the rows that ask for them.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame

Transport = Callable[[str, dict], tuple[int, bytes]]

#: Answers that are worth another try, and those that no further try can change.
AGAIN = (429, 500, 502, 503, 504)
REFUSED, ABSENT = (401, 403), 404
#: How a file must begin, and its least size in bytes.
FILE_MARK, FILE_LEAST = b"%PDF-", 10_000
#: Share of a title's words that a found title must hold.
OVERLAP = 0.6


class ServiceError(Exception):
    """The service gave no usable answer."""


class CredentialsMissing(ServiceError):
    """The service refuses; another try without other credentials is pointless."""


def urllib_transport(timeout: int = 30, headers: dict[str, str] | None = None) -> Transport:
    def send(url: str, params: dict) -> tuple[int, bytes]:
        from urllib.error import HTTPError

        full = f"{url}?{urlencode(params)}" if params else url
        try:
            with urlopen(Request(full, headers=headers or {}), timeout=timeout) as answer:
                return answer.status, answer.read()
        except HTTPError as e:
            return e.code, e.read()

    return send


@dataclass
class Client:
    """GET with linear back-off: `retries` further tries for `AGAIN` and for broken connections, none for anything else."""

    transport: Transport
    retries: int = 3
    backoff: float = 2.0
    pause: float = 0.0
    wait: Callable[[float], None] = field(default=time.sleep)

    def get(self, url: str, params: dict | None = None) -> bytes:
        reason = ""
        for tried in range(self.retries + 1):
            try:
                status, body = self.transport(url, params or {})
            except OSError as e:
                status, body, reason = 0, b"", str(e)
            if status in REFUSED:
                raise CredentialsMissing(f"{status} at {url}")
            if status == ABSENT:
                raise ServiceError(f"nothing at {url}")
            if 200 <= status < 300:
                if self.pause:
                    self.wait(self.pause)
                return body
            if status and status not in AGAIN:
                raise ServiceError(f"{status} at {url}")
            reason = reason or str(status)
            if tried < self.retries:
                self.wait(self.backoff * (tried + 1))
        raise ServiceError(f"{url}: {reason} after {self.retries + 1} tries")

    def json(self, url: str, params: dict | None = None):
        return json.loads(self.get(url, params))

    def pages(self, url: str, params: dict, most: int, size: int, start: str, count: str, items: Callable[[dict], list]) -> Iterator[dict]:
        """Up to `most` items of pages of `size`, which are asked for by the place of their first item."""
        at = 0
        while at < most:
            found = items(self.json(url, params | {start: at, count: min(size, most - at)}))
            yield from found[: most - at]
            at += len(found)
            if len(found) < size:
                return

    def try_json(self, url: str, params: dict | None = None) -> dict:
        """The answer, or nothing where the service has none."""
        try:
            return self.json(url, params) or {}
        except (ServiceError, ValueError):
            return {}


def anthology_url(doi: str | None) -> str | None:
    """The address that an identifier of the anthology itself tells."""
    found = re.match(r"10\.18653/v1/(.+)", re.sub(r"^(?:doi:|https?://doi\.org/)", "", (doi or "").strip()))
    return f"https://aclanthology.org/{found.group(1)}.pdf" if found else None


def resolvers(client: Client, email: str) -> list[tuple[str, Callable[[str | None, str | None], str | None]]]:
    """(name, resolver of (doi, title)) in the order in which they are asked."""

    def openalex(doi, title):
        return doi and (client.try_json(f"https://api.openalex.org/works/https://doi.org/{doi}").get("open_access") or {}).get("oa_url")

    def unpaywall(doi, title):
        return doi and (client.try_json(f"https://api.unpaywall.org/v2/{doi}", {"email": email}).get("best_oa_location") or {}).get("url_for_pdf")

    def scholar(doi, title):
        fields = {"fields": "openAccessPdf,externalIds"}
        base = "https://api.semanticscholar.org/graph/v1/paper"
        paper = client.try_json(f"{base}/DOI:{doi}", fields) if doi else {}
        if not paper and title:
            paper = next(iter(client.try_json(f"{base}/search", fields | {"query": title[:150], "limit": 1}).get("data") or []), {})
        return (paper.get("openAccessPdf") or {}).get("url")

    def arxiv(doi, title):
        if not title:
            return None
        try:
            feed = client.get("https://export.arxiv.org/api/query", {"search_query": f'ti:"{title[:100]}"', "max_results": 1}).decode()
        except ServiceError:
            return None
        entry = feed[feed.find("<entry>") :] if "<entry>" in feed else feed
        own, named = re.search(r"<id>https?://arxiv\.org/abs/([^<]+)</id>", entry), re.search(r"<title>([^<]+)</title>", entry)
        words = set(title.lower().split())
        if not own or named and len(words & set(named.group(1).lower().split())) < OVERLAP * max(len(title.split()), 1):
            return None
        return f"https://arxiv.org/pdf/{own.group(1).strip()}.pdf"

    return [("acl_anthology", lambda doi, title: anthology_url(doi)), ("openalex", openalex), ("unpaywall", unpaywall), ("semantic_scholar", scholar), ("arxiv", arxiv)]


def resolve(doi: str | None, title: str | None, cascade) -> tuple[str | None, str]:
    """(address, name of the first resolver that has one)."""
    for name, resolver in cascade:
        if address := resolver(doi, title):
            return address, name
    return None, "unresolved"


def checked_file(body: bytes | None) -> bytes | None:
    """The file, if it begins as one and is not too small."""
    return body if body and body.startswith(FILE_MARK) and len(body) >= FILE_LEAST else None


def download(client: Client, address: str | None) -> bytes | None:
    if not address or address == "None":
        return None
    try:
        return checked_file(client.get(address))
    except ServiceError:
        return None


def resolved_files(df: DataFrame, key: str, client: Callable[[], Client], email: str) -> DataFrame:
    """(key, url, origin, file) of rows (key, doi, title, pdf_url): the known address first, else the cascade's.

    `client` makes the client in each task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        cascade = resolvers(own, email)
        for batch in batches:
            rows = []
            for k, doi, title, known in zip(batch[key], batch["doi"], batch["title"], batch["pdf_url"]):
                address, origin = known, "given"
                body = download(own, known)
                if body is None:
                    address, origin = resolve(doi, title, cascade)
                    body = download(own, address)
                rows.append((k, address, origin, body))
            yield pd.DataFrame(rows, columns=[key, "url", "origin", "file"])

    kind = dict(df.dtypes)[key]
    return df.select(key, "doi", "title", "pdf_url").mapInPandas(run, f"{key} {kind}, url string, origin string, file binary")


def abstracts_by_doi(client: Client, dois: list[str], size: int = 50) -> dict[str, dict[str, list[int]]]:
    """Inverted abstracts of identifiers, asked for in batches."""
    out: dict[str, dict[str, list[int]]] = {}
    for at in range(0, len(dois), size):
        part = dois[at : at + size]
        answer = client.try_json("https://api.openalex.org/works", {"filter": "doi:" + "|".join(part), "per-page": size})
        for work in answer.get("results") or []:
            if work.get("doi") and work.get("abstract_inverted_index"):
                out[re.sub(r"^https?://doi\.org/", "", work["doi"].lower())] = work["abstract_inverted_index"]
    return out


