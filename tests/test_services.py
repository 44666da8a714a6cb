import json

import pytest

from lexmill.sources import models as M
from lexmill.sources import services as S


def transport(answers, log):
    def send(url, params):
        log.append((url, dict(params)))
        status, body = answers(url, params) if callable(answers) else answers.pop(0)
        if status == -1:
            raise OSError("broken")
        return status, body if isinstance(body, bytes) else json.dumps(body).encode()

    return send


def client(answers, log, waits=None):
    return S.Client(transport(answers, log), wait=(waits if waits is not None else []).append)


def test_retries_then_answers():
    log, waits = [], []
    assert client([(503, b""), (-1, b""), (429, b""), (200, {"a": 1})], log, waits).json("u") == {"a": 1}
    assert waits == [2.0, 4.0, 6.0] and len(log) == 4


def test_gives_up_after_the_last_try():
    log, waits = [], []
    with pytest.raises(S.ServiceError):
        client([(500, b"")] * 4, log, waits).get("u")
    assert len(log) == 4 and len(waits) == 3


@pytest.mark.parametrize("status, error", [(401, S.CredentialsMissing), (403, S.CredentialsMissing), (404, S.ServiceError), (400, S.ServiceError)])
def test_what_no_try_can_change(status, error):
    log = []
    with pytest.raises(error):
        client([(status, b"")], log).get("u")
    assert len(log) == 1


def test_pages_end_with_a_short_page_or_the_limit():
    def answers(url, params):
        return 200, {"items": list(range(params["start"], min(params["start"] + params["count"], 60)))}

    for most, wanted in ((45, 45), (500, 60)):
        got = list(client(answers, []).pages("u", {"q": "x"}, most, 25, "start", "count", lambda a: a["items"]))
        assert got == list(range(wanted))


def test_the_cascade_asks_in_order_and_stops_at_the_first():
    log = []

    def answers(url, params):
        if "unpaywall" in url:
            return 200, {"best_oa_location": {"url_for_pdf": "http://x/p.pdf"}}
        return 404, b""

    c = client(answers, log)
    assert S.resolve("10.1/a", "A title", S.resolvers(c, "me@x")) == ("http://x/p.pdf", "unpaywall")
    assert ["openalex" in log[0][0], "unpaywall" in log[1][0], len(log)] == [True, True, 2]
    assert S.resolve("doi:10.18653/v1/2020.acl-main.1", None, S.resolvers(c, "m")) == ("https://aclanthology.org/2020.acl-main.1.pdf", "acl_anthology")


def test_a_found_title_must_be_alike():
    feed = "<feed><title>query</title><entry><id>http://arxiv.org/abs/2001.1v1</id><title>{}</title></entry></feed>"
    for named, wanted in (("Gait analysis with depth video", "https://arxiv.org/pdf/2001.1v1.pdf"), ("Something else entirely here", None)):
        c = client(lambda url, params: (200, feed.format(named).encode()) if "arxiv" in url else (404, b""), [])
        assert S.resolve(None, "Gait analysis with depth video", S.resolvers(c, "m"))[0] == wanted


def test_files_are_checked():
    assert S.checked_file(b"%PDF-" + b"x" * 10_000) and not S.checked_file(b"%PDF-" + b"x" * 100) and not S.checked_file(b"<html>" + b"x" * 20_000)


def test_files_resolved_in_batches(spark):
    rows = [(1, "10.1/a", "t", "http://good"), (2, "10.1/b", "t", "http://bad"), (3, None, None, None)]
    df = spark.createDataFrame(rows, "k int, doi string, title string, pdf_url string")

    def make():
        def send(url, params):
            if url in ("http://good", "http://oa"):
                return 200, b"%PDF-" + b"x" * 10_000
            if "openalex" in url:
                return 200, b'{"open_access": {"oa_url": "http://oa"}}'
            return 404, b""

        return S.Client(send, wait=lambda s: None)

    got = {r.k: (r.url, r.origin, r.file is not None) for r in S.resolved_files(df, "k", make, "m").collect()}
    assert got == {1: ("http://good", "given", True), 2: ("http://oa", "openalex", True), 3: (None, "unresolved", False)}


def test_abstracts_in_batches():
    log = []

    def answers(url, params):
        return 200, {"results": [{"doi": f"https://doi.org/{d.upper()}", "abstract_inverted_index": {"a": [0]}} for d in params["filter"][4:].split("|")]}

    got = S.abstracts_by_doi(client(answers, log), [f"10.1/{i}x" for i in range(120)])
    assert len(got) == 120 and len(log) == 3 and "10.1/7x" in got


def test_chain_of_models():
    calls, waits = [], []

    def broken(prompt):
        calls.append("broken")
        raise OSError

    def empty(prompt):
        calls.append("empty")
        return "<think>hm</think>"

    chain = M.Chain([broken, empty, lambda p: "<think>so</think>\n```json\n{\"a\": [1, 2,]}\n```"], wait=waits.append)
    assert chain.ask_json("x", None) == {"a": [1, 2]}
    assert calls == ["broken"] * 3 + ["empty"] and waits == [1.0, 2.0]
    assert M.Chain([broken], retries=0).ask_json("x", "default") == "default"


def test_json_is_repaired():
    assert M.repaired_json('Here: {"a": "b", "c": [1, {"d": "cut of') == {"a": "b", "c": [1, {"d": "cut of"}]}
    assert M.repaired_json("{“a”: 1,}") == {"a": 1} and M.repaired_json("nothing") is None


def test_zones_are_refined_only_where_unsure(spark):
    long = "x" * 150
    df = spark.createDataFrame([("claim", 0.9, long), ("claim", 0.3, long), ("claim", 0.3, "short")], "zone string, confidence double, text string")
    got = [r.z for r in df.select(M.refined_zone(df.zone, df.confidence, df.text, lambda: M.Chain([lambda p: "I say: METHOD."])).alias("z")).collect()]
    assert got == ["claim", "method", "claim"]


def test_queries_and_configurations():
    chain = M.Chain([lambda p: '["Gait", "gait ", "walking speed", ""]'])
    assert M.expanded_queries(chain, "gait") == ["gait", "walking speed"]
    assert M.deep_merge({"a": {"b": 1, "c": 2}, "d": [1]}, {"a": {"c": 3}, "d": [2]}) == {"a": {"b": 1, "c": 3}, "d": [2]}
