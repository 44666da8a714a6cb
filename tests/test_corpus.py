import re

from pyspark.sql import functions as F

from lexmill.plans import corpus as C


def brute(text):
    for m in re.finditer(C.HEADING, text):
        tail = text[m.end() : m.end() + C.PROBED]
        dense = len(re.findall(C.YEARS, tail)) >= 3 and (
            len(re.findall(C.CITED, tail)) >= 2 or len(re.findall(C.SURNAMES, tail)) >= 3 or len(re.findall(C.YEARS_IN_BRACKETS, tail)) >= 3
        )
        if len(tail) < C.SHORT_TAIL or dense:
            return text[: m.start()].rstrip()
    return text


def test_reference_tails(spark):
    entry = "Doe, A. (2001). Gait. Journal of Tests, vol. 3. Roe, B. (2002). Pain. doi 10.1/x. "
    plain = "It is said here again that nothing of the kind was seen in any of the rooms. " * 30
    texts = [
        "Body text.\nReferences\n" + entry * 4, "Body. References 1 are many. " + plain, "Body. References A loose word. " + plain + "\nBibliography\n" + entry * 4,
        "No heading at all.", "", "References\n" + entry * 4, "Short tail.\nREFERENCES [1]", "Body.\nreferences " + entry * 3 + "\nReferences " + entry,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "k int, text string")
    got = {r.k: r.t for r in df.select("k", C.without_reference_tail(F.col("text")).alias("t")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)} | {99: None}
    # The full stop before a heading belongs to it.
    assert got[0] == "Body text" and got[1] == texts[1]
