from lexmill.llm import truncation as T

SCHEMA = "hit_id long, source string, abstract string, id string, c string"
WHOLE = "We tested {0} in small rooms. The results of {0} were better than those of the control group. Two readers checked every record of {0} by hand."


def rows():
    out = [(i, "a", WHOLE.format(f"method{i}"), "i", "c") for i in range(60)]
    cut = {
        100: "We tested methodx in small rooms. The results of methodx were better than those of", 101: "We tested methodx in small rooms. The results of methodx were bet",
        102: "We tested methody in small rooms. Two readers checked every…", 103: "We tested methodz in small rooms [...]", 104: "We tested methodz in small rooms (see the con",
        106: "We tested methodv in small rooms. The results of methodv were bettertha" + "n" * 90, 105: "We tested methodq in small rooms. The resul&am",
    }
    whole = {200: "We tested methodk in small rooms. Two readers checked every record of methodk by hand", 201: None, 202: "", 203: " ", 207: "We tested methodj in small rooms (less :( than expected. Two readers checked every record of methodj by hand.", 204: "No abstract available.", 205: "Short.", 206: "n/a"}
    for i, t in (cut | whole).items():
        out.append((i, "b", t, None, None))
    out.append((300, "b", cut[100], None, None))
    out.append((301, "c", (WHOLE.format("m") + " ") * 3000, None, None))
    return out, set(cut) | {300}


def test_cut_records(spark):
    data, wanted = rows()
    df = spark.createDataFrame(data, SCHEMA)
    assert {r.hit_id for r in T.truncated(df, "hit_id", "abstract").collect()} == wanted
    share = {r.source: r for r in T.cut_share(df, "hit_id", "abstract", "source").collect()}
    assert share["a"].n_cut == 0 and share["b"].n_cut == 8 and share["b"].n_texts == 11


def test_empty(spark):
    assert T.truncated(spark.createDataFrame([], SCHEMA), "hit_id", "abstract").count() == 0
