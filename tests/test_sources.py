from lexmill.sources import boolean, exports, manuscripts, payloads, tagged


def test_tagged_records(spark, tmp_path):
    text = "FN x\nVR 1\nPT J\nAU Cole, A\n   Dorn, B\nTI A long title\n   that goes on\nAB First line\n   second line\nDE gait; pain\nID pain; sleep\nPY 2020\nDI 10.1000/ABC.\nSO Journal\nER\nPT J\nTI abc\nER\n"
    (tmp_path / "a.txt").write_text(text)
    rows = tagged.plain_records(tagged.read_records(spark, str(tmp_path / "*.txt"))).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.title, r.abstract, r.authors) == ("a long title that goes on", "First line second line", ["Cole, A", "Dorn, B"])
    assert (r.keywords, r.year, r.doi) == (["gait", "pain", "sleep"], 2020, "10.1000/abc")


def test_dashed_records(spark):
    record = "PMID- 123\nTI  - A title that is long enough\n      and goes on\nAB  - " + "word " * 20 + "\nFAU - Cole, Ada\nAU  - Cole A\nFAU - Dorn, Bob\nMH  - Gait\nMH  - Pain\nDP  - 2019 Jan\nLID - 10.1000/x.1 [doi]"
    r = tagged.dashed_records(spark.createDataFrame([(record,), ("TI  - short",)], "record string")).collect()
    assert len(r) == 1 and r[0].authors == ["Cole, Ada", "Dorn, Bob"] and r[0].keywords == ["Gait", "Pain"]
    assert (r[0].pmid, r[0].year, r[0].doi) == ("123", 2019, "10.1000/x.1")


def test_sniff(spark):
    lines = [("PT\tAU\tTI\tSO\tAB",), ("\ufeffPT\tAU\tTI\tSO\tAB",), ("FN Export",), ("a\tb\tc\td\te",)]
    got = spark.createDataFrame(lines, "l string").select(tagged.sniff(spark_col("l"))).collect()
    assert [r[0] for r in got] == ["tsv", "tsv", "tagged", "tagged"]


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_exports(spark, tmp_path):
    (tmp_path / "acm.csv").write_text('# ; Titulo ; DOI ; Abstract\n1 ; "First title" ; "https://doi.org/10.1145/1.2" ; "An abstract that stops here..."\n2 ; "Second title" ; "" ; "Short one."\n3 ; "abc" ; "" ; ""\n')
    rows = {r.title: r for r in exports.read_export(spark, "acm", str(tmp_path / "acm.csv")).collect()}
    assert set(rows) == {"First title", "Second title"}
    assert rows["First title"].doi == "10.1145/1.2" and rows["First title"].landing_page == "https://doi.org/10.1145/1.2" and rows["First title"].abstract_truncated
    (tmp_path / "arxiv.csv").write_text('# ; arXiv_ID ; Titulo ; URL ; Abstract\n1 ; arXiv:2001.1234v2 ; A preprint title ; https://arxiv.org/abs/2001.1234 ; Something…\n')
    r = exports.read_export(spark, "arxiv", str(tmp_path / "arxiv.csv")).collect()[0]
    assert (r.source_id, r.pdf_url) == ("2001.1234", "https://arxiv.org/pdf/2001.1234")
    (tmp_path / "s.csv").write_text('Title,Authors,Year,DOI,Author Keywords,Abstract\n"A ""quoted"" title","Cole, A.; Dorn, B.",2020,10.1000/z,"gait | pain","Line one\nline two"\n')
    r = exports.read_export(spark, "scopus", str(tmp_path / "s.csv")).collect()[0]
    assert r.title == 'A "quoted" title' and r.authors == ["Cole, A.", "Dorn, B."] and r.keywords == ["gait", "pain"] and r.abstract == "Line one line two"
    (tmp_path / "w.tsv").write_text("\ufeffPT\tAU\tTI\tSO\tAB\tDI\tPY\tDE\tID\nJ\tCole, A; Dorn, B\tA tabbed title\tJournal\tText\t10.1/x\t2001\tpain; gait\tgait\n")
    r = exports.number_sources(exports.read_export(spark, "wos", str(tmp_path / "w.tsv")), ["title"]).collect()[0]
    assert r.paper_id == "wos_1" and r.keywords == ["gait", "pain"] and r.year == 2001


def test_payloads(spark):
    work = '{"results": [{"id": "https://x/W1", "doi": "https://doi.org/10.1/A", "title": "T", "publication_year": 2020, "abstract_inverted_index": {"full": [1], "abstract": [0, 2]}}]}'
    r = payloads.openalex_works(spark.createDataFrame([(work,), ("{broken",), (None,)], "payload string")).collect()
    assert len(r) == 1 and (r[0].source_id, r[0].abstract, r[0].year) == ("W1", "abstract full abstract", 2020)
    xml = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>2018 Jan-Feb</MedlineDate></PubDate></JournalIssue></Journal>
<ArticleTitle>Own title</ArticleTitle><Abstract><AbstractText>One.</AbstractText><AbstractText>Two.</AbstractText></Abstract><AuthorList><Author><LastName>Cole</LastName><ForeName>Ada</ForeName></Author></AuthorList></Article></MedlineCitation>
<PubmedData><ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">10.9/other</ArticleId></ArticleIdList></Reference></ReferenceList><ArticleIdList><ArticleId IdType="doi">10.1/own</ArticleId><ArticleId IdType="pmc">PMC5</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"""
    r = payloads.pubmed_articles(spark.createDataFrame([(xml,)], "payload string")).collect()[0]
    assert (r.pmid, r.doi, r.pmcid, r.year, r.abstract, r.authors) == ("7", "10.1/own", "PMC5", 2018, "One. Two.", ["Cole, Ada"])
    feed = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2001.1v3</id><title>A  t</title><summary>Some\n text</summary><published>2020-01-01</published><author><name>Ada</name></author></entry></feed>'
    r = payloads.atom_entries(spark.createDataFrame([(feed,)], "payload string")).collect()[0]
    assert (r.source_id, r.abstract, r.year, r.authors) == ("2001.1", "Some text", 2020, ["Ada"])
    assert payloads.balanced_json('text {"a": [1, "}"]} more') == '{"a": [1, "}"]}' and payloads.balanced_json("none {") is None


def test_snapshots(spark):
    rows = [("s", "q", "old", 1), ("s", "q", "new", 2), ("s", "r", "x", 1)]
    got = payloads.latest_snapshots(spark.createDataFrame(rows, "source string, query string, payload string, fetched_at int")).collect()
    assert sorted(r.payload for r in got) == ["new", "x"]


def test_boolean(spark):
    assert boolean.to_dnf("(a OR b) AND (c OR d)") == [["a", "c"], ["a", "d"], ["b", "c"], ["b", "d"]]
    assert boolean.to_dnf("a b OR c") == [["a", "b"], ["c"]] and boolean.to_dnf("") == [[]]
    df = spark.createDataFrame([("Gait in older adults",), ("Gaits and pain",), ("Deep learning of pain",), (None,)], "t string")
    pick = lambda q: sorted(r.t for r in df.where(boolean.matches(df.t, q)).collect() if r.t)
    assert pick("gait") == ["Gait in older adults"]
    assert pick("gait*") == ["Gait in older adults", "Gaits and pain"]
    assert pick('"deep learning" OR (gaits AND pain)') == ["Deep learning of pain", "Gaits and pain"]


def test_manuscripts(spark):
    bib = '@article{cole20, title = {A {Deep} title, with comma}, year = "2020"}\n@inproceedings{dorn, crossref = {conf}, title={X}}\n@proceedings{conf, title={The Conf}}'
    got = {k: f for _, k, f in manuscripts.bibtex_entries(bib)}
    assert got["cole20"] == {"title": "A Deep title, with comma", "year": "2020"} and got["dorn"]["booktitle"] == "The Conf"
    tex = "First one. We follow \\cite{cole20,dorn} as in e.g. other work, and more. Last."
    assert manuscripts.citation_contexts(tex) == [(k, "We follow \\cite{cole20,dorn} as in e.g. other work, and more.") for k in ("cole20", "dorn")]
    assert manuscripts.read_bibtex(spark.createDataFrame([(bib,), (None,)], "text string")).count() == 3
    assert manuscripts.read_contexts(spark.createDataFrame([(tex,), (None,)], "text string")).count() == 2


def test_news(spark):
    from lexmill.sources import news

    body = "word " * 40
    answer = '{"articles": [{"title": "A", "description": "%s", "url": "u1"}, {"title": "B", "content": "short", "url": "u2"}]}' % body
    rows = news.json_articles(spark.createDataFrame([(answer,), ("broken",), (None,)], "payload string")).collect()
    assert [r.title for r in rows] == ["A"] and len(rows[0].doc_id) == 8
    feed = f"<rss><item><title>C</title><description>&lt;p&gt;{body * 40}&lt;/p&gt;</description><link>u3</link></item></rss>"
    rows = news.rss_articles(spark.createDataFrame([(feed,)], "payload string")).collect()
    assert rows[0].title == "C" and len(rows[0].text) == news.MOST_TEXT and "<p>" not in rows[0].text
    files = spark.createDataFrame([(1,)], "a int")
    assert [r.origin for r in news.degrade(None, files).collect()] == ["file"]
    assert [r.origin for r in news.degrade(files.limit(0), files).collect()] == ["file"]
    assert [r.origin for r in news.degrade(files, files).collect()] == ["api"]
