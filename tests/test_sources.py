import json

from pyspark.sql import functions as F

from broadsheet.sources import feeds, papers, records, registry, sinks

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>c</title>
<item><title> First   item </title><link>https://www.pub.org/a/1/?utm_source=rss</link><guid isPermaLink="false">g1</guid><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate>
<dc:identifier>doi:10.1234/abc</dc:identifier><description><![CDATA[<p>Body <b>text</b></p>]]></description></item>
<item><title>Second</title><link>https://other.org/b</link><pubDate>nonsense</pubDate><description>d</description></item>
<item><title></title><link>https://www.pub.org/c</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="html">Atom one</title><link rel="alternate" href="https://pub.org/x"/><id>urn:1</id><updated>2024-01-05T00:00:00Z</updated><summary>s</summary></entry></feed>"""
EVIL = '<!DOCTYPE x [<!ENTITY a "b">]><rss><channel><item><title>t</title><link>https://pub.org/e</link></item></channel></rss>'


def payloads(spark):
    rows = [("s1", "S1", "f1", ["pub.org"], RSS), ("s2", "S2", "f2", ["pub.org"], ATOM), ("s3", "S3", "f3", ["pub.org"], EVIL), ("s4", "S4", "f4", ["pub.org"], "x" * 2_000_001)]
    return spark.createDataFrame(rows, "source_id string, source_label string, feed_url string, domains array<string>, xml string")


def test_read_feeds(spark):
    got = {r.guid: r for r in feeds.read_feeds(payloads(spark)).collect()}
    assert set(got) == {"g1", "https://other.org/b", "urn:1"}
    first = got["g1"]
    assert (first.title, first.url, first.doi, first.description) == ("First item", "https://www.pub.org/a/1", "10.1234/abc", "Body text")
    # A DOI is no canonical URL; the official item URL takes its place.
    assert first.canonical_url == first.url and first.official and str(first.published_at) == "2024-01-02 03:04:05"
    other = got["https://other.org/b"]
    assert (other.official, other.canonical_url, other.published_at) == (False, None, None)
    assert got["urn:1"].url == "https://pub.org/x"


def test_read_news_feeds(spark):
    item = "<item><title>{t}</title><link>https://n.org/{i}</link><pubDate>{d}</pubDate><source url='x'>Paper</source><description>{b}</description></item>"
    day = "Tue, 02 Jan 2024 00:00:00 GMT"
    rows = [("Head line - Paper", 1, day, "b"), ("Animals, Vol. 16, Pages 2247: Real", 2, day, "b"), ("Old", 3, "Tue, 02 Jan 2018 00:00:00 GMT", "b"), ("Bad", 4, "?", "b"), ("Wall", 5, day, "Members Only"), ("Undated", 6, "", "b"), ("Capped", 7, day, "b")]
    xml = "<rss><channel>" + "".join(item.format(t=t, i=i, d=d, b=b) for t, i, d, b in rows) + "</channel></rss>"
    df = spark.createDataFrame([("s", "Label", "f", "us", True, 10, 3, xml)], "source_id string, source_label string, feed_url string, market string, is_news boolean, max_age_days int, max_items int, xml string")
    got = feeds.read_news_feeds(df, F.lit("2024-01-05").cast("timestamp")).orderBy("pos").collect()
    assert [(r.title, r.source_label) for r in got] == [("Head line", "Paper"), ("Real", "Paper"), ("Undated", "Paper")]


def test_polls_of_one_feed_do_not_compete(spark):
    item = "<item><title>{t}</title><link>https://n.org/{t}</link><pubDate>Tue, 02 Jan 2024 00:00:00 GMT</pubDate><description>b</description></item>"
    polls = [("s", "L", "f", "us", False, 10, 2, "<rss><channel>" + "".join(item.format(t=f"{p}{k}") for k in range(4)) + "</channel></rss>") for p in "ab"]
    df = spark.createDataFrame(polls, "source_id string, source_label string, feed_url string, market string, is_news boolean, max_age_days int, max_items int, xml string")
    now = F.lit("2024-01-05").cast("timestamp")
    assert sorted(r.title for r in feeds.read_news_feeds(df, now).collect()) == ["a0", "a1", "b0", "b1"]
    assert feeds.read_news_feeds(df.withColumn("max_items", F.lit(None).cast("int")), now).count() == 8


def test_large_feeds_are_read_and_refused_ones_named(spark):
    schema = "source_id string, source_label string, feed_url string, domains array<string>, xml string"
    entry = "<item><title>t{k}</title><link>https://n.org/{k}</link><description>" + "word " * 500 + "</description></item>"
    big = "<rss><channel>" + "".join(entry.replace("{k}", str(k)) for k in range(1001)) + "</channel></rss>"
    rows = [("s", "L", "big", [], big), ("s", "L", "dtd", [], "<!DOCTYPE x><rss/>"), ("s", "L", "nul", [], "<rss>\x00</rss>"), ("s", "L", "none", [], None), ("s", "L", "page", [], "<html>x</html>")]
    df = spark.createDataFrame(rows, schema)
    got = feeds.read_feeds(df).collect()
    assert len(got) == 1001 and all(len(r.description) == 2499 for r in got)
    assert {(r.feed_url, r.reason) for r in feeds.refused_payloads(df).collect()} == {("dtd", "document-type"), ("nul", "nul-character"), ("none", "empty"), ("page", "unreadable")}


def test_read_sitemap(spark):
    df = spark.createDataFrame([("m", "<urlset><url><loc>https://a/1</loc></url><url><loc>https://a/2</loc></url></urlset>")], "name string, xml string")
    assert [(r.name, r.loc) for r in feeds.read_sitemap(df).collect()] == [("m", "https://a/1"), ("m", "https://a/2")]


def test_read_papers(spark, tmp_path):
    one = """<PubmedArticle><MedlineCitation><PMID Version="1">{p}</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate>{d}</PubDate></JournalIssue></Journal>
      <ArticleTitle>T{p}</ArticleTitle><Abstract><AbstractText Label="AIM">{a}</AbstractText><AbstractText>End.</AbstractText></Abstract></Article></MedlineCitation>
      <PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/{p}</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"""
    (tmp_path / "p.xml").write_text(
        "<PubmedArticleSet>" + one.format(p=1, d="<Year>2024</Year><Month>Feb</Month><Day>31</Day>", a="x" * 200) + one.format(p=2, d="<MedlineDate>2023 Mar-Apr</MedlineDate>", a="y" * 200)
        + one.format(p=3, d="<Year>2024</Year>", a="short") + "</PubmedArticleSet>"
    )
    got = {r.pmid: r for r in papers.read_papers(spark, str(tmp_path)).collect()}
    assert set(got) == {"1", "2"}
    assert str(got["1"].published_on) == "2024-02-28" and str(got["2"].published_on) == "2023-03-01"
    assert got["1"].abstract == "AIM: " + "x" * 200 + "\nEnd." and got["1"].doi == "10.1/1"


def test_read_editions(spark, tmp_path):
    (tmp_path / "2024-01-02.json").write_text(json.dumps({"date": "2024-01-02", "status": "published", "items": [{"titleKo": "a"}, {"id": "x", "titleKo": "b"}, {"id": "y", "scheduledAt": "2030-01-01T00:00:00Z"}]}, indent=1))
    (tmp_path / "2024-01-03.draft.json").write_text(json.dumps({"items": [{"id": "d"}]}))
    (tmp_path / "notes.json").write_text(json.dumps({"items": [{"id": "n"}]}))
    now = F.lit("2024-02-01").cast("timestamp")
    assert sorted(r.item_key for r in records.read_editions(spark, str(tmp_path), now).collect()) == ["2024-01-02_1", "x"]
    assert "d" in {r.item_key for r in records.read_editions(spark, str(tmp_path), now, drafts=True).collect()}


def test_event_log_skips_malformed_lines(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"articleId":"a","newStatus":"approved"}\n{broken\n{"articleId":"b"}\n')
    assert sorted(r.articleId for r in records.read_event_log(spark, str(tmp_path)).collect()) == ["a", "b"]


def test_read_performance(spark, tmp_path):
    (tmp_path / "p.csv").write_text('﻿날짜,검색어,페이지,노출수,클릭수,클릭률\n2024-01-01,"a\nb",https://e.org/article/v1_x?y=1,"1,200",12,1%\n2024-01-02,c,https://e.org/,100,5,\n', encoding="utf8")
    got = {r["query"]: r for r in records.read_performance(spark, str(tmp_path), "naver").collect()}
    assert got["a\nb"].impressions == 1200 and got["a\nb"].article_id == "v1_x" and got["a\nb"].ctr == 1.0
    # An empty cell counts as zero.
    assert got["c"].ctr == 0.0 and got["c"].article_id is None


def test_read_keywords(spark, tmp_path):
    (tmp_path / "a.csv").write_text('안내\n\n연관키워드,월간검색수,,경쟁정도\n,월간검색수(PC),월간검색수(모바일),\n"강아지, 사료",< 10,"1,230",높음\n고양이,20,30,낮음\n', encoding="utf8")
    (tmp_path / "b.csv").write_text("keyword,monthlyPcQcCnt,monthlyMobileQcCnt,competitionIndex\ndog,1,2,x\n", encoding="utf8")
    got = {r.keyword: (r.volume, r.competition) for r in records.read_keywords(spark, str(tmp_path)).collect()}
    assert got == {"강아지, 사료": (1235.0, "높음"), "고양이": (50.0, "낮음"), "dog": (3.0, "x")}


def test_read_pages_and_comments(spark, tmp_path):
    (tmp_path / "x.html").write_text("<p>a</p>")
    (tmp_path / "x.txt").write_text("no")
    assert [r.html for r in records.read_pages(spark, str(tmp_path)).collect()] == ["<p>a</p>"]
    page = [{"data": {"children": []}}, {"data": {"children": [{"kind": "t1", "data": {"body": "hi", "score": 3, "stickied": False}}, {"kind": "more", "data": {}}, {"kind": "t1", "data": {"body": "pin", "stickied": True}}]}}]
    df = spark.createDataFrame([("p", json.dumps(page))], "post string, json string")
    assert [(r.post, r.score, r.body) for r in records.read_comments(df).collect()] == [("p", 3, "hi")]


def test_registry(spark):
    schema = "id string, label string, domains array<string>, rss_urls array<string>, atom_urls array<string>, enabled boolean, rate_limit_ms int, timeout_ms int, priority int, consecutive_failures int, health_status string"
    df = spark.createDataFrame([(None, " Vet News ", ["https://www.Vet.org/x", "vet.org"], ["f"], [], None, 10, 999999, None, None, None), (None, "Other", [], [], [], None, None, None, None, None, None)], schema)
    a, b = registry.normalize_registry(df).orderBy("rate_limit_ms").collect()
    assert (a.id, a.label, a.domains, a.enabled, a.rate_limit_ms, a.timeout_ms, a.priority, a.fetch_strategy) == ("src-vet-news", "Vet News", ["vet.org"], True, 250, 60000, 50, "rss")
    assert (b.enabled, b.rate_limit_ms, b.timeout_ms, b.priority, b.health_status) == (False, 1000, 12000, 0, "disabled")


def test_merge_and_upsert(spark):
    old = spark.createDataFrame([("d1", 1, ["u1"]), ("d2", 2, ["u2"])], "day string, id long, keys array<string>")
    new = spark.createDataFrame([("d1", 3, ["u1", "u9"]), ("d1", 4, ["u2"]), ("d2", 5, [])], "day string, id long, keys array<string>")
    assert sorted(r.id for r in sinks.merge_edition(old, new, "day", "id", "keys").collect()) == [1, 2, 4, 5]
    v = spark.createDataFrame([("a", "new", 1), ("a", "newer", 2)], "k string, v string, o long")
    base = spark.createDataFrame([("a", "old"), ("b", "old")], "k string, v string")
    assert sorted((r.k, r.v) for r in sinks.upsert(base, v, ["k"], [F.col("o").desc()]).collect()) == [("a", "newer"), ("b", "old")]


def test_writers_replace_only_their_days(spark, tmp_path):
    path = str(tmp_path / "editions")
    sinks.write_by_day(spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "day string, id long"), "day", path)
    sinks.write_by_day(spark.createDataFrame([("2024-01-02", 3)], "day string, id long"), "day", path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3]
    log = str(tmp_path / "log")
    for i in range(2):
        sinks.append_events(spark.createDataFrame([(f"a{i}", "x")], "articleId string, newStatus string"), log)
    assert records.read_event_log(spark, log).count() == 2
    chunks = str(tmp_path / "search")
    sinks.write_search_chunks(spark.createDataFrame([("2024-01", "a"), ("2024-02", "b")], "month string, id string"), "month", chunks)
    assert spark.read.json(chunks).count() == 2


def test_publish_only_without_blockers(spark, tmp_path):
    schema = "id string, day string, workflow_status string, published_at timestamp, first_published_at timestamp, scheduled_at timestamp"
    none = F.array().cast("array<string>")
    now, path = F.lit("2024-01-05").cast("timestamp"), str(tmp_path / "out")
    bad = spark.createDataFrame([("a", "d", "approved", None, None, None), ("b", "d", "draft", None, None, None)], schema)
    assert not sinks.publish_edition(bad, none, none, now, "day", path)
    assert sinks.publish_edition(bad.where("id = 'a'"), none, none, now, "day", path)
    row = spark.read.parquet(path).first()
    assert row.workflow_status == "published" and str(row.first_published_at) == "2024-01-05 00:00:00"


def test_xml_junk_is_what_xml_forbids(spark):
    from broadsheet.catalog.sources import XML_JUNK, xml_safe

    chars = spark.range(1, 0xD800).union(spark.range(0xE000, 0x10010)).select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    want = {*range(1, 9), 0x0B, 0x0C, *range(0x0E, 0x20), 0xFFFE, 0xFFFF, *map(ord, "<>&")}
    assert {r.id for r in chars.where(xml_safe(F.col("c")) != F.col("c")).collect()} == want
    assert "-" not in XML_JUNK.replace("\\uFFFE-", "")
