from pyspark.sql import functions as F

from broadsheet.functions import dates, html, text, urls
from broadsheet.functions.patterns import java


def one(spark, col, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(col.alias("x")).first().x


def test_normalize_url(spark):
    cases = {
        " HTTPS://Example.COM/Path/?utm_source=a&b=1#top ": "https://example.com/Path?b=1",
        "https://example.com/a?UTM_Medium=x&gclid=1": "https://example.com/a",
        "https://example.com/a?x=%20y": "https://example.com/a?x=%20y",
        "http://example.com:80": "http://example.com/",
        "https://example.com//": "https://example.com/",
        "no url": "no url",
        "": "",
    }
    df = spark.createDataFrame(list(cases.items()), "raw string, want string").withColumn("got", urls.normalize_url(F.col("raw")))
    again = df.withColumn("twice", urls.normalize_url(F.col("got")))
    for r in again.collect():
        assert r.got == r.want
        assert r.twice == r.got


def test_stable_id_ignores_tracking(spark):
    ids = [one(spark, urls.stable_item_id([F.col("u")], [F.col("t")]), u=u, t="title") for u in ("https://a.example.com/x", "https://A.example.com/x/?utm_campaign=1#y")]
    assert ids[0] == ids[1] and ids[0].startswith("v1_") and len(ids[0]) == 19
    assert one(spark, urls.stable_item_id([F.col("u")], [F.col("t")]), u="", t="title") != ids[0]


def test_relay_and_safe(spark):
    assert one(spark, urls.is_relay(F.col("u")), u="https://news.google.com/rss/articles/abc")
    assert not one(spark, urls.is_safe_article_url(F.col("u")), u="https://example.com/tag/x")
    assert not one(spark, urls.is_safe_article_url(F.col("u")), u="http://example.com/a")
    assert one(spark, urls.is_safe_article_url(F.col("u")), u="https://example.com/a")


def test_doi_and_source_id(spark):
    assert one(spark, urls.normalize_doi(F.col("d")), d="doi: 10.1234/abc.5.") == "10.1234/abc.5"
    assert one(spark, urls.normalize_doi(F.col("d")), d="https://doi.org/10.99/x") is None
    assert one(spark, urls.source_id(F.col("d")), d="The Vet, Daily!") == "src-the-vet-daily"


def test_image_cleaning(spark):
    clean = lambda u: one(spark, urls.clean_image_url(F.col("u"), F.col("b")), u=u, b="https://x.example.com/dir/page")
    assert clean("a.png") == "https://x.example.com/dir/a.png"
    assert clean("http://cdn.example.com/a.png?x=1") == "https://cdn.example.com/a.png?x=1"
    assert clean("/img/logo.png") is None
    assert clean("data:image/png;base64,xx") is None
    assert clean("https://lh3.googleusercontent.com/a.png") is None


def test_dates(spark):
    parse = lambda v: str(one(spark, dates.parse_timestamp(F.col("v")).cast("string"), v=v))
    assert parse("Tue, 02 Jan 2024 03:04:05 GMT") == "2024-01-02 03:04:05"
    assert parse("2024-01-02T03:04:05+09:00") == "2024-01-01 18:04:05"
    assert parse("2024-01-02") == "2024-01-02 00:00:00"
    assert parse("yesterday") == "None"
    assert one(spark, dates.calendar_age(F.col("v"), F.lit("2024-02-30")), v="2024-02-01") is None
    assert one(spark, dates.iso_week(F.col("v").cast("date")), v="2021-01-03") == "2020-W53"


def test_java_boundaries_are_ascii(spark):
    assert not one(spark, F.regexp_like("v", F.lit(java(r"\b(최초)\b"))), v="세계 최초 발견")
    assert one(spark, F.regexp_like("v", F.lit(java(r"\b(최초)\b"))), v="a최초b")
    assert one(spark, F.regexp_like("v", F.lit(java(r"(?i)\bowner\b"))), v="éowner.")
    assert not one(spark, F.regexp_like("v", F.lit(java(r"(?i)\bowner\b"))), v="owners")
    assert one(spark, F.regexp_like("v", F.lit(java(r"a\sb"))), v="a b")


def test_text_cleaning(spark):
    assert one(spark, text.clean_text(F.col("v")), v="<b>A</b>&nbsp;&#8364; &#x1F600;&amp;") == "A € 😀&"
    assert one(spark, text.numeric_tokens(F.col("v")), v="N = 12, 5  mg and 10%") == ["n = 12,", "5 mg", "10%"]
    assert one(spark, text.parse_count(F.col("v")), v=" < 10 ") == 5.0
    assert one(spark, text.parse_count(F.col("v")), v="1,230") == 1230.0
    assert one(spark, text.apply_rewrites(F.col("v")), v="The Owner of a hospital-site") == "The 보호자 of a 병원-부위"
    assert one(spark, text.foreign_script(F.col("v")), v="NSAID 사용 alongside 漢字 Alone") == ["漢字", "alongside", "Alone"]
    long = "word " * 60 + "end. " + "tail " * 40
    assert one(spark, text.trim_deck(F.col("v")), v=long).endswith("…")
    assert one(spark, text.trim_deck(F.col("v")), v=("a" * 100 + ". " + "b" * 200)) == "a" * 100 + "."


def test_page_extraction(spark):
    page = """<html><head><title> A title </title><meta content='D' name="description"><link href="https://e.org/c" rel="alternate canonical">
      <meta property="og:image" content="/logo.png"><meta content="/i/p.jpg" property="og:image"></head><body><article>%s</article><p>%s</p></body></html>"""
    article = "".join(f"<p>{'x' * 90} {i}</p>" for i in range(10))
    df = spark.createDataFrame([(page % (article, "y" * 100), "https://e.org/a")], "html string, url string")
    r = df.select(
        html.extract_body(F.col("html")).alias("body"), html.lead_image(F.col("html"), F.col("url")).alias("img"), html.page_title(F.col("html")).alias("title"),
        html.canonical_url(html.tag_attributes(F.col("html"), "link")).alias("canonical"), html.meta_content(html.tag_attributes(F.col("html"), "meta"), "name", "description").alias("d"),
    ).first()
    assert "y" not in r.body and r.body.count("\n") == 9
    assert (r.img, r.title, r.canonical, r.d) == ("https://e.org/i/p.jpg", "A title", "https://e.org/c", "D")


def test_short_article_falls_back_to_the_whole_page(spark):
    page = "<article><p>" + "a" * 100 + "</p></article>" + "".join(f"<p>{'b' * 100}{i}</p>" for i in range(9))
    body = one(spark, html.extract_body(F.col("h")), h=page)
    assert body.startswith("a" * 100) and body.count("\n") == 9


def test_title_folding_and_long_keys(spark):
    assert one(spark, text.normalize_title(F.col("t")), t="ＡＢＣ <b>①</b> Ｘ") == "abc 1 x"
    assert one(spark, urls.source_id(F.col("t")), t="ＡＢＣ ①") == "src-abc-1"
    long = "word " * 30
    first, second = (one(spark, text.title_key(F.col("t")), t=long + end) for end in ("a", "b"))
    assert first != second and len(first) == len(second) == 97
    first, second = (one(spark, urls.source_id(F.col("t")), t=long + end) for end in ("a", "b"))
    assert first != second


def test_nested_images(spark):
    def image(json):
        page = f'<script type="application/ld+json">{json}</script>'
        return one(spark, html.lead_image(F.col("h"), F.lit("https://e.org/a")), h=page)

    assert image('{"@graph": [{"about": {"image": {"url": "https://c.org/n.jpg"}}}]}') == "https://c.org/n.jpg"
    assert image('{"image": [{"url": "https://c.org/l.jpg"}, "https://c.org/m.jpg"]}') == "https://c.org/l.jpg"
    assert image('{"image": "https://c.org/s.jpg"}') == "https://c.org/s.jpg"
    assert image('{"image": 5, "name": "x"}') is None
