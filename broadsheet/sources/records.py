"""SC1, SC5-SC9: editions, listings, logs and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import KEYWORD_HEADERS, PERFORMANCE_HEADERS
from ..functions.patterns import strip, text
from ..functions.text import parse_count, parse_measure

_S, _A = T.StringType(), T.ArrayType(T.StringType())
ITEM = T.StructType(
    [T.StructField(n, _S) for n in ("id", "titleKo", "leadKo", "summaryKo", "angleKo", "sourceType", "sourceLabel", "sourceUrl", "sourceUrlRaw", "finalUrl",
                                    "canonicalUrl", "sourceTitle", "category", "imageUrl", "imageOwnership", "contentTier", "tier", "clinicalRisk",
                                    "workflowStatus", "editorialStatus", "publicationStatus", "sourceStatus", "duplicateStatus", "visibility",
                                    "publishedAt", "firstPublishedAt", "scheduledAt", "reviewedAt", "reviewedBy", "vetReviewedAt", "vetReviewer",
                                    "contentHash", "doi", "journal")]
    + [T.StructField(n, _A) for n in ("bodyKo", "keyPointsKo", "suppressedReason", "species")]
    + [T.StructField("relevance", T.IntegerType())]
)
EDITION = T.StructType(
    [T.StructField("date", _S), T.StructField("status", _S), T.StructField("generatedAt", _S), T.StructField("publishedAt", _S), T.StructField("items", T.ArrayType(ITEM))]
)
EVENT = "articleId string, reviewerRole string, previousStatus string, newStatus string, contentHash string, sourceHash string, reviewedAt timestamp"


def flatten_editions(files: DataFrame, now: Column, drafts: bool = False) -> DataFrame:
    """SC1. Items of dated edition files (``file``, ``edition``), without those scheduled for later, newest edition first
    by ``date``; ``pos`` keeps the order inside the file."""
    pattern = r"(\d{4}-\d{2}-\d{2})(?:\.draft)?\.json$" if drafts else r"(?:^|/)(\d{4}-\d{2}-\d{2})\.json$"
    day = F.regexp_extract("file", pattern, 1)
    named = files.withColumn("_day", day).where(F.col("_day") != "")
    rows = named.select(
        F.coalesce("edition.date", "_day").alias("date"), F.col("edition.status").alias("status"), F.coalesce("edition.publishedAt", "edition.generatedAt").alias("edition_published"),
        F.posexplode("edition.items").alias("pos", "item"),
    )
    later = F.try_to_timestamp("item.scheduledAt") > now
    rows = rows.where(~F.coalesce(later, F.lit(False)))
    return rows.withColumn("item_key", F.coalesce(F.nullif("item.id", F.lit("")), F.concat("date", F.lit("_"), (F.col("pos") + 1).cast("string"))))


def read_editions(spark: SparkSession, path: str, now: Column, drafts: bool = False) -> DataFrame:
    """SC1 from a folder of edition files, one JSON document per file."""
    files = spark.read.schema(EDITION).json(path, multiLine=True)
    edition = F.struct(*[F.col(f.name) for f in EDITION.fields])
    return flatten_editions(files.select(F.input_file_name().alias("file"), edition.alias("edition")), now, drafts)


def parse_editions(payloads: DataFrame, now: Column, drafts: bool = False) -> DataFrame:
    """SC1 from a payload column ``json``."""
    return flatten_editions(payloads.select("file", F.from_json("json", EDITION).alias("edition")), now, drafts)


_POST = T.StructType(
    [T.StructField(n, _S) for n in ("id", "subreddit", "title", "selftext", "permalink")]
    + [T.StructField("score", T.LongType()), T.StructField("num_comments", T.LongType()), T.StructField("created_utc", T.DoubleType())]
    + [T.StructField(n, T.BooleanType()) for n in ("over_18", "stickied", "is_self")]
)
_LISTING = T.StructType([T.StructField("data", T.StructType([T.StructField("children", T.ArrayType(T.StructType([T.StructField("data", _POST)])))]))])
_COMMENT = T.StructType([T.StructField("body", _S), T.StructField("score", T.LongType()), T.StructField("stickied", T.BooleanType())])
_COMMENTS = T.ArrayType(
    T.StructType([T.StructField("data", T.StructType([T.StructField("children", T.ArrayType(T.StructType([T.StructField("kind", _S), T.StructField("data", _COMMENT)])))]))])
)


def read_social(payloads: DataFrame, json: str = "json", max_chars: int | None = None) -> DataFrame:
    """SC5. Posts of a listing payload; ``max_chars`` shortens their texts."""
    posts = payloads.select(F.explode(F.from_json(json, _LISTING)["data"]["children"]).alias("c")).select("c.data.*")
    return posts.select(
        "id", F.lit("social").alias("source_type"), F.concat(F.lit("r/"), "subreddit").alias("source_label"), "subreddit", "title",
        (text(F.col("selftext")) if max_chars is None else F.substring(text(F.col("selftext")), 1, max_chars)).alias("body"), "score", "num_comments", F.concat(F.lit("https://www.reddit.com"), "permalink").alias("url"),
        F.timestamp_micros((F.col("created_utc") * 1000000).cast("long")).alias("published_at"), F.col("over_18").alias("over18"), "stickied", "is_self",
    )


def read_comments(payloads: DataFrame, json: str = "json", limit: int | None = None, max_chars: int | None = None) -> DataFrame:
    """SC5. The comments of a post page, without pinned and empty ones; the first ``limit`` of a page if it is given."""
    children = F.get(F.from_json(json, _COMMENTS), F.lit(1))["data"]["children"]
    kept = F.filter(children, lambda c: (c["kind"] == "t1") & (text(c["data"]["body"]) != "") & ~F.coalesce(c["data"]["stickied"], F.lit(False)))
    body = lambda c: c["data"]["body"] if max_chars is None else F.substring(c["data"]["body"], 1, max_chars)
    top = F.transform(kept if limit is None else F.slice(kept, 1, limit), lambda c: F.struct(c["data"]["score"].alias("score"), body(c).alias("body")))
    keep = [c for c in payloads.columns if c != json]
    return payloads.select(*keep, F.posexplode(top).alias("pos", "c")).select(*keep, "pos", "c.score", "c.body")


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """SC6. JSON lines; malformed lines are dropped."""
    return spark.read.schema(EVENT).option("mode", "DROPMALFORMED").json(path)


def parse_event_lines(lines: DataFrame, line: str = "value", schema: str = EVENT) -> DataFrame:
    """SC6 from a column of lines."""
    parsed = lines.select(F.from_json(line, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return parsed.where(F.col("r").isNotNull() & F.col("r._corrupt").isNull()).select("r.*").drop("_corrupt")


def normalize_performance(raw: DataFrame, provider: str) -> DataFrame:
    """SC7. Report rows under any of the known headers, numbers cleaned, click rate between 0 and 1."""

    def pick(name: str) -> Column:
        # The first header that exists wins, even where its cell is empty.
        held = [h for h in PERFORMANCE_HEADERS[name] if h in raw.columns]
        return text(F.col(f"`{held[0]}`")) if held else F.lit("")

    impressions, clicks = parse_measure(pick("impressions")), parse_measure(pick("clicks"))
    ctr = parse_measure(pick("ctr"))
    ctr = F.when(ctr > 1, ctr / 100).otherwise(ctr)
    page = pick("page")
    return raw.select(
        F.lit(provider).alias("provider"), pick("date").alias("date"), pick("query").alias("query"), page.alias("page"), pick("country").alias("country"),
        pick("device").alias("device"), impressions.alias("impressions"), clicks.alias("clicks"),
        F.coalesce(ctr, F.when(impressions != 0, clicks / impressions)).alias("ctr"), parse_measure(pick("position")).alias("position"),
        F.nullif(F.regexp_extract(page, r"article/([^/.?#]+)", 1), F.lit("")).alias("article_id"),
    )


def read_performance(spark: SparkSession, path: str, provider: str) -> DataFrame:
    """SC7 from CSV files with quoted multi-line cells."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    bare = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    return normalize_performance(bare, provider)


def _cells(line: Column) -> Column:
    """Cells of a CSV line: split at commas outside quotes, quotes removed."""
    parts = F.split(line, ',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(parts, lambda c: strip(F.regexp_replace(F.regexp_replace(strip(c), '^"|"$', ""), '""', '"')))


def parse_keyword_lines(lines: DataFrame) -> DataFrame:
    """SC8. Keyword rows from (file, line_no, line): the header is the first line that names the keyword column, and
    may go on in a second line with the PC and mobile columns."""
    has_keyword = F.lit(False)
    for name in KEYWORD_HEADERS["keyword"]:
        has_keyword = has_keyword | F.contains("line", F.lit(name))
    filled = lines.where(strip(F.col("line")) != "")
    head = filled.where(has_keyword).groupBy("file").agg(F.min("line_no").alias("_head"), F.min_by("line", "line_no").alias("_h1"))
    after = filled.join(head, "file").where(F.col("line_no") > F.col("_head"))
    second = after.groupBy("file").agg(F.min("line_no").alias("_next"), F.min_by("line", "line_no").alias("_h2"))
    heads = head.join(second, "file")
    two = F.exists(_cells(F.col("_h2")), lambda c: F.regexp_like(c, F.lit(r"\((?:PC|모바일)\)")))
    merged = F.transform(_cells(F.col("_h1")), lambda c, i: F.coalesce(F.nullif(F.get(_cells(F.col("_h2")), i), F.lit("")), c))
    heads = heads.select("file", F.when(two, merged).otherwise(_cells(F.col("_h1"))).alias("header"), F.when(two, F.col("_next")).otherwise(F.col("_head")).alias("_last"))
    rows = filled.join(heads, "file").where(F.col("line_no") > F.col("_last")).withColumn("cells", _cells(F.col("line"))).where(F.size("cells") > 1)

    def pick(name: str) -> Column:
        found = [F.nullif(F.array_position("header", h), F.lit(0)) for h in KEYWORD_HEADERS[name]]
        return F.coalesce(F.get("cells", (F.coalesce(*found) - 1).cast("int")), F.lit(""))

    return rows.select(
        "file", "line_no", pick("keyword").alias("keyword"), (parse_count(pick("pc")) + parse_count(pick("mobile"))).alias("volume"), pick("competition").alias("competition")
    ).where(F.col("keyword") != "")


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """SC8 from keyword exports, which are small files; each is read whole to number its lines."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_replace("value", "^﻿", "").alias("t"))
    return parse_keyword_lines(files.select("file", F.posexplode(F.split("t", r"\r?\n")).alias("line_no", "line")))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """SC9. HTML files, one row each, or a Parquet table with url and html."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.text(path, wholetext=True, pathGlobFilter="*.html", recursiveFileLookup=True).select(F.input_file_name().alias("url"), F.col("value").alias("html"))
