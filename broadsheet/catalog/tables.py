"""The given tables in the roles the operators expect, as DataFrames and as the same thing in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import WS
from ..functions import text as tx
from ..functions.patterns import once, strip_plain
from ..operators.rules import find, judge, read

NOW = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    if name in ("documents", "pages", "conversations"):
        df = spread(df)
    zoned = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(zoned) if zoned else df


def spread(df: DataFrame) -> DataFrame:
    """For local runs on a table of one row group: where the session sets ``spark.broadsheet.spread``, rows are dealt to so
    many tasks. Off by default, since on a cluster it would shuffle whole texts."""
    tasks = int(df.sparkSession.conf.get("spark.broadsheet.spread", "0"))
    return df.repartition(tasks) if tasks else df


def now():
    return F.lit(NOW).cast("timestamp")


TITLE = r"^([^.!?\n]*)"


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """documents as articles: first sentence as title, lines as paragraphs."""
    return table(spark, sf, "documents").withColumns(
        {"title": once(F.regexp_extract("text", TITLE, 1), strip_plain), "paragraphs": tx.paragraphs(F.col("text"))}
    )


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def sql_squeeze(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '[{WS}]+', ' ', 'g'))"


ART = f"""art AS (
  SELECT doc_id, text, lang, source, n_chars, {sql_strip(f"regexp_extract(text, '{TITLE}', 1)")} AS title,
         [p for p in [{sql_strip('q')} for q in string_split(text, chr(10))] if p <> ''] AS paragraphs
  FROM documents)"""


def states(spark: SparkSession, sf: str) -> DataFrame:
    """Time, value and type of events, by the article of the same number."""
    return table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), "ts", "value", "event_type", "user_id")


def dated(spark: SparkSession, sf: str) -> DataFrame:
    """articles with the time, value and type of the event of the same number, if there is one."""
    return articles(spark, sf).join(states(spark, sf), "doc_id", "left")


DATED = ART + """,
dated AS (SELECT a.*, e.ts, e.value, e.event_type, e.user_id FROM art a LEFT JOIN events e ON e.event_id = a.doc_id)"""


def items(spark: SparkSession, sf: str, change: Callable[[DataFrame], DataFrame] = lambda read: read) -> DataFrame:
    """Articles as items of an edition: scores from labels, states from events, the rest from the text itself.

    The rules look at the texts before the join, so texts that nobody asks for afterwards are not shuffled. ``change`` sees the
    content of the items, with the texts that the rules work on, before that.
    """
    col = F.col
    content = articles(spark, sf).select(
        "doc_id", col("doc_id").cast("string").alias("id"), "title", "text", "lang", "n_chars",
        F.coalesce(F.try_element_at("paragraphs", F.lit(1)), F.lit("")).alias("lead"),
        F.slice("paragraphs", 2, F.greatest(F.size("paragraphs"), F.lit(1))).alias("paragraphs"),
        col("source").alias("source_label"), col("lang").alias("category"),
        F.when(col("lang") == "en", "index-news").when(col("lang") == "fr", "index-low-risk").when(col("lang") == "de", "index-analysis").otherwise("public-brief").alias("publication_status"),
        F.concat(F.lit("https://"), "lang", F.lit(".example.com/a/"), F.substring(F.md5("text"), 1, 12)).alias("source_url"),
        F.concat(F.lit("https://img.example.com/"), "source", F.lit("/"), (col("n_chars") % 97).cast("string"), F.lit(".jpg")).alias("image_url"),
        F.when(col("lang") == "en", "owned").when(col("lang") == "fr", "licensed").when(col("lang") == "de", "official-press").alias("image_ownership"),
        F.when(col("n_chars") > 1500, col("title")).alias("radar_clinical"),
        F.array(F.lit("en"), F.lit("fr")).alias("species"), col("lang").alias("species_studied"),
        F.when(col("n_chars") > 3000, "analysis").when(col("n_chars") > 1000, "evidence").when(col("n_chars") > 300, "brief").alias("content_tier"),
    )
    found = find(change(read(content)))
    joined = found.join(states(spark, sf), "doc_id", "left").join(table(spark, sf, "labels"), "doc_id", "left")
    return judge(
        joined.withColumns(
            {
                "published_at": col("ts"), "date": F.to_date("ts"),
                "clinical_risk": F.when(col("toxic") == 1, "high").when(col("quality") == 0, "medium").when(col("quality") == 1, "low"),
                "workflow_status": F.when(col("event_type") == "view", "published").when(col("event_type") == "click", "approved").when(col("event_type") == "error", "correction-required")
                .when(col("event_type") == "purchase", "automated").otherwise("draft"),
                "reviewed_at": F.when(col("quality") == 1, col("ts")), "reviewed_by": F.when(col("quality") == 1, F.concat(F.lit("r"), col("user_id"))),
                "duplicate_status": F.when(col("quality") == 0, "exact-duplicate").otherwise("unique"),
                "source_status": F.when(col("event_type") == "error", "unresolved").otherwise("verified"),
                "visibility": F.when((col("toxic") == 1) & (col("quality") == 0), "suppressed"),
                "scheduled_at": F.when(col("event_type") == "signup", col("ts") + F.expr("INTERVAL 5 DAYS")),
                "review_policy_version": F.when(col("user_id") > 75, "v1"),
                "selection_score": col("value") / 100, "relevance": F.floor("value").cast("int"),
            }
        ).drop("ts")
    )


ITEMS = DATED + """,
items AS (
  SELECT d.doc_id, d.doc_id::VARCHAR AS id, d.title, d.text, d.lang, d.value, d.event_type, d.user_id, l.quality, l.toxic, d.n_chars,
    coalesce(d.paragraphs[1], '') AS lead, d.paragraphs[2:] AS paragraphs, d.source AS source_label, d.lang AS category,
    d.ts AS published_at, CAST(d.ts AS DATE) AS date,
    CASE WHEN l.toxic = 1 THEN 'high' WHEN l.quality = 0 THEN 'medium' WHEN l.quality = 1 THEN 'low' END AS clinical_risk,
    CASE d.lang WHEN 'en' THEN 'index-news' WHEN 'fr' THEN 'index-low-risk' WHEN 'de' THEN 'index-analysis' ELSE 'public-brief' END AS publication_status,
    CASE d.event_type WHEN 'view' THEN 'published' WHEN 'click' THEN 'approved' WHEN 'error' THEN 'correction-required' WHEN 'purchase' THEN 'automated' ELSE 'draft' END AS workflow_status,
    'https://' || d.lang || '.example.com/a/' || substr(md5(d.text), 1, 12) AS source_url,
    CASE WHEN l.quality = 1 THEN d.ts END AS reviewed_at, CASE WHEN l.quality = 1 THEN 'r' || d.user_id END AS reviewed_by,
    'https://img.example.com/' || d.source || '/' || (d.n_chars % 97) || '.jpg' AS image_url,
    CASE d.lang WHEN 'en' THEN 'owned' WHEN 'fr' THEN 'licensed' WHEN 'de' THEN 'official-press' END AS image_ownership,
    CASE WHEN d.n_chars > 1500 THEN d.title END AS radar_clinical,
    CASE WHEN l.quality = 0 THEN 'exact-duplicate' ELSE 'unique' END AS duplicate_status,
    CASE WHEN d.event_type = 'error' THEN 'unresolved' ELSE 'verified' END AS source_status,
    CASE WHEN l.toxic = 1 AND l.quality = 0 THEN 'suppressed' END AS visibility,
    CASE WHEN d.event_type = 'signup' THEN d.ts + INTERVAL 5 DAY END AS scheduled_at,
    CASE WHEN d.user_id > 75 THEN 'v1' END AS review_policy_version,
    CASE WHEN d.n_chars > 3000 THEN 'analysis' WHEN d.n_chars > 1000 THEN 'evidence' WHEN d.n_chars > 300 THEN 'brief' END AS content_tier,
    d.value / 100 AS selection_score, CAST(floor(d.value) AS INTEGER) AS relevance
  FROM dated d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def with_sql(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


URL = r"^(https?)://([^/?#]+)([^?#]*)(\?[^#]*)?(#.*)?$"


def sql_url(col: str, group: int) -> str:
    return f"regexp_extract({col}, '{URL}', {group}, 'i')"


def sql_host(col: str) -> str:
    return f"regexp_replace(regexp_replace(lower({sql_url(sql_strip(col), 2)}), '^[^@]*@|:\\d*$', '', 'g'), '^www\\.', '')"


def sql_path(col: str) -> str:
    return f"(CASE WHEN {sql_url(sql_strip(col), 3)} = '' THEN '/' ELSE {sql_url(sql_strip(col), 3)} END)"


def sql_normal_url(col: str) -> str:
    """Normalised URL as SQL, written as its own derivation from the parts."""
    u = sql_strip(f"coalesce({col}, '')")
    host = f"regexp_replace(lower({sql_url(u, 2)}), CASE WHEN lower({sql_url(u, 1)}) = 'http' THEN ':80$' ELSE ':443$' END, '')"
    p = sql_url(u, 3)
    path = f"coalesce(nullif(CASE WHEN length({p}) > 1 THEN regexp_replace({p}, '/+$', '') ELSE {p} END, ''), '/')"
    q = sql_url(u, 4)
    params = f"list_filter(string_split(substr({q}, 2), '&'), lambda x: x <> '')"
    kept = f"list_filter({params}, lambda x: NOT regexp_matches(split_part(x, '=', 1), '^(utm_|gclid$|fbclid$|mc_cid$|mc_eid$|oc$)', 'i'))"
    written = f"array_to_string(list_transform({kept}, lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END), '&')"
    query = f"CASE WHEN len({kept}) = len({params}) THEN {q} WHEN len({kept}) = 0 THEN '' ELSE '?' || {written} END"
    return f"(CASE WHEN regexp_matches({u}, '{URL}', 'i') THEN lower({sql_url(u, 1)}) || '://' || {host} || {path} || {query} ELSE {u} END)"
