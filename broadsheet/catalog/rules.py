"""Queries for classification, quality and consistency rules (CL*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions.patterns import matches, settle
from ..operators import aggregate, topk, windows
from ..operators import joins as J
from ..operators import rules as R
from . import query
from .identity import registry_domains, sql_title
from .tables import (
    ART, ITEMS, NOW, WS, articles, items, now, sql_host, sql_squeeze, sql_strip, table, with_sql,
)
from .texts import re2

SQL_DIAGNOSTIC = f"""diag AS (
  SELECT user_id AS feed, count(*) AS items, max(ts) AS newest, round((epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 86400000000.0, 2) AS age_days,
    CASE WHEN count(*) >= 2 THEN round((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0 / (count(*) - 1), 2) END AS average_gap_days,
    round(count(*) FILTER (event_type <> 'signup') / count(*), 3) AS canonical_coverage, round(count(*) FILTER (value > 99) / count(*), 3) AS relay_ratio,
    count(*) - count(DISTINCT props) AS duplicate_guids FROM events GROUP BY user_id)"""


def rx(col: str, pattern: str) -> str:
    flag = ", 'i'" if pattern.startswith("(?i)") else ""
    return f"regexp_matches({col}, '{re2(pattern.replace('(?i)', '', 1))}'{flag})"


def sql_codes(pairs) -> str:
    whens = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for cond, code in pairs)
    return f"list_filter([{whens}], lambda c: c IS NOT NULL)"


def sql_compact(col: str) -> str:
    return f"regexp_replace({col}, '[{WS}]', '', 'g')"


def sql_sentence(col: str) -> str:
    v = sql_strip(col)
    return (f"({v} <> '' AND {rx(v, C.HANGUL)} AND NOT {rx(v, C.FOREIGN_SCRIPT)} AND NOT {rx(v, C.INTERNAL_ASCII)} "
            f"AND ({rx(v, C.SENTENCE_END)} OR {rx(v, C.HANGUL_TAIL)}))")


_BANNED = " OR ".join(f"contains(lower(all_text), '{t.lower()}')" for t in C.BANNED_TERMS)
_SHARED = [
    ("title = ''", "title-missing"), ("lead = '' AND body = ''", "body-missing"), (rx("all_text", C.FOREIGN_SCRIPT), "foreign-script"),
    (rx("all_text", C.UNTRANSLATED), "untranslated-term"), (_BANNED, "banned-term"), (rx("all_text", C.GARBLED), "garbled-text"),
    (rx("all_text", C.TEMPLATE), "template-text"), (rx("all_text", C.INTERNAL_ASCII), "internal-ascii"), (rx("all_text", C.BAD_PARTICLE), "particle-error"),
    ("repeated", "repeated-word"),
]
_BRIEF = [("length(title) < 10", "brief-title-too-short"), ("body_chars < 250 OR length(lead) < 250", "brief-too-short")]
_FULL = [
    ("len(paragraphs) < 3", "paragraphs-too-few"), ("body_chars < 420", "body-too-short"),
    ("len([p for p in compacted if length(p) < 40]) > 0", "paragraph-too-short"), ("len(list_distinct(compacted)) <> len(compacted)", "duplicate-paragraph"),
    (f"NOT {sql_sentence('title')}", "title-not-korean-sentence"),
    (f"NOT {sql_sentence('(CASE WHEN lead <> $$$$ THEN lead ELSE coalesce(paragraphs[1], $$$$) END)')}".replace("$$$$", "''"), "lead-not-korean-sentence"),
    (f"len([p for p in paragraphs if NOT {sql_sentence('p')}]) > 0", "body-not-korean-sentence"),
    ("len(title_words) >= 2 AND length(body) >= 120 AND len([w for w in title_words if contains(body, w)]) = 0", "title-body-mismatch"),
    ("source_url = ''", "source-missing"), ("radar_clinical IS NULL", "radar-missing"),
]

# items with tier, risk, role and the rule codes, written in SQL.
ITEMS_Q = ITEMS + f""",
iq0 AS (
  SELECT *, array_to_string(paragraphs, ' ') AS body, {sql_squeeze("title || ' ' || lead || ' ' || array_to_string(paragraphs, ' ') || ' '")} AS all_text,
    length({sql_compact("array_to_string(paragraphs, '')")}) AS body_chars, [{sql_compact('p')} for p in paragraphs] AS compacted,
    [w for w in regexp_split_to_array(regexp_replace(title, '[^가-힣A-Za-z0-9{WS}]', ' ', 'g'), '[{WS}]+') if length(w) >= 2] AS title_words,
    array_to_string(list_filter([title, lead, array_to_string(paragraphs, ' '), coalesce(radar_clinical, '')], lambda x: x <> ''), ' ') AS rule_text
  FROM items),
iqp AS (SELECT doc_id, regexp_extract_all(all_text, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+') AS pieces FROM iq0),  -- neighbours are compared, there are no back-references
iqr AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(pieces) AS w, unnest(list_concat(pieces[2:], [''])) AS x, unnest(list_concat(pieces[3:], ['', ''])) AS y FROM iqp) WHERE length(w) > 1 AND x = ' ' AND lower(w) = lower(y) AND regexp_matches(w, '^[A-Za-z]+$')),
iq1 AS (
  SELECT *, doc_id IN (SELECT doc_id FROM iqr) AS repeated, coalesce(content_tier, 'brief') AS ctier,
    coalesce(clinical_risk, CASE WHEN {rx('rule_text', C.HIGH_RISK)} THEN 'high' WHEN {rx('rule_text', C.LOW_RISK)} AND NOT {rx('rule_text', C.MEDIUM_RISK)} THEN 'low'
      WHEN {rx('rule_text', C.MEDIUM_RISK)} THEN 'medium' ELSE 'low' END) AS risk,
    CASE WHEN clinical_risk = 'high' OR (clinical_risk = 'medium' AND {rx('rule_text', C.CLINICAL_ACTION)}) THEN 'vet' ELSE 'editor' END AS role
  FROM iq0),
iq2 AS (
  SELECT *, CASE WHEN ctier = 'brief' THEN list_concat({sql_codes(_SHARED)}, {sql_codes(_BRIEF)}) ELSE list_concat({sql_codes(_SHARED)}, {sql_codes(_FULL)}) END AS quality_codes,
    {sql_codes([
        ("workflow_status IN ('draft', 'automated', 'correction-required')", "workflow-not-approved"), ("workflow_status = 'correction-required'", "correction-required"),
        ("workflow_status IN ('approved', 'published') AND role = 'vet'", "vet-review-missing"),
        ("workflow_status IN ('approved', 'published') AND role = 'editor' AND reviewed_at IS NULL", "editor-review-missing")])} AS workflow_codes,
    {sql_codes([
        ("workflow_status = 'correction-required'", "correction-required"), ("workflow_status IN ('draft', 'automated')", "workflow-not-approved"),
        ("risk = 'high'", "high-risk-vet-review-unavailable"), ("risk = 'high'", "high-risk-not-vet-reviewed"),
        ("risk = 'medium' AND publication_status <> 'index-news' AND reviewed_at IS NULL", "medium-risk-not-editor-reviewed")])} AS review_codes,
    {sql_codes([(rx('rule_text', '(?i)' + p), p) for p in C.UNSAFE_PHRASES])} AS unsafe
  FROM iq1),
iq3 AS (
  SELECT *, {sql_codes([
        ("publication_status = 'index-low-risk' AND coalesce(clinical_risk, '') <> 'low'", "index-low-risk-requires-low"),
        ("publication_status = 'index-news' AND ctier <> 'brief'", "index-news-requires-brief"),
        ("publication_status = 'index-news' AND coalesce(clinical_risk, '') NOT IN ('low', 'medium')", "index-news-requires-low-or-medium"),
        ("publication_status IN ('index-news', 'index-low-risk', 'public-brief') AND len(unsafe) > 0", "unsafe-clinical-command")])} AS grade_codes
  FROM iq2),
iq AS (
  SELECT *, coalesce(visibility, '') <> 'suppressed' AND NOT list_has_any(quality_codes, {list(C.CARD_BLOCKERS)}) AS renderable,
    list_sort(list_distinct(list_concat(list_concat(quality_codes, review_codes),
      list_concat(CASE WHEN review_policy_version IS NOT NULL AND publication_status NOT IN ('index-news', 'index-low-risk') THEN workflow_codes ELSE [] END, grade_codes)))) AS publish_codes
  FROM iq3)"""


def checked(spark, sf):
    """items with the rule codes as columns."""
    i = items(spark, sf).withColumns(
        {
            "quality_codes": R.quality_issues(), "publish_codes": F.array_sort(R.publish_issues()), "ctier": R.content_tier(),
            "risk": R.clinical_risk(), "role": R.required_role(),
        }
    )
    return i.withColumn("renderable", R.card_renderable(F.col("quality_codes")))


def joined(col):
    return F.array_join(col, ",")


@query("cl1_quality_issues", with_sql(ITEMS_Q, "SELECT doc_id, array_to_string(quality_codes, ',') AS codes FROM iq"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", joined(R.quality_issues()).alias("codes"))


@query("cl1_repeated_word", with_sql(ITEMS_Q, "SELECT doc_id, lang FROM iq WHERE repeated"))
def _(spark, sf):
    found = items(spark, sf, lambda read: settle(read, repeated=R.repeated_word(F.col("_all"))))
    return found.where("repeated").select("doc_id", "lang")


@query("cl2_publish_issues", with_sql(ITEMS_Q, "SELECT doc_id, array_to_string(publish_codes, ',') AS codes FROM iq"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", joined(F.array_sort(R.publish_issues())).alias("codes"))


@query("cl3_card_renderable", with_sql(ITEMS_Q, "SELECT doc_id, renderable FROM iq"))
def _(spark, sf):
    return checked(spark, sf).select("doc_id", "renderable")


SQL_INDEXABLE = """(coalesce(visibility, '') <> 'suppressed' AND len(publish_codes) = 0 AND CASE publication_status
    WHEN 'index-analysis' THEN reviewed_at IS NOT NULL AND ctier IN ('analysis', 'evidence') WHEN 'index-low-risk' THEN ctier IN ('analysis', 'evidence')
    WHEN 'index-news' THEN ctier = 'brief' AND coalesce(clinical_risk, '') IN ('low', 'medium') ELSE FALSE END)"""


@query("cl4_indexable", with_sql(ITEMS_Q, f"SELECT doc_id, {SQL_INDEXABLE} AS indexable, {SQL_INDEXABLE.replace('len(publish_codes) = 0', 'TRUE')} AS grade_fits FROM iq"))
def _(spark, sf):
    none = F.array().cast("array<string>")
    return checked(spark, sf).select("doc_id", R.indexable(F.col("publish_codes")).alias("indexable"), R.indexable(none).alias("grade_fits"))


@query("cl5_content_tier", with_sql(ITEMS_Q, """
    SELECT doc_id, ctier, CASE WHEN lang = 'es' THEN 'brief' WHEN quality = 1 THEN 'evidence' WHEN body_chars >= 420 AND radar_clinical IS NOT NULL AND radar_clinical <> '' THEN 'analysis' ELSE 'brief' END AS derived_tier FROM iq"""))
def _(spark, sf):
    i = items(spark, sf)
    bare = i.withColumns({"content_tier": F.lit(None).cast("string"), "category": F.when(F.col("lang") == "es", "brief"), "doi": F.when(F.col("quality") == 1, F.lit("10.1234/x"))})
    return i.select("doc_id", R.content_tier().alias("ctier")).join(bare.select("doc_id", R.content_tier().alias("derived_tier")), "doc_id")


@query("cl6_topics", with_sql(ART, """
    , h AS (SELECT doc_id, unnest([{'ord': 0, 'slug': 'ing', 'm': len(regexp_extract_all(title, 'ing', 0, 'i')), 'b': len(regexp_extract_all(text, 'ing', 0, 'i'))},
        {'ord': 1, 'slug': 'tion', 'm': len(regexp_extract_all(title, 'tion', 0, 'i')), 'b': len(regexp_extract_all(text, 'tion', 0, 'i'))},
        {'ord': 2, 'slug': 'eau', 'm': len(regexp_extract_all(title, 'eau', 0, 'i')), 'b': len(regexp_extract_all(text, 'eau', 0, 'i'))},
        {'ord': 3, 'slug': 'lich', 'm': len(regexp_extract_all(title, 'lich|sch', 0, 'i')), 'b': len(regexp_extract_all(text, 'lich|sch', 0, 'i'))}]) AS x FROM art),
    f AS (SELECT doc_id, x.ord AS ord, x.slug AS slug, x.m AS m, x.b AS b, max(x.m) OVER (PARTITION BY doc_id) AS top FROM h),
    r AS (SELECT doc_id, slug, row_number() OVER (PARTITION BY doc_id ORDER BY m DESC, b DESC, ord) AS rn, top FROM f WHERE (top > 0 AND m > 0) OR (top = 0 AND b >= 2))
    SELECT doc_id, rn AS topic_rank, slug FROM r WHERE rn <= CASE WHEN top > 0 THEN 3 ELSE 1 END"""))
def _(spark, sf):
    a = with_topics(articles(spark, sf))
    return a.select("doc_id", F.posexplode("topics").alias("pos", "slug")).select("doc_id", (F.col("pos") + 1).alias("topic_rank"), "slug")


DEMO_TOPICS = (("ing", "ing"), ("tion", "tion"), ("eau", "eau"), ("lich", "lich|sch"))


def with_topics(a, dictionary=DEMO_TOPICS):
    return a.withColumn("topics", topk.best_topics(topk.topic_hits(F.col("title"), F.col("text"), dictionary)))


_FIXED_HITS = "[" + ", ".join(
    f"{{'ord': {i}, 'slug': '{s}', 'm': len(regexp_extract_all(title, '{m}', 0, 'i')), 'b': len(regexp_extract_all(text, '{m}', 0, 'i'))}}" for i, (s, m) in enumerate(C.TOPICS)
) + "]"


@query("cl6_topics_fixed_dictionary", with_sql(ART, f"""
    , h AS (SELECT doc_id, unnest({_FIXED_HITS}) AS x FROM art), f AS (SELECT doc_id, x.ord AS ord, x.slug AS slug, x.m AS m, x.b AS b, max(x.m) OVER (PARTITION BY doc_id) AS top FROM h),
    r AS (SELECT doc_id, slug, row_number() OVER (PARTITION BY doc_id ORDER BY m DESC, b DESC, ord) AS rn, top FROM f WHERE (top > 0 AND m > 0) OR (top = 0 AND b >= 2)),
    l AS (SELECT doc_id, string_agg(slug, ',' ORDER BY rn) AS topics FROM r WHERE rn <= CASE WHEN top > 0 THEN 3 ELSE 1 END GROUP BY 1)
    SELECT art.doc_id, coalesce(topics, '') AS topics FROM art LEFT JOIN l ON l.doc_id = art.doc_id"""))
def _(spark, sf):
    a = with_topics(articles(spark, sf), C.TOPICS)
    return a.select("doc_id", joined("topics").alias("topics"))


@query("cl7_clinical_risk", with_sql(ITEMS_Q, "SELECT doc_id, risk FROM iq"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", R.clinical_risk().alias("risk"))


@query("cl8_review_issues", with_sql(ITEMS_Q, "SELECT doc_id, array_to_string(review_codes, ',') AS codes FROM iq"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", joined(R.review_issues()).alias("codes"))


@query("cl9_workflow_issues", with_sql(ITEMS_Q, "SELECT doc_id, role, array_to_string(workflow_codes, ',') AS codes FROM iq"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", R.required_role().alias("role"), joined(R.workflow_issues()).alias("codes"))


@query("cl10_contract_issues", f"""
    SELECT o_orderkey, array_to_string({sql_codes([
        ("o_orderstatus = 'P'", "lead-missing"), ("o_orderpriority = '1-URGENT'", "source-missing"), ("o_totalprice < 50000", "content-tier-missing"),
        ("o_orderstatus = 'F'", "clinical-risk-missing"), ("o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM')", "workflow-status-missing"), ("o_orderpriority = '5-LOW'", "publication-status-invalid")])}, ',') AS codes FROM orders""")
def _(spark, sf):
    o, p = table(spark, sf, "orders"), F.col("o_orderpriority")
    rows = o.select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("id"), F.lit("t").alias("title"), F.when(F.col("o_orderstatus") != "P", "lead").alias("lead"),
        F.array(F.lit("p")).alias("paragraphs"), F.lit("label").alias("source_label"), F.when(p != "1-URGENT", "https://a.example.com/").alias("source_url"),
        F.col("o_orderdate").alias("published_at"), F.when(F.col("o_totalprice") >= 50000, "brief").alias("content_tier"),
        F.when(F.col("o_orderstatus") != "F", "low").alias("clinical_risk"), F.when(p == "2-HIGH", "draft").when(p == "3-MEDIUM", "approved").otherwise("?").alias("workflow_status"),
        F.when(p == "5-LOW", "public").otherwise("public-brief").alias("publication_status"),
    )
    return R.prepare(rows).select("o_orderkey", joined(R.contract_issues()).alias("codes"))


UNSAFE_DEMO = ("the\\s+of", "ing\\s+on", "scum|trash", "anea")


@query("cl11_safety_issues", with_sql(ITEMS_Q, f"SELECT doc_id, array_to_string({sql_codes([(rx('rule_text', '(?i)' + p), p) for p in UNSAFE_DEMO])}, ',') AS found, len(unsafe) AS n_fixed FROM iq"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", joined(R.safety_issues(UNSAFE_DEMO)).alias("found"), F.size(R.safety_issues()).alias("n_fixed"))


@query("cl12_publication_policy", with_sql(ITEMS, """
    SELECT doc_id, publication_status AS stated, CASE WHEN review_policy_version IS NULL THEN NULL WHEN clinical_risk = 'high' THEN 'blocked-clinical' ELSE 'internal-draft' END AS defaulted FROM items"""))
def _(spark, sf):
    i = items(spark, sf)
    bare = i.withColumn("publication_status", F.lit(None).cast("string"))
    return i.select("doc_id", R.publication_policy().alias("stated")).join(bare.select("doc_id", R.publication_policy().alias("defaulted")), "doc_id")


def turns(spark, sf):
    """Assistant turns with the user turn before them."""
    c = table(spark, sf, "conversations")
    user = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("source_text"))
    return c.where("role = 'assistant'").join(user, ["conv_id", "turn"])


TURNS = """t AS (SELECT a.conv_id, a.turn, a.text, u.text AS source_text FROM conversations a JOIN conversations u
  ON u.conv_id = a.conv_id AND u.turn + 1 = a.turn AND u.role = 'user' WHERE a.role = 'assistant')"""


def sql_numbers(col: str) -> str:
    from .texts import sql_numbers as numbers

    return numbers(col)


@query("cl13_numeric_consistency", with_sql(TURNS, f"""
    , n AS (SELECT conv_id, turn, {sql_numbers("text || ' n=' || length(text) || ', 5 mg'")} AS lead_n, {sql_numbers("source_text || ' 5 mg'")} AS body_n, {sql_numbers("'n=' || turn")} AS key_n FROM t)
    SELECT conv_id, turn, array_to_string({sql_codes([("len([x for x in lead_n if NOT list_contains(body_n, x)]) > 0", "numeric-lead-body-mismatch"), ("len([x for x in key_n if NOT list_contains(body_n, x)]) > 0", "numeric-keypoints-body-mismatch")])}, ',') AS codes FROM n"""))
def _(spark, sf):
    lead = F.concat("text", F.lit(" n="), F.length("text").cast("string"), F.lit(", 5 mg"))
    key = F.concat(F.lit("n="), F.col("turn").cast("string"))
    return turns(spark, sf).select("conv_id", "turn", joined(R.numeric_issues(lead, F.concat("source_text", F.lit(" 5 mg")), key, F.lit(""))).alias("codes"))


KNOWN_DEMO = ("scum", "trash", "pathetic")
SQL_LANGUAGE = sql_codes(
    [(rx("rule_text", C.INTERNAL_ASCII), "korean-internal-ascii")] + [(f"contains(rule_text, '{k}')", f"known-error:{k}") for k in KNOWN_DEMO]
    + [(rx("title", C.TITLE_ENGLISH), "untranslated-title"), (rx("rule_text", C.SUPERLATIVE), "claim-superlative-review"),
       (f"len(paragraphs) > 1 AND len(list_distinct([{sql_title('p')} for p in paragraphs])) < len(paragraphs)", "repeated-paragraph")]
)


@query("cl14_language_audit", with_sql(ITEMS_Q, f", l AS (SELECT doc_id, {SQL_LANGUAGE} AS w FROM iq) SELECT doc_id, array_to_string(w, ',') AS warnings, len([x for x in w if regexp_matches(x, 'known-error|korean-internal-ascii')]) > 0 AS blocker FROM l WHERE len(w) > 0"))
def _(spark, sf):
    w = settle(items(spark, sf), w=R.language_warnings(KNOWN_DEMO)).where(F.size("w") > 0)
    return w.select("doc_id", joined("w").alias("warnings"), R.language_blocker(F.col("w")).alias("blocker"))


@query("cl14_superlative_corrected", with_sql(ITEMS_Q, f"SELECT doc_id, CASE WHEN {rx('rule_text', C.SUPERLATIVE_ANY)} THEN 'superlative' ELSE '' END AS codes FROM iq"))
def _(spark, sf):
    return items(spark, sf).select("doc_id", joined(R.superlative()).alias("codes"))


SQL_CLAIMS = f"""cq AS (SELECT *, {sql_numbers('lead')} AS lead_n, {sql_numbers('body')} AS body_n, {sql_numbers("coalesce(radar_clinical, '')")} AS radar_n FROM iq),
cw AS (SELECT *, {sql_codes([("len([x for x in lead_n if NOT list_contains(body_n, x)]) > 0", "numeric-lead-body-mismatch"), ("len([x for x in radar_n if NOT list_contains(body_n, x)]) > 0", "numeric-radar-body-mismatch"),
    (rx("rule_text", C.SUPERLATIVE), "unsupported-claim"), ("lang NOT IN ('en', 'fr')", "species-mismatch")])} AS claim_codes FROM cq)"""


@query("cl15_claim_audit", with_sql(ITEMS_Q + ", " + SQL_CLAIMS, """
    SELECT doc_id, array_to_string(claim_codes, ',') AS warnings, 'source-page' AS evidence_type, CASE WHEN len(claim_codes) > 0 THEN 'review' ELSE 'medium' END AS confidence, len(claim_codes) > 0 AS review_required FROM cw"""))
def _(spark, sf):
    c = items(spark, sf).withColumn("w", R.claim_warnings())
    c = c.withColumn("claim", R.claim(F.col("w")))
    return c.select("doc_id", joined("w").alias("warnings"), "claim.evidence_type", "claim.confidence", "claim.review_required")


TERMS = [("theria", ["ther", "thed"], ["scum"]), ("nation", ["tion"], ["trash", "pathetic"]), ("quelle", ["que"], [])]


@query("cl16_terminology_audit", """
    SELECT doc_id, 'theria' AS term, array_to_string([x for x in ['theria', 'ther', 'thed'] if contains(text, x)], ',') AS matched, CASE WHEN contains(text, 'scum') THEN 'scum' ELSE '' END AS forbidden FROM documents
      WHERE contains(text, 'theria') OR contains(text, 'ther') OR contains(text, 'thed') OR contains(text, 'scum')
    UNION ALL SELECT doc_id, 'nation', array_to_string([x for x in ['nation', 'tion'] if contains(text, x)], ','), array_to_string([x for x in ['trash', 'pathetic'] if contains(text, x)], ',') FROM documents
      WHERE contains(text, 'tion') OR contains(text, 'trash') OR contains(text, 'pathetic')
    UNION ALL SELECT doc_id, 'quelle', array_to_string([x for x in ['quelle', 'que'] if contains(text, x)], ','), '' FROM documents WHERE contains(text, 'que')""")
def _(spark, sf):
    hits = table(spark, sf, "documents").select("doc_id", F.explode(R.terminology_hits(F.col("text"), TERMS)).alias("h"))
    return hits.select("doc_id", "h.term", joined("h.matched").alias("matched"), joined("h.forbidden").alias("forbidden"))


_ACRONYM = "^[A-Z][A-Z0-9-]{1,8}$"
_SAFE = "".join(f" WHEN known = '{term}' THEN struct_pack(c := '{kind}', f := {confidence}::DOUBLE, h := FALSE)" for term, kind, confidence in C.SAFE_REPLACEMENTS)


@query("cl17_warning_triage", with_sql(ITEMS_Q, f"""
    , w AS (SELECT doc_id, title, unnest({SQL_LANGUAGE}) AS warning FROM iq), n AS (SELECT *, CASE WHEN starts_with(warning, 'known-error:') THEN substr(warning, 13) END AS known FROM w),
    k AS (SELECT *, regexp_extract(coalesce(known, '가' || upper(substr(title, 1, 3)) || '나'), '[가-힣]([A-Za-z][A-Za-z0-9·.-]*)[가-힣]', 1) AS token FROM n),
    t AS (SELECT doc_id, warning, CASE WHEN warning = 'korean-internal-ascii' AND (token IN {C.COMMON_ACRONYMS} OR regexp_matches(token, '{_ACRONYM}')) THEN struct_pack(c := 'false-positive', f := 0.98::DOUBLE, h := FALSE){_SAFE}
      WHEN warning = 'korean-internal-ascii' AND regexp_matches(token, '[A-Za-z][A-Za-z]') THEN struct_pack(c := 'untranslated-fragment', f := 0.86::DOUBLE, h := TRUE)
      WHEN warning = 'claim-superlative-review' THEN struct_pack(c := 'title-body-mismatch', f := 0.8::DOUBLE, h := TRUE) ELSE struct_pack(c := 'ambiguous', f := 0.6::DOUBLE, h := TRUE) END AS t FROM k)
    SELECT doc_id, warning, t.c AS classification, t.f AS confidence, t.h AS human FROM t"""))
def _(spark, sf):
    w = items(spark, sf).select("doc_id", "title", F.explode(R.language_warnings(KNOWN_DEMO)).alias("warning"))
    t = w.withColumn("t", R.warning_triage(F.col("warning"), F.concat(F.lit("가"), F.upper(F.substring("title", 1, 3)), F.lit("나"))))
    return t.select("doc_id", "warning", "t.classification", "t.confidence", "t.human")


def _found(col: str, pattern: str) -> str:
    return f"regexp_extract_all({col}, '{re2(pattern.replace('(?i)', '', 1))}', 0, 'i')"


@query("cl18_claim_triage", with_sql(ITEMS_Q + ", " + SQL_CLAIMS, f"""
    , b AS (SELECT *, array_to_string(claim_codes, ',') AS j, array_to_string(list_filter([title, lead, body], lambda x: x <> ''), ' ') AS told FROM cw WHERE len(claim_codes) > 0),
    u AS (SELECT *, list_distinct(list_filter([lower(regexp_replace(x, '[0-9,.{WS}-]', '', 'g')) for x in {_found('told', C.UNIT_NUMBER)}], lambda x: x <> '')) AS units FROM b)
    SELECT doc_id, CASE WHEN regexp_matches(j, 'unit|mg|μg|mcg|mL|IU|mmHg', 'i') OR (len(units) > 1 AND regexp_matches(array_to_string(units, ' '), 'mg|mL|IU|kg|mmHg', 'i')) THEN 'unit-mismatch'
        WHEN regexp_matches(j, 'numeric', 'i') THEN 'missing-context' ELSE 'unverifiable' END AS classification,
      CASE WHEN len({_found('rule_text', C.PLAIN_NUMBER)}) = 0 AND contains(j, 'numeric') THEN 'sample-size-missing' WHEN regexp_matches(rule_text, '사람|인간|보호자|소유주|소유자|반려인') THEN 'human-population-context-missing'
        WHEN regexp_matches(rule_text, '국내|한국|적용|임상') THEN 'domestic-applicability-missing' ELSE 'acceptable-brief' END AS context FROM u"""))
def _(spark, sf):
    c = settle(items(spark, sf), w=R.claim_warnings()).where(F.size("w") > 0)
    c = c.withColumn("claim", R.claim(F.col("w")))
    return c.select("doc_id", R.claim_triage(F.col("w")).alias("classification"), R.missing_context(F.col("w"), F.col("claim")).alias("context"))


@query("cl20_source_status", f"""
    WITH p AS (SELECT page_id, url, CASE WHEN page_id % 3 > 0 THEN url END AS canonical, regexp_matches({sql_host('url')}, '(^|\\.)(example\\.com|example\\.net)$') AS official FROM pages)
    SELECT page_id, CASE WHEN url LIKE 'https://%' AND canonical IS NOT NULL AND official THEN 'verified' ELSE 'unresolved' END AS status FROM p""")
def _(spark, sf):
    p = J.match_domain(table(spark, sf, "pages"), "url", registry_domains(spark, sf), "domain", "page_id")
    canonical = F.when(F.col("page_id") % 3 > 0, F.col("url"))
    return p.select("page_id", R.source_status(F.col("url"), canonical, F.col("domain").isNotNull()).alias("status"))


@query("cl23_feed_candidate_verdict", with_sql(SQL_DIAGNOSTIC, """
    , f AS (SELECT user_id, max(event_id) AS failed FROM events WHERE event_type = 'error' GROUP BY 1),
    k AS (SELECT e.user_id AS feed, count(*) FILTER (event_type <> 'error' AND (failed IS NULL OR event_id > failed)) AS streak FROM events e LEFT JOIN f ON f.user_id = e.user_id GROUP BY 1)
    SELECT diag.feed, CASE WHEN diag.feed % 50 = 0 THEN 'rejected' WHEN canonical_coverage >= 0.5 AND relay_ratio = 0 AND duplicate_guids = 0 AND streak >= 3 THEN 'approved-candidate' ELSE 'needs-human-review' END AS verdict FROM diag JOIN k ON k.feed = diag.feed"""))
def _(spark, sf):
    d = events_diagnostic(spark, sf)
    runs = table(spark, sf, "events").select(F.col("user_id").alias("feed"), "event_id", (F.col("event_type") != "error").alias("ok"))
    streak = windows.success_streak(runs, "feed", "event_id", "ok")
    v = R.candidate_verdict(F.lit(True), F.col("feed") % 50 == 0, F.lit(200), F.lit(True), F.col("newest"), F.col("canonical_coverage"), F.col("relay_ratio"),
                            F.col("duplicate_guids") == 0, F.lit(True), F.col("consecutive_successes"))
    return d.join(streak, "feed").select("feed", v.alias("verdict"))


def events_diagnostic(spark, sf):
    """Feed diagnosis over the events: user = feed, event = entry, props = guid."""
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("feed"), "ts", F.col("props").alias("guid"), (F.col("event_type") != "signup").alias("canonical"), (F.col("value") > 99).alias("relay")
    )
    return aggregate.feed_diagnostic(e, "feed", "ts", "guid", now())


@query("cl22_feed_status", f"""
    WITH {SQL_DIAGNOSTIC}
    SELECT feed, CASE WHEN feed % 29 = 0 THEN 'retired' WHEN feed % 23 = 0 THEN 'disabled' WHEN feed % 19 = 0 THEN 'failing' WHEN age_days > 30 AND (average_gap_days IS NULL OR average_gap_days <= 14) THEN 'stale'
      WHEN age_days > 7 AND (average_gap_days IS NULL OR average_gap_days > 14 OR items <= 2) THEN 'quiet' WHEN relay_ratio > 0 OR feed % 17 = 0 THEN 'degraded' ELSE 'healthy' END AS status FROM diag""")
def _(spark, sf):
    f = F.col("feed")
    s = R.feed_status(f % 29 == 0, f % 23 != 0, F.lit(True), F.when(f % 19 == 0, 500).otherwise(200), F.lit(True), F.col("age_days"), F.col("average_gap_days"),
                      F.col("items"), f % 17 != 0, F.col("relay_ratio"), F.lit(0), F.lit(True))
    return events_diagnostic(spark, sf).select("feed", s.alias("status"))


@query("cl24_image_rights", with_sql(ITEMS, """
    SELECT doc_id, coalesce(image_ownership, 'unknown') AS ownership, CASE lang WHEN 'es' THEN 'image-ownership-unknown' WHEN 'fr' THEN 'licensed-without-proof' WHEN 'de' THEN 'official-press-without-source' ELSE '' END AS issues,
      lang <> 'es' AS renderable FROM items"""))
def _(spark, sf):
    return items(spark, sf).select("doc_id", R.image_ownership().alias("ownership"), joined(R.image_issues()).alias("issues"), R.image_renderable().alias("renderable"))


@query("cl25_image_queue", with_sql(ITEMS, """
    SELECT id, CASE WHEN quality = 0 THEN 'rejected' ELSE 'pending' END AS status, toxic IS NOT NULL AND toxic = 0 AS indexable FROM items WHERE quality = 0 OR lang <> 'en'"""))
def _(spark, sf):
    i = items(spark, sf)
    decisions = i.where("quality = 0").select("id", F.lit("rejected").alias("status"))
    return R.image_queue(i, decisions, i.where("toxic = 0").select("id")).select("id", "status", "indexable")


@query("cl25_valid_decision", with_sql(ITEMS, "SELECT doc_id, CASE WHEN lang = 'fr' THEN FALSE WHEN lang = 'de' THEN quality IS NOT NULL AND quality = 1 WHEN lang = 'en' THEN TRUE ELSE FALSE END AS valid FROM items"))
def _(spark, sf):
    credit = F.when(F.col("quality") == 1, F.lit("agency"))
    return items(spark, sf).select("doc_id", R.valid_image_decision(F.lit("approved"), F.col("image_ownership"), F.lit(""), F.lit(""), F.lit(""), credit).alias("valid"))


OFFICIAL = "lang IN ('en', 'fr')"


SQL_EVALUATED = f"""
re0 AS (SELECT *, {OFFICIAL} AND source_status = 'verified' AS sourced, title <> '' AND lead <> '' AND len(paragraphs) > 0 AS written, lang NOT IN ('en', 'fr') AS bad_claim, coalesce(clinical_risk, '') AS stated,
    {sql_codes([(rx("rule_text", C.INTERNAL_ASCII), "korean-internal-ascii"), (rx("title", C.TITLE_ENGLISH), "untranslated-title"), (rx("rule_text", C.SUPERLATIVE), "claim-superlative-review"),
                (f"len(paragraphs) > 1 AND len(list_distinct([{sql_title('p')} for p in paragraphs])) < len(paragraphs)", "repeated-paragraph")])} AS language FROM cw),
re1 AS (SELECT *, len([w for w in language if w <> 'claim-superlative-review']) > 0 AS bad_lang FROM re0),
re2 AS (SELECT *, list_sort(list_distinct(list_concat({sql_codes([("stated = 'high'", "high-risk"), ("stated = ''", "risk-missing"), ("NOT sourced", "source-not-official"), ("duplicate_status <> 'unique'", "not-unique"),
    ("NOT written", "draft-text-missing"), ("bad_lang", "language-warning"), ("bad_claim", "claim-warning"), ("len(unsafe) > 0", "unsafe-phrase"), ("lang = 'es'", "image-rights")])},
    CASE WHEN written THEN quality_codes ELSE ['text-missing'] END))) AS blockers FROM re1),
re3 AS (SELECT *, len(blockers) = 0 AND len(language) = 0 AND len(claim_codes) = 0 AS clean FROM re2),
evaluated AS (SELECT *, CASE WHEN duplicate_status <> 'unique' THEN 'duplicate' WHEN NOT sourced THEN 'needs-source-fix' WHEN NOT written OR bad_lang THEN 'needs-language-fix' WHEN bad_claim OR len(unsafe) > 0 THEN 'needs-claim-fix'
      WHEN stated = 'high' THEN 'rejected' WHEN len(blockers) > 0 THEN 'needs-claim-fix' ELSE 'ready-public-brief' END AS status,
    CASE WHEN ctier = 'brief' AND stated IN ('low', 'medium') AND clean THEN 'index-news' WHEN stated = 'low' AND ctier IN ('analysis', 'evidence') AND len(language) = 0 AND len(claim_codes) = 0 AND len(unsafe) = 0 THEN 'index-low-risk' ELSE 'public-brief' END AS grade,
    stated = 'low' AND ctier IN ('analysis', 'evidence') AND clean AS index_candidate FROM re3)"""


SQL_RELEASE = ITEMS_Q + ", " + SQL_CLAIMS + "," + SQL_EVALUATED


@query("cl26_release_evaluation", with_sql(SQL_RELEASE, "SELECT doc_id, status, array_to_string(blockers, ',') AS blockers, grade, index_candidate FROM evaluated"))
def _(spark, sf):
    e = settle(items(spark, sf), e=R.release_evaluation(F.col("lang").isin("en", "fr")))
    return e.select("doc_id", "e.status", joined(F.array_sort("e.blockers")).alias("blockers"), "e.grade", "e.index_candidate")


@query("cl31_re_review", with_sql(ITEMS, "SELECT doc_id, coalesce(quality = 0, FALSE) AS re_review FROM items"))
def _(spark, sf):
    from .identity import _content_hash

    i = items(spark, sf).withColumn("current", _content_hash())
    stored = F.when(F.col("quality") == 1, F.col("current")).when(F.col("quality") == 0, F.sha2("lead", 256))
    return i.select("doc_id", R.re_review_needed(stored, F.col("current")).alias("re_review"))


@query("cl32_schedule_eligible", with_sql(ITEMS_Q, """
    SELECT doc_id, workflow_status IN ('approved', 'published') AND len(workflow_codes) = 0 AND risk <> 'high' AND NOT (risk = 'medium' AND reviewed_at IS NULL)
      AND title <> '' AND lead <> '' AND len(paragraphs) > 0 AND content_tier IS NOT NULL AND clinical_risk IS NOT NULL AS eligible FROM iq"""))
def _(spark, sf):
    return items(spark, sf).select("doc_id", R.schedule_eligible().alias("eligible"))


@query("cl33_index_pages", with_sql(ITEMS, """
    SELECT 'edition' AS kind, strftime(date, '%Y-%m-%d') AS name, count(*) AS n, count(*) >= 4 AS indexable FROM items WHERE quality = 1 GROUP BY date
    UNION ALL SELECT 'topic', lang, count(*), count(*) >= 5 FROM items WHERE quality = 1 GROUP BY lang"""))
def _(spark, sf):
    good = items(spark, sf).where("quality = 1")
    editions = good.groupBy(F.date_format("date", "yyyy-MM-dd").alias("name")).agg(F.count("*").alias("n")).select(F.lit("edition").alias("kind"), "name", "n", (F.col("n") >= C.ISSUE_MIN).alias("indexable"))
    hubs = good.groupBy(F.col("lang").alias("name")).agg(F.count("*").alias("n")).select(F.lit("topic").alias("kind"), "name", "n", (F.col("n") >= 5).alias("indexable"))
    return editions.unionByName(hubs)


@query("cl35_labels", f"""
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'approved' WHEN o_orderpriority = '2-HIGH' THEN 'draft' ELSE 'legacy-published' END AS status FROM orders""")
def _(spark, sf):
    p = F.col("o_orderpriority")
    o = R.prepare(table(spark, sf, "orders").withColumn("workflow_status", F.when(p == "1-URGENT", " Approved ").when(p == "2-HIGH", "DRAFT").otherwise("n/a")))
    return o.select("o_orderkey", R.workflow_status(legacy=True).alias("status"))


@query("cl36_approval_blockers", with_sql(ITEMS_Q, f"""
    , r AS (SELECT *, CASE WHEN quality = 1 THEN 'editor' WHEN quality = 0 THEN 'vet' END AS who FROM iq)
    SELECT doc_id, array_to_string({sql_codes([("who IS NULL", "reviewer-missing"), ("who IS NOT NULL AND who <> role", "role-mismatch"), ("event_type <> 'view'", "source-not-confirmed"), ("TRUE", "checklist-incomplete"),
      ("workflow_status = 'correction-required'", "correction-first"), ("role = 'vet' AND who = 'editor'", "vet-role-required")])}, ',') AS blockers FROM r"""))
def _(spark, sf):
    i = items(spark, sf).withColumn("checklist", F.when(F.col("event_type") == "view", F.array(F.lit("sourceConfirmed"), F.lit("numbersChecked"))))
    who = F.when(F.col("quality") == 1, "editor").when(F.col("quality") == 0, "vet")
    return i.select("doc_id", joined(R.approval_blockers(who)).alias("blockers"))


@query("cl38_legacy_audit", with_sql(ITEMS_Q, "SELECT doc_id, 'legacy-review-queue' AS disposition FROM iq WHERE len(unsafe) > 0 UNION ALL SELECT doc_id, 'safe' FROM iq WHERE len(unsafe) = 0"))
def _(spark, sf):
    c = checked(spark, sf)
    return c.select("doc_id", F.coalesce(R.legacy_audit(R.indexable(F.col("publish_codes"))), F.lit("safe")).alias("disposition"))


@query("cl39_first_publish_class", with_sql(ITEMS_Q, f"""
    SELECT doc_id, CASE WHEN duplicate_status <> 'unique' THEN 'duplicate' WHEN NOT ({OFFICIAL}) OR source_status <> 'verified' THEN 'needs-source-fix'
      WHEN title = '' OR lead = '' OR len(paragraphs) = 0 OR len(publish_codes) > 0 THEN 'needs-language-fix' WHEN coalesce(clinical_risk, '') <> 'low' THEN 'rejected' ELSE 'ready-for-editor' END AS class FROM iq"""))
def _(spark, sf):
    none = F.array().cast("array<string>")
    return checked(spark, sf).select("doc_id", R.first_publish_class(F.col("lang").isin("en", "fr"), none, F.col("publish_codes")).alias("class"))


@query("cl44_derived_findings", with_sql(TURNS, """
    , n AS (SELECT conv_id, turn, source_text, text || ' Seen ' || length(text) || ' times.' AS d FROM t),
    x AS (SELECT conv_id, turn, [replace(q, ',', '') for q in regexp_extract_all(d, '\\d+(?:[.,]\\d+)?')] AS dn, [replace(q, ',', '') for q in regexp_extract_all(source_text, '\\d+(?:[.,]\\d+)?')] AS sn,
       [k for k in [regexp_replace(lower(q), '[.\\-]+$', '') for q in regexp_extract_all(d, '[A-Z][A-Za-z.\\-]{2,}')] if length(k) >= 3 AND NOT contains(lower(source_text), k)] AS names FROM n)
    SELECT conv_id, turn, len(list_distinct([q for q in dn if NOT list_contains(sn, q)])) AS n_numbers, len(list_distinct(names)) AS n_names FROM x"""))
def _(spark, sf):
    derived = F.concat("text", F.lit(" Seen "), F.length("text").cast("string"), F.lit(" times."))
    f = turns(spark, sf).withColumn("f", R.derived_findings(derived, F.col("source_text")))
    return f.select("conv_id", "turn", F.size("f.numbers").alias("n_numbers"), F.size("f.names").alias("n_names"))


@query("cl45_review_queue", with_sql(ITEMS_Q, """
    , z AS (SELECT *, CASE WHEN workflow_status = 'correction-required' THEN 'correction-required' WHEN role = 'vet' THEN 'vet-review-needed' END AS reason,
       CASE WHEN clinical_risk = 'high' THEN 40 WHEN clinical_risk = 'medium' THEN 25 ELSE 10 END + CASE WHEN workflow_status = 'correction-required' THEN 40 ELSE 0 END AS priority FROM iq WHERE workflow_status IN ('draft', 'automated', 'correction-required'))
    SELECT doc_id, reason, priority, ctier IN ('analysis', 'evidence') AS index_eligible FROM z"""))
def _(spark, sf):
    i = items(spark, sf).where(F.col("workflow_status").isin(*C.QUEUE_STATUSES))
    no = F.lit(False)
    out = i.select(
        "doc_id", R.block_reason().alias("reason"), topk.review_priority(F.col("clinical_risk"), R.workflow_status(), no, no).alias("priority"),
        R.content_tier().isin("analysis", "evidence").alias("index_eligible"),
    )
    return out
