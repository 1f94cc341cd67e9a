"""CL*: rule packs. Each pack is an ``array<string>`` of issue codes, so one pass over the table gives all flags.

The rules read the item columns by name, the joined texts that ``prepare`` adds and what it finds in them. Those texts are
columns of their own, so that a row is joined and cleaned once, however many rules look at it. ``read`` and ``find`` need no
other columns than ``CONTENT``: where the rest of an item comes from other tables, they go before the join and ``judge``
after it, and no text is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as tx
from ..functions.hints import hints, pieces, repeated_words_of
from ..functions.patterns import BLANK, codes, compact, java, matches, once, settle, squeeze, squeeze_blanks, strip, strip_plain, text
from ..functions.urls import is_relay, is_safe_article_url
from ..session import cut_lineage

ITEM_COLUMNS = {
    "id": "string", "date": "date", "title": "string", "lead": "string", "paragraphs": "array<string>",
    "key_points": "array<string>", "angle": "string", "radar_clinical": "string", "radar_owner": "string",
    "radar_evidence": "string", "category": "string", "content_tier": "string", "tier": "string", "source_type": "string",
    "doi": "string", "journal": "string", "source_label": "string", "source_url": "string", "final_url": "string",
    "source_url_raw": "string", "source_title": "string", "source_status": "string", "duplicate_status": "string",
    "visibility": "string", "index_policy": "string", "publication_status": "string", "clinical_risk": "string",
    "workflow_status": "string", "editorial_status": "string", "reviewed_at": "timestamp", "reviewed_by": "string",
    "vet_reviewed_at": "timestamp", "vet_reviewer": "string", "published_at": "timestamp", "first_published_at": "timestamp",
    "scheduled_at": "timestamp", "image_url": "string", "image_ownership": "string", "image_origin": "string",
    "image_license": "string", "image_credit": "string", "image_source_url": "string", "species": "array<string>",
    "study_type": "string", "species_studied": "string", "sample_size": "string", "limitations": "string",
    "checklist": "array<string>", "draft_kind": "string", "review_policy_version": "string", "reviewer_role": "string",
    "duplicate": "boolean", "selection_score": "double", "content_hash": "string",
}


#: Item columns that :func:`read` and :func:`find` look at: the texts, and what a tier or a claim is judged by.
CONTENT = (
    "title", "lead", "paragraphs", "key_points", "angle", "radar_clinical", "radar_owner", "radar_evidence", "category", "content_tier", "tier", "source_type",
    "doi", "journal", "source_url", "final_url", "source_url_raw", "source_title", "species", "study_type", "species_studied",
)


def complete(df: DataFrame, names: Iterable[str] = ITEM_COLUMNS) -> DataFrame:
    missing = {n: F.lit(None).cast(ITEM_COLUMNS[n]) for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


def _c(name: str) -> Column:
    return text(F.col(name))


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def _needs_hangul(pattern: str) -> bool:
    """Whether a literal or a pattern without top-level alternatives holds a Hangul character, so that a match must."""
    return "|" not in re.sub(r"\([^()]*\)", "", pattern) and bool(re.search("[가-힣]", re.sub(r"\([^()]*\)[?*]?", "", pattern)))


def _any_code(arr: Column, *wanted: str) -> Column:
    return F.arrays_overlap(arr, F.array(*[F.lit(w) for w in wanted]))


def rule_text(*names: str) -> Column:
    """Non-empty fields joined by a blank."""
    return F.concat_ws(" ", *[F.nullif(F.col(n), F.lit("")) for n in names])


def prepare(df: DataFrame) -> DataFrame:
    """Add missing item columns, the texts the rules work on and what the rules find in these."""
    return judge(find(read(df)))


def read(df: DataFrame) -> DataFrame:
    """The texts the rules work on, from the columns of ``CONTENT``."""
    full = complete(df, CONTENT)
    full = full.withColumns(
        {
            "_title": strip_plain(_c("title")), "_lead": strip_plain(_c("lead")), "_body": F.array_join(_list("paragraphs"), " "),
            "_points": F.array_join(_list("key_points"), " "),
        }
    )
    full = full.withColumns(
        {
            "_read": rule_text("title", "lead", "_body", "angle", "radar_clinical"),
            "_audit": rule_text("title", "lead", "_body", "_points", "angle", "radar_clinical", "radar_owner", "radar_evidence"),
        }
    )
    # Rules that cannot match without Hangul or without some word ask these first. All texts here hold words of "_audit" only.
    known = full.withColumn("_hints", hints(F.col("_audit"), HINTED)).withColumn("_hangul", _hint(C.HANGUL))
    # Most texts have no white space but blanks.
    plain, whole = ~_hint(ODD_SPACE), rule_text("title", "lead", "_body", "_points", "angle")
    known = known.withColumns(
        {
            "_parts": F.when(plain, F.transform(_list("paragraphs"), lambda p: F.replace(p, F.lit(" "), F.lit("")))).otherwise(F.transform(_list("paragraphs"), compact)),
            "_all": F.when(plain, squeeze_blanks(whole)).otherwise(squeeze(whole)),
        }
    )
    known = known.withColumn("_chars", F.length(F.array_join("_parts", "")))
    return known.withColumns({"_inferred": _text_risk(), "_acts": _text_acts(), "_echo": repeated_words_of(F.transform(_list("paragraphs"), _unmarked))})


def _unmarked(paragraph: Column) -> Column:
    """A paragraph in lower case without markup. It is not folded: paragraphs are compared with each other, and they are in one form."""
    marked = F.contains(paragraph, F.lit("<")) | F.contains(paragraph, F.lit("&"))
    return F.lower(F.when(marked, F.regexp_replace(paragraph, "(?i)<[^>]+>|&(?:amp|nbsp|quot|#39);", " ")).otherwise(paragraph))


def find(df: DataFrame) -> DataFrame:
    """What the rules find in the texts of ``read``, as columns; Spark computes those that are asked for. Whoever changes a text
    or another column of ``CONTENT`` afterwards has to call it again."""
    found = df.withColumns({"_quality": _find_quality(), "_unsafe": _find_unsafe(C.UNSAFE_PHRASES), "_numeric": _find_numeric(), "_language": _find_language(C.KNOWN_ERRORS)})
    return found.withColumn("_claims", _find_claims())


def judge(df: DataFrame) -> DataFrame:
    """The remaining item columns, and the risk and the role that follow from those and from the texts."""
    return complete(df).withColumns({"_risk": _infer_risk(), "_role": _infer_role()})


#: Columns of an item that hold its text, and the joined texts of ``prepare``.
TEXTS = (
    "text", "lead", "paragraphs", "key_points", "angle", "radar_clinical", "radar_owner", "radar_evidence", "_title", "_lead", "_body", "_parts", "_points",
    "_all", "_read", "_audit",
)
#: Columns of ``find``.
FOUND = ("_quality", "_unsafe", "_numeric", "_language", "_claims")


#: White space that is not a blank.
ODD_SPACE = f"[{C.WS.replace(' ', '')}]"
BANNED = "(?i)" + "|".join(C.BANNED_TERMS)
#: Patterns that ``prepare`` scans the texts for. One that can't match without Hangul asks the first.
HINTED = (C.HANGUL, C.FOREIGN_SCRIPT, C.UNTRANSLATED, BANNED, C.GARBLED, C.TEMPLATE, C.HIGH_RISK, C.MEDIUM_RISK, C.LOW_RISK, ODD_SPACE)


def _hint(pattern: str) -> Column:
    return F.col("_hints").bitwiseAND(F.lit(1 << HINTED.index(pattern))) != 0


def _found(col: Column, pattern: str) -> Column:
    """:func:`matches` in a text of the item, which is searched only if it may hold a match."""
    if pattern in HINTED:
        return _hint(pattern) & matches(col, pattern)
    return F.col("_hangul") & matches(col, pattern) if pieces(pattern) == C.HANGUL else matches(col, pattern)


#: ``C.REPEATED_WORD`` without Hangul: a word starts once and is compared as a whole.
_REPEATED_LATIN = rf"(?i)(?<![A-Za-z0-9_])([A-Za-z]{{2,}}+){BLANK}++\1(?![A-Za-z0-9_])"


def repeated_word(col: Column) -> Column:
    """Whether ``C.REPEATED_WORD`` is found in a text of the item."""
    latin = F.coalesce(F.regexp_like(col, F.lit(_REPEATED_LATIN)), F.lit(False))
    return latin | (F.col("_hangul") & matches(col, C.REPEATED_WORD))


def facts(items: DataFrame, **found: Column) -> DataFrame:
    """Prepared items without their texts, with ``found`` (codes and flags of the rules), stored once: what a job reads many times,
    joins and shuffles."""
    coded = settle(items, **found) if found else items
    return cut_lineage(coded.drop(*TEXTS, *FOUND))


def content_tier() -> Column:
    """CL5."""
    explicit = F.lower(_c("content_tier"))
    evidence = (_c("radar_evidence") != "") | (_c("doi") != "") | (_c("source_type") == "paper") | (_c("journal") != "")
    judged = (_c("radar_clinical") != "") | (_c("radar_owner") != "")
    return (
        F.when(explicit.isin(*C.CONTENT_TIERS), explicit)
        .when((F.lower(_c("tier")) == "brief") | (_c("category") == "brief"), F.lit("brief"))
        .when(evidence, F.lit("evidence"))
        .when((F.col("_chars") >= C.ANALYSIS_MIN_CHARS) & judged, F.lit("analysis"))
        .otherwise(F.lit("brief"))
    )


def _is_sentence(v: Column) -> Column:
    """Whether a trimmed text reads as a sentence."""
    clean = (v != "") & matches(v, C.HANGUL) & ~matches(v, C.FOREIGN_SCRIPT) & ~matches(v, C.INTERNAL_ASCII)
    return clean & (matches(v, C.SENTENCE_END) | matches(v, C.HANGUL_TAIL))


def _title_mismatch(title: Column, body: Column) -> Column:
    words = F.filter(F.split(F.regexp_replace(title, f"[^가-힣A-Za-z0-9{C.WS}]", " "), f"[{C.WS}]+"), lambda w: F.length(w) >= 2)
    # The words of a title are only cut where the body is long enough, and once.
    missing = once(words, lambda own: (F.size(own) >= 2) & ~F.exists(own, lambda w: F.contains(body, w)))
    return (F.length(body) >= 120) & missing


def quality_issues(skip: tuple[str, ...] = ()) -> Column:
    """CL1. Quality codes in order, read from the column that ``find`` adds; briefs get the shared ones and their own two length checks."""
    return F.filter("_quality", lambda c: ~c.isin(*skip)) if skip else F.col("_quality")


def _find_quality() -> Column:
    title, lead, parts = F.col("_title"), F.col("_lead"), _list("paragraphs")
    body, everything, chars, plain = F.col("_body"), F.col("_all"), F.col("_chars"), F.col("_parts")
    banned = _found(everything, BANNED)
    source = F.coalesce(*[F.nullif(_c(n), F.lit("")) for n in ("source_url", "final_url", "source_url_raw")], F.lit(""))
    shared = [
        (title == "", "title-missing"),
        ((lead == "") & (body == ""), "body-missing"),
        (_found(everything, C.FOREIGN_SCRIPT), "foreign-script"),
        (_found(everything, C.UNTRANSLATED), "untranslated-term"),
        (banned, "banned-term"),
        (_found(everything, C.GARBLED), "garbled-text"),
        (_found(everything, C.TEMPLATE), "template-text"),
        (F.col("_hangul") & matches(everything, C.INTERNAL_ASCII), "internal-ascii"),
        (F.col("_hangul") & matches(everything, C.BAD_PARTICLE), "particle-error"),
        (repeated_word(everything), "repeated-word"),
    ]
    brief = [
        (F.length(title) < 10, "brief-title-too-short"),
        ((chars < C.BRIEF_MIN_CHARS) | (F.length(lead) < C.BRIEF_MIN_CHARS), "brief-too-short"),
    ]
    opening = F.when(lead != "", lead).otherwise(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")))
    full = [
        (F.size(parts) < 3, "paragraphs-too-few"),
        (chars < C.ANALYSIS_MIN_CHARS, "body-too-short"),
        (F.exists(plain, lambda p: F.length(p) < 40), "paragraph-too-short"),
        (F.size(F.array_distinct(plain)) != F.size(plain), "duplicate-paragraph"),
        (~_is_sentence(title), "title-not-korean-sentence"),
        (~_is_sentence(opening), "lead-not-korean-sentence"),
        (F.exists(parts, lambda p: ~_is_sentence(p)), "body-not-korean-sentence"),
        (_title_mismatch(title, body), "title-body-mismatch"),
        (strip(source) == "", "source-missing"),
        (is_relay(source), "source-relay"),
        ((_c("radar_clinical") == "") & (_c("radar_owner") == "") & (_c("radar_evidence") == ""), "radar-missing"),
    ]
    return F.concat(codes(*shared), F.when(content_tier() == "brief", codes(*brief)).otherwise(codes(*full)))


def publication_status() -> Column:
    """Known publication status or null."""
    value = F.lower(strip(_c("publication_status")))
    return F.when(value.isin(*C.PUBLICATION_STATUSES), value)


def workflow_status(legacy: bool = False, draft: bool = False) -> Column:
    """CL35. Known workflow status, else the default for the kind of row."""
    value = F.lower(strip(F.coalesce(F.nullif(F.col("workflow_status"), F.lit("")), F.col("editorial_status"), F.lit(""))))
    default = "draft" if draft else "legacy-published" if legacy else "automated"
    return F.when(value.isin(*C.WORKFLOW_STATUSES), value).otherwise(F.lit(default))


def clinical_risk() -> Column:
    """CL7. Stated or inferred risk, read from the column that ``judge`` adds."""
    return F.col("_risk")


def _infer_risk() -> Column:
    explicit = F.lower(_c("clinical_risk"))
    return F.when(explicit.isin(*C.RISKS), explicit).otherwise(F.col("_inferred"))


def _text_risk() -> Column:
    body = F.col("_read")
    return (
        F.when(_found(body, C.HIGH_RISK), F.lit("high"))
        .when(_found(body, C.LOW_RISK) & ~_found(body, C.MEDIUM_RISK), F.lit("low"))
        .when(_found(body, C.MEDIUM_RISK), F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def required_role() -> Column:
    """CL9. Role that has to review the item, read from the column that ``judge`` adds."""
    return F.col("_role")


def _infer_role() -> Column:
    risk = F.lower(F.coalesce(F.nullif(F.col("clinical_risk"), F.lit("")), F.lit("low")))
    return F.when((risk == "high") | ((risk == "medium") & F.col("_acts")), F.lit("vet")).otherwise(F.lit("editor"))


def _text_acts() -> Column:
    return _found(rule_text("title", "lead", "_body", "radar_clinical"), C.CLINICAL_ACTION)


def _has_editor() -> Column:
    return F.col("reviewed_at").isNotNull() & (_c("reviewed_by") != "")


def _has_vet() -> Column:
    return F.col("vet_reviewed_at").isNotNull() & (_c("vet_reviewer") != "")


def workflow_issues() -> Column:
    """CL9."""
    status, role = workflow_status(), required_role()
    done = status.isin("approved", "published")
    return codes(
        (status.isin(*C.OPEN_WORKFLOW), "workflow-not-approved"),
        (status == "correction-required", "correction-required"),
        (done & (role == "vet") & ~_has_vet(), "vet-review-missing"),
        (done & (role == "editor") & ~_has_editor() & ~_has_vet(), "editor-review-missing"),
    )


def checklist_complete() -> Column:
    return F.forall(F.array(*[F.lit(k) for k in C.CHECKLIST]), lambda k: F.array_contains(_list("checklist"), k))


def is_new_publication() -> Column:
    return (_c("publication_status") != "") | (_c("draft_kind") != "") | (_c("review_policy_version") != "")


def review_issues(vet_available: bool = False) -> Column:
    """CL8. Review gate; dates after the policy day and explicitly new rows are gated, older rows are not."""
    raw = F.lower(strip(F.coalesce(F.nullif(F.col("workflow_status"), F.lit("")), F.col("editorial_status"), F.lit(""))))
    # "correction-required" and the review states are shared by the editorial and the workflow list.
    status = F.when(raw.isin(*C.WORKFLOW_STATUSES), raw).otherwise(F.lit("automated"))
    risk = clinical_risk()
    day = F.coalesce(F.to_date("published_at"), F.col("date"))
    gated = is_new_publication() | F.coalesce(day > F.lit(C.REVIEW_POLICY_DATE).cast("date"), F.lit(False))
    news = F.lower(_c("publication_status")) == "index-news"
    reviewed = F.col("reviewed_at").isNotNull() | F.col("vet_reviewed_at").isNotNull()
    unavailable = F.lit(not vet_available)
    open_states = ("draft", "automated", "editor-review-required", "vet-review-required", "archived")
    return codes(
        (status == "correction-required", "correction-required"),
        (_c("workflow_status").isin(*open_states), "workflow-not-approved"),
        (gated & (risk == "high") & unavailable, "high-risk-vet-review-unavailable"),
        (gated & (risk == "high") & (status != "vet-reviewed") & ~_has_vet(), "high-risk-not-vet-reviewed"),
        (gated & (risk == "medium") & ~news & ~status.isin("editor-reviewed", "vet-reviewed") & ~reviewed, "medium-risk-not-editor-reviewed"),
        ((status == "vet-reviewed") & unavailable, "vet-reviewer-unavailable"),
    )


def contract_issues() -> Column:
    """CL10. Required fields and enums of a row."""
    return codes(
        (strip(_c("id")) == "", "id-missing"),
        (strip(_c("title")) == "", "title-missing"),
        (strip(_c("lead")) == "", "lead-missing"),
        (F.size(_list("paragraphs")) == 0, "body-missing"),
        (strip(_c("source_label")) == "", "source-label-missing"),
        ((strip(_c("source_url")) == "") & (strip(_c("source_url_raw")) == "") & (_c("source_status") != "unresolved"), "source-missing"),
        (F.col("published_at").isNull(), "published-at-missing"),
        (~_c("content_tier").isin(*C.CONTENT_TIERS), "content-tier-missing"),
        (~_c("clinical_risk").isin(*C.RISKS), "clinical-risk-missing"),
        (~_c("workflow_status").isin(*C.WORKFLOW_STATUSES), "workflow-status-missing"),
        ((_c("publication_status") != "") & publication_status().isNull(), "publication-status-invalid"),
    )


def safety_issues(patterns: tuple[str, ...] = C.UNSAFE_PHRASES) -> Column:
    """CL11. The unsafe-phrase patterns that occur; the usual ones are read from the column that ``find`` adds."""
    return F.col("_unsafe") if patterns == C.UNSAFE_PHRASES else _find_unsafe(patterns)


def _find_unsafe(patterns: tuple[str, ...]) -> Column:
    body = rule_text("title", "lead", "_body", "_points", "angle", "radar_clinical")
    found = F.array_compact(F.array(*[F.when(_found(body, f"(?i){p}"), F.lit(p)) for p in patterns]))
    # Hardly any row has one, so one scan for all of them decides first.
    return F.when(_found(body, "(?i)" + "|".join(patterns)), found).otherwise(F.array().cast("array<string>"))


def publication_policy() -> Column:
    """CL12."""
    risk = F.lower(F.coalesce(F.nullif(F.col("clinical_risk"), F.lit("")), F.lit("low")))
    return F.coalesce(
        publication_status(),
        F.when(is_new_publication(), F.when(risk == "high", F.lit("blocked-clinical")).otherwise(F.lit("internal-draft"))),
    )


def publish_issues(skip: tuple[str, ...] = (), duplicate: Column | None = None) -> Column:
    """CL2. Quality, review, workflow, safety and duplicate codes together."""
    status, risk = publication_status(), F.lower(_c("clinical_risk"))
    unsafe = F.size(safety_issues()) > 0
    auto = F.coalesce(status.isin("index-low-risk", "index-news"), F.lit(False))
    flagged = F.coalesce(F.col("duplicate"), F.lit(False)) if duplicate is None else duplicate
    # Rows without a schema version are legacy and skip the workflow gate.
    new_row = _c("review_policy_version") != ""
    grades = codes(
        ((status == "index-low-risk") & (risk != "low"), "index-low-risk-requires-low"),
        ((status == "index-news") & (content_tier() != "brief"), "index-news-requires-brief"),
        ((status == "index-news") & ~risk.isin("low", "medium"), "index-news-requires-low-or-medium"),
        ((auto | (F.coalesce(status == "public-brief", F.lit(False)))) & unsafe, "unsafe-clinical-command"),
    )
    none = F.array().cast("array<string>")
    return F.array_distinct(
        F.concat(
            quality_issues(skip), codes((flagged, "duplicate-source")), review_issues(),
            F.when(new_row & ~auto, workflow_issues()).otherwise(none), grades,
        )
    )


def card_renderable(quality: Column) -> Column:
    """CL3."""
    return (_c("visibility") != "suppressed") & ~_any_code(quality, *C.CARD_BLOCKERS)


def indexable(publish: Column) -> Column:
    """CL4."""
    status, tier, risk = publication_status(), content_tier(), F.lower(_c("clinical_risk"))
    blocked = (_c("visibility") == "suppressed") | (_c("index_policy") == "legacy-noindex") | F.coalesce(F.col("duplicate"), F.lit(False))
    grade_ok = (
        F.when(status.isNull(), tier.isin("analysis", "evidence"))
        .when(status == "index-analysis", _has_editor() & tier.isin("analysis", "evidence"))
        .when(status == "index-low-risk", tier.isin("analysis", "evidence"))
        .when(status == "index-news", (tier == "brief") & risk.isin("low", "medium"))
        .otherwise(F.lit(False))
    )
    sourced = (_c("source_url") != "") | (_c("final_url") != "") | (_c("source_url_raw") != "")
    return ~blocked & grade_ok & sourced & (F.size(publish) == 0)


def numeric_issues(lead: Column, body: Column, key_points: Column, radar: Column) -> Column:
    """CL13. Numeric claims that the body does not contain."""
    names = ("numeric-lead-body-mismatch", "numeric-keypoints-body-mismatch", "numeric-radar-body-mismatch")

    def judged(claims: Column) -> Column:
        # The body is only searched when a short field has a number at all, and once for all of them.
        held = F.when(F.size(F.flatten(claims)) > 0, tx.numeric_tokens(body))
        return once(held, lambda h: codes(*[(F.size(F.array_except(claims[k], h)) > 0, name) for k, name in enumerate(names)]))

    return once(F.array(*[tx.numeric_tokens(c) for c in (lead, key_points, radar)]), judged)


def item_numeric_issues() -> Column:
    return F.col("_numeric")


def _find_numeric() -> Column:
    return numeric_issues(
        _c("lead"), F.col("_body"), F.col("_points"), rule_text("radar_clinical", "radar_evidence", "radar_owner"),
    )


def language_warnings(known: tuple[str, ...] = C.KNOWN_ERRORS) -> Column:
    """CL14. Language audit; with the usual errors read from the column that ``find`` adds. The superlative code keeps the ASCII
    word boundary of the rule; see ``superlative``."""
    return F.col("_language") if known == C.KNOWN_ERRORS else _find_language(known)


def _find_language(known: tuple[str, ...]) -> Column:
    body = F.col("_audit")
    hangul = F.col("_hangul")
    pairs = [(hangul & matches(body, C.INTERNAL_ASCII), "korean-internal-ascii")]
    pairs += [((hangul if _needs_hangul(k) else F.lit(True)) & F.contains(body, F.lit(k)), f"known-error:{k}") for k in known]
    pairs += [
        (matches(_c("title"), C.TITLE_ENGLISH), "untranslated-title"),
        (hangul & matches(body, C.SUPERLATIVE), "claim-superlative-review"),
        (F.col("_echo"), "repeated-paragraph"),
    ]
    return codes(*pairs)


def language_blocker(warnings: Column) -> Column:
    return F.exists(warnings, lambda w: F.regexp_like(w, F.lit("known-error|korean-internal-ascii")))


def superlative() -> Column:
    """Corrected variant of the superlative check: the words anywhere, not only beside ASCII letters."""
    return codes((matches(F.col("_audit"), C.SUPERLATIVE_ANY), "superlative"))


def claim_warnings() -> Column:
    """CL15. Read from the column that ``find`` adds."""
    return F.col("_claims")


def _find_claims() -> Column:
    body = F.col("_audit")
    studied = F.transform(F.split(_c("species_studied"), "[,/·]"), strip)
    has_both = (_c("species_studied") != "") & (F.size(_list("species")) > 0)
    return F.concat(
        item_numeric_issues(),
        codes(
            (matches(_c("study_type"), C.CASE_REPORT) & matches(body, C.GENERALISING), "case-report-generalization"),
            (F.col("_hangul") & matches(body, C.SUPERLATIVE) & ~matches(_c("source_title"), C.SUPERLATIVE), "unsupported-claim"),
            (has_both & ~F.arrays_overlap(studied, _list("species")), "species-mismatch"),
        ),
    )


def claim(warnings: Column) -> Column:
    """CL15. The structured claim of an item."""
    numbers = tx.plain_numbers(F.col("_audit"))
    return F.struct(
        F.coalesce(*[F.nullif(_c(n), F.lit("")) for n in ("radar_clinical", "lead", "title")], F.lit("")).alias("claim"),
        F.when((_c("doi") != "") | (_c("journal") != ""), F.lit("paper-metadata")).when(_c("source_url") != "", F.lit("source-page")).otherwise(F.lit("not-available")).alias("evidence_type"),
        F.col("source_url").alias("evidence_url"),
        F.coalesce(F.nullif(F.col("species_studied"), F.lit("")), F.array_join(_list("species"), ",")).alias("species"),
        F.col("sample_size").alias("population"),
        numbers.alias("number"),
        F.transform(numbers, lambda n: F.regexp_replace(n, f"[0-9,.{C.WS}]", "")).alias("unit"),
        F.when(F.size(warnings) > 0, F.lit("review")).when(_c("source_url") != "", F.lit("medium")).otherwise(F.lit("low")).alias("confidence"),
        ((F.size(warnings) > 0) | (_c("source_url") == "")).alias("review_required"),
    )


def terminology_hits(body: Column, terms: list[tuple[str, list[str], list[str]]]) -> Column:
    """CL16, JN9. Dictionary terms found in a text: (canonical, matched names, forbidden translations)."""
    entries = []
    for canonical, aliases, forbidden in terms:
        names = F.array_compact(F.array(*[F.when(F.contains(body, F.lit(n)), F.lit(n)) for n in [canonical, *aliases]]))
        bad = [F.when(F.contains(body, F.lit(n)), F.lit(n)) for n in forbidden]
        bad_names = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
        entries.append(F.struct(F.lit(canonical).alias("term"), names.alias("matched"), bad_names.alias("forbidden")))
    return F.filter(F.array(*entries), lambda e: (F.size(e["matched"]) > 0) | (F.size(e["forbidden"]) > 0))


def warning_triage(warning: Column, original: Column) -> Column:
    """CL17. Class and confidence of a language warning."""
    known = F.when(F.startswith(warning, F.lit("known-error:")), F.regexp_replace(warning, "^known-error:", ""))
    token = F.regexp_extract(F.coalesce(known, original, F.lit("")), "[가-힣]([A-Za-z][A-Za-z0-9·.-]*)[가-힣]", 1)
    acronym = token.isin(*C.COMMON_ACRONYMS) | F.regexp_like(token, F.lit("^[A-Z][A-Z0-9-]{1,8}$"))
    ascii_inside = warning == "korean-internal-ascii"

    def verdict(kind: str, confidence: float, human: bool) -> Column:
        return F.struct(F.lit(kind).alias("classification"), F.lit(confidence).alias("confidence"), F.lit(human).alias("human"))

    triage = F.when(ascii_inside & acronym, verdict("false-positive", 0.98, False))
    for term, kind, confidence in C.SAFE_REPLACEMENTS:
        triage = triage.when(known == term, verdict(kind, confidence, False))
    return (
        triage.when(ascii_inside & F.regexp_like(token, F.lit("[A-Za-z]{2,}")), verdict("untranslated-fragment", 0.86, True))
        .when(warning == "claim-superlative-review", verdict("title-body-mismatch", 0.8, True))
        .otherwise(verdict("ambiguous", 0.6, True))
    )


def claim_triage(warnings: Column) -> Column:
    """CL18. Class of a claim row."""
    joined = F.array_join(warnings, ",")
    body = rule_text("title", "lead", "_body", "_points")
    found = F.transform(F.regexp_extract_all(body, F.lit(java(C.UNIT_NUMBER)), F.lit(0)), lambda t: F.lower(F.regexp_replace(t, f"[0-9,.{C.WS}-]", "")))
    units = F.array_distinct(F.filter(found, lambda u: u != ""))
    mixed = (F.size(units) > 1) & matches(F.array_join(units, " "), "(?i)mg|mL|IU|kg|mmHg")
    return (
        F.when(matches(joined, "(?i)unit|mg|μg|mcg|mL|IU|mmHg") | mixed, F.lit("unit-mismatch"))
        .when((_c("source_url") == "") & (_c("source_url_raw") == ""), F.lit("unverifiable"))
        .when(matches(joined, "(?i)numeric"), F.lit("missing-context"))
        .otherwise(F.lit("unverifiable"))
    )


def missing_context(warnings: Column, claim_col: Column) -> Column:
    """CL18. First context field that is missing."""
    body = F.concat_ws(" ", rule_text("title", "lead", "_body"), claim_col["claim"])
    url = text(claim_col["evidence_url"])
    numeric = F.exists(warnings, lambda w: F.contains(F.lower(w), F.lit("numeric")))
    return (
        F.when((url == "") | matches(url, r"(?i)google\.com/rss/articles"), F.lit("source-detail-missing"))
        .when(claim_col["evidence_type"] == "not-available", F.lit("study-type-missing"))
        .when((F.size(claim_col["number"]) == 0) & numeric, F.lit("sample-size-missing"))
        .when(matches(body, "사람|인간|보호자|소유주|소유자|반려인") & (text(claim_col["population"]) == ""), F.lit("human-population-context-missing"))
        .when((text(claim_col["species"]) == "") & matches(body, "개|고양이|말|조류|동물|반려"), F.lit("species-context-missing"))
        .when(((claim_col["evidence_type"] == "paper-metadata") | (_c("doi") != "")) & (_c("limitations") == ""), F.lit("limitation-missing"))
        .when(matches(body, "국내|한국|적용|임상"), F.lit("domestic-applicability-missing"))
        .otherwise(F.lit("acceptable-brief"))
    )


def update_class(has_match: Column, verified: Column, same_source: Column, same_numbers: Column, title_score: Column, corrects: Column) -> Column:
    """CL19."""
    close = title_score >= 0.9
    return (
        F.when(~has_match, F.when(verified, F.lit("separate-story")).otherwise(F.lit("unresolved")))
        .when(same_source & same_numbers, F.when(close, F.lit("duplicate")).otherwise(F.lit("minor-update")))
        .when(same_source & corrects, F.lit("correction"))
        .when(same_source, F.lit("substantive-update"))
        .when(close, F.lit("duplicate"))
        .otherwise(F.lit("unresolved"))
    )


def source_status(url: Column, canonical: Column, canonical_official: Column) -> Column:
    """CL20."""
    ok = (text(url) != "") & is_safe_article_url(url) & ~is_relay(url) & (text(canonical) != "") & canonical_official
    return F.when(F.coalesce(ok, F.lit(False)), F.lit("verified")).otherwise(F.lit("unresolved"))


def resolution_status(decision: Column, decision_ok: Column, similarity: Column, gap_days: Column) -> Column:
    """CL21."""
    return (
        F.when((decision == "manually-approved") & decision_ok, F.lit("manually-approved"))
        .when(decision == "rejected", F.lit("rejected"))
        .when((similarity >= 0.92) & (gap_days.isNull() | (gap_days <= 3)), F.lit("resolved"))
        .when(similarity.isNotNull(), F.lit("candidate"))
        .otherwise(F.lit("unresolved"))
    )


def resolution_reason(status: Column, mapped: Column) -> Column:
    """CL21. Why a relay item has its resolution status."""
    return (
        F.when(status == "manually-approved", "explicit-editor-approval").when(status == "rejected", "explicit-editor-rejection")
        .when(status == "resolved", "high-confidence-official-direct-match").when(status == "candidate", "medium-confidence-needs-human-review")
        .when(mapped, "official-domain-mapped-no-verified-candidate").otherwise("publisher-domain-not-mapped")
    )


def feed_status(retired: Column, enabled: Column, ok: Column, http: Column, parsed: Column, age: Column, gap: Column, items: Column,
                official: Column, relay_ratio: Column, duplicate_guids: Column, mime_ok: Column, streak: Column | None = None) -> Column:
    """CL22. First matching state; a healthy feed needs three successes in a row."""
    state = (
        F.when(retired, F.lit("retired"))
        .when(~enabled, F.lit("disabled"))
        .when(~ok | (http >= 400) | ~parsed, F.lit("failing"))
        .when((age > 30) & (gap.isNull() | (gap <= 14)), F.lit("stale"))
        .when((age > 7) & (gap.isNull() | (gap > 14) | (items <= 2)), F.lit("quiet"))
        .when(~official | (relay_ratio > 0) | (duplicate_guids > 0) | ~mime_ok | (items == 0), F.lit("degraded"))
        .otherwise(F.lit("healthy"))
    )
    if streak is None:
        return state
    return F.when((state == "healthy") & (F.coalesce(streak, F.lit(0)) < 3), F.lit("degraded")).otherwise(state)


def candidate_verdict(official: Column, relay: Column, http: Column, parsed: Column, newest: Column, canonical_rate: Column,
                      relay_rate: Column, stable_ids: Column, robots_ok: Column, streak: Column) -> Column:
    """CL23."""
    checks = F.array(
        http.isin(200, 304), parsed, newest.isNotNull(), canonical_rate >= 0.5, relay_rate == 0, stable_ids, robots_ok, streak >= 3
    )
    passed = F.forall(checks, lambda c: F.coalesce(c, F.lit(False)))
    return F.when(~official | relay, F.lit("rejected")).when(passed, F.lit("approved-candidate")).otherwise(F.lit("needs-human-review"))


def image_ownership() -> Column:
    """CL24."""
    value = F.lower(strip(_c("image_ownership")))
    return (
        F.when(value.isin(*C.IMAGE_OWNERSHIPS), value)
        .when(_c("image_origin") == "editorial-card", F.lit("owned"))
        .when(_c("image_url") != "", F.lit("unknown"))
    )


def _external(url: Column) -> Column:
    return F.regexp_like(text(url), F.lit("(?i)^https?://[^/]"))


def image_issues() -> Column:
    url, ownership = _c("image_url"), F.coalesce(image_ownership(), F.lit(""))
    return codes(
        ((url != "") & (ownership == "unknown"), "image-ownership-unknown"),
        ((ownership == "licensed") & (_c("image_license") == ""), "licensed-without-proof"),
        ((ownership == "official-press") & (_c("image_source_url") == "") & (_c("image_credit") == ""), "official-press-without-source"),
        ((ownership == "source-embed") & ~_external(url), "source-embed-not-external"),
        (F.regexp_like(url, F.lit("(?i)^http://")), "image-http"),
    )


def image_renderable() -> Column:
    url, ownership = _c("image_url"), F.coalesce(image_ownership(), F.lit(""))
    trusted = (_c("image_origin") == "editorial-card") | ownership.isin(*C.IMAGE_APPROVED)
    return (url != "") & ~F.regexp_like(url, F.lit("(?i)^http://")) & (trusted | ~_external(url))


def image_external() -> Column:
    return _external(F.col("image_url"))


def valid_image_decision(status: Column, ownership: Column, reason: Column, license_: Column, source: Column, credit: Column) -> Column:
    """CL25."""
    approved = (
        text(ownership).isin(*C.IMAGE_APPROVED)
        & ~((text(ownership) == "licensed") & (text(license_) == ""))
        & ~((text(ownership) == "official-press") & (text(source) == "") & (text(credit) == ""))
    )
    return F.when(status == "rejected", strip(text(reason)) != "").when(status == "approved", approved).otherwise(F.lit(False))


def image_queue(items: DataFrame, decisions: DataFrame, index_ids: DataFrame) -> DataFrame:
    """CL25. External images that need a decision, indexable first."""
    rows = items.select("id", "title", "image_url", image_ownership().alias("ownership"), image_issues().alias("issues"), image_external().alias("external"))
    rows = rows.join(decisions.select("id", F.col("status").alias("decision")), "id", "left")
    rows = rows.join(index_ids.select("id", F.lit(True).alias("_idx")).distinct(), "id", "left")
    status = F.coalesce("decision", F.when((F.size("issues") > 0) & F.col("external"), F.lit("pending")).otherwise(F.lit("clear")))
    out = rows.select("id", "title", "image_url", "ownership", "issues", "external", status.alias("status"), F.coalesce("_idx", F.lit(False)).alias("indexable"))
    return out.where((F.col("status") != "clear") & F.col("external"))


def has_draft_text() -> Column:
    return (_c("title") != "") & (_c("lead") != "") & (F.size(_list("paragraphs")) > 0)


def source_ok(official: Column) -> Column:
    return (_c("source_url") != "") & is_safe_article_url(F.col("source_url")) & (_c("source_status") == "verified") & F.coalesce(official, F.lit(False))


def release_evaluation(official: Column, skip: tuple[str, ...] = ()) -> Column:
    """CL26. Blockers, status and grade of a draft in one struct."""
    written, sourced = has_draft_text(), source_ok(official)
    quality = F.when(written, quality_issues(skip)).otherwise(F.array(F.lit("text-missing")))
    facts = F.struct(
        language_warnings().alias("language"), claim_warnings().alias("claims"), safety_issues().alias("safety"), quality.alias("quality"),
        written.alias("written"), sourced.alias("sourced"),
    )
    # What reads the texts is computed once; blockers, status and grade look at it many times.
    return once(facts, lambda f: once(_release_blockers(f), lambda blockers: _release_verdict(f, blockers)))


def _bad_language(facts: Column) -> Column:
    return F.exists(facts["language"], lambda w: F.regexp_like(w, F.lit(C.BLOCKING_LANGUAGE)))


def _bad_claims(facts: Column) -> Column:
    return F.exists(facts["claims"], lambda w: F.regexp_like(w, F.lit(C.BLOCKING_CLAIM)))


def _release_blockers(facts: Column) -> Column:
    risk, unique = _c("clinical_risk"), _c("duplicate_status") == "unique"
    image_bad = (_c("image_url") != "") & ~image_renderable()
    return F.array_distinct(
        F.concat(
            codes(
                (risk == "high", "high-risk"), (risk == "", "risk-missing"), (~facts["sourced"], "source-not-official"), (~unique, "not-unique"),
                (~facts["written"], "draft-text-missing"), (_bad_language(facts), "language-warning"), (_bad_claims(facts), "claim-warning"),
                (F.size(facts["safety"]) > 0, "unsafe-phrase"),
            ),
            facts["quality"],
            codes((image_bad, "image-rights")),
        )
    )


def _release_verdict(facts: Column, blockers: Column) -> Column:
    risk, unique, tier = _c("clinical_risk"), _c("duplicate_status") == "unique", content_tier()
    language, claims, safety = facts["language"], facts["claims"], facts["safety"]
    clean = (F.size(blockers) == 0) & (F.size(language) == 0) & (F.size(claims) == 0)
    status = (
        F.when(~unique, F.lit("duplicate"))
        .when(~facts["sourced"], F.lit("needs-source-fix"))
        .when(~facts["written"] | _bad_language(facts), F.lit("needs-language-fix"))
        .when(_bad_claims(facts) | (F.size(safety) > 0), F.lit("needs-claim-fix"))
        .when(risk == "high", F.lit("rejected"))
        .when(F.size(blockers) > 0, F.lit("needs-claim-fix"))
        .otherwise(F.lit("ready-public-brief"))
    )
    grade = (
        F.when((tier == "brief") & F.lower(risk).isin("low", "medium") & clean, F.lit("index-news"))
        .when((F.lower(risk) == "low") & tier.isin("analysis", "evidence") & (F.size(language) == 0) & (F.size(claims) == 0) & (F.size(safety) == 0), F.lit("index-low-risk"))
        .otherwise(F.lit("public-brief"))
    )
    index_candidate = (F.lower(risk) == "low") & tier.isin("analysis", "evidence") & clean
    return F.struct(blockers.alias("blockers"), status.alias("status"), grade.alias("grade"), index_candidate.alias("index_candidate"), (grade == "index-news").alias("is_news"))


def re_review_needed(stored: Column, current: Column) -> Column:
    """CL31."""
    return (text(stored) != "") & (stored != current)


def schedule_eligible() -> Column:
    """CL32."""
    status = F.coalesce(F.nullif(F.col("workflow_status"), F.lit("")), F.lit("draft"))
    risk = clinical_risk()
    contract = F.filter(contract_issues(), lambda i: ~i.isin("published-at-missing", "workflow-status-missing"))
    return (
        status.isin("approved", "published") & (F.size(workflow_issues()) == 0)
        & ~((risk == "high") & F.col("vet_reviewed_at").isNull())
        & ~((risk == "medium") & F.col("reviewed_at").isNull() & F.col("vet_reviewed_at").isNull())
        & (F.size(contract) == 0)
    )


def approval_blockers(reviewer_role: Column) -> Column:
    """CL36. What stands against an approval by a reviewer of the given role (null: not registered)."""
    role, who = required_role(), text(reviewer_role)
    held = lambda k: F.array_contains(_list("checklist"), k)
    rest = F.lit(True)
    for k in C.CHECKLIST[1:]:
        rest = rest & held(k)
    return codes(
        (who == "", "reviewer-missing"),
        ((who != "") & ~((who == "admin") | (who == role)), "role-mismatch"),
        ((_c("source_url") == "") | matches(_c("source_url"), r"(?i)^https?://(?:news\.)?google\."), "source-not-direct"),
        (~held(C.CHECKLIST[0]), "source-not-confirmed"),
        (~rest, "checklist-incomplete"),
        (_c("workflow_status") == "correction-required", "correction-first"),
        ((role == "vet") & (who != "") & ~who.isin("vet", "admin"), "vet-role-required"),
    )


def legacy_audit(indexable_col: Column) -> Column:
    """CL38. Disposition of a row with unsafe phrases, null for a safe one."""
    unsafe = F.size(safety_issues()) > 0
    url = F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.col("source_url_raw"), F.lit(""))
    critical = indexable_col & (clinical_risk() == "high") & ((url == "") | is_relay(url))
    return F.when(unsafe, F.when(critical, F.lit("correction-required-noindex")).otherwise(F.lit("legacy-review-queue")))


def first_publish_class(official: Column, warnings: Column, publish: Column) -> Column:
    """CL39."""
    return (
        F.when(_c("duplicate_status") != "unique", F.lit("duplicate"))
        .when(~((_c("source_url") != "") & is_safe_article_url(F.col("source_url")) & F.coalesce(official, F.lit(False))) | (_c("source_status") != "verified"), F.lit("needs-source-fix"))
        .when(~has_draft_text() | (F.size(warnings) > 0) | (F.size(publish) > 0), F.lit("needs-language-fix"))
        .when(_c("clinical_risk") != "low", F.lit("rejected"))
        .otherwise(F.lit("ready-for-editor"))
    )


def block_reason() -> Column:
    """CL45. First reason that blocks an approval."""
    status = F.coalesce(F.nullif(F.col("workflow_status"), F.lit("")), F.lit("draft"))
    url = F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.nullif(F.col("source_url_raw"), F.lit("")))
    return (
        F.when(status == "correction-required", F.lit("correction-required"))
        .when(status == "vet-review-required", F.lit("handed-to-vet"))
        .when(url.isNull(), F.lit("source-missing"))
        .when(matches(url, r"(?i)^https?://(?:news\.)?google\."), F.lit("relay-url"))
        .when(required_role() == "vet", F.lit("vet-review-needed"))
    )


def derived_findings(derived: Column, source: Column) -> Column:
    """CL44. What a derived text states and its source does not: numbers, species, directives, capitalised names."""
    number = r"\d+(?:[.,]\d+)?"
    bare = lambda c: F.transform(F.regexp_extract_all(text(c), F.lit(number), F.lit(0)), lambda n: F.replace(n, F.lit(","), F.lit("")))
    lowered = F.lower(text(source))
    numbers = F.array_except(bare(derived), bare(source))
    species = F.array_compact(
        F.array(*[
            F.when(F.contains(text(derived), F.lit(name)) & ~F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(lowered, t)), F.lit(name))
            for name, terms in C.SPECIES.items()
        ])
    )
    directives = F.array_distinct(F.regexp_extract_all(text(derived), F.lit(C.DIRECTIVE), F.lit(0)))
    names = F.regexp_extract_all(text(derived), F.lit(r"[A-Z][A-Za-z.\-]{2,}"), F.lit(0))
    keyed = F.transform(names, lambda n: F.struct(F.lower(F.regexp_replace(n, r"[.\-]+$", "")).alias("k"), n.alias("n")))
    keyed = F.filter(keyed, lambda s: F.length(s["k"]) >= 3)
    keys = F.transform(keyed, lambda s: s["k"])
    first = F.filter(keyed, lambda s, i: (F.array_position(keys, s["k"]) == i + 1) & ~F.contains(lowered, s["k"]))
    latin = F.transform(first, lambda s: s["n"])
    return F.struct(numbers.alias("numbers"), species.alias("species"), directives.alias("directives"), latin.alias("names"))


def context_of(value: Column, needle: Column, reach: int = 28) -> Column:
    """Surroundings of the first occurrence of a finding."""
    at = F.instr(value, needle)
    start = F.greatest(F.lit(1), at - reach)
    return F.regexp_replace(F.substring(value, start, at - start + F.length(needle) + reach), f"[{C.WS}]+", " ")
