"""ID4-ID9 and TX*: text keys, cleaning and measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    BIBLIOGRAPHIC_MARKERS, EXTERNAL_LINK, FOREIGN_SCRIPT, KEYWORD_STOPWORDS, NARRATIVE, NUMBER_TOKEN, PLAIN_NUMBER,
    RELEVANCE_TERMS, REWRITE_RULES, WS,
)
from .patterns import compact, count, find_all, java, matches, once, replace, squeeze, strip, strip_plain, text
from .unicode import nfkc

_ENTITIES = (
    ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#8217;|&rsquo;", "'"),
    ("&#8220;|&#8221;|&ldquo;|&rdquo;", '"'), (r"&#\d+;", " "),
)


def title_key(title: Column) -> Column:
    """ID4. A key over 80 characters is cut there and closed with a hash of the whole, so that titles which differ later differ."""
    whole = F.regexp_replace(F.lower(text(title)), "[^a-z0-9가-힣]", "")
    return F.when(F.length(whole) <= 80, whole).otherwise(F.concat(F.substring(whole, 1, 80), F.lit("#"), F.substring(F.md5(whole), 1, 16)))


def title_words(plain: Column) -> Column:
    """Lower-case words of a title without tags, already in NFKC form."""
    return F.trim(F.regexp_replace(F.lower(plain), "[^a-z0-9가-힣]+", " "))


def normalize_title(title: Column) -> Column:
    """ID5. Lower-case words of a title: tags go first, then NFKC folding, then everything but letters and digits."""
    return title_words(nfkc(F.regexp_replace(text(title), "(?i)<[^>]+>|&(?:amp|nbsp|quot|#39);", " ")))


def title_tokens(title: Column) -> Column:
    """ID6. Distinct title words longer than one character."""
    return F.array_distinct(F.filter(F.split(normalize_title(title), " "), lambda w: F.length(w) > 1))


def overlap_similarity(left: Column, right: Column) -> Column:
    """Shared words over the larger set, rounded to three digits before any threshold is applied."""
    larger = F.greatest(F.size(left), F.size(right))
    return F.when(larger > 0, F.round(F.size(F.array_intersect(left, right)) / larger, 3)).otherwise(F.lit(0.0))


def text_hash(value: Column) -> Column:
    """ID9."""
    return F.sha2(text(value), 256)


def struct_hash(**fields: Column) -> Column:
    """ID7-ID9. Hash of named fields in the given order; absent text counts as empty."""
    return F.sha2(F.to_json(F.struct(*[F.coalesce(c, F.lit("")).alias(n) if n[-1] != "_" else c.alias(n[:-1]) for n, c in fields.items()])), 256)


def strip_html(html: Column) -> Column:
    """TX1. Visible text of a fragment."""

    def untag(out: Column) -> Column:
        out = F.regexp_replace(out, r"(?i)<script[\s\S]*?</script>", "")
        out = F.regexp_replace(out, r"(?i)<style[\s\S]*?</style>", "")
        return F.regexp_replace(out, "<[^>]+>", " ")

    def decode(out: Column) -> Column:
        for entity, plain in _ENTITIES:
            out = F.regexp_replace(out, entity, plain)
        return out

    # Each pattern starts with one character; texts without it are not searched.
    out = once(text(html), lambda v: F.when(F.contains(v, F.lit("<")), untag(v)).otherwise(v))
    return squeeze(once(out, lambda v: F.when(F.contains(v, F.lit("&")), decode(v)).otherwise(v)))


def _decode_numeric(value: Column, pattern: str, base: int) -> Column:
    found = F.array_distinct(F.regexp_extract_all(value, F.lit(pattern), F.lit(1)))

    def put(acc: Column, digits: Column) -> Column:
        point = F.conv(digits, base, 10).cast("int")
        # chr() stops at 255, so the code point goes through its UTF-32 bytes.
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        mark = "&#x" if base == 16 else "&#"
        return F.replace(acc, F.concat(F.lit(mark), digits, F.lit(";")), char)

    return F.aggregate(found, value, put)


def clean_text(html: Column) -> Column:
    """TX2. Tags out, named and numeric entities decoded."""
    out = F.regexp_replace(text(html), "<[^>]+>", " ")
    out = F.regexp_replace(out, "(?i)&#160;|&nbsp;", " ")
    out = F.regexp_replace(out, "(?i)&amp;", "&")
    out = F.regexp_replace(out, "(?i)&quot;", '"')
    out = F.regexp_replace(out, "(?i)&#39;|&apos;", "'")
    out = _decode_numeric(out, r"&#(\d{1,7});", 10)
    out = _decode_numeric(out, r"&#x([0-9A-Fa-f]{1,6});", 16)
    return squeeze(out)


def paragraphs(body: Column) -> Column:
    """TX11. Trimmed non-empty lines of a body."""
    return F.filter(F.transform(F.split(text(body), "\n"), strip_plain), lambda p: p != "")


def body_char_count(parts: Column) -> Column:
    """TX11. Characters of the body without white space."""
    return F.length(compact(F.array_join(parts, "")))


def numeric_tokens(value: Column) -> Column:
    """TX12. Numeric claims (number with unit, ``n=``, percent), in order of appearance."""
    # The look-ahead skips all characters that no token starts with.
    return F.transform(find_all(text(value), f"(?=[nNsS표대0-9]){NUMBER_TOKEN}"), lambda t: F.lower(squeeze(t)))


def plain_numbers(value: Column) -> Column:
    """Numbers with an optional unit, as the update and claim audits compare them."""
    return F.transform(find_all(text(value), PLAIN_NUMBER), squeeze)


def foreign_script(value: Column) -> Column:
    """TX13. Foreign-script runs and Latin words; words in capitals only count as acronyms and pass."""
    runs = F.regexp_extract_all(text(value), F.lit(f"{FOREIGN_SCRIPT}+"), F.lit(0))
    latin = F.regexp_extract_all(text(value), F.lit("[A-Za-z]{2,}"), F.lit(0))
    return F.array_distinct(F.concat(runs, F.filter(latin, lambda t: F.regexp_like(t, F.lit("[a-z]")))))


def apply_rewrites(value: Column, rules=REWRITE_RULES) -> Column:
    """TX14. Ordered pattern/replacement rules folded into one expression."""
    out = text(value)
    for pattern, replacement in rules:
        out = replace(out, pattern, replacement)
    return out


def rule_hits(value: Column, rules=REWRITE_RULES) -> Column:
    """TX14. (rule, hits) of the rules that occur, as an array; ``explode`` gives one row per rule."""
    counted = F.array(*[F.struct(F.lit(pattern).alias("rule"), count(text(value), pattern).alias("hits")) for pattern, _ in rules])
    return F.filter(counted, lambda r: r["hits"] > 0)


def article_text_quality(body: Column, title: Column) -> Column:
    """TX15. Verdict on extracted text."""
    value = text(body)
    length = F.length(value)
    symbols = F.regexp_count(value, F.lit("[{};=<>|&$]"))
    words = F.regexp_count(value, F.lit("[A-Za-z][A-Za-z'-]*"))
    word_list = F.regexp_extract_all(value, F.lit("[A-Za-z][A-Za-z'-]*"), F.lit(0))
    capitals = F.size(F.filter(word_list, lambda w: F.regexp_like(w, F.lit("^[A-Z]"))))
    sentences = F.regexp_count(value, F.lit(f"[.!?][\"')\\]]?(?:[{WS}]|$)"))
    title_words = F.array_distinct(F.regexp_extract_all(F.lower(text(title)), F.lit("[a-z]{5,}"), F.lit(0)))
    lowered = F.lower(value)
    hits = F.size(F.filter(title_words, lambda w: F.contains(lowered, w)))
    return (
        F.when(length < 400, F.lit("too-short"))
        .when(symbols / length > 0.012, F.lit("looks-like-code"))
        .when((words >= 40) & (capitals / words > 0.4), F.lit("looks-like-navigation"))
        .when((sentences == 0) | (length / sentences > 300), F.lit("looks-like-navigation"))
        .when((F.size(title_words) >= 3) & (hits / F.size(title_words) < 0.34), F.lit("title-mismatch"))
        .otherwise(F.lit("ok"))
    )


def bibliographic_only(description: Column) -> Column:
    """TX16. Description holds catalogue data and no narrative."""
    value = clean_text(description)
    markers = sum((matches(value, p).cast("int") for p in BIBLIOGRAPHIC_MARKERS), F.lit(0))
    head = F.element_at(F.split(value, java(BIBLIOGRAPHIC_MARKERS[0])), 1)
    return (
        F.when(value == "", F.lit(True))
        .when(matches(value, EXTERNAL_LINK), F.lit(True))
        .when(markers < 2, F.lit(False))
        .otherwise(~matches(head, NARRATIVE) & (F.length(head) < 700))
    )


def parse_count(value: Column) -> Column:
    """TX17. ``< 10`` is 5, thousands separators go, anything else unreadable is 0."""
    raw = strip(text(value))
    number = F.regexp_replace(raw, java(r"[,\s]"), "").try_cast("double")
    return F.when(F.regexp_like(raw, F.lit(r"^<\s*10$")), F.lit(5.0)).otherwise(F.coalesce(number, F.lit(0.0)))


def parse_measure(value: Column) -> Column:
    """TX17. Report cell as a number: percent signs, blanks and commas go; empty is 0, unreadable is null."""
    raw = F.regexp_replace(text(value), "[% ,]", "")
    return F.when(raw == "", F.lit(0.0)).otherwise(raw.try_cast("double"))


def coverage_tokens(keyword: Column, stopwords=KEYWORD_STOPWORDS) -> Column:
    """TX18. Meaningful words of a keyword."""
    words = F.filter(F.split(text(keyword), f"[{WS}·,/]+"), lambda w: F.length(w) >= 2)
    return F.filter(words, lambda w: ~w.isin(*stopwords))


def lead_repeats_body(lead: Column, parts: Column) -> Column:
    """TX19."""
    return (text(lead) != "") & (compact(text(lead)) == compact(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))))


def term_hits(value: Column, terms: str = RELEVANCE_TERMS) -> Column:
    """TX20. Number of different terms of a list found in the text."""
    found = F.regexp_extract_all(text(value), F.lit(f"(?i){terms}"), F.lit(0))
    return F.size(F.array_distinct(F.transform(found, F.lower)))


def any_term(value: Column, terms: str = RELEVANCE_TERMS) -> Column:
    return matches(text(value), f"(?i){terms}")


def term_count(value: Column, pattern: str) -> Column:
    return count(text(value), f"(?i){pattern}")


def trim_deck(value: Column, limit: int = 220) -> Column:
    """ID23. Deck cut at the last sentence end before ``limit``, or with an ellipsis."""
    flat = squeeze(text(value))
    cut = F.substring(flat, 1, limit)
    end = F.length(F.regexp_extract(cut, r"^([\s\S]*[.!?])", 1))
    return (
        F.when(F.length(flat) <= limit, flat)
        .when(end - 1 > 80, F.substring(cut, F.lit(1), end))
        .otherwise(F.concat(F.trim(cut), F.lit("…")))
    )


def short_source(value: Column) -> Column:
    """ID23. Source name without its subtitle, at most 42 characters."""
    flat = squeeze(text(value))
    head = F.trim(F.element_at(F.split(flat, java(r"\s+[:=]\s+")), 1))
    return F.when(F.length(head) > 42, F.concat(F.trim(F.substring(head, 1, 40)), F.lit("…"))).otherwise(head)
