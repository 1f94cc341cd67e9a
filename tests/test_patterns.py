"""Patterns behind a look-ahead, and expressions that are computed once."""

import random

import pytest
from pyspark.sql import functions as F

from broadsheet import constants as C
from broadsheet.functions import hints, patterns, text
from broadsheet.operators import rules, topk
from broadsheet.sources import sinks

PATTERNS = [
    C.UNTRANSLATED, C.GARBLED, C.TEMPLATE, C.HIGH_RISK, C.MEDIUM_RISK, C.LOW_RISK, C.CLINICAL_ACTION, C.TITLE_ENGLISH, C.PAYWALL, C.SENTENCE_END, C.SUPERLATIVE, C.REPEATED_WORD,
    "(?i)" + "|".join(C.BANNED_TERMS), "(?i)" + "|".join(C.UNSAFE_PHRASES), *[f"(?i){m}" for _, m in C.TOPICS], "a?b|c", "x*|y", "(?:a|)b", "[^a]b|c", r"\\d+|z", "(a|b)?c",
]


def texts():
    rng = random.Random(9)
    parts = sorted({w for p in PATTERNS for w in __import__("re").findall("[가-힣A-Za-z]+", p)}) + [" ", "  ", "[", "]", "a", "b", "c", "7", ".", "\n", "é", "수"]
    made = ["".join(rng.choice((str.upper, str.lower, str))(rng.choice(parts)) + rng.choice(("", " ")) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    return [(k, t) for k, t in enumerate([*made, "", None])]


def test_a_look_ahead_changes_no_match(spark):
    df = spark.createDataFrame(texts(), "k int, t string")
    plain = [F.regexp_count("t", F.lit(patterns.java(p))) for p in PATTERNS]
    made = [patterns.count(F.col("t"), p) for p in PATTERNS]
    for r in df.select("t", F.array(*plain).alias("plain"), F.array(*made).alias("made")).collect():
        assert r.plain == r.made, r.t
    assert patterns.led(C.HIGH_RISK).startswith("(?i)(?=[가-힣") and patterns.led(C.TEMPLATE).startswith("(?i)(?=[")
    assert all(patterns.led(p) == patterns.java(p) for p in PATTERNS[-6:] if p != "[^a]b|c" and p != "a?b|c")


def test_topic_hits_equal_plain_counts(spark):
    df = spark.createDataFrame(texts(), "k int, t string").withColumn("title", F.substring("t", 1, 9))
    plain = F.array(*[F.struct(F.regexp_count(F.coalesce(F.col(c), F.lit("")), F.lit(f"(?i){m}"))) for _, m in C.TOPICS for c in ("title", "t")])
    for r in df.select("t", plain.alias("plain"), topk.topic_hits(F.col("title"), F.col("t")).alias("hits")).collect():
        assert [x[0] for x in r.plain] == [n for h in r.hits for n in (h.meta, h.body)], r.t


@pytest.mark.parametrize("judge", ["release", "publish"])
def test_rules_on_texts_are_computed_once(spark, judge):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")  # the plan is read as a text
    items = rules.prepare(spark.createDataFrame([("1", "a title", "b", ["c"])], "id string, title string, lead string, paragraphs array<string>"))
    if judge == "release":
        df = patterns.settle(items, e=rules.release_evaluation(F.lit(True))).select("e.*")
    else:
        df = sinks.publish_blockers(items, rules.contract_issues(), rules.publish_issues(), F.current_timestamp()).select("reasons")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("(?:Invol|ractical)") == 1


def test_white_space_helpers_equal_the_plain_patterns(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["a", "b ", " ", "\n", "\t", "\r\n", "\u0085", "\u00a0", "\u2028", "\u2029", "\ufeff", "가"]) for _ in range(rnd.randrange(9))) for _ in range(800)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t, ws = F.col("t"), patterns.WS
    plain = {"squeeze": F.trim(F.regexp_replace(t, f"[{ws}]+", " ")), "strip_plain": F.regexp_replace(t, f"^[{ws}]+|[{ws}]+$", ""), "compact": F.regexp_replace(t, f"[{ws}]", "")}
    for name, want in plain.items():
        assert df.where(~getattr(patterns, name)(t).eqNullSafe(want)).count() == 0, name


def test_single_blanks_are_not_replaced(spark):
    """White space is replaced where it changes something; in most texts that is nowhere."""
    df = spark.createDataFrame([("a b c", "a  b\tc \u00a0d",)], "plain string, odd string")
    assert df.select(F.regexp_count("plain", F.lit(patterns.RUNS)), F.regexp_count("odd", F.lit(patterns.RUNS))).first() == (0, 3)


def test_hints_keep_every_text_with_a_match(spark):
    """A clear bit is certain, for the rules' patterns and for odd ones; most texts need no search."""
    found = tuple(PATTERNS[:13]) + (C.HANGUL, C.FOREIGN_SCRIPT, "(?:ab|cd)e?fgh|(?:a(?:bcd)b)?x", "(?!abc)abcd+e")
    rows = texts() + [(1000 + k, t) for k, t in enumerate(["xlorem\nIPSUMx", "TODO", "[ 내용 ]", "abfgh", "cdefgh x", "abcdde", "Ж", "STUDY", "병원", "plain text"])]
    df = spark.createDataFrame(rows, "k int, t string").withColumn("t", F.coalesce("t", F.lit("")))
    judged = df.select("t", hints.hints(F.col("t"), found).alias("bits"), F.array(*[F.regexp_like("t", F.lit(patterns.java(p))) for p in found]).alias("plain")).collect()
    for r in judged:
        assert not [p for k, p in enumerate(found) if r.plain[k] and not r.bits >> k & 1], r.t
    assert [r.bits & (1 << found.index(C.TEMPLATE)) for r in judged if r.t == "plain text"] == [0]
    assert hints.pieces(C.CLINICAL_ACTION) == C.HANGUL and hints.pieces(C.REPEATED_WORD) is None and hints.pieces("ab?c") is None


def test_repeated_word_equals_the_plain_pattern(spark):
    rng = random.Random(3)
    parts = ["an", "An", "ant", "a", "가나", "가나다", "x1", "_", " ", "  ", "\n", " ", "-", "7"]
    made = [(str(k), "".join(rng.choice(parts) for _ in range(rng.randint(2, 7)))) for k in range(1500)]
    items = rules.prepare(spark.createDataFrame(made, "id string, title string"))
    out = items.select("_all", rules.repeated_word(F.col("_all")).alias("got"), F.regexp_like("_all", F.lit(patterns.java(C.REPEATED_WORD))).alias("want")).collect()
    assert [r._all for r in out if r.got != r.want] == [] and {r.got for r in out} == {True, False}


def test_markup_is_dropped_as_by_the_plain_patterns(spark):
    rng = random.Random(4)
    parts = ["a", " ", "  ", "\n", " ", "<b>", "</p>", "<", ">", "&", "&amp;", "lt;", "&#8217;", "&#9;", "<SCRIPT>", "</script>", "<style x>", "</style>", "&nbsp;"]
    df = spark.createDataFrame([("".join(rng.choice(parts) for _ in range(rng.randint(0, 9))),) for _ in range(1500)] + [(None,)], "t string")
    plain = F.coalesce("t", F.lit(""))
    for pattern, to in ((r"(?i)<script[\s\S]*?</script>", ""), (r"(?i)<style[\s\S]*?</style>", ""), ("<[^>]+>", " "), *text._ENTITIES):
        plain = F.regexp_replace(plain, pattern, to)
    plain = F.trim(F.regexp_replace(plain, f"[{patterns.WS}]+", " "))
    assert df.where(~text.strip_html(F.col("t")).eqNullSafe(plain)).count() == 0


def test_rules_search_a_body_once_and_few_texts(spark):
    """Numbers of the body are looked for once for all fields, and long patterns stand behind their hint."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")  # the plan is read as a text
    items = rules.prepare(spark.createDataFrame([("1", "a title", "b 3%", ["c 3 mg"])], "id string, title string, lead string, paragraphs array<string>"))
    df = items.select(rules.item_numeric_issues().alias("n"), rules.quality_issues().alias("q"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("sample(?: size)?") <= 5 and plan.count("_hints#") > 4
    assert df.first().n == ["numeric-lead-body-mismatch"]


def test_texts_without_odd_white_space_are_joined_as_by_the_plain_patterns(spark):
    rng = random.Random(6)
    parts = ["a", "b.", " ", "  ", "\t", " ", "가", ""]
    make = lambda: "".join(rng.choice(parts[: rng.choice([4, 8])]) for _ in range(rng.randint(0, 5)))
    made = [(str(k), make(), rng.choice([make(), None]), [make() for _ in range(rng.randint(0, 3))], make()) for k in range(800)]
    items = rules.prepare(spark.createDataFrame(made, "id string, title string, lead string, paragraphs array<string>, angle string"))
    whole = F.concat_ws(" ", "title", "lead", F.array_join("paragraphs", " "), F.lit(""), "angle")
    plain = F.trim(F.regexp_replace(whole, f"[{patterns.WS}]+", " "))
    parts = F.transform("paragraphs", lambda p: F.regexp_replace(p, f"[{patterns.WS}]", ""))
    assert items.where(~F.col("_all").eqNullSafe(plain) | ~F.col("_parts").eqNullSafe(parts)).count() == 0
    assert {r.odd for r in items.select(rules._hint(rules.ODD_SPACE).alias("odd")).collect()} == {True, False}


def test_repeated_paragraphs_equal_the_plain_rule(spark):
    rng = random.Random(7)
    parts = ["a", "B", "b", " ", "  ", "-", "<i>", "&amp;", "가", "é", "İ", "7"]
    made = [([rng.choice(["".join(rng.choice(parts) for _ in range(rng.randint(0, 3))), None]) for _ in range(rng.randint(0, 4))],) for _ in range(1500)] + [(None,), ([],)]
    df = rules.prepare(spark.createDataFrame(made, "paragraphs array<string>"))
    own = F.coalesce("paragraphs", F.array().cast("array<string>"))
    words = F.transform(own, lambda p: text.title_words(F.regexp_replace(p, "(?i)<[^>]+>|&(?:amp|nbsp|quot|#39);", " ")))
    out = df.select("paragraphs", F.array_contains(rules.language_warnings(), "repeated-paragraph").alias("got"), (F.size(F.array_distinct(words)) < F.size(own)).alias("want")).collect()
    assert [r.paragraphs for r in out if r.got != r.want] == [] and {r.got for r in out} == {True, False}
