"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at counts of one document and votes good, votes bad or abstains. The votes of all documents are reduced to
a histogram of vote patterns, which has at most 3 to the power of the number of rules rows. On it,
expectation-maximisation estimates the share of good documents and of each kind of bad ones, and how often each rule casts
each vote for each of them (its accuracy). There is one kind of bad document per rule, since spam in capitals and a page
of symbols have little in common; a kind is held to its rule's bad vote, so a document without bad votes is good. A document's verdict is its posterior probability
of being good.

Only DataFrame functions; the counts of a document come from array functions inside its row, so nothing is shuffled but
the histogram.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import SPACE, SPACES, keep_decided, let, store, table, texts
from .queries import query

#: Base rule: fewest words, and the largest share of words in repeated three-word windows, in percent.
LEAST_WORDS = 50
MOST_REPEATED = 50
#: A document stays when its posterior reaches this.
LEAST_POSTERIOR = 0.5
#: Start of the estimation: rates of (bad, good) votes in good documents, in bad ones, and in those a rule stands for.
START = {"good": (0.001, 0.7), "bad": (0.03, 0.65), "own": (0.999998, 1e-6)}
START_GOOD = 0.8
#: A rule is held to casting at most this share of bad votes on good documents, or a large kind of bad ones would pass as good.
MOST_ERRORS = 0.001
#: Share of the corpus that each kind of bad documents is given at least.
LEAST_SHARE = 0.005
#: Documents that the start weighs in every estimate.
START_WEIGHT = 5.0
ROUNDS = 100


def _repeated(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more in one document.

    Windows are sorted by a hash; those with an equal neighbour are compared as texts, sorted again, and the places that
    remain are counted as a union of intervals of three words.
    """
    n = F.size(words) - 2

    def windows(w: Column) -> Column:
        return F.array_sort(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("k"), i.alias("i"))))

    def same_next(s: Column) -> Column:
        return F.filter(s, lambda x, j: F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False)) | F.coalesce(F.get(s, j - 1)["k"] == x["k"], F.lit(False)))

    def spelled(w: Column, s: Column) -> Column:
        return F.array_sort(F.transform(s, lambda x: F.struct(F.concat_ws(" ", F.get(w, x["i"]), F.get(w, x["i"] + 1), F.get(w, x["i"] + 2)).alias("k"), x["i"].alias("i"))))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    body = let(words, lambda w: let(let(windows(w), same_next), lambda s: let(let(spelled(w, s), same_next), lambda t: let(F.array_sort(F.transform(t, lambda x: x["i"])), covered))))
    return F.when(n < 2, F.lit(0).cast("long")).otherwise(body)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its text's digest and the counts that the rules read; a null or empty text has zeros."""
    base = texts(docs, id_col, text_col)
    trimmed = F.trim(F.col("text"), F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")

    def length_of(pattern: str) -> Column:
        """Code points that are left when everything that matches is deleted."""
        return F.length(F.regexp_replace("text", pattern, "")).cast("long")

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(w)).cast("long").alias("n_distinct"), _repeated(w).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    return base.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), let(words, of_words).alias("w"), let(lines, of_lines).alias("l"), length_of(SPACE + "+").alias("word_chars"),
        length_of("[^#*$%&|<>]+").alias("n_symbols"), length_of("\\P{Lu}+").alias("n_upper"), length_of("[^!?]+").alias("n_shouts"), length_of("[^0-9]+").alias("n_digits"),
    ).select("doc_id", "text_sha256", "w.*", "l.*", "word_chars", "n_symbols", "n_upper", "n_shouts", "n_digits")


def votes() -> dict[str, Column]:
    """Each rule's vote over the columns of :func:`counts`: 1 good, -1 bad, 0 abstains."""
    c = F.col

    def vote(bad: Column, good: Column) -> Column:
        return F.when(c("n_words") == 0, 0).when(bad, -1).when(good, 1).otherwise(0)

    few = F.least(c("n_words") * 0.2, F.sqrt(c("n_words").cast("double")) * 9)
    return {
        "symbols": vote(c("n_symbols") * 10 > c("n_words"), c("n_symbols") == 0),
        "capitals": vote(c("n_upper") * 10 > c("word_chars") * 3, c("n_upper") * 10 < c("word_chars")),
        "variety": vote(c("n_distinct") < few, c("n_distinct") > few * 2),
        "shouting": vote(c("n_shouts") * 10 > c("n_words") * 3, F.lit(False)),
        "repeats": vote(c("n_repeat_words") * 10 > c("n_words") * 3, c("n_repeat_words") * 10 < c("n_words")),
        "lines": vote(c("n_dup_lines") * 2 > c("n_lines"), (c("n_dup_lines") == 0) & (c("n_lines") > 1)),
        "word_length": vote((c("word_chars") < c("n_words") * 3) | (c("word_chars") > c("n_words") * 10), F.lit(False)),
        "digits": vote(c("n_digits") * 5 > c("word_chars"), F.lit(False)),
    }


Model = tuple[list[float], list[list[dict[int, float]]]]


def _start(n_rules: int) -> Model:
    """Shares of good documents and of the kinds of bad ones; per kind and rule the rate of each vote."""
    def rates(kind: str) -> dict[int, float]:
        bad, good = START[kind]
        return {-1: bad, 1: good, 0: 1 - bad - good}

    kinds = [[rates("good") for _ in range(n_rules)]]
    kinds += [[rates("own" if rule == k else "bad") for rule in range(n_rules)] for k in range(n_rules)]
    return [START_GOOD] + [(1 - START_GOOD) / n_rules] * n_rules, kinds


def responsibilities(pattern: list[int], model: Model) -> list[float]:
    """Posterior of each kind of document, good first, given one vote per rule."""
    shares, kinds = model
    odds = [math.log(share) + sum(math.log(rule[v]) for rule, v in zip(rates, pattern)) for share, rates in zip(shares, kinds)]
    top = max(odds)
    parts = [math.exp(o - top) for o in odds]
    return [p / sum(parts) for p in parts]


def estimate(histogram: list[tuple[list[int], int]], n_rules: int, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over vote patterns with their counts. The start weighs as ``START_WEIGHT`` documents of each
    kind, which keeps the kinds apart in a corpus that has none of them; a kind keeps its own rule's start."""
    start = _start(n_rules)
    model = start
    total = sum(n for _, n in histogram)
    for _ in range(rounds):
        mass = [START_WEIGHT * s for s in start[0]]
        seen = [[{v: START_WEIGHT * p for v, p in rule.items()} for rule in rates] for rates in start[1]]
        for pattern, n in histogram:
            for k, p in enumerate(responsibilities(pattern, model)):
                mass[k] += n * p
                for rule, v in zip(seen[k], pattern):
                    rule[v] += n * p
        kinds = [[{v: x / sum(rule.values()) for v, x in rule.items()} for rule in rates] for rates in seen]
        for k in range(n_rules):
            kinds[k + 1][k] = start[1][k + 1][k]
            if (bad := kinds[0][k][-1]) > MOST_ERRORS:
                kinds[0][k] = {v: MOST_ERRORS if v == -1 else p * (1 - MOST_ERRORS) / (1 - bad) for v, p in kinds[0][k].items()}
        shares = [max(LEAST_SHARE, m / (total + START_WEIGHT)) for m in mass]
        before, model = model, ([x / sum(shares) for x in shares], kinds)
        if abs(before[0][0] - model[0][0]) < 1e-12:
            break
    return model


def _votes_of(code: int, n_rules: int) -> list[int]:
    return [code // 3**j % 3 - 1 for j in range(n_rules)]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_POSTERIOR) -> DataFrame:
    """One row per row of ``docs``: the counts, base_failed, quality (posterior of being good) and kept.

    A null or empty text has no words and fails the base rule. Rows that repeat are judged alike. An empty table gives no
    rows. The estimation covers the votes of all documents.
    """
    rules = votes()
    cast = store(counts(docs, id_col, text_col).select("*", *[v.cast("byte").alias(f"vote_{k}") for k, v in rules.items()]), "quality-votes")
    names = [f"vote_{k}" for k in rules]
    code = sum(((F.col(n).cast("int") + 1) * 3**j for j, n in enumerate(names)), F.lit(0))
    cast = cast.withColumn("pattern", code)
    histogram = [(_votes_of(r["pattern"], len(names)), r["count"]) for r in cast.groupBy("pattern").count().orderBy("pattern").collect()]
    model = estimate(histogram, len(names))
    verdicts = ["0"] * 3 ** len(names)  # one number per vote pattern, looked up by its code
    for pattern, _ in histogram:
        verdicts[sum((v + 1) * 3**j for j, v in enumerate(pattern))] = repr(responsibilities(pattern, model)[0])
    lookup = F.split(F.lit(",".join(verdicts)), ",").cast("array<double>")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    scored = cast.withColumn("quality", F.get(lookup, F.col("pattern"))).withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)).drop("pattern", *names)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that :func:`judge` rejects, all columns unchanged; rows that share an id, or have none, are judged each
    by its own text."""
    digest = F.sha2(F.coalesce(docs[text_col].cast("string"), F.lit("")), 256)
    return keep_decided(docs, id_col, judge(docs, id_col, text_col).select("doc_id", "kept", "text_sha256"), "quality-gone", text_sha256=digest)


@query("op7_quality_rules")
def op7_quality_rules(spark, sf_dir):
    judged = judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
