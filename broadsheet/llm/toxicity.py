"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the marked words of a clause from left to right: insults, threats, targets, negation and
reported speech. Each turns a mark into a factor and remembers what it needs (a negation still open, a clause that reports
what somebody said, a target named before the insult). They are composed into one transducer, so a clause is read once and
its score depends on how the marks stand together: "you are an idiot" counts fully, "you are not an idiot" and "he said: idiot"
count less. A document is scored by its matched clauses, not by single words.

The lexicon is an Aho-Corasick automaton over words and word beginnings: fixed lists, and entries that labelled rows teach.
Entries are learned by covering: of the features that are many times as frequent in toxic rows, the one that is in most
toxic rows that have no entry yet goes in first. An entry weighs the logarithm of how many times as frequent it is.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import store, table, texts
from .labels import labelled, remainder
from .queries import query

#: Labelled rows of each class that the lexicon and the weights are learned from.
SAMPLE = 3000
#: Candidate features that are looked at while covering.
CANDIDATES = 3000
#: A learned entry is in at least this many toxic rows that have no other entry, and so many times as frequent in toxic rows.
LEAST_ROWS = 4
LEAST_TIMES = 12
#: Weight of a fixed entry that nothing was learned about.
FIXED_WEIGHT = 2.0

# Words of the grammar.
INSULTS = "idiot idiots moron morons stupid pathetic loser losers scum trash worthless disgusting clown imbecile dumbass crétin abruti connard ordure débile dummkopf arschloch abschaum trottel estúpido imbécil basura inútil asqueroso"
THREATS = "kill murder strangle stab shoot destroy hurt tuer frapper töten umbringen erschießen matar golpear"
TARGETS = "you your you're he she they him her them these those people tu vous toi il elle ils elles du ihr sie er dich euch tú usted él ella ellos ellas ustedes"
NEGATIONS = "not no never isn't aren't wasn't don't doesn't n't ne pas jamais nicht kein keine nie nunca jamás"
REPORTS = "said says say called calls quoted wrote claims reported dit disait écrit sagte sagt schrieb nannte dijo dice escribió llamó"

_CLAUSE = re.compile(r"[.;:!?\n]")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")

# ---------------------------------------------------------------- transducers

#: A transducer is {state: {mark: (next state, factor)}}; a mark without an entry keeps the state and has factor 1.
Transducer = dict[str, dict[str, tuple[str, float]]]

INSULT: Transducer = {"none": {"insult": ("seen", 1.0)}, "seen": {"insult": ("seen", 1.2)}}
THREAT: Transducer = {"none": {"threat": ("seen", 1.0)}, "seen": {"threat": ("seen", 1.2), "target": ("aimed", 1.5)}}
TARGET: Transducer = {"none": {"target": ("named", 1.0)}, "named": {"insult": ("named", 1.3)}}
NEGATION: Transducer = {"plain": {"negation": ("negated", 1.0)}, "negated": {"insult": ("plain", 0.6), "threat": ("plain", 0.4), "negation": ("plain", 1.0)}}
REPORT: Transducer = {"direct": {"report": ("reported", 1.0)}, "reported": {"insult": ("reported", 0.7), "threat": ("reported", 0.7)}}
MARKS = ("insult", "threat", "target", "negation", "report")


def compose(*parts: Transducer) -> tuple[dict[tuple[str, ...], dict[str, tuple[tuple[str, ...], float]]], tuple[str, ...]]:
    """One transducer that runs all ``parts`` side by side: its states are their reachable combinations, its factors products."""
    start = tuple(next(iter(p)) for p in parts)
    table: dict[tuple[str, ...], dict[str, tuple[tuple[str, ...], float]]] = {}
    todo = [start]
    while todo:
        state = todo.pop()
        if state in table:
            continue
        table[state] = {}
        for mark in MARKS:
            moves = [p.get(s, {}).get(mark, (s, 1.0)) for p, s in zip(parts, state)]
            target, factor = tuple(m[0] for m in moves), math.prod(m[1] for m in moves)
            table[state][mark] = (target, factor)
            todo.append(target)
    return table, start


GRAMMAR, START = compose(INSULT, THREAT, TARGET, NEGATION, REPORT)


def clause_score(marks: list[tuple[str, float]]) -> float:
    """Weight of one clause, given its marks in order, each with its lexicon weight (used for insults and threats). A target
    after a threat adds to that threat."""
    state, total, threat = START, 0.0, 0.0
    for mark, weight in marks:
        state, factor = GRAMMAR[state][mark]
        if mark in ("insult", "threat"):
            total += weight * factor
            threat = weight * factor if mark == "threat" else threat
        elif mark == "target":
            total += threat * (factor - 1)
    return total


# ---------------------------------------------------------------- lexicon

#: Entries are (text, whole word or word beginning, mark, weight).
Entry = tuple[str, bool, str, float]


def fixed_entries() -> list[Entry]:
    return [(w, True, mark, FIXED_WEIGHT) for mark, words in (("insult", INSULTS), ("threat", THREATS)) for w in words.split()]


@functools.lru_cache(maxsize=4)
def _matcher(entries: tuple[Entry, ...]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    by_text: dict[str, list[Entry]] = defaultdict(list)
    for e in entries:
        by_text[e[0]].append(e)
    for text, own in by_text.items():
        automaton.add_word(text, (len(text), own))
    automaton.make_automaton()
    return automaton


_CONTEXT = {w: mark for mark, words in (("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS)) for w in words.split()}


def hits(text: str, entries: tuple[Entry, ...]) -> list[tuple[int, int, str, float]]:
    """(start, end, mark, weight) of lexicon entries at word beginnings of a text in lower case; the longest at one start."""
    found: dict[int, tuple[int, int, str, float]] = {}
    if not entries:
        return []
    for last, (size, own) in _matcher(entries).iter(text):
        start, end = last - size + 1, last + 1
        if start and text[start - 1].isalpha():
            continue
        for _, whole, mark, weight in own:
            if whole and end < len(text) and text[end].isalpha():
                continue
            if start not in found or found[start][1] < end:
                found[start] = (start, end, mark, weight)
    return [found[k] for k in sorted(found)]


def matched_clauses(text: str, entries: tuple[Entry, ...]) -> list[float]:
    """Scores of the clauses of a text that hold an insult or a threat."""
    low = text.lower()
    found = hits(low, entries)
    out = []
    at = 0
    while at < len(found):
        begin = max((m + 1 for m in (low.rfind(c, 0, found[at][0]) for c in ".;:!?\n")), default=0)
        stop = _CLAUSE.search(low, found[at][1])
        end = stop.start() if stop else len(low)
        if begin and low[begin - 1] == ":":  # what stands before a colon reports what follows
            begin = max((m + 1 for m in (low.rfind(c, 0, begin - 1) for c in ".;!?\n")), default=0)
        inside = []
        while at < len(found) and found[at][0] < end:
            inside.append(found[at])
            at += 1
        marks = [(m.start(), _CONTEXT[m.group()], 0.0) for m in _WORD.finditer(low, begin, end) if m.group() in _CONTEXT]
        marks += [(s, mark, weight) for s, _, mark, weight in inside]
        out.append(clause_score([(mark, weight) for _, mark, weight in sorted(marks)]))
    return out


def _signals(text: str, clauses: list[float]) -> tuple[float, float, float]:
    """What the final weights see: the total, the total per hundred words and the strongest clause, all damped."""
    if not clauses:
        return 0.0, 0.0, 0.0
    total = sum(clauses)
    return math.log1p(total), math.log1p(100 * total / max(1, len(text.split()))), math.log1p(max(clauses))


# ---------------------------------------------------------------- learning


def _word_features(text: str) -> Counter:
    """How often whole words (with $) and word beginnings of three to eight letters (with *) occur."""
    out: Counter = Counter()
    for w, n in Counter(_WORD.findall(text.lower())).items():
        out[w + "$"] += n
        for k in range(3, min(8, len(w)) + 1):
            out[w[:k] + "*"] += n
    return out


def _cover(rows: list[list[int]], features: list[tuple[str, float]]) -> list[int]:
    """Features chosen one after another by the rows that they add; of equal ones the most telling, then the longest."""
    holders: dict[int, set[int]] = defaultdict(set)
    for k, own in enumerate(rows):
        for f in own:
            holders[f].add(k)
    chosen, covered = [], set()
    while holders:
        best = max(holders, key=lambda f: (len(holders[f] - covered), features[f][1], len(features[f][0]), features[f][0]))
        if len(holders[best] - covered) < LEAST_ROWS:
            break
        chosen.append(best)
        covered |= holders.pop(best)
    return chosen


def learn_entries(sample: DataFrame) -> list[Entry]:
    """Lexicon entries from (doc_id, text, toxic) rows. The words are counted by Spark; at most ``CANDIDATES`` features and
    the toxic rows' lists of them reach the driver."""

    def run(batches):
        for batch in batches:
            own = [_word_features(t) for t in batch.column(1).to_pylist()]
            lists = [pa.array([list(o) for o in own], pa.list_(pa.string())), pa.array([list(o.values()) for o in own], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], names=["doc_id", "toxic", "feature", "times"])

    held = store(sample.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id long, toxic int, feature array<string>, times array<long>"), "toxicity-features")
    size = {r["toxic"]: r["count"] for r in held.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return []
    each = held.select("doc_id", "toxic", F.explode(F.arrays_zip("feature", "times")).alias("f")).select("doc_id", "toxic", "f.feature", "f.times")
    bad, clean = F.sum(F.col("toxic") * F.col("times")), F.sum((1 - F.col("toxic")) * F.col("times"))
    ratio = (bad / size[1]) / ((clean + 0.5) / size[0])
    counted = each.groupBy("feature").agg(F.sum("toxic").alias("rows"), ratio.alias("ratio")).where((F.col("rows") >= LEAST_ROWS) & (F.col("ratio") >= LEAST_TIMES))
    features = [(r["feature"], r["ratio"]) for r in counted.orderBy(F.desc("rows"), F.desc("ratio"), "feature").limit(CANDIDATES).collect()]
    if not features:
        return []
    numbered = sample.sparkSession.createDataFrame([(f[0], k) for k, f in enumerate(features)], "feature string, number int")
    lists = each.where("toxic = 1").join(F.broadcast(numbered), "feature").groupBy("doc_id").agg(F.sort_array(F.collect_list("number")).alias("own")).orderBy("doc_id").collect()
    chosen = [features[k] for k in _cover([r["own"] for r in lists], features)]
    return [(text[:-1], text.endswith("$"), "insult", round(math.log(ratio), 6)) for text, ratio in chosen]


def fit(signals: np.ndarray, labels: np.ndarray, rounds: int = 50, shrink: float = 0.5) -> np.ndarray:
    """Logistic regression by Newton steps with a ridge; the first weight is the constant."""
    x = np.column_stack([np.ones(len(signals)), signals])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) * shrink
    ridge[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (labels - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, training=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score, clauses (how many matched) and strongest (the highest clause score).

    ``labels`` has doc_id and toxic; rows that ``training`` does not select are never learned from. Null and empty texts
    match nothing and get the score of a text without matches. Rows that repeat are scored alike, an empty table gives no
    rows, and without labels the fixed lexicon and even odds at one full insult are used.
    """
    base = texts(docs, id_col, text_col)
    sample = store(labelled(base, labels, "toxic", training or (lambda c: F.lit(True)), SAMPLE), "toxicity-sample")
    entries = tuple(sorted({(e[0], e[1]): e for e in fixed_entries() + learn_entries(sample)}.values()))

    def signals(batches):
        for batch in batches:
            got = [_signals(t, matched_clauses(t, entries)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), *[pa.array([g[k] for g in got], pa.float64()) for k in range(3)]], names=["toxic", "total", "density", "top"])

    rows = sample.select("doc_id", "text", "toxic").mapInArrow(signals, "toxic int, total double, density double, top double").collect()  # 2 * SAMPLE rows of numbers
    if rows and len({r["toxic"] for r in rows}) == 2:
        weights = fit(np.array([[r["total"], r["density"], r["top"]] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float))
    else:
        weights = np.array([-3.0, 1.0, 1.0, 1.0])

    def run(batches):
        for batch in batches:
            scores, counts, tops = [], [], []
            for t in batch.column(1).to_pylist():
                clauses = matched_clauses(t, entries)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights[0] + weights[1:] @ np.array(_signals(t, clauses))))))))
                counts.append(len(clauses))
                tops.append(max(clauses, default=0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(counts, pa.int64()), pa.array(tops, pa.float64())], names=["doc_id", "score", "clauses", "strongest"])

    return base.mapInArrow(run, "doc_id long, score double, clauses long, strongest double")


HELD_OUT = 5


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    training = lambda doc_id: remainder(doc_id, HELD_OUT) != 0
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), training)
    held_out = F.coalesce(remainder(F.col("doc_id"), HELD_OUT) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "clauses", "strongest")
