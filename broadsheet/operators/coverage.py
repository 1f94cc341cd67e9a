"""JN10, JN14: which documents hold all terms of a keyword, by a substring dictionary and postings.

A term counts when it stands inside some word of the text. The distinct words of all texts are indexed by their two- and
three-letter grams; a term looks only at the words of its rarest gram. Postings then say which documents hold a term: one row
per term and block of 64 documents, with a bit per document. The terms of a keyword are intersected block by block, so neither
the index nor the result of an intersection is a list of (keyword, document) pairs: a common term costs one row per 64
documents, a rare one a row per document. Further conditions on the document (a class it must be of) are postings as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import WS
from ..session import cut_lineage

BLOCK = 64
#: Opens the terms that stand for a class of documents; texts are split at white space, so no word holds it.
CLASS = "\n"


def words_of(value: Column) -> Column:
    """Distinct words of a text, split where the terms of a keyword are split."""
    return F.filter(F.array_distinct(F.split(F.coalesce(value, F.lit("")), f"[{WS}·,/]+")), lambda w: w != "")


def grams(value: Column, n: int) -> Column:
    """Distinct ``n``-letter grams; none for shorter texts. Runs of grams that do not overlap start at each of the first ``n``
    letters: looking up every gram by its place would read all letters before it."""
    runs = [F.regexp_extract_all(F.substring(value, k + 1, 2**31 - 1), F.lit("(?s)" + "." * n), F.lit(0)) for k in range(n)]
    return F.when(F.length(value) >= n, F.array_distinct(F.concat(*runs))).otherwise(F.array().cast("array<string>"))


def words_with(terms: DataFrame, words: DataFrame) -> DataFrame:
    """(term, word) where the word contains the term. Both sides hold distinct texts, terms at least two letters."""
    wanted = cut_lineage(terms.select("term", F.explode(F.when(F.length("term") == 2, F.array("term")).otherwise(grams(F.col("term"), 3))).alias("gram")))
    cut = words.select("word", F.explode(F.concat(grams(F.col("word"), 2), grams(F.col("word"), 3))).alias("gram"))
    postings = cut_lineage(cut.join(wanted.select("gram").distinct(), "gram", "left_semi"))
    sizes = postings.groupBy("gram").agg(F.count("*").alias("n"))
    # A gram that no word has settles its term: no word contains it.
    rarest = wanted.join(sizes, "gram", "left").groupBy("term").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best"))
    return rarest.select("term", F.col("best.gram").alias("gram")).join(postings, "gram").where(F.contains("word", F.col("term"))).select("term", "word")


def postings(docs: DataFrame, ordinal: str, text: str, terms: DataFrame, classes: str | None = None) -> DataFrame:
    """(term, block, mask): which documents hold which of the ``terms``; bit ``i`` of a mask is ordinal 64 * block + i.

    ``ordinal`` is a whole number that no two documents share. ``classes`` names an array of classes of the document; the
    term of a class is its name after ``CLASS``.
    """
    held = docs.select(F.col(ordinal).cast("long").alias("ord"), F.explode(words_of(F.col(text))).alias("word"))
    found = words_with(terms.where(~F.startswith("term", F.lit(CLASS))), held.select("word").distinct())
    rows = held.join(found, "word").select("term", "ord")
    if classes:
        rows = rows.unionByName(docs.select(F.explode(F.transform(classes, lambda c: F.concat(F.lit(CLASS), c))).alias("term"), F.col(ordinal).cast("long").alias("ord")))
    bit = F.expr(f"shiftleft(1L, CAST(pmod(ord, {BLOCK}) AS INT))")
    return rows.groupBy("term", F.floor(F.col("ord") / BLOCK).alias("block")).agg(F.bit_or(bit).alias("mask"))


def intersections(keywords: DataFrame, keyword: str, needed: str, index: DataFrame) -> DataFrame:
    """(keyword, block, mask) of the documents that hold all terms in ``needed``; no rows for a keyword without terms.

    The blocks of a keyword's rarest term are the only ones looked at.
    """
    index = cut_lineage(index)
    wanted = keywords.select(F.col(keyword).alias("_k"), F.array_distinct(needed).alias("_needed")).where(F.size("_needed") > 0)
    sizes = index.groupBy("term").agg(F.count("*").alias("n"))
    rarest = wanted.select("_k", "_needed", F.explode("_needed").alias("term")).join(sizes, "term", "left")
    rarest = rarest.groupBy("_k", "_needed").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")).alias("best")).select("_k", "_needed", F.col("best.term").alias("term"))
    first = rarest.join(index, "term").select("_k", "block", "mask", F.array_except("_needed", F.array("term")).alias("others"))
    rest = first.select("_k", "block", F.size("others").alias("many"), F.explode("others").alias("term"))
    met = rest.join(index, ["term", "block"]).groupBy("_k", "block", "many").agg(F.bit_and("mask").alias("also"), F.count("*").alias("n")).where("n = many")
    both = first.where(F.size("others") > 0).select("_k", "block", "mask").join(met.select("_k", "block", "also"), ["_k", "block"])
    out = first.where(F.size("others") == 0).select("_k", "block", "mask").unionByName(both.select("_k", "block", F.col("mask").bitwiseAND(F.col("also")).alias("mask")))
    return out.where("mask != 0").withColumnRenamed("_k", keyword)


def covering(keywords: DataFrame, keyword: str, needed: str, docs: DataFrame, ordinal: str, text: str, classes: str | None = None) -> DataFrame:
    """JN10, JN14. (keyword, block, mask) of the documents whose text holds all terms that a keyword needs."""
    terms = keywords.select(F.explode(needed).alias("term")).distinct()
    return intersections(keywords, keyword, needed, postings(docs, ordinal, text, terms, classes))


def counted(found: DataFrame, keyword: str, name: str = "n_docs") -> DataFrame:
    """Number of documents per keyword."""
    return found.groupBy(keyword).agg(F.sum(F.bit_count("mask")).alias(name))


def first_documents(found: DataFrame, keyword: str, ordinal: str, k: int) -> DataFrame:
    """(keyword, ordinal, rank): the ``k`` lowest ordinals per keyword. Only the first ``k`` blocks are taken apart, and the
    window group limit keeps ``k`` rows per keyword before each shuffle."""
    by_block = Window.partitionBy(keyword).orderBy("block")
    blocks = found.withColumn("_b", F.row_number().over(by_block)).where(F.col("_b") <= k)
    bits = F.filter(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.call_function("getbit", F.col("mask"), i) == 1)
    each = blocks.select(keyword, F.explode(F.transform(bits, lambda i: F.col("block") * BLOCK + i)).alias(ordinal))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy(keyword).orderBy(ordinal)))
    return ranked.where(F.col("rank") <= k)


def class_terms(keyword: Column, rules: list[tuple[str, str, str | None]]) -> Column:
    """JN14. Class terms that a keyword demands of a document: rules of (class, pattern, pattern that lifts the demand)."""
    out = []
    for name, pattern, unless in rules:
        wanted = F.rlike(keyword, F.lit(pattern))
        if unless:
            wanted &= ~F.rlike(keyword, F.lit(unless))
        out.append(F.when(wanted, F.lit(CLASS + name)))
    return F.array_compact(F.array(*out))


def classes_of(shown: Column, rules: list[tuple[str, str]]) -> Column:
    """Classes that a text belongs to: rules of (class, pattern)."""
    return F.array_compact(F.array(*[F.when(F.rlike(F.coalesce(shown, F.lit("")), F.lit(p)), F.lit(name)) for name, p in rules]))
