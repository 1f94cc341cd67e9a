"""Which patterns a text may match, from scans that take linear time however many alternatives a pattern has."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import needs


def pieces(pattern: str) -> str | None:
    """A pattern for the plain pieces of which every match of ``pattern`` holds one; a single character class is its own."""
    if re.fullmatch(r"\[[^\[\]\\^&]+\]", pattern):
        return pattern
    needed = needs(pattern)
    if needed is None:
        return None
    return "|".join([*(re.escape(w) for w in sorted(needed[0])), *(["[가-힣]"] if needed[1] else [])])


def hints(col: Column, patterns: tuple[str, ...]) -> Column:
    """A bit per pattern: whether the text may match it. Case is ignored. A clear bit is certain, a set one has to be confirmed
    by a search."""
    scans = [pieces(p) for p in patterns]

    plain = [k for k, scan in enumerate(scans) if scan is not None]
    always = sum(1 << k for k, scan in enumerate(scans) if scan is None)

    def held(texts: pa.Array, scan: str) -> np.ndarray:
        return pc.fill_null(pc.match_substring_regex(texts, scan, ignore_case=True), False).to_numpy(zero_copy_only=False)

    def run(texts: pa.Array) -> pa.Array:
        found = np.full(len(texts), always, dtype=np.int64)
        # One scan for all pieces finds the texts, few as a rule, that are scanned for each pattern.
        some = np.flatnonzero(held(texts, "|".join(scans[k] for k in plain))) if plain else []
        if len(some):
            asked = texts.take(pa.array(some))
            for k in plain:
                found[some] |= held(asked, scans[k]).astype(np.int64) << k
        return pa.array(found)

    return F.arrow_udf(run, "long")(col)


def repeated_words_of(col: Column) -> Column:
    """Whether two texts of an array of lower-case texts have the same words (of ``a-z``, digits and Hangul) in the same order."""

    def run(lists: pa.Array) -> pa.Array:
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        words = pc.ascii_trim(pc.replace_substring_regex(lists.flatten(), "[^a-z0-9가-힣]+", " "), " ")
        row = np.repeat(np.arange(len(lists)), counts)
        alike = pc.fill_null(words.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.lexsort((alike, row))
        same = (row[order][1:] == row[order][:-1]) & (alike[order][1:] == alike[order][:-1])
        return pa.array(np.bincount(row[order][1:][same], minlength=len(lists)) > 0)

    return F.arrow_udf(run, "boolean")(col)
