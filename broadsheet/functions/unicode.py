"""NFKC folding, the one text step Spark has no expression for. Arrow batches, ASCII rows skip the work."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


@pandas_udf(StringType())
def _fold(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def needs_folding(col: Column) -> Column:
    """Text that NFKC may change: anything but ASCII, precomposed Latin letters and precomposed Hangul."""
    return F.regexp_like(col, F.lit("[^\\x00-\\x7FÀ-ÖØ-öø-ÿĀ-ıĴ-ľŁ-ňŊ-ž가-힣]"))


def nfkc(col: Column) -> Column:
    """NFKC form. The argument of the function is null for text that needs no folding, so such rows carry nothing to Python."""
    return F.coalesce(_fold(F.when(needs_folding(col), col)), col)
