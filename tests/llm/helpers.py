"""Documents that every operator has to take, and plain versions to compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0d]+")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Names that the operators use inside; an input may have them as well.
CLASHING = ("id", "kept", "key", "bucket", "spans", "_kept", "_gone", "_repeats_id", "component_id", "piece", "length", "prefix", "gram", "quality", "score")


def frame(spark, texts, start: int = 0, clashing: bool = False):
    """Documents with ids from ``start`` on, or with the ids of (id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (start + k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, None if k % 3 == 0 else "en", None if k % 2 else "s", None if t is None else len(t)) for k, (i, t) in enumerate(rows)], DOCS)
    if clashing:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
    return df


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def odd_texts() -> list[str | None]:
    """Null, empty, blank, ties, repeats, other scripts, control characters and one very long text."""
    base = prose(1, 120)
    return [
        None, "", " \t\r\n\x0b\x0c ", "one", "one", "ONE", "two words", base, base, base.replace(" ", "\n"), base + " ", prose(2, 80) + "\n" + prose(2, 80), "a a a a a a a a a a a a a a a a a a a a",
        "漢字かな 🙂 naïve é ́ \x1c\x85 \xa0 x", "<|endoftext|> ½ ٣", prose(3, 30_000, 5000), "x" * 20_000, "\n" * 500,
    ]
