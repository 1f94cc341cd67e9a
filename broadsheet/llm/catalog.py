"""Loads every operator of this folder, which registers its query."""

from . import boosted, bpe, codes, exact, graph, lexical, licences, ngram_join, packing, quality, substrings, toxicity, wrapper  # noqa: F401
from .queries import ORACLES, QUERIES  # noqa: F401
