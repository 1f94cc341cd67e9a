"""Registered queries of this folder: against their SQL where there is one, otherwise a row per document."""

import pytest

from broadsheet.llm import catalog
from oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, name):
    assert compare(spark, duck(SF), name, catalog.QUERIES[name], catalog.ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - {"op6_license_scan", "op2_best_fit_packing", "op13_graph_neighbours"}))
def test_rows(spark, name):
    table = "pages" if name.startswith("op5") else "documents"
    assert catalog.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
