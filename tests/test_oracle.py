"""Every query with an oracle: Spark result == DuckDB result (sf0.001)."""

from __future__ import annotations

import pytest

from genoframe.plans.catalog import all_queries

from helpers import duck_rows, rowset, spark_rows

QUERIES = {k: v for k, v in all_queries().items() if v.oracle is not None}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, sf_dir, name):
    q = QUERIES[name]
    scols, srows = spark_rows(q.build(spark, sf_dir))
    ocols, orows = duck_rows(duck, q.oracle)
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rowset(scols, srows) == rowset(ocols, orows)
