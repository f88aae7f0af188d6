"""Every registered query of the sensor library against its SQL on the smallest tables."""

from __future__ import annotations

import compare
import pytest
from pyspark.sql import functions as F

from sensorjobs.plans import base, core, ingest, marts, pipelines  # noqa: F401


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.engine(sf_dir)


def test_every_query_has_sql():
    assert set(base.QUERIES) == set(base.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(base.QUERIES))
def test_query(spark, sf_dir, con, name):
    assert compare.differences(base.QUERIES[name](spark, sf_dir), con, base.ORACLE_SQL[name]) == ""


def test_ties_round_as_in_sql(spark, con):
    values = [x for k in range(-400, 400) for x in (k / 1000 + 272.4, (k * 0.01 + k * 0.02) / 2, k / 8)] + [0.5, -0.5, 2.5, 1e15 + 0.3, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = [tuple(x) for x in rows.select(base.r("v", 2), base.r("v", 0), base.r(F.col("v") / 3)).collect()]
    text = ", ".join("(NULL::DOUBLE)" if v is None else f"({v!r}::DOUBLE)" for v in values)
    assert got == con.sql(f"SELECT {base.rd('v', 2)}, {base.rd('v', 0)}, {base.rd('v / 3')} FROM (VALUES {text}) t(v)").fetchall()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
