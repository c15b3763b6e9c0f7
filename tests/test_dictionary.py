"""Functions that run once per different value."""

import re

import pytest
from pyspark.sql import functions as F

from panelspark.operators import dictionary, map_distinct

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("fits", [True, False])
def test_equals_the_plain_column(spark, monkeypatch, fits):
    monkeypatch.setattr(dictionary, "fits_broadcast", lambda df: fits)
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 40)).alias("t"), F.lit("x").alias("value"))
    upper = lambda c: F.coalesce(F.upper(c), F.lit("none"))
    for name in (None, "clean"):
        got = map_distinct(df, "t", upper, name)
        want = df.withColumn(name or "t", upper("t"))
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert map_distinct(df.limit(0), "t", upper).count() == 0


@pytest.mark.parametrize("name", ["codebook", "clean_distinct_values"])
def test_no_pattern_runs_over_the_facts(spark, name):
    from __spark_entry__ import queries
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = lambda x: len(re.match(r"[\s:+\-|]*", x)[0])
    for i, line in enumerate(lines):
        if "regexp_replace" in line:                        # below it stands a checkpoint of the different values
            under = [x for x in lines[i + 1:] if depth(x) > depth(line)]
            assert under and any("LogicalRDD" in x for x in under) and not any("parquet" in x for x in under), plan
    assert plan.count("regexp_replace") >= 1


def test_the_function_sees_each_value_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def count(x):
        seen.add(1)
        return x and x.upper()
    df = spark.range(20_000).select(F.concat(F.lit("v"), F.col("id") % 130).alias("t"))
    assert map_distinct(df, "t", count).distinct().count() == 130
    assert seen.value <= 130
