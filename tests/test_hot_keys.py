"""Hot keys: found in one pass, joined apart, tasks of even size."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from panelspark.operators import hot_keys, merge_keep_left, skew, split_join


@pytest.fixture
def sides(spark):
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 5000).cast("long").alias("k"), F.col("id").alias("v"),
        F.lit("left").alias("tag"))
    right = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"), F.lit("right").alias("tag"))
    return left, right.unionByName(right.where("k = 7 OR k = 9").withColumn("w", F.lit(-1).cast("long")))


def test_hot_keys_are_those_of_large_share(spark, sides):
    left, _ = sides
    want = {r[0] for r in spark.createDataFrame([(7,), (None,)], "k long").select(F.xxhash64("k")).collect()}
    assert set(hot_keys(left, ["k"], 0.02)) == want
    assert hot_keys(left.limit(0), ["k"]) == [] and hot_keys(left.where("k != 7 AND k IS NOT NULL"), ["k"], 0.02) == []


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows", [1_000_000, 0])        # the hot keys' rows by broadcast, or copied over salts
def test_split_join_is_the_join(sides, how, rows):
    left, right = sides
    right = right.drop("tag")
    got = split_join(left, right, ["k"], how, share=0.02, max_broadcast_rows=rows)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_other_kinds_of_join(sides):
    left, right = sides
    with pytest.raises(ValueError, match="how"):
        split_join(left, right, ["k"], "full")
    assert merge_keep_left(left, right, ["k"], "full").count() == left.join(right, ["k"], "full").count()


@pytest.mark.parametrize("name", ["merge_keep_left", "regex_extract_year", "housing_table", "join_hot_keys"])
def test_no_task_of_the_shuffle_holds_a_hot_customer(spark, tmp_path, monkeypatch, name):
    """A third of all orders on one customer, nothing broadcast whole: the largest shuffle task is at most twice the median one."""
    from __spark_entry__ import queries
    src = "/root/testdata/sf0.01"
    for t in ("customer", "nation", "region", "lineitem", "supplier"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{src}/{t}.parquet")
    orders = spark.read.parquet(f"{src}/orders.parquet")
    orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey"))).write.parquet(str(tmp_path / "orders.parquet"))
    seen = []

    def spread(left, right, keys, how="inner", *a, **k):
        out = real(left, right, keys, how, *a, **k)
        hot = hot_keys(left, keys)
        if left.count() > 10_000:
            assert hot
            rest = left.where(~F.xxhash64(*keys).isin(hot)).repartition(8, *keys)
            sizes = [r["count"] for r in rest.groupBy(F.spark_partition_id()).count().collect()]
            seen.append((max(sizes), median(sizes), len(sizes)))
        return out
    real = skew.split_join
    monkeypatch.setattr(skew, "split_join", spread)
    real_fits = skew.fits_broadcast
    monkeypatch.setattr(skew, "fits_broadcast", lambda df, *a: real_fits(df, 100))      # customers do not fit, a hot one does
    got = queries()[name](spark, str(tmp_path))
    assert seen and all(n == 8 and most <= 2 * mid for most, mid, n in seen)
    monkeypatch.undo()
    want = queries()[name](spark, str(tmp_path))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
