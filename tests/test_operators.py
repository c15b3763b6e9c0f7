import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.operators import (backfill_columns, checked_broadcast, detail_plus_total, duplicate_keys,
                                  explode_pairs, fill_zero, growth, join_panels, lag_values, lookup_join,
                                  merge_keep_left, pivot_wide, rename_strict, rollup_period, row_sum,
                                  select_prefix, select_spec, split_column, sum_by_period, union_by_name,
                                  with_global_index, with_totals)


def _none_first(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_none_first)


def test_with_totals_matches_stacked_form(spark):
    df = spark.createDataFrame([("E", 2015, 1, 1.0), ("W", 2015, 1, 2.0), (None, 2015, 1, 4.0), ("E", 2015, 2, None)],
                               "r string, y int, q int, v double")
    a = with_totals(df, "r", ["y", "q"], {"s": "v"})
    b = detail_plus_total(df, "r", ["y", "q"], {"s": "v"})
    assert rows(a, "r", "y", "q", "s") == rows(b, "r", "y", "q", "s")
    got = {(r["r"], r["q"]): r["s"] for r in a.collect()}
    # A NULL region is a detail group, distinct from the Total row.
    assert got[(None, 1)] == 4.0 and got[("Total", 1)] == 7.0 and got[("E", 2)] == 0.0


def test_with_totals_outer_keys(spark):
    df = spark.createDataFrame([("E", "u", 1, 1.0), ("E", "s", 1, 2.0), ("W", "u", 1, 5.0)],
                               "r string, m string, q int, v double")
    out = {(r["r"], r["m"]): r["s"] for r in with_totals(df, "m", ["q"], {"s": "v"}, outer=["r"]).collect()}
    assert out == {("E", "u"): 1.0, ("E", "s"): 2.0, ("E", "Total"): 3.0, ("W", "u"): 5.0, ("W", "Total"): 5.0}


def test_growth_is_positional(spark):
    # Quarter 2016Q2 is missing: the YoY of 2016Q3 compares with 2015Q3's predecessor by position.
    periods = [(2015, 1), (2015, 2), (2015, 3), (2015, 4), (2016, 1), (2016, 3)]
    df = spark.createDataFrame([("a", y, q, float(i + 1)) for i, (y, q) in enumerate(periods)],
                               "s string, y int, q int, v double")
    g = growth(df, "v", ["s"], ["y", "q"], rates={"yoy": 4, "qoq": 1}, changes={"d4": 4})
    out = {(r["y"], r["q"]): (r["yoy"], r["qoq"], r["d4"]) for r in g.collect()}
    assert out[(2015, 4)][0] is None
    assert out[(2016, 1)] == ((5.0 - 1.0) / 1.0, (5.0 - 4.0) / 4.0, 4.0)
    assert out[(2016, 3)][0] == (6.0 - 2.0) / 2.0  # lag 4 by position = 2015Q2


def test_zero_base_growth(spark, fx):
    df = spark.read.option("header", True).schema("series string, yr int, qtr int, value double").csv(
        f"{fx}/zero_base.csv")
    g = growth(df, "value", ["series"], ["yr", "qtr"], rates={"yoy": 4, "qoq": 1})
    a = {(r["yr"], r["qtr"]): (r["yoy"], r["qoq"]) for r in g.where("series = 'a'").collect()}
    assert math.isnan(a[(2020, 2)][1])          # 0 / 0
    assert a[(2021, 1)][0] == math.inf           # 5 vs 0 four back
    assert a[(2021, 2)][1] == -1.0               # 0 vs 5
    b = {(r["yr"], r["qtr"]): r["qoq"] for r in g.where("series = 'b'").collect()}
    assert b[(2020, 1)] is None                  # a series starts fresh
    gn = growth(df, "value", ["series"], ["yr", "qtr"], rates={"qoq": 1}, zero_base="null")
    assert {r["qoq"] for r in gn.where("series = 'a' AND yr = 2020 AND qtr > 1").collect()} == {None}


def _brute_global_lag(items, n):
    items = sorted(items)
    return {k: (items[i - n][1] if i >= n else None) for i, (k, _) in enumerate(items)}


@pytest.mark.parametrize("block", [3, 7, 1 << 16])
def test_global_lag_matches_single_window(spark, block):
    rnd = random.Random(7)
    data = [(s, y, q, float(rnd.randint(0, 50))) for s in "abcde" for y in (2015, 2016, 2017) for q in (1, 2, 3, 4)
            if rnd.random() > 0.15]
    df = spark.createDataFrame(data, "s string, y int, q int, v double").repartition(5)
    out = lag_values(df, {"p4": ("v", 4), "p1": ("v", 1)}, ["s"], ["y", "q"], scope="global", block_rows=block)
    got = {(r["s"], r["y"], r["q"]): (r["p4"], r["p1"]) for r in out.collect()}
    items = [((s, y, q), v) for s, y, q, v in data]
    b4, b1 = _brute_global_lag(items, 4), _brute_global_lag(items, 1)
    assert len(got) == len(data)
    assert got == {k: (b4[k], b1[k]) for k in b4}


def test_global_index_contiguous(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(6)
    idx = with_global_index(df, ["k"], partitions=4)
    pairs = sorted((r["k"], r["_gidx"]) for r in idx.collect())
    assert [g for _, g in pairs] == list(range(1000))


def test_global_lag_plan_has_no_single_partition(spark):
    df = spark.range(0, 200).select((F.col("id") % 5).alias("s"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    out = lag_values(df, {"p": ("v", 1)}, ["s"], ["t"], scope="global")
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    # Only the per-partition count table (one row per partition) meets in one task.
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[_pid" in lines[i + 1]
    single = df.withColumn("p", F.lag("v", 1).over(Window.orderBy("s", "t")))
    assert "SinglePartition" in single._jdf.queryExecution().executedPlan().toString()


def test_pivot_strict_raises_on_duplicates(spark, fx):
    df = spark.createDataFrame([(1, "A", 1.0), (1, "A", 2.0), (2, "B", 3.0)], "i int, k string, v double")
    with pytest.raises(Exception, match="duplicate"):
        pivot_wide(df, "k", "v", values=["A", "B"]).collect()
    ok = pivot_wide(df.where("v > 1"), "k", "v", values=["A", "B", "X"])
    assert ok.columns == ["i", "A", "B", "X"]
    assert rows(ok, "i", "A", "B", "X") == [(1, 2.0, None, None), (2, None, 3.0, None)]


def test_pivot_then_unpivot_round_trip(spark):
    long = spark.createDataFrame([(1, "A", 1.0), (1, "B", 2.0), (2, "A", 3.0)], "i int, k string, v double")
    wide = pivot_wide(long, "k", "v", values=["A", "B"])
    back = wide.unpivot("i", ["A", "B"], "k", "v").where(F.col("v").isNotNull())
    assert rows(back, "i", "k", "v") == rows(long, "i", "k", "v")


def test_fill_zero_and_row_sum(spark):
    df = spark.createDataFrame([(1, None, 2.0, float("nan"))], "i int, a double, b double, c double")
    f = fill_zero(df, ["a", "b", "c"]).withColumn("t", row_sum(["a", "b", "c"]))
    assert rows(f, "a", "b", "c", "t") == [(0.0, 2.0, 0.0, 2.0)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, "A")], "i int, k string")
    assert rows(duplicate_keys(df, ["i", "k"]), "i", "k", "n") == [(1, "A", 2)]


def test_merge_keep_left(spark):
    left = spark.createDataFrame([(1, "KY", 10)], "id int, st string, v int")
    right = spark.createDataFrame([(1, "XX", "mine"), (2, "KY", "idle")], "id int, st string, name string")
    out = merge_keep_left(left, right, ["id"])
    assert sorted(out.columns) == ["id", "name", "st", "v"]
    assert rows(out, "id", "st", "name") == [(1, "KY", "mine")]


def test_lookup_join_normalized_and_left(spark):
    left = spark.createDataFrame([("PIKE", 1), ("Harlan", 2)], "FIPS string, v int")
    look = spark.createDataFrame([("pike", "East")], "county string, Region string")
    inner = lookup_join(left, look, "FIPS", "county", "inner", normalize="lower")
    assert rows(inner, "FIPS", "Region") == [("pike", "East")]
    lft = lookup_join(left, look, "FIPS", "county", "left", normalize="lower")
    assert rows(lft, "FIPS", "Region") == [("harlan", None), ("pike", "East")]
    plan = inner._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_checked_broadcast_falls_back(spark):
    small = spark.range(10)
    big = spark.range(100)
    j_small = spark.range(1000).join(checked_broadcast(small, max_rows=50), "id")
    assert "BroadcastHashJoin" in j_small._jdf.queryExecution().executedPlan().toString()
    unhinted = checked_broadcast(big, max_rows=50)
    assert "broadcast" not in unhinted._jdf.queryExecution().logical().toString().lower()
    from panelspark.operators.frames import fits_broadcast
    assert fits_broadcast(big, max_rows=1000) and not fits_broadcast(big, max_rows=1000, max_bytes=1000)
    long_text = big.selectExpr("id", "repeat('x', 10000) AS t", "array(id) AS a")     # real bytes, not a guess per type
    assert not fits_broadcast(long_text, max_rows=1000, max_bytes=500_000) and fits_broadcast(long_text.limit(0))


def test_size_check_is_made_anew(spark, tmp_path):
    from panelspark.operators.frames import fits_broadcast
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    assert fits_broadcast(spark.read.parquet(path), max_rows=10)
    spark.range(50).write.mode("append").parquet(path)
    assert not fits_broadcast(spark.read.parquet(path), max_rows=10)


def test_pivot_cells_do_not_depend_on_the_number_of_values(spark):
    df = spark.createDataFrame([("a", "k1", None), ("a", "k1", 5.0), ("a", "k2", 7.0)], "id string, k string, v double").coalesce(1)
    for n in (64, 65):
        wide = pivot_wide(df, "k", "v", ids=["id"], values=[f"k{i}" for i in range(1, n + 1)], strict=False).first()
        assert (wide["k1"], wide["k2"], wide["k3"]) == (5.0, 7.0, None), n


def test_rename_matching(spark):
    from panelspark.operators import rename_matching
    df = spark.range(1).selectExpr("1 AS a_x", "2 AS b", "3 AS c_x")
    assert rename_matching(df, "_x$", "").columns == ["a", "b", "c"]
    assert rename_matching(df, "nope", "z").columns == df.columns
    with pytest.raises(ValueError):
        rename_matching(df, "^[ac]", "q")


def test_rename_strict_and_select_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "YrBuilt_a int, Heating_b int, OccHU int, UtilityGas int")
    with pytest.raises(KeyError):
        rename_strict(df, {"nope": "x"})
    assert select_prefix(df, "heating", "yrbuilt").columns == ["Heating_b", "YrBuilt_a"]
    assert select_spec(df, ["OccHU", ("prefix", "Yr")]).columns == ["OccHU", "YrBuilt_a"]


def test_join_panels_clash_raises(spark):
    a = spark.createDataFrame([("KY_2015", 2015, 1.0)], "codeyr string, year int, EGCLP double")
    b = spark.createDataFrame([("KY_2015", 2015, "KY", 2.0)], "codeyr string, year int, statecode string, EGCLP double")
    with pytest.raises(ValueError, match="EGCLP"):
        join_panels(a, b, "codeyr", drop_right=["year", "statecode"])
    ok = join_panels(a, b.drop("EGCLP").withColumn("EGWYP", F.lit(3.0)), "codeyr", drop_right=["year", "statecode"])
    assert rows(ok, "codeyr", "year", "EGCLP", "EGWYP") == [("KY_2015", 2015, 1.0, 3.0)]


def test_drop_matching(spark):
    from panelspark.operators import drop_matching
    df = spark.createDataFrame([(1, 2, 3)], "k int, v_y int, w int")
    assert drop_matching(df, r"_y$").columns == ["k", "w"]
    assert drop_matching(df, r"nothing").columns == ["k", "v_y", "w"]  # zero matches drop nothing


def test_union_backfill_split(spark):
    a = spark.createDataFrame([("x", float("nan"))], "n string, r double")
    b = spark.createDataFrame([("Total", 0.5)], "n string, t double")
    u = union_by_name(a, b)
    assert set(u.columns) == {"n", "r", "t"}
    f = backfill_columns(u.withColumn("t2", F.lit(9.0)), {"r": "t2"})
    assert rows(f, "n", "r") == [("Total", 9.0), ("x", 9.0)]
    s = split_column(spark.createDataFrame([("Pike County, Kentucky",)], "NAME string"), "NAME", ["County", "State"])
    assert s.columns == ["County", "State"] and rows(s, "County", "State") == [("Pike County", " Kentucky")]


def test_explode_pairs(spark):
    df = spark.createDataFrame([("KY", [["2015", "1"], ["2016"]]), ("WV", None)], "g string, data array<array<string>>")
    out = explode_pairs(df, "data", ["g"])
    assert rows(out, "g", "V1", "V2") == [("KY", "2015", "1"), ("KY", "2016", None)]


def test_rollup_and_sum(spark):
    df = spark.createDataFrame([("a", 2015, 1, 1.0), ("a", 2015, 2, None), ("a", 2016, 1, 2.0)],
                               "k string, y int, m int, v double")
    out = rollup_period(df, ["k"], ["y", "m"], ["y"], {"s": "v"})
    assert rows(out, "k", "y", "s", "n_fine") == [("a", 2015, 1.0, 2), ("a", 2016, 2.0, 1)]
    assert rows(sum_by_period(df, ["k"], {"s": "v"}), "k", "s") == [("a", 3.0)]


def test_wide_pivots_use_spark_pivot_path(spark):
    """More than 64 key values: Spark's own pivot, same results and the same strictness."""
    from panelspark.operators import pivot_sum
    keys = [f"k{i:03d}" for i in range(70)]
    rows = [(i % 3, k, float(i)) for i, k in enumerate(keys)] + [(0, "k000", 5.0)]
    df = spark.createDataFrame(rows, "i int, k string, v double")
    wide = pivot_sum(df, "k", "v", ids=["i"])
    assert wide.columns == ["i", *keys]
    row0 = wide.where("i = 0").first()
    assert row0["k000"] == 5.0 and row0["k001"] is None and row0["k003"] == 3.0
    with pytest.raises(Exception, match="duplicate"):
        pivot_wide(df, "k", "v", ids=["i"]).collect()
    unique = pivot_wide(df.where("NOT (i = 0 AND k = 'k000' AND v = 5.0)"), "k", "v", ids=["i"])
    assert unique.where("i = 1").first()["k001"] == 1.0
