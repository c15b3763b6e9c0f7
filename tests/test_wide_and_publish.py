"""Pivots of any width, and publishing with a manifest."""

import pytest
from pyspark.sql import functions as F

from panelspark.operators import cells_to_rows, cut_columns, pivot_cells, pivot_wide
from panelspark.sources import publish, publish_table, published_versions, read_published



def test_wide_rows_are_filled_without_a_search_for_each_block(spark):
    """Sparse cells over 1,500 blocks: blocks that an id lacks come as empty rows, in the right places."""
    rows = [(k % 3, f"key{k:05d}", float(k)) for k in range(6_000)] + [(9, None, 1.0)]
    cells, names = pivot_cells(spark.createDataFrame(rows, "id int, k string, v double"), "k", "v", ["id"], block=4)
    got = {r["id"]: r["cells"] for r in cells.collect()}
    assert got == {i: [float(k) if k % 3 == i else None for k in range(6_000)] for i in range(3)}
    assert "array_position" not in cells._jdf.queryExecution().optimizedPlan().toString()


def test_fifty_thousand_series(spark):
    n = 50_000
    long = spark.range(4 * n).select((F.col("id") % 4).alias("yr"), F.concat(F.lit("S."), F.lpad(F.floor(F.col("id") / 4).cast("string"), 6, "0")).alias("series"), F.col("id").cast("double").alias("v"))
    long = long.where("id % 7 != 3" if "id" in long.columns else F.col("v") % 7 != 3)
    cells, names = pivot_cells(long, "series", "v", ["yr"])
    assert names.count() == n and {r[0] for r in cells.select(F.size("cells")).collect()} == {n}
    back = cells_to_rows(cells, names, ["yr"], "v").select("yr", "series", "v")
    assert back.count() == long.count() and back.exceptAll(long).isEmpty()
    part = cut_columns(cells, names, ["yr"], 40_000, 40_003)
    assert part.columns == ["yr", "S.040000", "S.040001", "S.040002"]
    want = {(r["yr"], r["series"]): r["v"] for r in long.where("series >= 'S.040000' AND series < 'S.040003'").collect()}
    assert {(r["yr"], c): r[c] for r in part.collect() for c in part.columns[1:] if r[c] is not None} == want


@pytest.mark.parametrize("block", [1, 3, 64])
def test_cells_equal_the_small_pivot(spark, block):
    rows = [("a", "x", 1.0), ("a", "z", None), ("b", "y", 2.0), (None, "x", 3.0), ("b", None, 9.0), ("c", "q", 4.0), ("c", "w", float("nan"))]
    df = spark.createDataFrame(rows, "id string, k string, v double")
    cells, names = pivot_cells(df, "k", "v", ["id"], block=block)
    got = cut_columns(cells, names, ["id"])
    want = pivot_wide(df.where("k IS NOT NULL"), "k", "v", ["id"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_more_values_than_spark_allows(spark):
    old = spark.conf.get("spark.sql.pivotMaxValues")
    df = spark.range(300).select((F.col("id") % 3).alias("i"), (F.col("id") % 149).alias("k"), F.col("id").alias("v"))
    want = pivot_wide(df, "k", "v", ["i"])
    spark.conf.set("spark.sql.pivotMaxValues", 100)
    try:
        got = pivot_wide(df, "k", "v", ["i"])
        assert sorted(got.columns) == sorted(want.columns) and got.select(*want.columns).exceptAll(want).isEmpty()
        with pytest.raises(Exception, match="duplicate"):
            pivot_wide(df.union(df), "k", "v", ["i"]).collect()
        assert pivot_wide(df.union(df), "k", "v", ["i"], strict=False).count() == 3
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", old)
    assert pivot_cells(df.limit(0), "k", "v", ["i"])[0].count() == 0


def test_publish_and_read(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("part"), F.when(F.col("id") % 5 > 0, F.col("id") * 0.1).alias("x"))
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    first = publish_table(df, path, "one", partition_by=["part"])
    assert first["rows"] == 1000 and read_published(spark, path).exceptAll(df).isEmpty()
    old = read_published(spark, path)
    publish_table(df.where("id < 10"), path, "two")
    assert read_published(spark, path).count() == 10 and old.count() == 1000 and read_published(spark, path, "one").count() == 1000
    assert publish_table(df, path, "two")["rows"] == 10                   # a retry after the switch
    assert [m["version"] for m in published_versions(spark, path)] == ["one", "two"]
    publish_table(df.limit(0), path, "three")
    assert read_published(spark, path).count() == 0 and read_published(spark, path).columns == df.columns
    with pytest.raises(ValueError, match="version"):
        publish_table(df, path, "../x")


def test_a_failed_attempt_stays_unseen_and_a_retry_leaves_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.range(500).withColumn("x", F.col("id") * 2)
    publish_table(df, path, "one")
    real = publish._totals
    monkeypatch.setattr(publish, "_totals", lambda c, n=[0]: n.__setitem__(0, n[0] + 1) or ([F.lit(1).alias("rows")] if n[0] == 2 else real(c)))
    with pytest.raises(Exception):
        publish_table(df.limit(7), path, "two")                           # what is read back differs
    monkeypatch.undo()
    assert read_published(spark, path).count() == 500
    publish_table(df.limit(9), path, "two")
    assert read_published(spark, path).count() == 9 and len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert not [p for p in (tmp_path / "t" / "manifest").iterdir() if p.suffix == ".tmp"]


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.range(5)
    publish_table(df, path, "one")
    monkeypatch.setattr(publish, "_manifests", lambda folder: [])         # a writer that has not seen the first
    monkeypatch.setattr(publish, "published_versions", lambda s, p: [])
    with pytest.raises(RuntimeError, match="another writer"):
        publish_table(df.limit(2), path, "two")
    monkeypatch.undo()
    assert read_published(spark, path).count() == 5
