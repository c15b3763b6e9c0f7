import os
import shutil
import tempfile

from panelspark.sources import string_schema
from panelspark.streaming import land_delimited

COLS = "MINE_ID CAL_YR CAL_QTR SUBUNIT_CD COAL_METAL_IND STATE COAL_PRODUCTION AVG_EMPLOYEE_CNT".split()


def test_landing_appends_each_file_once(spark, fx):
    root = tempfile.mkdtemp(prefix="panelspark-landing-")
    src, table, ckpt = (os.path.join(root, x) for x in ("drop", "table", "ckpt"))
    os.makedirs(src)
    shutil.copy(os.path.join(fx, "production.txt"), os.path.join(src, "q1.txt"))
    schema = string_schema(COLS)

    land_delimited(spark, src, schema, table, ckpt, partition_by=["CAL_YR"]).awaitTermination()
    first = spark.read.parquet(table)
    n1 = first.count()
    assert n1 == 126 and {r["_source"] for r in first.select("_source").distinct().collect()} == {"q1.txt"}

    # A second drop lands; a re-run appends only the new file.
    shutil.copy(os.path.join(fx, "production.txt"), os.path.join(src, "q2.txt"))
    land_delimited(spark, src, schema, table, ckpt, partition_by=["CAL_YR"]).awaitTermination()
    land_delimited(spark, src, schema, table, ckpt, partition_by=["CAL_YR"]).awaitTermination()
    after = spark.read.parquet(table)
    assert after.count() == 2 * n1
    assert {r["_source"] for r in after.select("_source").distinct().collect()} == {"q1.txt", "q2.txt"}


def test_checkpoint_is_a_stable_path_of_the_caller(spark, fx):
    """A later application (here: another checkpoint folder of the session) with the same path goes on, no file is lost."""
    import pytest
    root = tempfile.mkdtemp(prefix="panelspark-landing-")
    src, table, ckpt = (os.path.join(root, x) for x in ("drop", "table", "ckpt"))
    os.makedirs(src)
    schema = string_schema(COLS)
    with pytest.raises(TypeError):
        land_delimited(spark, src, schema, table)
    shutil.copy(os.path.join(fx, "production.txt"), os.path.join(src, "a.txt"))
    land_delimited(spark, src, schema, table, ckpt).awaitTermination()
    n = spark.read.parquet(table).count()
    shutil.copy(os.path.join(fx, "production.txt"), os.path.join(src, "b.txt"))
    land_delimited(spark.newSession(), src, schema, table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == 2 * n
