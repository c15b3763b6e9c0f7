"""The end-to-end runners on the fixture files: every table written and readable."""

import os
import tempfile

from panelspark.plans import run


def _read(spark, path):
    return spark.read.option("header", True).option("nullValue", "NA").csv(path)


def test_run_mining(spark, fx):
    out = tempfile.mkdtemp(prefix="panelspark-run-")
    paths = run.run_mining(spark, f"{fx}/production.txt", f"{fx}/mines.txt", f"{fx}/county_lookup.csv",
                           f"{fx}/mtype_lookup.csv", out, compat=True)
    assert set(paths) == {"facts", "facts_ky", "production_by_region", "production_by_mtype",
                          "production_by_county", "employment_by_mtype", "employment_by_county",
                          "employment_by_region", "production_page_east", "production_page_west"}
    assert _read(spark, paths["facts_ky"]).where("STATE <> 'KY'").count() == 0
    region = _read(spark, paths["production_by_region"])
    assert region.count() == 30 and "Infinity" not in {r[0] for r in region.select("clpttp").collect()}
    county = _read(spark, paths["production_by_county"])
    assert "county_name_check" in county.columns
    assert county.where("FIPS_CNTY_NM = 'McLean' AND CAL_YR = '2016' AND CAL_QTR = '4'").first()[
        "clpctp_Qtr_County"] == "Infinity"


def test_run_energy_and_housing(spark, fx):
    out = tempfile.mkdtemp(prefix="panelspark-run-")
    paths = run.run_energy(spark, f"{fx}/series.ndjson", f"{fx}/sheets", f"{fx}/state_lookup.csv", out,
                           fmt="parquet")
    assert spark.read.parquet(paths["combined_panel"]).where("codeyr = 'US_2001'").first()["EGTEP"] == 10003.0
    assert spark.read.parquet(paths["codebook"]).count() == 5
    hpaths = run.run_housing(spark, f"{fx}/housing", f"{fx}/state_lookup.csv", os.path.join(out, "h"))
    assert _read(spark, hpaths["housing"]).count() == 16


def test_mining_from_landed_parquet(spark, fx):
    """Land the production drop with the streaming job, then run the tables from the landed table."""
    import shutil

    from panelspark.sources import string_schema
    from panelspark.streaming import land_delimited
    cols = "MINE_ID CAL_YR CAL_QTR SUBUNIT_CD COAL_METAL_IND STATE COAL_PRODUCTION AVG_EMPLOYEE_CNT".split()
    root = tempfile.mkdtemp(prefix="panelspark-land-")
    os.makedirs(os.path.join(root, "drop"))
    shutil.copy(os.path.join(fx, "production.txt"), os.path.join(root, "drop", "q.txt"))
    land_delimited(spark, os.path.join(root, "drop"), string_schema(cols), os.path.join(root, "table"), os.path.join(root, "ckpt"),
                   partition_by=["CAL_YR"]).awaitTermination()
    args = (f"{fx}/mines.txt", f"{fx}/county_lookup.csv", f"{fx}/mtype_lookup.csv")
    from_table = run.run_mining(spark, os.path.join(root, "table"), *args, os.path.join(root, "a"), compat=True)
    from_text = run.run_mining(spark, f"{fx}/production.txt", *args, os.path.join(root, "b"), compat=True)
    for name in ("production_by_region", "employment_by_county", "production_by_county"):
        a = sorted(tuple(r) for r in _read(spark, from_table[name]).collect())
        b = sorted(tuple(r) for r in _read(spark, from_text[name]).collect())
        assert a == b and len(a) > 0, name
