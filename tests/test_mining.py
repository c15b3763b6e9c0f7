"""The growth tables on the fixture files, checked against a row-by-row brute force."""

import math

import pytest
from pyspark.sql import functions as F

import brute_mining as bm
from panelspark.plans import mining
from panelspark.sources import read_delimited, read_lookup, string_schema

PROD_COLS = "MINE_ID CAL_YR CAL_QTR SUBUNIT_CD COAL_METAL_IND STATE COAL_PRODUCTION AVG_EMPLOYEE_CNT".split()


@pytest.fixture(scope="module")
def inputs(spark, fx):
    prod = read_delimited(spark, f"{fx}/production.txt", string_schema(PROD_COLS))
    mines = read_delimited(spark, f"{fx}/mines.txt", string_schema(["MINE_ID", "FIPS_CNTY_NM", "MINE_NAME", "STATE"]))
    cl = read_lookup(spark, f"{fx}/county_lookup.csv", string_schema(["county", "Region"]))
    ml = read_lookup(spark, f"{fx}/mtype_lookup.csv", string_schema(["SUBUNIT_CD", "mtype"]))
    facts = mining.enrich_facts(prod, mines, cl, ml)
    ky = mining.state_subset(facts)
    brute_facts, region = bm.load_facts(fx)
    return {"facts": facts, "ky": ky, "cl": cl, "brute": brute_facts, "region": region}


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def test_enrich_facts(inputs):
    facts = inputs["facts"]
    ids = {r["MINE_ID"] for r in facts.select("MINE_ID").distinct().collect()}
    # dropped: metal mine, county absent from lookup, unknown mine type, production without mine
    assert not ids & {"0000103", "0000105", "0000106", "0000999"}
    assert "0000104" in ids  # other state, still in the national facts
    row = facts.where("MINE_ID = '0000001' AND CAL_YR = 2015 AND CAL_QTR = 1").first()
    assert row["STATE"] == "KY" and row["FIPS_CNTY_NM"] == "pike" and row["Region"] == "East"
    assert row["Date_qtr"] == "2015-1" and row["COAL_PRODUCTION"] == 1000.0
    assert dict(facts.dtypes)["CAL_YR"] == "int"
    bad = facts.where("MINE_ID = '0000004' AND CAL_YR = 2015 AND CAL_QTR = 2").first()
    assert bad["COAL_PRODUCTION"] is None  # "n/a" -> NULL
    assert inputs["ky"].where("STATE <> 'KY'").count() == 0


def test_brute_sees_same_facts(inputs):
    ky = inputs["ky"]
    assert ky.count() == len(inputs["brute"])
    s = ky.agg(F.sum("COAL_PRODUCTION")).first()[0]
    assert s == sum(r["prod"] or 0.0 for r in inputs["brute"])


@pytest.mark.parametrize("compat", [True, False])
def test_growth_tables_match_brute_force(inputs, compat):
    tabs = mining.growth_tables(inputs["ky"], inputs["cl"], compat=compat)
    f, region = inputs["brute"], inputs["region"]
    expected = {
        "production_by_region": bm.production_by_region(f),
        "production_page_east": bm.region_page(f, "East"),
        "production_page_west": bm.region_page(f, "West"),
        "production_by_county": bm.production_by_county(f, region, compat),
        "employment_by_mtype": bm.employment_by_mtype(f, compat),
        "employment_by_county": bm.employment_by_county(f, region, compat),
        "employment_by_region": bm.employment_by_region(f, compat),
    }
    for name, exp in expected.items():
        got = as_dicts(tabs[name])
        assert set(got[0]) == set(exp[0]), name
        assert bm.normalise(got) == bm.normalise(exp), name


def test_traps(inputs):
    cube = mining.period_cube(inputs["ky"])
    county = {(r["FIPS_CNTY_NM"], r["CAL_YR"], r["CAL_QTR"]): r
              for r in mining.production_by_county(cube, inputs["cl"], compat=True).collect()}
    # all-missing group sums to 0 (not NULL); the next quarter grows from a zero base -> Inf
    assert county[("McLean", 2016, 3)]["clpctp"] == 0.0
    assert county[("McLean", 2016, 4)]["clpctp_Qtr_County"] == math.inf
    # missing quarter: positional lag compares 2016Q3 with 2015Q2
    mc = county[("Mccreary", 2016, 3)]
    assert mc["clpctp_YOY_County"] == (mc["clpctp"] - county[("Mccreary", 2015, 2)]["clpctp"]) / \
        county[("Mccreary", 2015, 2)]["clpctp"]
    # compat: only McLean is fixed; the comparison column is false for Mccreary only
    assert mc["county_name_check"] is False
    assert all(r["county_name_check"] for k, r in county.items() if k[0] != "Mccreary")
    # global lag: the first rows of a later series compare with the previous series
    assert county[("McLean", 2015, 1)]["clpctp_YOY_County"] is not None
    fixed = {r["FIPS_CNTY_NM"] for r in mining.production_by_county(cube, inputs["cl"], compat=False).collect()}
    assert fixed == {"Pike", "McCreary", "McLean", "Muhlenberg"}
    series = {(r["FIPS_CNTY_NM"], r["CAL_YR"], r["CAL_QTR"]): r
              for r in mining.production_by_county(cube, inputs["cl"], compat=False).collect()}
    assert series[("McLean", 2015, 1)]["clpctp_YOY_County"] is None


def test_detail_sums_equal_total(inputs):
    t = mining.production_by_region(mining.period_cube(inputs["ky"]))
    det = t.where("Region <> 'Total'").groupBy("CAL_YR", "CAL_QTR").agg(F.sum("clpttp").alias("s"))
    tot = t.where("Region = 'Total'").select("CAL_YR", "CAL_QTR", "clpttp")
    j = det.join(tot, ["CAL_YR", "CAL_QTR"])
    assert j.count() == 10 and j.where("abs(s - clpttp) > 1e-6").count() == 0


def test_growth_times_base_recovers_value(inputs):
    t = mining.production_by_region(mining.period_cube(inputs["ky"]))
    from pyspark.sql import Window
    w = Window.partitionBy("Region").orderBy("CAL_YR", "CAL_QTR")
    chk = t.withColumn("p", F.lag("clpttp", 1).over(w)).where("p IS NOT NULL AND p <> 0")
    assert chk.where("abs(clpttp_Qtr_Region * p + p - clpttp) > 1e-6").count() == 0
