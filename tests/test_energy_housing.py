"""Energy panel (P10-P14, P16) and housing table (P15) on the fixture files."""

import pytest

from panelspark.plans import energy_panel as ep
from panelspark.plans import housing as hs
from panelspark.sources import read_lookup, read_series_ndjson, read_sheet_set, string_schema


@pytest.fixture(scope="module")
def lk(spark, fx):
    return read_lookup(spark, f"{fx}/state_lookup.csv", string_schema(["name", "statecode"]))


@pytest.fixture(scope="module")
def series(spark, fx):
    return read_series_ndjson(spark, f"{fx}/series.ndjson")


@pytest.fixture(scope="module")
def sheets(spark, fx):
    return read_sheet_set(spark, f"{fx}/sheets")


def test_series_long(series):
    rows = {(r["code"], r["year"], r["group"]): r for r in ep.series_long(series).collect()}
    assert rows[("KY", 2001, "TETCB")]["value"] == 100.5
    assert rows[("KY", 2005, "TETCB")]["value"] is None      # NULL value
    assert rows[("KY", 2003, "CLEIB")]["value"] is None      # one-element pair
    assert ("US", 2001, "TETCB") in rows                     # national unified to US
    assert ("USA-AK1", 2001, "TETCB") in rows                # not 6 long: kept whole
    assert not any(k[2] in ("NODAT", "NOGEO") for k in rows)  # no data / no geography vanish
    compat = {(r["code"], r["year"]) for r in ep.series_long(series, compat=True).collect()}
    assert ("USA", 2001) in compat and ("US", 2001) not in compat


def test_state_year_panel(series, lk):
    p = ep.state_year_panel(series, lk)
    assert p.columns == ["code", "year", "codeyr", "CLEIB", "TETCB", "name"]
    got = [(r["code"], r["year"], r["CLEIB"], r["TETCB"], r["name"]) for r in p.collect()]
    assert got[0] == ("KY", 2001, 50.0, 100.5, "Kentucky")
    assert [g[:2] for g in got] == sorted(g[:2] for g in got)      # sorted by code, year
    assert ("VA", 2001, 20.0, None, None) in got                   # state absent from lookup


def test_pivot_duplicate_raises(spark, fx, lk):
    dup = read_series_ndjson(spark, f"{fx}/series_dup.ndjson")
    with pytest.raises(Exception, match="duplicate"):
        ep.state_year_panel(dup, lk).collect()


def test_generation_long_and_monthly(sheets):
    g = ep.generation_long(sheets)
    assert g.where("typeofproducer <> 'Total Electric Power Industry'").count() == 0
    srcs = {r[0] for r in g.select("energysource").distinct().collect()}
    assert "EGCLP" in srcs and "Battery Storage" in srcs and "Coal" not in srcs
    assert g.where("year = 2005 AND month = 1").first()["year_month"] == "2005-1-01"
    m = ep.generation_monthly(sheets)
    assert "Coal" in m.columns and "EGCLP" not in m.columns
    ky01 = m.where("year = 2001 AND month = 1 AND state = 'KY'").first()
    assert ky01["Wind"] is None and ky01["Coal"] == 202.0
    assert m.where("state = 'US-TOTAL'").count() == 2             # monthly keeps raw spelling


def test_generation_annual(sheets):
    a = ep.generation_annual(sheets)
    cols = a.columns
    assert cols[:2] == ["year", "statecode"] and cols[-2:] == ["codeyr", "EGREP"]
    assert cols[2:-2] == sorted(cols[2:-2]) and "Battery Storage" in cols
    rows = {(r["year"], r["statecode"]): r for r in a.collect()}
    assert set(rows) == {(2001, "KY"), (2001, "US"), (2003, "KY"), (2003, "US"), (2005, "KY"), (2018, "WV")}
    ky = rows[(2001, "KY")]
    assert ky["EGWYP"] == 0.0                                      # zero-filled
    assert ky["EGCLP"] == 202.0 + 203.0                            # months summed, other producer excluded
    assert ky["EGREP"] == sum(ky[c] for c in ep.RENEWABLE_CODES) and ky["codeyr"] == "KY_2001"


def test_combined_panel(series, lk, sheets):
    c = ep.combined_panel(ep.state_year_panel(series, lk), ep.generation_annual(sheets))
    rows = {r["codeyr"]: r for r in c.collect()}
    assert rows["KY_2001"]["EGCLP"] == 405.0 and rows["KY_2001"]["year"] == 2001
    assert rows["US_2001"]["EGTEP"] == 10003.0                     # national rows join (USA -> US)
    assert rows["WV_2018"]["EGTEP"] == 10003.0 and rows["VA_2001"]["EGTEP"] is None
    assert "statecode" not in c.columns and c.columns.count("year") == 1
    compat = ep.state_year_panel(series, lk, compat=True)
    rows_c = {r["codeyr"]: r for r in ep.combined_panel(compat, ep.generation_annual(sheets)).collect()}
    assert rows_c["USA_2001"]["EGTEP"] is None                     # trap: national rows miss the join


def test_codebook(series):
    cb = [tuple(r) for r in ep.codebook(series).collect()]
    assert sorted(cb) == [
        ("CLEIB", "Coal used by power plants , ", "Billion Btu"),   # both Kentucky and Virginia rows
        ("NODAT", "A record without data ", "Percent"),                # ", Kentucky" -> ", " -> " "
        ("TETCB", "Total energy consumed  region", "Billion Btu"),
        ("TETCB", "Total energy consumed , all sectors", "Billion Btu"),
        ("TETCB", "Total energy consumed , all sectors, ", "Billion Btu"),  # "West Virginia" goes whole
    ]
    assert [r[0] for r in cb] == sorted(r[0] for r in cb)


def test_housing_table(spark, fx, lk):
    t = hs.housing_table(hs.read_housing(spark, f"{fx}/housing"), lk)
    assert t.columns == ["year", "State", "county", "statecode", "YrBuilt_2014plus", "YrBuilt_2010_2013",
                         "YrBuilt_2000_2009", "YrBuilt_1980_1999", "YrBuilt_1960_1979", "YrBuilt_1940_1959",
                         "YrBuilt_1939OrLess", "Heating_LPGas", "Heating_Elec", "Heating_FuelOil", "Heating_Coal",
                         "Heating_Other", "Heating_None", "OccHU"]
    assert {r["year"] for r in t.select("year").distinct().collect()} == {"2010", "2011"}  # 2013 after a gap
    rows = {(r["year"], r["county"]): r for r in t.collect()}
    assert rows[("2010", "pike")]["State"] == "Kentucky" and rows[("2010", "pike")]["statecode"] == "KY"
    assert rows[("2010", "caddo")]["statecode"] == "LA"
    assert ("2010", "juneau city and") in rows and ("2010", "bethel") in rows and ("2010", "anchorage") in rows
    assert rows[("2010", "adjuntas")]["statecode"] is None         # state absent from lookup
    assert rows[("2010", "county")]["State"] == "Louisiana"        # "Parish County": first word only
    dc = rows[("2010", "district of columbia")]
    assert dc["State"] is None and dc["statecode"] is None         # no comma
    assert rows[("2011", "pike")]["Heating_None"] is None          # code absent that year
    assert rows[("2010", "pike")]["OccHU"] == "1010" and dict(t.dtypes)["OccHU"] == "string"
    assert hs.housing_table(hs.read_housing(spark, f"{fx}/housing_empty"), lk).count() == 0
