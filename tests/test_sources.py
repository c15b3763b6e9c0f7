import pytest

import os
import tempfile

from pyspark.sql import functions as F

from panelspark.sources import (CORRUPT, contiguous_year_prefix, read_delimited, read_json_matrix, read_lookup,
                                read_series_ndjson, read_sheet_set, string_schema, tag_source, write_table)

PROD_COLS = "MINE_ID CAL_YR CAL_QTR SUBUNIT_CD COAL_METAL_IND STATE COAL_PRODUCTION AVG_EMPLOYEE_CNT".split()


def test_read_delimited_ragged_and_quotes(spark, fx):
    prod = read_delimited(spark, f"{fx}/production.txt", string_schema(PROD_COLS))
    bad = {r["MINE_ID"]: r for r in prod.where(F.col(CORRUPT).isNotNull()).collect()}
    assert set(bad) == {"0000101", "0000102"}
    assert bad["0000101"]["STATE"] is None            # short row padded with NULL
    assert bad["0000102"]["AVG_EMPLOYEE_CNT"] == "1"  # long row truncated
    mines = read_delimited(spark, f"{fx}/mines.txt", string_schema(["MINE_ID", "FIPS_CNTY_NM", "MINE_NAME", "STATE"]))
    names = {r["MINE_ID"]: r["MINE_NAME"] for r in mines.collect()}
    assert names["0000101"] == "Big #1 Mine" and names["0000102"] == "O'Brien's Mine"
    assert names["0000001"] == "Mine 1" and len(names) == 19
    assert prod.where(F.col("MINE_ID") == "0000001").count() == 10  # leading zeros survive as text


def test_read_delimited_by_name(spark, fx):
    wanted = ["COAL_PRODUCTION", "MINE_ID", "CAL_YR"]            # a subset, in another order
    prod = read_delimited(spark, f"{fx}/production.txt", wanted)
    assert prod.columns == wanted + [CORRUPT]
    row = prod.where("MINE_ID = '0000001' AND CAL_YR = '2015'").orderBy("COAL_PRODUCTION").first()
    assert row["COAL_PRODUCTION"] == "1000"
    # With CSV column pruning only the columns a query reads are parsed, so ragged
    # rows are flagged relative to those; the full-width check is the test above.
    assert prod.count() == 126
    import pytest
    with pytest.raises(KeyError):
        read_delimited(spark, f"{fx}/production.txt", ["NOT_THERE"])


def test_read_lookup(spark, fx):
    lk = read_lookup(spark, f"{fx}/state_lookup.csv", string_schema(["name", "statecode"]))
    assert dict((r["name"], r["statecode"]) for r in lk.collect())["United States"] == "US"


def test_read_series(spark, fx):
    s = read_series_ndjson(spark, f"{fx}/series.ndjson")
    assert s.count() == 8
    ky = s.where("geography = 'USA-KY' AND geoset_id = 'SEDS.CLEIB.A'").first()
    assert ky["data"] == [["2001", "50"], ["2003"]]


def test_read_sheet_set(spark, fx):
    sh = read_sheet_set(spark, f"{fx}/sheets")
    sheets = {r["sheet"] for r in sh.select("sheet").distinct().collect()}
    assert sheets == {"2001_2002_FINAL", "2003_2004_FINAL", "2005-2007_FINAL", "2018_Preliminary"}
    assert sh.where(F.col("year").isNull()).count() == 0
    assert dict(sh.dtypes)["generation"] == "double" and dict(sh.dtypes)["year"] == "int"
    first = sh.where("sheet = '2005-2007_FINAL' AND energysource = 'Total' AND month = 1").first()
    assert (first["year"], first["state"], first["generation"]) == (2005, "KY", 5001.0)
    assert sh.where(F.col("typeofproducer") == "Electric Generators, Electric Utilities").count() == 12


def test_read_json_matrix(spark, fx):
    m = read_json_matrix(spark, f"{fx}/housing")
    assert m.count() == 24
    row = m.where(F.col("source") == "HousingPhysChar_2011.json").first()["cells"]
    assert row["NAME"] == "Pike County, Kentucky" and row["state"] == "00"
    assert "S2504_C01_038E" not in row
    keyed = read_json_matrix(spark, f"{fx}/housing", keys=["NAME", "S2504_C01_038E"])
    assert keyed.where("source = 'HousingPhysChar_2011.json' AND S2504_C01_038E IS NULL").count() == 8
    assert read_json_matrix(spark, f"{fx}/housing_empty").count() == 0


def test_contiguous_year_prefix(spark):
    df = spark.createDataFrame([(y,) for y in (2010, 2010, 2011, 2013, 2014, 2009)], "y int")
    assert sorted(r["y"] for r in contiguous_year_prefix(df, "y", 2010).collect()) == [2010, 2010, 2011]
    assert contiguous_year_prefix(df.where("y <> 2010"), "y", 2010).count() == 0


def test_tag_source_and_write_round_trip(spark, fx):
    lk = tag_source(read_lookup(spark, f"{fx}/state_lookup.csv", string_schema(["name", "statecode"])))
    assert {r["source"] for r in lk.collect()} == {"state_lookup.csv"}
    out = tempfile.mkdtemp(prefix="panelspark-sink-")
    df = spark.createDataFrame([("KY", None, 1.5), ("WV", "x", None)], "a string, b string, c double")
    write_table(df, os.path.join(out, "csv"), fmt="csv", null_value="NA")
    back = spark.read.option("header", True).option("nullValue", "NA").schema(df.schema).csv(os.path.join(out, "csv"))
    assert sorted(back.collect()) == sorted(df.collect())
    parts = [os.path.join(out, "csv", f) for f in os.listdir(os.path.join(out, "csv")) if f.endswith(".csv")]
    text = "".join(open(p).read() for p in parts)
    assert text.count("NA") == 2                     # both NULL cells written as NA
    write_table(df, os.path.join(out, "pq"), partition_by=["a"])
    assert sorted(spark.read.parquet(os.path.join(out, "pq")).select("a", "b", "c").collect()) == sorted(df.collect())


def test_headers_in_another_order_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.txt").write_text("MINE_ID|STATE\n1|KY\n")
    (tmp_path / "b.txt").write_text("STATE|MINE_ID|MORE\nWV|2|x\n")
    got = read_delimited(spark, str(tmp_path), ["MINE_ID", "STATE"]).drop(CORRUPT)
    assert sorted(map(tuple, got.collect())) == [("1", "KY"), ("2", "WV")]
    every = read_delimited(spark, str(tmp_path)).drop(CORRUPT)
    assert sorted((r["MINE_ID"], r["STATE"], r["MORE"]) for r in every.collect()) == [("1", "KY", None), ("2", "WV", "x")]
    with pytest.raises(KeyError):
        read_delimited(spark, str(tmp_path), ["MINE_ID", "MORE"])
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path), string_schema(["MINE_ID", "STATE"])).collect()


def test_many_files_with_different_headers(spark, tmp_path, monkeypatch):
    from panelspark.sources import readers
    heads = ["A|B", "B|A|C", "C|A"]
    for k in range(60):
        cells = {"A": f"a{k}", "B": f'"b{k}"', "C": f"#{k}"}
        names = heads[k % 3].split("|")
        (tmp_path / f"f{k:02}.txt").write_text(f"{heads[k % 3]}\r\n" + "|".join(cells[n] for n in names) + "\n\n" + (f"short{k}\n" if k == 7 else ""))
    got = read_delimited(spark, str(tmp_path))
    assert got.columns == ["A", "B", "C", CORRUPT]
    rows = sorted((r["A"] or "", r["B"], r["C"], r[CORRUPT]) for r in got.collect())
    want = [(f"a{k}", f"b{k}" if k % 3 < 2 else None, f"#{k}" if k % 3 else None, None) for k in range(60)] + [("", "short7", None, "short7")]
    assert rows == sorted(want)
    assert read_delimited(spark, str(tmp_path), ["A"]).drop(CORRUPT).columns == ["A"]
    monkeypatch.setattr(readers, "MAX_HEADERS", 2)
    with pytest.raises(ValueError, match="more than 2 different headers"):
        read_delimited(spark, str(tmp_path))


def test_quotes_are_data(spark, tmp_path):
    (tmp_path / "q.txt").write_text('A|B|C\n"x|y|z\n1|"2"|#3\n')
    assert [tuple(r) for r in read_delimited(spark, str(tmp_path)).drop(CORRUPT).collect()] == [('"x', "y", "z"), ("1", "2", "#3")]


def test_corrupt_rows_are_counted(spark, tmp_path):
    from panelspark.sources import corrupt_rows
    (tmp_path / "q.txt").write_text("A|B|C\n1|2|3\n1|2\n1|2|3|4\n")
    assert corrupt_rows(read_delimited(spark, str(tmp_path))) == 2


def test_sheet_row_with_a_damaged_year_stays(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Some title\nYEAR,MONTH,STATE,TYPE,SOURCE,GENERATION\n2001,1,AK,T,Coal,5\n20x1,2,AK,T,Coal,6\n")
    rows = read_sheet_set(spark, str(tmp_path)).collect()
    assert sorted((r["year"] or 0, r["month"], r["generation"]) for r in rows) == [(0, 2, 6.0), (2001, 1, 5.0)]


def test_year_run_counts_files_without_rows(spark, tmp_path):
    from panelspark.plans import housing
    from panelspark.sources import landed_years
    for year, rows in ((2010, ',["A County, Kentucky"]'), (2011, ""), (2012, ',["B County, Kentucky"]'), (2014, ',["C County, Kentucky"]')):
        (tmp_path / f"H_{year}.json").write_text(f'[["NAME"]{rows}]')
    years = landed_years(spark, str(tmp_path))
    assert sorted(r[0] for r in years.collect()) == [2010, 2011, 2012, 2014]
    kept = housing.housing_rows(housing.read_housing(spark, str(tmp_path)), 2010, years)
    assert sorted(r["year"] for r in kept.collect()) == ["2010", "2012"]


def test_lookup_with_a_repeated_key_raises(spark, tmp_path):
    (tmp_path / "l.csv").write_text("county,Region\npike,East\npike,West\n,x\n,y\n")
    with pytest.raises(ValueError, match="pike"):
        read_lookup(spark, str(tmp_path), key="county")
    assert read_lookup(spark, str(tmp_path)).count() == 4
