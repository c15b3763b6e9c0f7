"""Write the small hand-shaped fixture files (deterministic; re-run to regenerate).

Every trap listed in FIXTURES.md is planted here on purpose; the comments name it.
"""

from __future__ import annotations

import json
import os

HERE = os.path.dirname(os.path.abspath(__file__))

COUNTIES = [("PIKE", "pike", "East"), ("McCreary", "mccreary", "East"),
            ("McLean", "mclean", "West"), ("Muhlenberg", "muhlenberg", "West")]
SUBUNITS = [("01", "Underground"), ("02", "Surface"), ("03", "Facility")]
QUARTERS = [(2015 + (i // 4), i % 4 + 1) for i in range(10)]  # 2015Q1 .. 2017Q2


def production_value(m: int, q: int) -> int:
    return 1000 * (m + 1) + 37 * q + (m * q) % 11


def employment_value(m: int, q: int) -> int:
    return 10 + m + (q % 3)


def write_mining() -> None:
    header = "MINE_ID|CAL_YR|CAL_QTR|SUBUNIT_CD|COAL_METAL_IND|STATE|COAL_PRODUCTION|AVG_EMPLOYEE_CNT"
    prod = [header]
    mines = ["MINE_ID|FIPS_CNTY_NM|MINE_NAME|STATE"]
    m = 0
    for county_raw, county, _ in COUNTIES:
        for sub, _ in SUBUNITS:
            mine_id = f"{m + 1:07d}"
            # A non-key column on both sides with different values: mine 1 says XX, production says KY.
            mines.append(f"{mine_id}|{county_raw}|Mine {m + 1}|{'XX' if m == 0 else 'KY'}")
            for qi, (yr, qtr) in enumerate(QUARTERS):
                # One missing quarter: McCreary has no rows at all for 2016 Q2.
                if county == "mccreary" and (yr, qtr) == (2016, 2):
                    continue
                p, e = str(production_value(m, qi)), str(employment_value(m, qi))
                # One group with all measures missing: McLean 2016 Q3 (every mine).
                if county == "mclean" and (yr, qtr) == (2016, 3):
                    p = ""
                # One non-numeric and one empty measure.
                if m == 3 and qi == 1:
                    p = "n/a"
                if m == 4 and qi == 2:
                    e = ""
                prod.append(f"{mine_id}|{yr}|{qtr}|{sub}|C|KY|{p}|{e}")
            m += 1
    # A quoted name with '#', a bare apostrophe.
    mines.append('0000101|PIKE|"Big #1 Mine"|KY')
    mines.append("0000102|PIKE|O'Brien's Mine|KY")
    prod.append("0000101|2015|1|01|C|KY|500|5")
    prod.append("0000102|2015|1|01|C|KY|700|7")
    # One non-coal row, one other state, one county absent from the lookup, one unknown mine type.
    mines.append("0000103|PIKE|Metal Mine|KY")
    prod.append("0000103|2015|1|01|M|KY|900|9")
    mines.append("0000104|Logan|West Mine|WV")
    prod.append("0000104|2015|1|01|C|WV|400|4")
    mines.append("0000105|Harlan|Lost County Mine|KY")
    prod.append("0000105|2015|1|01|C|KY|300|3")
    mines.append("0000106|PIKE|Odd Type Mine|KY")
    prod.append("0000106|2015|1|99|C|KY|200|2")
    # One mine with no production, one production row with no mine.
    mines.append("0000107|PIKE|Idle Mine|KY")
    prod.append("0000999|2015|1|01|C|KY|100|1")
    # One short and one long row.
    prod.append("0000101|2015|2|01|C")
    prod.append("0000102|2015|2|01|C|KY|10|1|extra")
    with open(os.path.join(HERE, "production.txt"), "w") as f:
        f.write("\n".join(prod) + "\n")
    with open(os.path.join(HERE, "mines.txt"), "w") as f:
        f.write("\n".join(mines) + "\n")
    with open(os.path.join(HERE, "county_lookup.csv"), "w") as f:
        f.write("county,Region\n" + "".join(f"{c},{r}\n" for _, c, r in COUNTIES) + "logan,East\n")
    with open(os.path.join(HERE, "mtype_lookup.csv"), "w") as f:
        f.write("SUBUNIT_CD,mtype\n" + "".join(f"{s},{t}\n" for s, t in SUBUNITS))


def write_lookups() -> None:
    rows = [("Kentucky", "KY"), ("West Virginia", "WV"), ("Louisiana", "LA"), ("Alaska", "AK"),
            ("United States", "US")]  # Virginia is absent on purpose
    with open(os.path.join(HERE, "state_lookup.csv"), "w") as f:
        f.write("name,statecode\n" + "".join(f"{n},{c}\n" for n, c in rows))


def write_series() -> None:
    recs = [
        {"geoset_id": "SEDS.TETCB.A", "geography": "USA-KY", "units": "Billion Btu",
         "description": "Total energy consumed, Kentucky, all sectors, See the notes",
         "data": [["2001", "100.5"], ["2003", "101"], ["2005", None]]},
        {"geoset_id": "SEDS.TETCB.A", "geography": "USA-WV", "units": "Billion Btu",
         "description": "Total energy consumed, West Virginia, all sectors, See the notes",
         "data": [["2001", "80"], ["2018", "82.25"]]},
        {"geoset_id": "SEDS.TETCB.A", "geography": "USA", "units": "Billion Btu",
         "description": "Total energy consumed, United States, all sectors",
         "data": [["2001", "9000"], ["2003", "9100"]]},
        {"geoset_id": "SEDS.CLEIB.A", "geography": "USA-KY", "units": "Billion Btu",
         "description": "Coal used by power plants, Kentucky, See table 4, and more",
         "data": [["2001", "50"], ["2003"]]},
        {"geoset_id": "SEDS.CLEIB.A", "geography": "USA-VA", "units": "Billion Btu",
         "description": "Coal used by power plants, Virginia, See table 4, and more",
         "data": [["2001", "20"]]},
        {"geoset_id": "SEDS.NODAT.A", "geography": "USA-KY", "units": "Percent",
         "description": "A record without data, Kentucky"},
        {"geoset_id": "SEDS.NOGEO.A", "geography": None, "units": "Percent",
         "description": "A record without geography", "data": [["2001", "1"]]},
        {"geoset_id": "SEDS.TETCB.A", "geography": "USA-AK1", "units": "Billion Btu",
         "description": "Total energy consumed, Alaska region", "data": [["2001", "5"]]},
    ]
    with open(os.path.join(HERE, "series.ndjson"), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")
    with open(os.path.join(HERE, "series_dup.ndjson"), "w") as f:
        f.write(json.dumps(recs[0]) + "\n")
        f.write(json.dumps({**recs[0], "data": [["2001", "999"]]}) + "\n")


SOURCES = ["Total", "Coal", "Solar Thermal and Photovoltaic", "Wood and Wood Derived Fuels",
           "Other Biomass", "Pumped Storage", "Geothermal", "Wind", "Hydroelectric Conventional",
           "Battery Storage"]
PREAMBLE = ["Net Generation by State by Type of Producer by Energy Source,,,,,",
            "(Thousand Megawatthours),,,,,", ",,,,,", "Source: landed workbook,,,,,"]
HEADER = "YEAR,MONTH,STATE,TYPE OF PRODUCER,ENERGY SOURCE,GENERATION (Megawatthours)"


def _sheet_rows(years: list[int], states: list[str], skip_source: tuple | None = None) -> list[str]:
    rows = []
    for y in years:
        for mo in (1, 2):
            for st in states:
                for i, src in enumerate(SOURCES):
                    if skip_source and (y, st, src) == skip_source:
                        continue
                    val = 100 * (i + 1) + mo + (y % 100)
                    if src == "Total":
                        val = 5000 + mo
                    rows.append(f" {y} , {mo} ,{st},Total Electric Power Industry,{src}, {val} ")
                rows.append(f"{y},{mo},{st},\"Electric Generators, Electric Utilities\",Coal,1")
    return rows


def write_sheets() -> None:
    d = os.path.join(HERE, "sheets")
    os.makedirs(d, exist_ok=True)
    sheets = {
        "2001_2002_FINAL": [HEADER] + _sheet_rows([2001], ["KY", "US-TOTAL"], skip_source=(2001, "KY", "Wind")),
        "2003_2004_FINAL": [HEADER] + _sheet_rows([2003], ["KY", "US-Total"]),
        "2005-2007_FINAL": PREAMBLE + [HEADER] + _sheet_rows([2005], ["KY"]),
        "2018_Preliminary": PREAMBLE + [HEADER] + _sheet_rows([2018], ["WV"]),
        "EnergySource_Notes": ["Note,Meaning", "2019,this sheet must be ignored,x,Total Electric Power Industry,Coal,1"],
    }
    for name, rows in sheets.items():
        with open(os.path.join(d, f"{name}.csv"), "w") as f:
            f.write("\n".join(rows) + "\n")


CODES = ["S2504_C01_001E"] + [f"S2504_C01_{i:03d}E" for i in range(9, 16)] + \
        [f"S2504_C01_{i:03d}E" for i in range(32, 39)]
NAMES = ["Pike County, Kentucky", "Caddo Parish, Louisiana", "Juneau City and Borough, Alaska",
         "Bethel Census Area, Alaska", "Adjuntas Municipio, Puerto Rico", "Parish County, Louisiana",
         "District of Columbia", "Anchorage Municipality, Alaska"]


def write_housing() -> None:
    d = os.path.join(HERE, "housing")
    os.makedirs(d, exist_ok=True)
    for yr in (2010, 2011, 2013):
        codes = [c for c in CODES if not (yr == 2011 and c == "S2504_C01_038E")]
        header = ["NAME", *codes, "NAME", "state", "county"]
        rows = [header]
        for i, name in enumerate(NAMES):
            vals = [str(1000 * (i + 1) + j + yr % 100) for j in range(len(codes))]
            rows.append([name, *vals, name, f"{i:02d}", f"{i * 3:03d}"])
        with open(os.path.join(d, f"HousingPhysChar_{yr}.json"), "w") as f:
            json.dump(rows, f)
    e = os.path.join(HERE, "housing_empty")
    os.makedirs(e, exist_ok=True)
    with open(os.path.join(e, "HousingPhysChar_2012.json"), "w") as f:
        json.dump([["NAME", *CODES, "NAME", "state", "county"]], f)


def write_zero_base() -> None:
    rows = ["series,yr,qtr,value"]
    a = [0, 0, 0, 0, 5, 0]
    b = [3, 6, 6, 12, 0, 9]
    for name, vals in (("a", a), ("b", b)):
        for i, v in enumerate(vals):
            rows.append(f"{name},{2020 + i // 4},{i % 4 + 1},{v}")
    with open(os.path.join(HERE, "zero_base.csv"), "w") as f:
        f.write("\n".join(rows) + "\n")


if __name__ == "__main__":
    write_mining()
    write_lookups()
    write_series()
    write_sheets()
    write_housing()
    write_zero_base()
