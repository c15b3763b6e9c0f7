"""Brute-force growth tables in plain Python, read straight from the fixture files.

Written row by row like the original scripts (sort, positional lag, stack,
backfill), independent of Spark, to check the one-pass Spark plans.
"""

from __future__ import annotations

import csv
import math
import os
from collections import defaultdict

TOTAL = "Total"


def _parse_num(s):
    if s is None:
        return None
    try:
        return float(s.strip())
    except ValueError:
        return None


def _pipe_rows(path, ncols):
    with open(path) as f:
        header = f.readline().rstrip("\n").split("|")
        for line in f:
            parts = line.rstrip("\n").split("|")
            parts = (parts + [None] * ncols)[:ncols]
            yield dict(zip(header, parts))


def load_facts(fx: str, state: str = "KY") -> list[dict]:
    prod = list(_pipe_rows(os.path.join(fx, "production.txt"), 8))
    mines = {m["MINE_ID"]: m for m in _pipe_rows(os.path.join(fx, "mines.txt"), 4)}
    with open(os.path.join(fx, "county_lookup.csv")) as f:
        region = {r["county"]: r["Region"] for r in csv.DictReader(f)}
    with open(os.path.join(fx, "mtype_lookup.csv")) as f:
        mtype = {r["SUBUNIT_CD"]: r["mtype"] for r in csv.DictReader(f)}
    out = []
    for p in prod:
        m = mines.get(p["MINE_ID"])
        if m is None or p["COAL_METAL_IND"] != "C":
            continue
        county = m["FIPS_CNTY_NM"].lower()
        if county not in region or p["SUBUNIT_CD"] not in mtype:
            continue
        if p["STATE"] != state:  # the left (production) STATE wins
            continue
        out.append({"Region": region[county], "mtype": mtype[p["SUBUNIT_CD"]], "county": county,
                    "yr": int(p["CAL_YR"]), "qtr": int(p["CAL_QTR"]),
                    "prod": _parse_num(p["COAL_PRODUCTION"]), "emp": _parse_num(p["AVG_EMPLOYEE_CNT"])})
    return out, region


def sums(facts, keys, measure):
    acc = defaultdict(float)
    for r in facts:
        k = tuple(r[x] for x in keys)
        v = r[measure]
        acc[k] += 0.0 if v is None or math.isnan(v) else v
    return sorted(acc.items())


def ieee_growth(x, p):
    if x is None or p is None:
        return None
    d = x - p
    if p == 0:
        if math.isnan(d) or d == 0:
            return math.nan
        return math.copysign(math.inf, d)
    return d / p


def lagged(values, n):
    return [values[i - n] if i >= n else None for i in range(len(values))]


def growth_cols(values, prefix_rate, prefix_change=None):
    """Rates (and changes) at n=4 and n=1 over a list of values in order."""
    out = [dict() for _ in values]
    for n, tag in ((4, "YOY"), (1, "Qtr")):
        prev = lagged(values, n)
        for i, (x, p) in enumerate(zip(values, prev)):
            out[i][prefix_rate[tag]] = ieee_growth(x, p)
            if prefix_change:
                out[i][prefix_change[tag]] = None if p is None else x - p
    return out


def series_table(items, key_len, value_name, rate_names, change_names=None, scope="series"):
    """items: sorted [(key tuple incl. yr, qtr), value]; lag per series (key[:key_len]) or globally."""
    rows = []
    if scope == "global":
        groups = [items]
    else:
        by = defaultdict(list)
        for k, v in items:
            by[k[:key_len]].append((k, v))
        groups = [by[g] for g in sorted(by)]
    for g in groups:
        vals = [v for _, v in g]
        gc = growth_cols(vals, rate_names, change_names)
        for (k, v), extra in zip(g, gc):
            rows.append({"key": k, value_name: v, **extra})
    return rows


def bf(a, b):
    return b if a is None or (isinstance(a, float) and math.isnan(a)) else a


def label(yr, qtr):
    return f"{yr}-{qtr * 3}-01"


def proper(s):
    return s[:1].upper() + s[1:].lower()


# ---------------------------------------------------------------- tables

def production_by_region(facts):
    det = series_table(sums(facts, ["Region", "yr", "qtr"], "prod"), 1, "clpttp",
                       {"YOY": "clpttp_YOY_Region", "Qtr": "clpttp_Qtr_Region"})
    tot = series_table(sums(facts, ["yr", "qtr"], "prod"), 0, "clpttp",
                       {"YOY": "clpttp_YOY_Total", "Qtr": "clpttp_Qtr_Total"})
    out = []
    for r in det:
        reg, yr, qtr = r["key"]
        out.append({"Region": reg, "CAL_YR": yr, "CAL_QTR": qtr, "clpttp": r["clpttp"],
                    "clpttp_YOY_Region": bf(r["clpttp_YOY_Region"], None),
                    "clpttp_Qtr_Region": bf(r["clpttp_Qtr_Region"], None),
                    "clpttp_YOY_Total": None, "clpttp_Qtr_Total": None, "mtype": None, "Date_Qtr": label(yr, qtr)})
    for r in tot:
        yr, qtr = r["key"]
        out.append({"Region": TOTAL, "CAL_YR": yr, "CAL_QTR": qtr, "clpttp": r["clpttp"],
                    "clpttp_YOY_Region": r["clpttp_YOY_Total"], "clpttp_Qtr_Region": r["clpttp_Qtr_Total"],
                    "clpttp_YOY_Total": r["clpttp_YOY_Total"], "clpttp_Qtr_Total": r["clpttp_Qtr_Total"],
                    "mtype": TOTAL, "Date_Qtr": label(yr, qtr)})
    return out


def region_page(facts, region):
    sub = [f for f in facts if f["Region"] == region]
    det = series_table(sums(sub, ["mtype", "yr", "qtr"], "prod"), 1, "clpttp",
                       {"YOY": "clpttp_YOY_Mtype", "Qtr": "clpttp_Qtr_Mtype"})
    tot = series_table(sums(sub, ["yr", "qtr"], "prod"), 0, "clpttp",
                       {"YOY": f"clpttp_YOY_{region}", "Qtr": f"clpttp_Qtr_{region}"})
    out = []
    for r in det:
        m, yr, qtr = r["key"]
        out.append({"mtype": m, "CAL_YR": yr, "CAL_QTR": qtr, "clpttp": r["clpttp"],
                    "clpttp_YOY_Mtype": bf(r["clpttp_YOY_Mtype"], None),
                    "clpttp_Qtr_Mtype": bf(r["clpttp_Qtr_Mtype"], None),
                    f"clpttp_YOY_{region}": None, f"clpttp_Qtr_{region}": None, "Date_Qtr": label(yr, qtr)})
    for r in tot:
        yr, qtr = r["key"]
        out.append({"mtype": TOTAL, "CAL_YR": yr, "CAL_QTR": qtr, "clpttp": r["clpttp"],
                    "clpttp_YOY_Mtype": r[f"clpttp_YOY_{region}"], "clpttp_Qtr_Mtype": r[f"clpttp_Qtr_{region}"],
                    f"clpttp_YOY_{region}": r[f"clpttp_YOY_{region}"],
                    f"clpttp_Qtr_{region}": r[f"clpttp_Qtr_{region}"], "Date_Qtr": label(yr, qtr)})
    return out


def _names(county, compat):
    name = proper(county)
    if compat:
        name = "McLean" if name == "Mclean" else name
        return name, {"county_name_check": name == ("McCreary" if name == "Mccreary" else name)}
    return {"Mclean": "McLean", "Mccreary": "McCreary"}.get(name, name), {}


def production_by_county(facts, region, compat=True):
    rows = series_table(sums(facts, ["county", "yr", "qtr"], "prod"), 1, "clpctp",
                        {"YOY": "clpctp_YOY_County", "Qtr": "clpctp_Qtr_County"},
                        scope="global" if compat else "series")
    out = []
    for r in rows:
        c, yr, qtr = r["key"]
        name, extra = _names(c, compat)
        out.append({"FIPS_CNTY_NM": name, "CAL_YR": yr, "CAL_QTR": qtr, "clpctp": r["clpctp"],
                    "clpctp_YOY_County": r["clpctp_YOY_County"], "clpctp_Qtr_County": r["clpctp_Qtr_County"],
                    "Region": region.get(c), **extra, "Date_Qtr": label(yr, qtr)})
    return out


def _emp_total(facts):
    return series_table(sums(facts, ["yr", "qtr"], "emp"), 0, "clpetp",
                        {"YOY": "clpetp_YOY_Total", "Qtr": "clpetp_Qtr_Total"},
                        {"YOY": "clpetp_YOY_TotalChange", "Qtr": "clpetp_Qtr_TotalChange"})


def employment_by_mtype(facts, compat=True):
    det = series_table(sums(facts, ["mtype", "yr", "qtr"], "emp"), 1, "clpetp",
                       {"YOY": "clpetp_YOY_mtype", "Qtr": "clpetp_Qtr_mtype"},
                       {"YOY": "clpetp_YOY_AbsChange", "Qtr": "clpetp_Qtr_AbsChange"},
                       scope="global" if compat else "series")
    out = []
    for r in det:
        m, yr, qtr = r["key"]
        out.append({"mtype": m, "CAL_YR": yr, "CAL_QTR": qtr, "clpetp": r["clpetp"],
                    "clpetp_YOY_mtype": bf(r["clpetp_YOY_mtype"], None),
                    "clpetp_YOY_AbsChange": bf(r["clpetp_YOY_AbsChange"], None),
                    "clpetp_Qtr_mtype": bf(r["clpetp_Qtr_mtype"], None),
                    "clpetp_Qtr_AbsChange": bf(r["clpetp_Qtr_AbsChange"], None),
                    "clpetp_YOY_Total": None, "clpetp_YOY_TotalChange": None, "clpetp_Qtr_Total": None,
                    "clpetp_Qtr_TotalChange": None, "Region": None, "Date_Qtr": label(yr, qtr)})
    for r in _emp_total(facts):
        yr, qtr = r["key"]
        out.append({"mtype": TOTAL, "CAL_YR": yr, "CAL_QTR": qtr, "clpetp": r["clpetp"],
                    "clpetp_YOY_mtype": r["clpetp_YOY_Total"], "clpetp_YOY_AbsChange": r["clpetp_YOY_TotalChange"],
                    "clpetp_Qtr_mtype": r["clpetp_Qtr_Total"], "clpetp_Qtr_AbsChange": r["clpetp_Qtr_TotalChange"],
                    "clpetp_YOY_Total": r["clpetp_YOY_Total"], "clpetp_YOY_TotalChange": r["clpetp_YOY_TotalChange"],
                    "clpetp_Qtr_Total": r["clpetp_Qtr_Total"], "clpetp_Qtr_TotalChange": r["clpetp_Qtr_TotalChange"],
                    "Region": TOTAL, "Date_Qtr": label(yr, qtr)})
    return out


def _region_emp(facts, compat):
    return series_table(sums(facts, ["Region", "yr", "qtr"], "emp"), 1, "clprte",
                        {"YOY": "clprte_YOY_byRegion", "Qtr": "clprte_Qtr_byRegion"},
                        {"YOY": "clprte_YOY_AbsChange", "Qtr": "clprte_Qtr_AbsChange"},
                        scope="global" if compat else "series")


_REGION_COLS = ["clprte", "clprte_YOY_byRegion", "clprte_YOY_AbsChange", "clprte_Qtr_byRegion",
                "clprte_Qtr_AbsChange"]


def employment_by_county(facts, region, compat=True):
    cty = series_table(sums(facts, ["county", "yr", "qtr"], "emp"), 1, "clpcte",
                       {"YOY": "clpcte_YOY_County", "Qtr": "clpcte_Qtr_County"},
                       {"YOY": "clpcte_YOY_AbsChange", "Qtr": "clpcte_Qtr_AbsChange"},
                       scope="global" if compat else "series")
    out = []
    for r in cty:
        c, yr, qtr = r["key"]
        name, extra = _names(c, compat)
        row = {"FIPS_CNTY_NM": name, "CAL_YR": yr, "CAL_QTR": qtr, "Region": region.get(c), **extra,
               **{k: None for k in _REGION_COLS}}
        for k in ("clpcte", "clpcte_YOY_County", "clpcte_YOY_AbsChange", "clpcte_Qtr_County",
                  "clpcte_Qtr_AbsChange"):
            row[k] = bf(r[k], None)
        row["Date_Qtr"] = label(yr, qtr)
        out.append(row)
    for r in _region_emp(facts, compat):
        reg, yr, qtr = r["key"]
        row = {"FIPS_CNTY_NM": reg, "CAL_YR": yr, "CAL_QTR": qtr, "Region": reg,
               **({"county_name_check": None} if compat else {}), **{k: r[k] for k in _REGION_COLS},
               "clpcte": r["clprte"], "clpcte_YOY_County": r["clprte_YOY_byRegion"],
               "clpcte_YOY_AbsChange": r["clprte_YOY_AbsChange"], "clpcte_Qtr_County": r["clprte_Qtr_byRegion"],
               "clpcte_Qtr_AbsChange": r["clprte_Qtr_AbsChange"], "Date_Qtr": label(yr, qtr)}
        out.append(row)
    return out


def employment_by_region(facts, compat=True):
    out = []
    for r in _region_emp(facts, compat):
        reg, yr, qtr = r["key"]
        out.append({"Region": reg, "CAL_YR": yr, "CAL_QTR": qtr,
                    **{k: bf(r[k], None) if k != "clprte" else r[k] for k in _REGION_COLS},
                    "clpetp": None, "clpetp_YOY_Total": None, "clpetp_YOY_TotalChange": None,
                    "clpetp_Qtr_Total": None, "clpetp_Qtr_TotalChange": None, "mtype": None,
                    "Date_Qtr": label(yr, qtr)})
    for r in _emp_total(facts):
        yr, qtr = r["key"]
        out.append({"Region": TOTAL, "CAL_YR": yr, "CAL_QTR": qtr, "clprte": r["clpetp"],
                    "clprte_YOY_byRegion": r["clpetp_YOY_Total"], "clprte_YOY_AbsChange": None,
                    "clprte_Qtr_byRegion": r["clpetp_Qtr_Total"], "clprte_Qtr_AbsChange": None,
                    "clpetp": r["clpetp"], "clpetp_YOY_Total": r["clpetp_YOY_Total"],
                    "clpetp_YOY_TotalChange": r["clpetp_YOY_TotalChange"], "clpetp_Qtr_Total": r["clpetp_Qtr_Total"],
                    "clpetp_Qtr_TotalChange": r["clpetp_Qtr_TotalChange"], "mtype": TOTAL,
                    "Date_Qtr": label(yr, qtr)})
    return out


def normalise(rows: list[dict]) -> list[tuple]:
    def val(v):
        if isinstance(v, float):
            if math.isnan(v):
                return "nan"
            return round(v, 9)
        return v
    return sorted((tuple(sorted((k, val(v)) for k, v in r.items())) for r in rows), key=repr)
