"""Quarterly mine production and employment: enriched facts and growth tables.

Tables (see README for the mapping):
  enrich_facts            P1  facts = production x mines, coal only, county region and mine type
  production_by_region    P2  region series + Total series, YoY / QoQ growth
  production_by_mtype     P3  mine-type series + Total
  production_region_pages P4/P5  mine type + Total inside each region, all regions in one pass
  production_by_county    P6  county series, region looked up, names in sentence case
  employment_by_mtype     P7  mine-type series + Total with absolute changes
  employment_by_county    P8  county rows and region rows in one table
  employment_by_region    P9  region rows + Total

All tables derive from ``period_cube``: one scan of the facts summed to
(region, mine type, county, year, quarter).  Sums are additive, so every table
re-aggregates this small cube instead of re-reading the facts.

``compat=True`` reproduces the published tables literally: lags of four tables
run across series boundaries (they were computed after ``ungroup()``), and only
"Mclean" is fixed, with a boolean check column where the second fix was written
as a comparison.  ``compat=False`` (the default) lags within each series and
fixes both names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.labels import quarter_end_label, safe_double
from panelspark.functions.missing import sum_skip_missing
from panelspark.functions.text import paste, sentence_case
from panelspark.operators.aggregate import IS_TOTAL, TOTAL, with_totals
from panelspark.operators.frames import DEFAULT_BROADCAST_ROWS, backfill_columns
from panelspark.operators.skew import lookup_join, merge_keep_left
from panelspark.operators.growth import growth

# County names whose capitalisation is not sentence case.
NAME_EXCEPTIONS = {"Mclean": "McLean", "Mccreary": "McCreary"}
COMPAT_CHECK_COL = "county_name_check"


@dataclass(frozen=True)
class MineCols:
    """Column names of the facts; override to run the tables on other inputs."""
    mine_id: str = "MINE_ID"
    year: str = "CAL_YR"
    quarter: str = "CAL_QTR"
    production: str = "COAL_PRODUCTION"
    employment: str = "AVG_EMPLOYEE_CNT"
    region: str = "Region"
    mtype: str = "mtype"
    county: str = "FIPS_CNTY_NM"
    state: str = "STATE"
    coal_flag: str = "COAL_METAL_IND"
    subunit: str = "SUBUNIT_CD"
    lookup_county: str = "county"
    date_label: str = "Date_Qtr"
    # Sum measures exactly in units of 10^-exact_scale (order-independent); None sums doubles.
    exact_scale: int | None = None


DEFAULT = MineCols()
PROD = "_prod"
EMP = "_emp"


# ---------------------------------------------------------------- P1: facts

def enrich_facts(production: DataFrame, mines: DataFrame, county_lookup: DataFrame,
                 mtype_lookup: DataFrame, c: MineCols = DEFAULT) -> DataFrame:
    """Join production with mines (left columns win), keep coal, add region and mine type.

    Mines without a county or mine type in the lookups are dropped (inner joins),
    so every "Total" later is a total over matched mines.  Measures and period
    keys are cast from text; unparsable values become NULL.
    """
    # One row per mine: broadcast after a size check, else a shuffle join on MINE_ID.
    facts = merge_keep_left(production, mines, [c.mine_id], "inner", max_broadcast_rows=DEFAULT_BROADCAST_ROWS)
    facts = facts.where(F.col(c.coal_flag) == "C")
    facts = facts.withColumn("Date_qtr", paste("-", c.year, c.quarter))
    facts = lookup_join(facts, county_lookup, c.county, c.lookup_county, "inner", normalize="lower")
    facts = lookup_join(facts, mtype_lookup, c.subunit, c.subunit, "inner")
    return facts.withColumns({
        c.production: safe_double(c.production),
        c.employment: safe_double(c.employment),
        c.year: safe_double(c.year).cast("int"),
        c.quarter: safe_double(c.quarter).cast("int"),
    })


def state_subset(facts: DataFrame, state: str = "KY", c: MineCols = DEFAULT) -> DataFrame:
    return facts.where(F.col(c.state) == state)


def period_cube(facts: DataFrame, c: MineCols = DEFAULT) -> DataFrame:
    """One row per (region, mine type, county, year, quarter) with NA-safe sums."""
    return facts.groupBy(c.region, c.mtype, c.county, c.year, c.quarter).agg(
        sum_skip_missing(c.production, c.exact_scale).alias(PROD),
        sum_skip_missing(c.employment, c.exact_scale).alias(EMP))


# ---------------------------------------------------------------- helpers

def _period(c: MineCols) -> list[str]:
    return [c.year, c.quarter]


def _rates(prefix: str, tag: str, with_change: bool, change_tag: str = "AbsChange") -> dict:
    rates = {f"{prefix}_YOY_{tag}": 4, f"{prefix}_Qtr_{tag}": 1}
    changes = {f"{prefix}_YOY_{change_tag}": 4, f"{prefix}_Qtr_{change_tag}": 1} if with_change else {}
    return {"rates": rates, "changes": changes}


def _label(df: DataFrame, c: MineCols) -> DataFrame:
    return df.withColumn(c.date_label, quarter_end_label(c.year, c.quarter))


def _series_and_total(cube: DataFrame, c: MineCols, dim: str, measure: str, value: str,
                      detail: dict, total: dict, detail_scope: str, outer: tuple[str, ...] = (),
                      total_labels: dict[str, str] | None = None,
                      value_names: tuple[str, str] | None = None) -> DataFrame:
    """Detail rows per dim and one Total series per outer key, from one grouping-sets pass.

    ``detail``/``total`` name the growth columns: {"rates": {name: n}, "changes": {name: n}}.
    A detail column is NULL on total rows and the other way round, as after stacking
    the two tables.  With per-series detail lags, detail and total series share one
    window (partitioned by the total flag and the dimension), so the facts are read
    once.  Lags across detail series use one global row index that restarts
    between the detail and the Total rows.  ``total_labels`` sets label columns on
    total rows (NULL on detail rows).  ``value_names`` splits the summed value into
    a detail column and a total column (each NULL on the other rows).
    """
    agg = with_totals(cube, dim, _period(c), {value: measure}, outer=list(outer), keep_flag=True,
                      exact_scale=c.exact_scale)
    generic = {"rates": {f"_r{n}": n for n in (4, 1)}, "changes": {f"_c{n}": n for n in (4, 1)}}
    if detail_scope == "series":
        g = growth(agg, value, [*outer, IS_TOTAL, dim], _period(c), **generic)
    elif not outer:
        # Detail rows concatenated across dims, Total rows their own series: one
        # global index ordered by (total flag, dim, period), restarting at the flag.
        g = growth(agg, value, [dim], _period(c), scope=detail_scope, restart=[IS_TOTAL], **generic)
    else:
        d = growth(agg.where(~F.col(IS_TOTAL)), value, [*outer, dim], _period(c), scope=detail_scope, **generic)
        t = growth(agg.where(F.col(IS_TOTAL)), value, [*outer, IS_TOTAL], _period(c), **generic)
        g = d.unionByName(t)
    flag = F.col(IS_TOTAL)
    named = {}
    for names, on in ((detail, ~flag), (total, flag)):
        for kind, prefix in (("rates", "_r"), ("changes", "_c")):
            for name, n in names.get(kind, {}).items():
                named[name] = F.when(on, F.col(f"{prefix}{n}"))
    for col, label in (total_labels or {}).items():
        named[col] = F.when(flag, F.lit(label))
    drop = [IS_TOTAL, *[f"_{k}{n}" for k in "rc" for n in (4, 1)]]
    if value_names:
        named[value_names[0]] = F.when(~flag, F.col(value))
        named[value_names[1]] = F.when(flag, F.col(value))
        drop.append(value)
    return g.withColumns(named).drop(*drop)


def _county_names(df: DataFrame, c: MineCols, compat: bool) -> DataFrame:
    name = F.col(c.county)
    df = df.withColumn(c.county, sentence_case(name))
    if compat:
        df = df.withColumn(c.county, F.when(name == "Mclean", "McLean").otherwise(name))
        fixed = F.when(name == "Mccreary", "McCreary").otherwise(name)
        return df.withColumn(COMPAT_CHECK_COL, name == fixed)
    fixes = F.create_map(*[F.lit(x) for kv in NAME_EXCEPTIONS.items() for x in kv])
    return df.withColumn(c.county, F.coalesce(F.try_element_at(fixes, name), name))


def _scope(compat: bool) -> str:
    return "global" if compat else "series"


# ---------------------------------------------------------------- P2, P3

def production_by_region(cube: DataFrame, c: MineCols = DEFAULT) -> DataFrame:
    v = "clpttp"
    out = _series_and_total(cube, c, c.region, PROD, v, _rates(v, "Region", False),
                            _rates(v, "Total", False), "series", total_labels={c.mtype: TOTAL})
    out = _label(out, c)
    out = backfill_columns(out, {f"{v}_YOY_Region": f"{v}_YOY_Total", f"{v}_Qtr_Region": f"{v}_Qtr_Total"})
    return out.select(c.region, c.year, c.quarter, v, f"{v}_YOY_Region", f"{v}_Qtr_Region",
                      f"{v}_YOY_Total", f"{v}_Qtr_Total", c.mtype, c.date_label)


def production_by_mtype(cube: DataFrame, c: MineCols = DEFAULT) -> DataFrame:
    v = "clpttp"
    out = _series_and_total(cube, c, c.mtype, PROD, v, _rates(v, "Mtype", False),
                            _rates(v, "Total", False), "series", total_labels={c.region: TOTAL})
    out = _label(out, c)
    out = backfill_columns(out, {f"{v}_YOY_Mtype": f"{v}_YOY_Total", f"{v}_Qtr_Mtype": f"{v}_Qtr_Total"})
    return out.select(c.mtype, c.year, c.quarter, v, f"{v}_YOY_Mtype", f"{v}_Qtr_Mtype",
                      f"{v}_YOY_Total", f"{v}_Qtr_Total", c.region, c.date_label)


# ---------------------------------------------------------------- P4, P5

def production_region_pages(cube: DataFrame, c: MineCols = DEFAULT) -> DataFrame:
    """Mine type + Total inside every region, in one pass (grouping sets per region).

    The region-total growth columns are named ``clpttp_YOY_Area``/``clpttp_Qtr_Area``;
    ``region_page`` renames them to the region's name.
    """
    v = "clpttp"
    out = _series_and_total(cube, c, c.mtype, PROD, v, _rates(v, "Mtype", False),
                            _rates(v, "Area", False), "series", outer=(c.region,))
    out = _label(out, c)
    out = backfill_columns(out, {f"{v}_YOY_Mtype": f"{v}_YOY_Area", f"{v}_Qtr_Mtype": f"{v}_Qtr_Area"})
    return out.select(c.region, c.mtype, c.year, c.quarter, v, f"{v}_YOY_Mtype", f"{v}_Qtr_Mtype",
                      f"{v}_YOY_Area", f"{v}_Qtr_Area", c.date_label)


def region_page(pages: DataFrame, region: str, c: MineCols = DEFAULT) -> DataFrame:
    """One region's page: its rows, region column dropped, totals named after it."""
    v = "clpttp"
    return (pages.where(F.col(c.region) == region).drop(c.region)
            .withColumnsRenamed({f"{v}_YOY_Area": f"{v}_YOY_{region}", f"{v}_Qtr_Area": f"{v}_Qtr_{region}"}))


# ---------------------------------------------------------------- P6

GRAIN_COLS = ("_value", "_r4", "_r1", "_c4", "_c1")


def _grain_growth(cube: DataFrame, c: MineCols, measure: str, grains: dict[str, str], compat: bool,
                  with_change: bool) -> DataFrame:
    """Sums per (key, period) for each grain (e.g. county, region), with lags 4 and 1.

    Returns one frame with ``_grain``, ``_key``, the period, ``_value`` and the
    generic ``_r4``/``_r1`` rates (``_c4``/``_c1`` changes).  All grains come from one
    GROUPING SETS pass and share one window per series.  Lags across series
    (compat) run in one global row index that restarts at the grain.
    """
    rates = {"rates": {"_r4": 4, "_r1": 1}, "changes": {"_c4": 4, "_c1": 1} if with_change else {}}
    period = _period(c)
    agg = cube.groupingSets([[key, *period] for key in grains.values()], *grains.values(), *period).agg(
        sum_skip_missing(measure, c.exact_scale).alias("_value"),
        *[F.grouping(key).alias(f"_in_{g}") for g, key in grains.items()])
    name, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for g, col in grains.items():           # grouping() is 0 on the rows of the key's own set
        name = F.when(F.col(f"_in_{g}") == 0, F.lit(g)).otherwise(name)
        key = F.when(F.col(f"_in_{g}") == 0, F.col(col)).otherwise(key)
    stacked = agg.select(name.alias("_grain"), key.alias("_key"), *period, "_value")
    if compat:
        return growth(stacked, "_value", ["_key"], period, scope="global", restart=["_grain"], **rates)
    return growth(stacked, "_value", ["_grain", "_key"], period, **rates)


def _named(df: DataFrame, value: str, tag: str, with_change: bool, change_tag: str = "AbsChange") -> DataFrame:
    """Give the generic growth columns of ``_grain_growth`` their published names."""
    names = {"_value": value, "_r4": f"{value}_YOY_{tag}", "_r1": f"{value}_Qtr_{tag}"}
    if with_change:
        names.update({"_c4": f"{value}_YOY_{change_tag}", "_c1": f"{value}_Qtr_{change_tag}"})
    return df.withColumnsRenamed(names)


def _county_rows(g: DataFrame, c: MineCols, county_lookup: DataFrame, compat: bool) -> DataFrame:
    g = lookup_join(g, county_lookup, c.county, c.lookup_county, "left")
    return _county_names(g, c, compat)


def production_by_county(cube: DataFrame, county_lookup: DataFrame, c: MineCols = DEFAULT,
                         compat: bool = False) -> DataFrame:
    v = "clpctp"
    grown = _grain_growth(cube, c, PROD, {"county": c.county}, compat, False)
    county = _named(grown.drop("_grain").withColumnRenamed("_key", c.county), v, "County", False)
    out = _label(_county_rows(county, c, county_lookup, compat), c)
    extra = [COMPAT_CHECK_COL] if compat else []
    look = [x for x in out.columns if x not in (c.county, c.year, c.quarter, v, f"{v}_YOY_County",
                                                 f"{v}_Qtr_County", c.date_label, *extra)]
    return out.select(c.county, c.year, c.quarter, v, f"{v}_YOY_County", f"{v}_Qtr_County",
                      *look, *extra, c.date_label)


# ---------------------------------------------------------------- P7

def employment_by_mtype(cube: DataFrame, c: MineCols = DEFAULT, compat: bool = False) -> DataFrame:
    v = "clpetp"
    out = _series_and_total(cube, c, c.mtype, EMP, v, _rates(v, "mtype", True),
                            _rates(v, "Total", True, "TotalChange"), _scope(compat),
                            total_labels={c.region: TOTAL})
    out = _label(out, c)
    out = backfill_columns(out, {
        f"{v}_YOY_mtype": f"{v}_YOY_Total", f"{v}_Qtr_mtype": f"{v}_Qtr_Total",
        f"{v}_YOY_AbsChange": f"{v}_YOY_TotalChange", f"{v}_Qtr_AbsChange": f"{v}_Qtr_TotalChange"})
    return out.select(c.mtype, c.year, c.quarter, v, f"{v}_YOY_mtype", f"{v}_YOY_AbsChange",
                      f"{v}_Qtr_mtype", f"{v}_Qtr_AbsChange", f"{v}_YOY_Total", f"{v}_YOY_TotalChange",
                      f"{v}_Qtr_Total", f"{v}_Qtr_TotalChange", c.region, c.date_label)


# ---------------------------------------------------------------- P8, P9

def employment_by_county(cube: DataFrame, county_lookup: DataFrame, c: MineCols = DEFAULT,
                         compat: bool = False) -> DataFrame:
    """County rows and region rows in one table; county cells backfilled from the region ones.

    Both grains come from one pass over the cube and one window (or, with lags
    across series, one global index); the columns of the other grain are NULL.
    """
    v, r = "clpcte", "clprte"
    g = _grain_growth(cube, c, EMP, {"county": c.county, "region": c.region}, compat, True)
    of_county, key = F.col("_grain") == "county", F.col("_key")
    rows = g.withColumn(c.county, F.when(of_county, key))       # NULL meets no lookup row
    rows = _county_rows(rows, c, county_lookup, compat)
    shown = {"_value": (v, r), "_r4": (f"{v}_YOY_County", f"{r}_YOY_byRegion"), "_c4": (f"{v}_YOY_AbsChange", f"{r}_YOY_AbsChange"),
             "_r1": (f"{v}_Qtr_County", f"{r}_Qtr_byRegion"), "_c1": (f"{v}_Qtr_AbsChange", f"{r}_Qtr_AbsChange")}
    named = {}
    for col, (mine, other) in shown.items():
        named[mine] = F.when(of_county, F.col(col))
        named[other] = F.when(~of_county, F.col(col))
    look = [x for x in rows.columns if x not in (c.county, c.year, c.quarter, "_grain", "_key", *shown)]
    region = F.when(of_county, F.col(c.region)).otherwise(key) if c.region in look else F.when(~of_county, key)
    named[c.region] = region
    rows = rows.withColumns(named)
    rest = [*look, *([] if c.region in look else [c.region])]
    out = rows.select(c.county, c.year, c.quarter, v, f"{v}_YOY_County", f"{v}_YOY_AbsChange", f"{v}_Qtr_County",
                      f"{v}_Qtr_AbsChange", *rest, r, f"{r}_YOY_byRegion", f"{r}_YOY_AbsChange", f"{r}_Qtr_byRegion",
                      f"{r}_Qtr_AbsChange")
    out = backfill_columns(out, {
        f"{v}_YOY_County": f"{r}_YOY_byRegion", f"{v}_Qtr_County": f"{r}_Qtr_byRegion",
        f"{v}_YOY_AbsChange": f"{r}_YOY_AbsChange", f"{v}_Qtr_AbsChange": f"{r}_Qtr_AbsChange",
        v: r, c.county: c.region})
    return _label(out, c)


def employment_by_region(cube: DataFrame, c: MineCols = DEFAULT, compat: bool = False) -> DataFrame:
    """Region rows + the Total series; the absolute changes are not backfilled.

    Region and total rows come from one grouping-sets pass and are lagged
    together: one window per series, or (compat) one global row index that
    restarts between the region and the total rows.
    """
    v, r = "clpetp", "clprte"
    out = _series_and_total(cube, c, c.region, EMP, "_value", _rates(r, "byRegion", True),
                            _rates(v, "Total", True, "TotalChange"), _scope(compat),
                            total_labels={c.mtype: TOTAL}, value_names=(r, v))
    out = _label(out, c)
    out = backfill_columns(out, {f"{r}_YOY_byRegion": f"{v}_YOY_Total", f"{r}_Qtr_byRegion": f"{v}_Qtr_Total",
                                 r: v})
    return out.select(c.region, c.year, c.quarter, r, f"{r}_YOY_byRegion", f"{r}_YOY_AbsChange",
                      f"{r}_Qtr_byRegion", f"{r}_Qtr_AbsChange", v, f"{v}_YOY_Total",
                      f"{v}_YOY_TotalChange", f"{v}_Qtr_Total", f"{v}_Qtr_TotalChange", c.mtype, c.date_label)


# ---------------------------------------------------------------- all tables

def growth_tables(facts: DataFrame, county_lookup: DataFrame, c: MineCols = DEFAULT,
                  compat: bool = False, regions: tuple[str, ...] = ("East", "West")) -> dict[str, DataFrame]:
    """Every growth table from one scan of the facts.

    The cube is checkpointed to the session's reliable checkpoint folder, so the
    eight tables read it instead of re-scanning the facts, and a lost executor
    does not force the scan to run again.
    """
    cube = period_cube(facts, c).checkpoint(eager=True)
    pages = production_region_pages(cube, c)
    out = {
        "production_by_region": production_by_region(cube, c),
        "production_by_mtype": production_by_mtype(cube, c),
        "production_by_county": production_by_county(cube, county_lookup, c, compat),
        "employment_by_mtype": employment_by_mtype(cube, c, compat),
        "employment_by_county": employment_by_county(cube, county_lookup, c, compat),
        "employment_by_region": employment_by_region(cube, c, compat),
    }
    for r in regions:
        out[f"production_page_{r.lower()}"] = region_page(pages, r, c)
    return out
