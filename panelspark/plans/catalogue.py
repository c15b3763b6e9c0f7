"""Queries over the driver tables, one per operator, each with an independent SQL oracle.

Analogies used to run the operators on the driver's star schema:
  production facts  = lineitem (l_extendedprice as production, l_quantity as employment)
  region / county   = r_name / n_name of the supplier's nation
  mine type         = l_returnflag
  period            = year and quarter of l_shipdate

Every query reads whole tables.  Money is summed exactly on both sides (whole cents
in a BIGINT in Spark, DECIMAL(18,2) in the oracle), so the Spark result and the
oracle agree to the last bit whatever the order of partial sums.  The oracles are
written in the original, literal style (separate aggregates stacked with UNION,
CASE backfills, plain windows), so they check the one-pass Spark plans rather than
mirror them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import (extract_first, if_else, month_label, paste,
                                  quarter_end_label, quarter_label, recode, remove_all, remove_first,
                                  safe_double, sentence_case, substr_between, trim_space, unify)
from panelspark.functions.missing import nan, sum_skip_missing
from panelspark.operators.frames import DEFAULT_BROADCAST_ROWS
from panelspark.operators import (detail_plus_total, drop_matching, duplicate_keys, explode_pairs,
                                  fill_zero, fits_broadcast, growth, join_panels, lookup_join, map_distinct, merge_keep_left,
                                  cells_to_rows, pivot_cells, pivot_sum, pivot_wide, rename_matching, rename_strict, rollup_period, row_sum, select_prefix,
                                  sized_join, split_column, sum_by_period, union_by_name, with_columns_chained,
                                  with_global_index, with_totals)
from panelspark.plans import energy_panel, mining
from panelspark.sources import (CORRUPT, contiguous_year_prefix, matrix_rows, parse_delimited, parse_series, sheet_rows,
                                tag_source)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ shared inputs

def geography(spark: SparkSession, d: str) -> DataFrame:
    """nation -> (n_nationkey, n_name, r_name); Spark broadcasts the small files by their size."""
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return nation.join(region, "n_regionkey").drop("n_regionkey")


def facts(spark: SparkSession, d: str, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Line items placed by their supplier's nation and region.

    When the supplier -> nation -> region map passes the broadcast size check,
    line items join it by broadcast and every later sum is a single aggregation.
    Beyond the bound (a supplier table that grows with the data), line items are
    first summed per (supplier, flag, year, quarter): the shuffle join then sees
    one row per supplier and period instead of one per line item, and a supplier
    holding a third of all rows is combined map-side before any shuffle.  Both
    plans give the same sums (exact: money is summed in whole cents).
    """
    li = table(spark, d, "lineitem").select(
        "l_suppkey", "l_returnflag",
        F.year("l_shipdate").cast("int").alias("yr"), F.quarter("l_shipdate").cast("int").alias("qtr"),
        F.col("l_extendedprice").alias("prod"), F.col("l_quantity").alias("emp"))
    placed = supplier_places(spark, d)
    if fits_broadcast(placed, max_broadcast_rows):
        return li.join(F.broadcast(placed), "l_suppkey").drop("l_suppkey")
    pre = li.groupBy("l_suppkey", "l_returnflag", "yr", "qtr").agg(
        sum_skip_missing("prod", 2).alias("prod"), sum_skip_missing("emp", 2).alias("emp"))
    return pre.join(placed, "l_suppkey").drop("l_suppkey")


def supplier_places(spark: SparkSession, d: str) -> DataFrame:
    """supplier -> (n_name, r_name, county): the map that places line items."""
    sup = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                             F.col("s_nationkey").alias("n_nationkey"))
    placed = sup.join(geography(spark, d), "n_nationkey").drop("n_nationkey")
    return placed.withColumn("county", F.lower("n_name"))


MINE = mining.MineCols(year="yr", quarter="qtr", production="prod", employment="emp", region="r_name",
                       mtype="l_returnflag", county="county", lookup_county="county", date_label="date_qtr",
                       exact_scale=2)


def county_lookup(spark: SparkSession, d: str) -> DataFrame:
    return geography(spark, d).select(F.lower("n_name").alias("county"), "r_name")


def cube(spark: SparkSession, d: str) -> DataFrame:
    return mining.period_cube(facts(spark, d), MINE)


FACTS_SQL = """
WITH li AS (
  SELECT l_suppkey, l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS yr,
         CAST(quarter(l_shipdate) AS INTEGER) AS qtr,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS prod, CAST(l_quantity AS DECIMAL(18,2)) AS emp
  FROM lineitem),
facts AS (
  SELECT li.*, n.n_name, lower(n.n_name) AS county, r.r_name
  FROM li JOIN supplier s ON li.l_suppkey = s.s_suppkey
          JOIN nation n ON s.s_nationkey = n.n_nationkey
          JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


def _sum(col: str) -> str:
    return f"CAST(COALESCE(SUM({col}), 0) AS DOUBLE)"


def _g(x: str, n: int, w: str) -> str:
    return f"({x} - lag({x}, {n}) OVER {w}) / lag({x}, {n}) OVER {w}"


def _c(x: str, n: int, w: str) -> str:
    return f"{x} - lag({x}, {n}) OVER {w}"


def _bf(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NULL OR isnan({a}) THEN {b} ELSE {a} END"


# ------------------------------------------------------------------ aggregation

@register("sum_by_period", FACTS_SQL + f"""
SELECT r_name, yr, qtr, {_sum('prod')} AS production FROM facts GROUP BY r_name, yr, qtr""")
def q_sum_by_period(spark, d):
    return sum_by_period(facts(spark, d), ["r_name", "yr", "qtr"], {"production": "prod"}, exact_scale=2)


@register("sum_na_rm", f"""
SELECT l_discount, {_sum('CAST(CASE WHEN isnan(v) THEN NULL ELSE v END AS DECIMAL(18,2))')} AS disc_sum,
       COUNT(*) AS n_rows
FROM (SELECT l_discount,
             CASE WHEN l_linenumber = 1 THEN CAST('nan' AS DOUBLE) ELSE nullif(l_discount, 0) END AS v
      FROM lineitem)
GROUP BY l_discount""")
def q_sum_na_rm(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_discount",
        F.when(F.col("l_linenumber") == 1, nan()).otherwise(F.nullif("l_discount", F.lit(0.0))).alias("v"))
    return li.groupBy("l_discount").agg(sum_skip_missing("v", 2).alias("disc_sum"),
                                        F.count(F.lit(1)).alias("n_rows"))


@register("exact_sums_any_scale", """
SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 1048576 AS small,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) * 1099511627776 AS large
FROM lineitem GROUP BY 1, 2""")
def q_exact_sums_any_scale(spark, d):
    """Small values between large ones that cancel: exact whatever the order (a plain double sum loses the small ones) (AGG-1)."""
    li = table(spark, d, "lineitem").select("l_returnflag", F.year("l_shipdate").cast("int").alias("yr"), "l_quantity", "l_extendedprice")
    noise = F.col("l_extendedprice") * 1e25
    rows = li.withColumn("small", F.explode(F.array(noise, F.col("l_quantity") / 1048576, -noise, nan(), F.lit(None).cast("double"))))
    return sum_by_period(rows.withColumn("large", F.when(~F.isnan("small") & (F.abs("small") < 1e9), F.col("l_quantity") * 1099511627776.0)),
                         ["l_returnflag", "yr"], {"small": "small", "large": "large"}, exact_scale="any")


@register("grouping_sets_totals", FACTS_SQL + f"""
SELECT CASE WHEN grouping(r_name) = 1 THEN 'Total' ELSE r_name END AS r_name, yr, qtr,
       {_sum('prod')} AS production
FROM facts GROUP BY GROUPING SETS ((r_name, yr, qtr), (yr, qtr))""")
def q_grouping_sets_totals(spark, d):
    return with_totals(facts(spark, d), "r_name", ["yr", "qtr"], {"production": "prod"}, exact_scale=2)


@register("grouping_sets_subset", FACTS_SQL + f"""
SELECT r_name, l_returnflag, yr, qtr, {_sum('prod')} AS production FROM facts
GROUP BY r_name, l_returnflag, yr, qtr
UNION ALL
SELECT r_name, 'Total' AS l_returnflag, yr, qtr, {_sum('prod')} AS production FROM facts
GROUP BY r_name, yr, qtr""")
def q_grouping_sets_subset(spark, d):
    return with_totals(facts(spark, d), "l_returnflag", ["yr", "qtr"], {"production": "prod"},
                       outer=["r_name"], exact_scale=2)


@register("detail_plus_total", FACTS_SQL + f"""
SELECT r_name, yr, qtr, {_sum('prod')} AS production FROM facts GROUP BY r_name, yr, qtr
UNION ALL
SELECT 'Total' AS r_name, yr, qtr, {_sum('prod')} AS production FROM facts GROUP BY yr, qtr""")
def q_detail_plus_total(spark, d):
    return detail_plus_total(facts(spark, d), "r_name", ["yr", "qtr"], {"production": "prod"}, exact_scale=2)


@register("monthly_to_annual", f"""
WITH m AS (
  SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(month(l_shipdate) AS INTEGER) AS mo,
         {_sum('CAST(l_quantity AS DECIMAL(18,2))')} AS quantity
  FROM lineitem GROUP BY 1, 2, 3)
SELECT l_returnflag, yr, {_sum('CAST(quantity AS DECIMAL(18,2))')} AS quantity, COUNT(*) AS n_fine
FROM m GROUP BY l_returnflag, yr""")
def q_monthly_to_annual(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_returnflag", F.year("l_shipdate").cast("int").alias("yr"),
        F.month("l_shipdate").cast("int").alias("mo"), "l_quantity")
    return rollup_period(li, ["l_returnflag"], ["yr", "mo"], ["yr"], {"quantity": "l_quantity"}, exact_scale=2)


# ------------------------------------------------------------------ growth

@register("growth_yoy_qoq", FACTS_SQL + f"""
, s AS (SELECT r_name, yr, qtr, {_sum('prod')} AS production FROM facts GROUP BY r_name, yr, qtr)
SELECT r_name, yr, qtr, production,
       {_g('production', 4, 'w')} AS production_yoy, {_g('production', 1, 'w')} AS production_qoq
FROM s WINDOW w AS (PARTITION BY r_name ORDER BY yr, qtr)""")
def q_growth_yoy_qoq(spark, d):
    """Positional lag within each region's series."""
    s = sum_by_period(facts(spark, d), ["r_name", "yr", "qtr"], {"production": "prod"}, exact_scale=2)
    return growth(s, "production", ["r_name"], ["yr", "qtr"],
                  rates={"production_yoy": 4, "production_qoq": 1})


@register("growth_total", FACTS_SQL + f"""
, s AS (SELECT yr, qtr, {_sum('prod')} AS production FROM facts GROUP BY yr, qtr)
SELECT yr, qtr, production, {_g('production', 4, 'w')} AS production_yoy_total,
       {_g('production', 1, 'w')} AS production_qoq_total
FROM s WINDOW w AS (ORDER BY yr, qtr)""")
def q_growth_total(spark, d):
    """One series with one row per period: the window holds as many rows as there are quarters."""
    s = sum_by_period(facts(spark, d), ["yr", "qtr"], {"production": "prod"}, exact_scale=2)
    return growth(s, "production", [], ["yr", "qtr"],
                  rates={"production_yoy_total": 4, "production_qoq_total": 1})


@register("growth_global_order", FACTS_SQL + f"""
, s AS (SELECT n_name, yr, qtr, {_sum('emp')} AS employment FROM facts GROUP BY n_name, yr, qtr)
SELECT n_name, yr, qtr, employment,
       {_g('employment', 4, 'w')} AS employment_yoy, {_c('employment', 4, 'w')} AS employment_yoy_change,
       {_g('employment', 1, 'w')} AS employment_qoq, {_c('employment', 1, 'w')} AS employment_qoq_change
FROM s WINDOW w AS (ORDER BY n_name, yr, qtr)""")
def q_growth_global_order(spark, d):
    """Lag over all nation series concatenated (the published county tables do this)."""
    s = sum_by_period(facts(spark, d), ["n_name", "yr", "qtr"], {"employment": "emp"}, exact_scale=2)
    return growth(s, "employment", ["n_name"], ["yr", "qtr"], scope="global",
                  rates={"employment_yoy": 4, "employment_qoq": 1},
                  changes={"employment_yoy_change": 4, "employment_qoq_change": 1})


@register("absolute_change", FACTS_SQL + f"""
, s AS (SELECT l_returnflag, yr, qtr, {_sum('emp')} AS employment FROM facts GROUP BY l_returnflag, yr, qtr)
SELECT l_returnflag, yr, qtr, employment, {_c('employment', 4, 'w')} AS employment_yoy_change,
       {_c('employment', 1, 'w')} AS employment_qoq_change
FROM s WINDOW w AS (PARTITION BY l_returnflag ORDER BY yr, qtr)""")
def q_absolute_change(spark, d):
    s = sum_by_period(facts(spark, d), ["l_returnflag", "yr", "qtr"], {"employment": "emp"}, exact_scale=2)
    return growth(s, "employment", ["l_returnflag"], ["yr", "qtr"],
                  changes={"employment_yoy_change": 4, "employment_qoq_change": 1})


_ZERO_SQL = """CASE WHEN qtr = 2 AND (yr % 2 = 0 OR r_name = 'AFRICA') THEN 0.0
            WHEN qtr = 3 AND yr = 1999 AND r_name = 'AFRICA' THEN -production
            ELSE production END"""


def _zeroed(df: DataFrame, col: str) -> DataFrame:
    r, y, q, v = F.col("r_name"), F.col("yr"), F.col("qtr"), F.col(col)
    return df.withColumn(col, F.when((q == 2) & ((y % 2 == 0) | (r == "AFRICA")), F.lit(0.0))
                         .when((q == 3) & (y == 1999) & (r == "AFRICA"), -v).otherwise(v))


@register("growth_zero_base", FACTS_SQL + f"""
, s0 AS (SELECT r_name, yr, qtr, {_sum('prod')} AS production FROM facts GROUP BY r_name, yr, qtr),
s AS (SELECT r_name, yr, qtr, {_ZERO_SQL} AS production FROM s0)
SELECT r_name, yr, qtr, production, {_g('production', 4, 'w')} AS production_yoy,
       {_g('production', 1, 'w')} AS production_qoq,
       CASE WHEN lag(production, 1) OVER w = 0 THEN NULL ELSE {_g('production', 1, 'w')} END AS production_qoq_null
FROM s WINDOW w AS (PARTITION BY r_name ORDER BY yr, qtr)""")
def q_growth_zero_base(spark, d):
    """Zero bases give +Inf, -Inf and NaN (IEEE) by default; NULL with zero_base='null'."""
    s = _zeroed(sum_by_period(facts(spark, d), ["r_name", "yr", "qtr"], {"production": "prod"}, exact_scale=2),
                "production")
    g = growth(s, "production", ["r_name"], ["yr", "qtr"], rates={"production_yoy": 4, "production_qoq": 1})
    return growth(g, "production", ["r_name"], ["yr", "qtr"], rates={"production_qoq_null": 1}, zero_base="null")


# ------------------------------------------------------------------ the published growth tables

_CUBE_SQL = FACTS_SQL + """
, cube AS (SELECT r_name, l_returnflag, county, yr, qtr, CAST(COALESCE(SUM(prod), 0) AS DOUBLE) AS prod,
                  CAST(COALESCE(SUM(emp), 0) AS DOUBLE) AS emp
           FROM facts GROUP BY r_name, l_returnflag, county, yr, qtr)
"""


def _sum_cube(x: str) -> str:
    return _sum(f"CAST({x} AS DECIMAL(18,2))")


def _label_sql() -> str:
    return "CAST(yr AS VARCHAR) || '-' || CAST(qtr * 3 AS VARCHAR) || '-01'"


def _p2_sql(source: str = "cube", prelude: str = "") -> str:
    return _CUBE_SQL + prelude + f"""
, reg AS (SELECT r_name, yr, qtr, {_sum_cube('prod')} AS clpttp FROM {source} GROUP BY r_name, yr, qtr),
reg_g AS (SELECT *, {_g('clpttp', 4, 'w')} AS clpttp_YOY_Region, {_g('clpttp', 1, 'w')} AS clpttp_Qtr_Region
          FROM reg WINDOW w AS (PARTITION BY r_name ORDER BY yr, qtr)),
tot AS (SELECT yr, qtr, {_sum_cube('prod')} AS clpttp FROM {source} GROUP BY yr, qtr),
tot_g AS (SELECT *, {_g('clpttp', 4, 'w')} AS clpttp_YOY_Total, {_g('clpttp', 1, 'w')} AS clpttp_Qtr_Total,
                 'Total' AS r_name, 'Total' AS l_returnflag
          FROM tot WINDOW w AS (ORDER BY yr, qtr)),
u AS (SELECT * FROM reg_g UNION ALL BY NAME SELECT * FROM tot_g)
SELECT r_name, yr, qtr, clpttp, {_bf('clpttp_YOY_Region', 'clpttp_YOY_Total')} AS clpttp_YOY_Region,
       {_bf('clpttp_Qtr_Region', 'clpttp_Qtr_Total')} AS clpttp_Qtr_Region, clpttp_YOY_Total, clpttp_Qtr_Total,
       l_returnflag, {_label_sql()} AS date_qtr
FROM u"""


@register("mining_production_by_region", _p2_sql())
def q_mining_production_by_region(spark, d):
    """Production by region plus a Total series, growth backfilled from the total."""
    return mining.production_by_region(cube(spark, d), MINE)


_ZERO_CELL_SQL = """
, cubez AS (SELECT * REPLACE (CASE WHEN qtr = 2 AND (yr % 2 = 0 OR r_name = 'AFRICA') THEN 0.0
                                   WHEN qtr = 3 AND yr = 1999 AND r_name = 'AFRICA' THEN -prod
                                   ELSE prod END AS prod) FROM cube)
"""


@register("backfill_coalesce", _p2_sql("cubez", _ZERO_CELL_SQL))
def q_backfill_coalesce(spark, d):
    """P2 with zero bases in the series: NaN cells are backfilled, Inf cells kept."""
    return mining.production_by_region(_zeroed_cube(cube(spark, d)), MINE)


def _zeroed_cube(c: DataFrame) -> DataFrame:
    """Zero (or negate) every cube cell of the chosen (region, period) pairs."""
    r, y, q, v = F.col("r_name"), F.col("yr"), F.col("qtr"), F.col(mining.PROD)
    return c.withColumn(mining.PROD, F.when((q == 2) & ((y % 2 == 0) | (r == "AFRICA")), F.lit(0.0))
                        .when((q == 3) & (y == 1999) & (r == "AFRICA"), -v).otherwise(v))


@register("mining_production_by_mtype", _CUBE_SQL + f"""
, det AS (SELECT l_returnflag, yr, qtr, {_sum_cube('prod')} AS clpttp FROM cube GROUP BY l_returnflag, yr, qtr),
det_g AS (SELECT *, {_g('clpttp', 4, 'w')} AS clpttp_YOY_Mtype, {_g('clpttp', 1, 'w')} AS clpttp_Qtr_Mtype
          FROM det WINDOW w AS (PARTITION BY l_returnflag ORDER BY yr, qtr)),
tot AS (SELECT yr, qtr, {_sum_cube('prod')} AS clpttp FROM cube GROUP BY yr, qtr),
tot_g AS (SELECT *, {_g('clpttp', 4, 'w')} AS clpttp_YOY_Total, {_g('clpttp', 1, 'w')} AS clpttp_Qtr_Total,
                 'Total' AS r_name, 'Total' AS l_returnflag
          FROM tot WINDOW w AS (ORDER BY yr, qtr)),
u AS (SELECT * FROM det_g UNION ALL BY NAME SELECT * FROM tot_g)
SELECT l_returnflag, yr, qtr, clpttp, {_bf('clpttp_YOY_Mtype', 'clpttp_YOY_Total')} AS clpttp_YOY_Mtype,
       {_bf('clpttp_Qtr_Mtype', 'clpttp_Qtr_Total')} AS clpttp_Qtr_Mtype, clpttp_YOY_Total, clpttp_Qtr_Total,
       r_name, {_label_sql()} AS date_qtr
FROM u""")
def q_mining_production_by_mtype(spark, d):
    """Production by mine type plus a Total series."""
    return mining.production_by_mtype(cube(spark, d), MINE)


@register("mining_production_region_pages", _CUBE_SQL + f"""
, det AS (SELECT r_name, l_returnflag, yr, qtr, {_sum_cube('prod')} AS clpttp FROM cube
          GROUP BY r_name, l_returnflag, yr, qtr),
det_g AS (SELECT *, {_g('clpttp', 4, 'w')} AS clpttp_YOY_Mtype, {_g('clpttp', 1, 'w')} AS clpttp_Qtr_Mtype
          FROM det WINDOW w AS (PARTITION BY r_name, l_returnflag ORDER BY yr, qtr)),
tot AS (SELECT r_name, yr, qtr, {_sum_cube('prod')} AS clpttp FROM cube GROUP BY r_name, yr, qtr),
tot_g AS (SELECT *, {_g('clpttp', 4, 'w')} AS clpttp_YOY_Area, {_g('clpttp', 1, 'w')} AS clpttp_Qtr_Area,
                 'Total' AS l_returnflag
          FROM tot WINDOW w AS (PARTITION BY r_name ORDER BY yr, qtr)),
u AS (SELECT * FROM det_g UNION ALL BY NAME SELECT * FROM tot_g)
SELECT r_name, l_returnflag, yr, qtr, clpttp, {_bf('clpttp_YOY_Mtype', 'clpttp_YOY_Area')} AS clpttp_YOY_Mtype,
       {_bf('clpttp_Qtr_Mtype', 'clpttp_Qtr_Area')} AS clpttp_Qtr_Mtype, clpttp_YOY_Area, clpttp_Qtr_Area,
       {_label_sql()} AS date_qtr
FROM u""")
def q_mining_production_region_pages(spark, d):
    """Mine type + Total inside every region, all region pages in one pass."""
    return mining.production_region_pages(cube(spark, d), MINE)


_COUNTY_LOOKUP_SQL = """
, lk AS (SELECT lower(n.n_name) AS county, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


def _sentence(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


@register("mining_production_by_county", _CUBE_SQL + _COUNTY_LOOKUP_SQL + f"""
, cty AS (SELECT county, yr, qtr, {_sum_cube('prod')} AS clpctp FROM cube GROUP BY county, yr, qtr),
g AS (SELECT *, {_g('clpctp', 4, 'w')} AS clpctp_YOY_County, {_g('clpctp', 1, 'w')} AS clpctp_Qtr_County
      FROM cty WINDOW w AS (ORDER BY county, yr, qtr)),
j AS (SELECT g.*, lk.r_name FROM g LEFT JOIN lk ON g.county = lk.county),
p AS (SELECT * REPLACE ({_sentence('county')} AS county) FROM j),
m AS (SELECT * REPLACE (CASE WHEN county = 'Mclean' THEN 'McLean' ELSE county END AS county) FROM p)
SELECT county, yr, qtr, clpctp, clpctp_YOY_County, clpctp_Qtr_County, r_name,
       county = CASE WHEN county = 'Mccreary' THEN 'McCreary' ELSE county END AS {mining.COMPAT_CHECK_COL},
       {_label_sql()} AS date_qtr
FROM m""")
def q_mining_production_by_county(spark, d):
    """County production, lag across county series as published, region looked up."""
    return mining.production_by_county(cube(spark, d), county_lookup(spark, d), MINE, compat=True)


_P7_SQL = _CUBE_SQL + f"""
, det AS (SELECT l_returnflag, yr, qtr, {_sum_cube('emp')} AS clpetp FROM cube GROUP BY l_returnflag, yr, qtr),
det_g AS (SELECT *, {_g('clpetp', 4, 'w')} AS clpetp_YOY_mtype, {_c('clpetp', 4, 'w')} AS clpetp_YOY_AbsChange,
                 {_g('clpetp', 1, 'w')} AS clpetp_Qtr_mtype, {_c('clpetp', 1, 'w')} AS clpetp_Qtr_AbsChange
          FROM det WINDOW w AS (ORDER BY l_returnflag, yr, qtr)),
tot AS (SELECT yr, qtr, {_sum_cube('emp')} AS clpetp FROM cube GROUP BY yr, qtr),
tot_g AS (SELECT *, {_g('clpetp', 4, 'w')} AS clpetp_YOY_Total, {_c('clpetp', 4, 'w')} AS clpetp_YOY_TotalChange,
                 {_g('clpetp', 1, 'w')} AS clpetp_Qtr_Total, {_c('clpetp', 1, 'w')} AS clpetp_Qtr_TotalChange,
                 'Total' AS l_returnflag, 'Total' AS r_name
          FROM tot WINDOW w AS (ORDER BY yr, qtr)),
u AS (SELECT * FROM det_g UNION ALL BY NAME SELECT * FROM tot_g)
SELECT l_returnflag, yr, qtr, clpetp,
       {_bf('clpetp_YOY_mtype', 'clpetp_YOY_Total')} AS clpetp_YOY_mtype,
       {_bf('clpetp_YOY_AbsChange', 'clpetp_YOY_TotalChange')} AS clpetp_YOY_AbsChange,
       {_bf('clpetp_Qtr_mtype', 'clpetp_Qtr_Total')} AS clpetp_Qtr_mtype,
       {_bf('clpetp_Qtr_AbsChange', 'clpetp_Qtr_TotalChange')} AS clpetp_Qtr_AbsChange,
       clpetp_YOY_Total, clpetp_YOY_TotalChange, clpetp_Qtr_Total, clpetp_Qtr_TotalChange, r_name,
       {_label_sql()} AS date_qtr
FROM u"""


@register("mining_employment_by_mtype", _P7_SQL)
def q_mining_employment_by_mtype(spark, d):
    """Employment by mine type (lag across series, as published) plus a Total series."""
    return mining.employment_by_mtype(cube(spark, d), MINE, compat=True)


def _region_emp_sql(window: str) -> str:
    return f"""
, reg AS (SELECT r_name, yr, qtr, {_sum_cube('emp')} AS clprte FROM cube GROUP BY r_name, yr, qtr),
reg_g AS (SELECT *, {_g('clprte', 4, 'w')} AS clprte_YOY_byRegion, {_c('clprte', 4, 'w')} AS clprte_YOY_AbsChange,
                 {_g('clprte', 1, 'w')} AS clprte_Qtr_byRegion, {_c('clprte', 1, 'w')} AS clprte_Qtr_AbsChange
          FROM reg WINDOW w AS ({window}))
"""


def _p8_sql(compat: bool) -> str:
    cty_w = "ORDER BY county, yr, qtr" if compat else "PARTITION BY county ORDER BY yr, qtr"
    reg_w = "ORDER BY r_name, yr, qtr" if compat else "PARTITION BY r_name ORDER BY yr, qtr"
    names = ("SELECT * REPLACE (CASE WHEN county = 'Mclean' THEN 'McLean' ELSE county END AS county), "
             f"county = CASE WHEN county = 'Mccreary' THEN 'McCreary' ELSE county END AS {mining.COMPAT_CHECK_COL}"
             if compat else
             "SELECT * REPLACE (CASE WHEN county = 'Mclean' THEN 'McLean' WHEN county = 'Mccreary' "
             "THEN 'McCreary' ELSE county END AS county)")
    return _CUBE_SQL + _COUNTY_LOOKUP_SQL + _region_emp_sql(reg_w) + f"""
, cty AS (SELECT county, yr, qtr, {_sum_cube('emp')} AS clpcte FROM cube GROUP BY county, yr, qtr),
g AS (SELECT *, {_g('clpcte', 4, 'w')} AS clpcte_YOY_County, {_c('clpcte', 4, 'w')} AS clpcte_YOY_AbsChange,
             {_g('clpcte', 1, 'w')} AS clpcte_Qtr_County, {_c('clpcte', 1, 'w')} AS clpcte_Qtr_AbsChange
      FROM cty WINDOW w AS ({cty_w})),
j AS (SELECT g.*, lk.r_name FROM g LEFT JOIN lk ON g.county = lk.county),
p AS (SELECT * REPLACE ({_sentence('county')} AS county) FROM j),
m AS ({names} FROM p),
u AS (SELECT * FROM m UNION ALL BY NAME SELECT * FROM reg_g),
b AS (SELECT * REPLACE ({_bf('clpcte_YOY_County', 'clprte_YOY_byRegion')} AS clpcte_YOY_County,
                        {_bf('clpcte_Qtr_County', 'clprte_Qtr_byRegion')} AS clpcte_Qtr_County,
                        {_bf('clpcte_YOY_AbsChange', 'clprte_YOY_AbsChange')} AS clpcte_YOY_AbsChange,
                        {_bf('clpcte_Qtr_AbsChange', 'clprte_Qtr_AbsChange')} AS clpcte_Qtr_AbsChange,
                        {_bf('clpcte', 'clprte')} AS clpcte,
                        COALESCE(county, r_name) AS county) FROM u)
SELECT *, {_label_sql()} AS date_qtr FROM b"""


@register("mining_employment_by_county", _p8_sql(compat=True))
def q_mining_employment_by_county(spark, d):
    """County rows and region rows in one table, county cells backfilled from region ones."""
    return mining.employment_by_county(cube(spark, d), county_lookup(spark, d), MINE, compat=True)


@register("mixed_grain_union", _p8_sql(compat=False))
def q_mixed_grain_union(spark, d):
    """P8 with lags kept inside each series and both name fixes applied."""
    return mining.employment_by_county(cube(spark, d), county_lookup(spark, d), MINE, compat=False)


@register("mining_employment_by_region", _CUBE_SQL + _region_emp_sql("ORDER BY r_name, yr, qtr") + f"""
, tot AS (SELECT yr, qtr, {_sum_cube('emp')} AS clpetp FROM cube GROUP BY yr, qtr),
tot_g AS (SELECT *, {_g('clpetp', 4, 'w')} AS clpetp_YOY_Total, {_c('clpetp', 4, 'w')} AS clpetp_YOY_TotalChange,
                 {_g('clpetp', 1, 'w')} AS clpetp_Qtr_Total, {_c('clpetp', 1, 'w')} AS clpetp_Qtr_TotalChange,
                 'Total' AS l_returnflag, 'Total' AS r_name
          FROM tot WINDOW w AS (ORDER BY yr, qtr)),
u AS (SELECT * FROM reg_g UNION ALL BY NAME SELECT * FROM tot_g)
SELECT * REPLACE ({_bf('clprte_YOY_byRegion', 'clpetp_YOY_Total')} AS clprte_YOY_byRegion,
                  {_bf('clprte_Qtr_byRegion', 'clpetp_Qtr_Total')} AS clprte_Qtr_byRegion,
                  {_bf('clprte', 'clpetp')} AS clprte),
       {_label_sql()} AS date_qtr
FROM u""")
def q_mining_employment_by_region(spark, d):
    """Region employment plus the Total series; absolute changes are not backfilled."""
    return mining.employment_by_region(cube(spark, d), MINE, compat=True)


# ------------------------------------------------------------------ sets and reshaping

@register("union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment,
       CAST(NULL AS DOUBLE) AS acctbal, 'customer' AS src FROM customer
UNION ALL
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nationkey, CAST(NULL AS VARCHAR) AS segment,
       s_acctbal AS acctbal, 'supplier' AS src FROM supplier""")
def q_union_by_name(spark, d):
    cust = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("src"))
    sup = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("src"))
    return union_by_name(cust, sup)


def _flag_sum(flag: str, fill: bool) -> str:
    s = f"SUM(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = '{flag}')"
    return f"CAST(COALESCE({s}, 0) AS DOUBLE)" if fill else f"CAST({s} AS DOUBLE)"


@register("pivot_long_to_wide", f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, {_flag_sum('A', False)} AS A, {_flag_sum('N', False)} AS N,
       {_flag_sum('R', False)} AS R, {_flag_sum('X', False)} AS X
FROM lineitem GROUP BY 1""")
def q_pivot_long_to_wide(spark, d):
    """Declared key values, including one (X) absent from the data: its column is all NULL."""
    li = table(spark, d, "lineitem").select(F.year("l_shipdate").cast("int").alias("yr"), "l_returnflag",
                                            "l_quantity")
    long = sum_by_period(li, ["yr", "l_returnflag"], {"quantity": "l_quantity"}, exact_scale=2)
    return pivot_wide(long, "l_returnflag", "quantity", ids=["yr"], values=["A", "N", "R", "X"])


def _order_flags(spark, d) -> DataFrame:
    """Quantity per order and flag, spread wide in one aggregation, absent flags 0."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    wide = pivot_sum(li, "l_returnflag", "l_quantity", ids=["l_orderkey"], values=["A", "N", "R"], exact_scale=2)
    return fill_zero(wide, ["A", "N", "R"])


@register("pivot_fill_zero", f"""
SELECT l_orderkey, {_flag_sum('A', True)} AS A, {_flag_sum('N', True)} AS N, {_flag_sum('R', True)} AS R
FROM lineitem GROUP BY l_orderkey""")
def q_pivot_fill_zero(spark, d):
    """Order x flag quantities, absent flags filled with 0 (value columns only)."""
    return _order_flags(spark, d)


@register("rowwise_sum", f"""
SELECT l_orderkey, {_flag_sum('A', True)} AS A, {_flag_sum('N', True)} AS N, {_flag_sum('R', True)} AS R,
       {_flag_sum('A', True)} + {_flag_sum('R', True)} AS a_plus_r
FROM lineitem GROUP BY l_orderkey""")
def q_rowwise_sum(spark, d):
    return _order_flags(spark, d).withColumn("a_plus_r", row_sum(["A", "R"]))


@register("pivot_uniqueness_check", """
SELECT l_orderkey, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_returnflag HAVING COUNT(*) > 1""")
def q_pivot_uniqueness_check(spark, d):
    """The (ids, key) pairs a strict pivot would reject."""
    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag"])


@register("pivot_any_width", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, 'PART.' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS series, CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS quantity
FROM lineitem GROUP BY 1, 2""")
def q_pivot_any_width(spark, d):
    """Yearly quantities spread over one place per part, however many parts there are, and read back as rows (RSH-1)."""
    li = table(spark, d, "lineitem").select(F.year("l_shipdate").cast("int").alias("yr"), "l_quantity",
                                            F.concat(F.lit("PART."), F.lpad(F.col("l_partkey").cast("string"), 8, "0")).alias("series"))
    long = sum_by_period(li, ["yr", "series"], {"quantity": "l_quantity"}, exact_scale=2)
    cells, names = pivot_cells(long, "series", "quantity", ["yr"])
    return cells_to_rows(cells, names, ["yr"], "quantity").select("yr", "series", "quantity")


@register("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def q_distinct_rows(spark, d):
    return table(spark, d, "part").select("p_brand", "p_type").distinct()


@register("sorted_panel", """
SELECT prio, yr, n_orders, CAST(row_number() OVER (ORDER BY prio NULLS LAST, yr NULLS LAST) AS INTEGER) AS pos
FROM (SELECT nullif(o_orderpriority, '5-LOW') AS prio, CAST(year(o_orderdate) AS INTEGER) AS yr,
             COUNT(*) AS n_orders FROM orders GROUP BY 1, 2)""")
def q_sorted_panel(spark, d):
    """Sort with NULLs last; the position column makes the order visible (global index, no single task)."""
    o = table(spark, d, "orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"),
                                         F.year("o_orderdate").cast("int").alias("yr"))
    agg = o.groupBy("prio", "yr").agg(F.count(F.lit(1)).alias("n_orders"))
    ranked = with_global_index(agg, ["prio", "yr"], name="pos")
    return (ranked.withColumn("pos", (F.col("pos") + 1).cast("int"))
            .orderBy(F.col("prio").asc_nulls_last(), F.col("yr").asc_nulls_last()))


@register("explode_series", """
SELECT vec_id, label, CAST(UNNEST(range(0, len(embedding))) AS INTEGER) AS pos,
       CAST(UNNEST(embedding) AS DOUBLE) AS value
FROM embeddings""")
def q_explode_series(spark, d):
    """Each vector as a list of [position, value] pairs, exploded with parent fields copied down."""
    e = table(spark, d, "embeddings").select(
        "vec_id", "label",
        F.transform("embedding", lambda x, i: F.array(i.cast("double"), x.cast("double"))).alias("pairs"))
    out = explode_pairs(e, "pairs", ["vec_id", "label"], names=("pos", "value"))
    return out.withColumn("pos", F.col("pos").cast("int"))


@register("json_parse", """
SELECT event_type, CAST(SUM(k) AS BIGINT) AS k_sum, COUNT(*) AS n_events, COUNT(*) - COUNT(k) AS n_missing_k
FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
GROUP BY event_type""")
def q_json_parse(spark, d):
    ev = table(spark, d, "events").select("event_type", F.from_json("props", "k INT").getField("k").alias("k"))
    return ev.groupBy("event_type").agg(F.sum("k").cast("bigint").alias("k_sum"),
                                        F.count(F.lit(1)).alias("n_events"),
                                        (F.count(F.lit(1)) - F.count("k")).alias("n_missing_k"))


@register("split_column", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[2] AS second_word,
       string_split(p_name, ',')[1] AS comma_first, string_split(p_name, ',')[2] AS comma_second
FROM part""")
def q_split_column(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    p = split_column(p, "p_name", ["first_word", "second_word"], sep=" ", drop=False)
    return split_column(p, "p_name", ["comma_first", "comma_second"], sep=",")


# ------------------------------------------------------------------ joins

@register("merge_keep_left", """
SELECT o.o_custkey AS c_custkey, o.o_orderkey, o.o_orderpriority AS tag, c.c_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_merge_keep_left(spark, d):
    """Both sides carry ``tag``; the left (orders) value wins and no duplicate column is left."""
    left = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey",
                                            F.col("o_orderpriority").alias("tag"))
    right = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("tag"))
    return merge_keep_left(left, right, ["c_custkey"], max_broadcast_rows=DEFAULT_BROADCAST_ROWS)


@register("join_hot_keys", """
SELECT CASE WHEN o.o_orderkey % 3 = 0 THEN 1 ELSE o.o_custkey END AS c_custkey, o.o_orderkey, o.o_orderpriority AS tag, c.c_name
FROM orders o JOIN customer c ON c.c_custkey = CASE WHEN o.o_orderkey % 3 = 0 THEN 1 ELSE o.o_custkey END""")
def q_join_hot_keys(spark, d):
    """A third of all orders on one customer, joined without broadcasting the customers: the hot one is found and joined apart (JN-1)."""
    left = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey")).alias("c_custkey"),
                                            "o_orderkey", F.col("o_orderpriority").alias("tag"))
    right = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("tag"))
    return merge_keep_left(left, right, ["c_custkey"])


@register("lookup_inner", """
SELECT s.s_nationkey, s.s_suppkey, s.s_name, n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def q_lookup_inner(spark, d):
    sup = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return lookup_join(sup, table(spark, d, "nation").select("n_nationkey", "n_name"), "s_nationkey", "n_nationkey")


@register("lookup_inner_normalized", """
SELECT s.s_suppkey, lower(n.n_name) AS n_name, lk.Region
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN (SELECT lower(n2.n_name) AS county, r.r_name AS Region FROM nation n2 JOIN region r
      ON n2.n_regionkey = r.r_regionkey WHERE r.r_name <> 'ASIA') lk ON lower(n.n_name) = lk.county""")
def q_lookup_inner_normalized(spark, d):
    """Left key lower-cased before the lookup; nations missing from the lookup (ASIA) are dropped."""
    sup = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    sup = lookup_join(sup, table(spark, d, "nation").select("n_nationkey", "n_name"), "s_nationkey", "n_nationkey")
    lk = (geography(spark, d).where(F.col("r_name") != "ASIA")
          .select(F.lower("n_name").alias("county"), F.col("r_name").alias("Region")))
    return lookup_join(sup.drop("s_nationkey"), lk, "n_name", "county", "inner", normalize="lower")


@register("lookup_left", """
SELECT c.c_nationkey, c.c_custkey, c.c_name, n.n_name, n.n_regionkey
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) n ON c.c_nationkey = n.n_nationkey""")
def q_lookup_left(spark, d):
    """Customers of nations that the lookup lacks keep their row, with NULLs."""
    nation = table(spark, d, "nation").where("n_regionkey != 3").select("n_nationkey", "n_name", "n_regionkey")
    return lookup_join(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), nation, "c_nationkey", "n_nationkey", "left")


@register("panel_left_join", FACTS_SQL + """
, lp AS (SELECT n_name || '_' || CAST(yr AS VARCHAR) AS codeyr, n_name, yr,
                CAST(COALESCE(SUM(emp), 0) AS DOUBLE) AS quantity FROM facts GROUP BY n_name, yr),
op AS (SELECT n.n_name || '_' || CAST(CAST(year(o.o_orderdate) AS INTEGER) AS VARCHAR) AS codeyr,
              CAST(COALESCE(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS order_total
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
       GROUP BY 1)
SELECT lp.*, op.order_total FROM lp LEFT JOIN op ON lp.codeyr = op.codeyr""")
def q_panel_left_join(spark, d):
    """Two annual panels on the composed key ``name_year``; the right copies of name and year are dropped."""
    lp = sum_by_period(facts(spark, d), ["n_name", "yr"], {"quantity": "emp"}, exact_scale=2)
    lp = lp.withColumn("codeyr", paste("_", "n_name", "yr"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"),
                                         F.year("o_orderdate").cast("int").alias("yr"), "o_totalprice")
    # Sum per customer and year before the customer join: a hot customer collapses map-side.
    o = sum_by_period(o, ["c_custkey", "yr"], {"order_total": "o_totalprice"}, exact_scale=2)
    cust = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    oc = o.join(cust, "c_custkey").join(geography(spark, d).select("n_nationkey", "n_name"),
                                        "n_nationkey")
    op = sum_by_period(oc, ["n_name", "yr"], {"order_total": "order_total"}, exact_scale=2)
    op = op.withColumn("codeyr", paste("_", "n_name", "yr"))
    return join_panels(lp, op, "codeyr", drop_right=["n_name", "yr"])


# ------------------------------------------------------------------ filters and conditionals

@register("filter_equality", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_filter_equality(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_orderstatus", "o_totalprice")


@register("filter_not_equal", "SELECT event_id, event_type, value FROM events WHERE event_type <> 'view'")
def q_filter_not_equal(spark, d):
    return table(spark, d, "events").where(F.col("event_type") != "view").select("event_id", "event_type", "value")


@register("filter_not_null", """
SELECT o_orderkey, prio FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS prio FROM orders)
WHERE prio IS NOT NULL""")
def q_filter_not_null(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"))
    return o.where(F.col("prio").isNotNull())


@register("conditional_na_aware", """
SELECT o_orderkey, CASE WHEN c THEN 'urgent' WHEN NOT c THEN 'other' END AS urgency
FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') = '1-URGENT' AS c FROM orders)""")
def q_conditional_na_aware(spark, d):
    """A NULL condition gives NULL, not the else branch."""
    o = table(spark, d, "orders")
    cond = F.nullif("o_orderpriority", F.lit("5-LOW")) == "1-URGENT"
    return o.select("o_orderkey", if_else(cond, F.lit("urgent"), F.lit("other")).alias("urgency"))


# Fixed values for the recode example: two spellings to one, then a value map.
EVENT_VARIANTS = ["click", "view"]
EVENT_MAP = {"browse": "BRW", "signup": "SGN", "purchase": "PUR"}


@register("recode_map", """
SELECT event_class, COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM (SELECT value, CASE WHEN event_type IN ('click', 'view') THEN 'BRW' WHEN event_type = 'signup' THEN 'SGN'
                         WHEN event_type = 'purchase' THEN 'PUR' ELSE event_type END AS event_class FROM events)
GROUP BY event_class""")
def q_recode_map(spark, d):
    """Unify spellings, then map values; 'error' is not in the map and passes unchanged."""
    ev = table(spark, d, "events").select(
        recode(unify("event_type", EVENT_VARIANTS, "browse"), EVENT_MAP).alias("event_class"), "value")
    return ev.groupBy("event_class").agg(F.count(F.lit(1)).alias("n_events"),
                                         F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value_sum"))


@register("proper_case", """
SELECT p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS p_name_proper FROM part""")
def q_proper_case(spark, d):
    return table(spark, d, "part").select("p_partkey", sentence_case("p_name").alias("p_name_proper"))


@register("proper_case_exceptions", """
SELECT p_partkey, fixed, fixed = CASE WHEN fixed = 'Blue bolt' THEN 'Blue Bolt' ELSE fixed END AS name_check,
       CASE WHEN fixed = 'Blue bolt' THEN 'Blue Bolt' ELSE fixed END AS fixed_both
FROM (SELECT p_partkey, CASE WHEN s = 'Red widget' THEN 'Red Widget' ELSE s END AS fixed
      FROM (SELECT p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS s FROM part))""")
def q_proper_case_exceptions(spark, d):
    """Exception map after sentence case; ``name_check`` reproduces a fix written as a comparison."""
    p = table(spark, d, "part").select("p_partkey", recode(sentence_case("p_name"), {"Red widget": "Red Widget"})
                                       .alias("fixed"))
    second = recode("fixed", {"Blue bolt": "Blue Bolt"})
    return p.select("p_partkey", "fixed", (F.col("fixed") == second).alias("name_check"), second.alias("fixed_both"))


@register("safe_numeric_cast", """
SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS prio_num,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS prio_rank FROM orders""")
def q_safe_numeric_cast(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", safe_double("o_orderpriority").alias("prio_num"),
                    safe_double(F.substring("o_orderpriority", 1, 1)).alias("prio_rank"))


# ------------------------------------------------------------------ labels and text

@register("period_label", """
SELECT o_orderkey,
       CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(quarter(o_orderdate) AS VARCHAR) AS date_qtr,
       CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(quarter(o_orderdate) * 3 AS VARCHAR) || '-01' AS date_qtr_end,
       CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-01' AS year_month
FROM orders""")
def q_period_label(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"),
                                         F.quarter("o_orderdate").alias("q"), F.month("o_orderdate").alias("m"))
    return o.select("o_orderkey", quarter_label("y", "q").alias("date_qtr"),
                    quarter_end_label("y", "q").alias("date_qtr_end"), month_label("y", "m").alias("year_month"))


@register("composite_key", """
SELECT n_name, yr, nullif(n_name, 'NATION_0') || '_' || CAST(yr AS VARCHAR) AS codeyr,
       COALESCE(nullif(n_name, 'NATION_0'), 'NA') || '_' || CAST(yr AS VARCHAR) AS codeyr_na
FROM (SELECT DISTINCT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS yr
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)""")
def q_composite_key(spark, d):
    """A NULL part keeps the key NULL by default; ``na_text`` writes it as 'NA'."""
    # Distinct (customer, year) before the customer join: a hot customer collapses map-side.
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"),
                                         F.year("o_orderdate").cast("int").alias("yr")).distinct()
    cust = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    keys = o.join(cust, "c_custkey").join(nat, "n_nationkey").select("n_name", "yr").distinct()
    part = F.nullif("n_name", F.lit("NATION_0"))
    return keys.select("n_name", "yr", paste("_", part, "yr").alias("codeyr"),
                       paste("_", part, "yr", na_text=True).alias("codeyr_na"))


@register("geo_code", """
SELECT c.c_custkey, CASE WHEN length(n.n_name) <> 8 THEN n.n_name ELSE substr(n.n_name, 5, 2) END AS geo
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_geo_code(spark, d):
    """Names of length 8 are cut to characters 5-6; others are kept whole."""
    cust = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    c = lookup_join(cust, table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    n = F.col("n_name")
    return c.select("c_custkey", F.when(F.char_length(n) != 8, n).otherwise(substr_between(n, 5, 6)).alias("geo"))


@register("substring_code", "SELECT c_custkey, substr(c_name, 6, 5) AS code FROM customer")
def q_substring_code(spark, d):
    return table(spark, d, "customer").select("c_custkey", substr_between("c_name", 6, 10).alias("code"))


@register("regex_extract_year", """
SELECT o.o_orderkey, nullif(regexp_extract(c.c_name, '[0-9]{4}'), '') AS name_digits,
       nullif(regexp_extract(o.o_orderpriority, '[0-9]{4}'), '') AS prio_digits
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_regex_extract_year(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    c = sized_join(o, table(spark, d, "customer").select("c_custkey", "c_name"), ["c_custkey"])
    return c.select("o_orderkey", extract_first("c_name", "[0-9]{4}").alias("name_digits"),
                    extract_first("o_orderpriority", "[0-9]{4}").alias("prio_digits"))


@register("regex_remove_first", "SELECT c_custkey, regexp_replace(c_name, '0', '') AS name_trimmed FROM customer")
def q_regex_remove_first(spark, d):
    return table(spark, d, "customer").select("c_custkey", remove_first("c_name", "0").alias("name_trimmed"))


@register("regex_remove_all", """
SELECT p_partkey, regexp_replace(p_type, 'MO|PROMO', '', 'g') AS type_clean,
       regexp_replace(p_name, 'a|e', '', 'g') AS name_clean FROM part""")
def q_regex_remove_all(spark, d):
    """Leftmost match wins at each position, so PROMO goes whole though MO is listed first."""
    return table(spark, d, "part").select("p_partkey", remove_all("p_type", "MO|PROMO").alias("type_clean"),
                                          remove_all("p_name", "a|e").alias("name_clean"))


@register("normalize_name", """
SELECT c.c_custkey, lower(regexp_replace('  ' || n.n_name || chr(9) || ' ', '^\\s+|\\s+$', '', 'g')) AS county
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_normalize_name(spark, d):
    cust = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    c = lookup_join(cust, table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    padded = F.concat(F.lit("  "), F.col("n_name"), F.lit("\t "))
    return c.select("c_custkey", F.lower(trim_space(padded)).alias("county"))


@register("computed_columns", """
SELECT l_orderkey, l_linenumber, disc_price, charge, charge - disc_price AS tax_part
FROM (SELECT l_orderkey, l_linenumber, disc_price, disc_price * (1 + l_tax) AS charge
      FROM (SELECT *, l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem))""")
def q_computed_columns(spark, d):
    """Each new column uses the one before it."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    out = with_columns_chained(li, [
        ("disc_price", F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        ("charge", F.col("disc_price") * (1 + F.col("l_tax"))),
        ("tax_part", F.col("charge") - F.col("disc_price")),
    ])
    return out.select("l_orderkey", "l_linenumber", "disc_price", "charge", "tax_part")


@register("rename_project", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey FROM supplier")
def q_rename_project(spark, d):
    s = rename_strict(table(spark, d, "supplier"), {"s_suppkey": "supplier_id", "s_name": "supplier_name"})
    return s.drop("s_acctbal").select("supplier_id", "supplier_name", "s_nationkey")


@register("select_by_prefix", "SELECT p_type, p_brand, p_partkey, p_size FROM part")
def q_select_by_prefix(spark, d):
    """Case-insensitive prefixes, columns in the order of the prefixes."""
    return select_prefix(table(spark, d, "part"), "P_T", "p_b", "P_P", "p_s")


@register("contiguous_year_prefix", """
WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders WHERE year(o_orderdate) <> 1998),
ys AS (SELECT DISTINCT yr FROM o WHERE yr >= 1995),
gap AS (SELECT min(g) AS g FROM (SELECT yr + 1 AS g FROM ys UNION ALL SELECT 1995) c
        WHERE g NOT IN (SELECT yr FROM ys))
SELECT o_orderkey, yr FROM o WHERE yr >= 1995 AND yr < (SELECT g FROM gap)""")
def q_contiguous_year_prefix(spark, d):
    """Orders without 1998: from 1995 only the unbroken run 1995-1997 is kept."""
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("int").alias("yr"))
    return contiguous_year_prefix(o.where(F.col("yr") != 1998), "yr", 1995)



# ------------------------------------------------------------------ monthly generation tables

# Fixed values for the generation analogue on the driver tables.
SHEET_NATIONAL = {"00": "US-TOTAL", "01": "US-Total"}
SHEET_SOURCES = {"A": "EGA", "N": "EGN"}
SHEET_RENEWABLES = ["EGA", "EGN"]
OTHER_PRODUCER = "Other producers"


def generation_sheet(spark: SparkSession, d: str) -> DataFrame:
    """Monthly 'generation' rows: line-item quantity per (year, month, state, producer, source).

    State is the supplier's nation as a 2-digit code (nations 0 and 1 spell the national
    total two ways),
    producer comes from the line status, source is the return flag.
    """
    li = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), "l_returnflag", "l_linestatus", "l_quantity",
        F.year("l_shipdate").cast("int").alias("year"), F.month("l_shipdate").cast("int").alias("month"))
    sup = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    placed = sup.join(table(spark, d, "nation").select("n_nationkey"), "n_nationkey")
    keys = ["s_suppkey", "year", "month", "l_linestatus", "l_returnflag"]
    if fits_broadcast(placed):
        placed = F.broadcast(placed)
    else:       # a large supplier table: line items are summed per supplier and month before the shuffle join
        li = sum_by_period(li, keys, {"l_quantity": "l_quantity"}, exact_scale=2)
    code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    rows = li.join(placed, "s_suppkey").select(
        "year", "month", recode(code, SHEET_NATIONAL).alias("state"),
        F.when(F.col("l_linestatus") == "F", F.lit(energy_panel.TOTAL_PRODUCER))
        .otherwise(F.lit(OTHER_PRODUCER)).alias("typeofproducer"),
        F.col("l_returnflag").alias("energysource"), "l_quantity")
    return sum_by_period(rows, ["year", "month", "state", "typeofproducer", "energysource"],
                         {"generation": "l_quantity"}, exact_scale=2)


SHEET_SQL = f"""
WITH sheet AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, CAST(month(l.l_shipdate) AS INTEGER) AS month,
         CASE WHEN n.n_nationkey = 0 THEN 'US-TOTAL' WHEN n.n_nationkey = 1 THEN 'US-Total'
              ELSE lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') END AS state,
         CASE WHEN l.l_linestatus = 'F' THEN 'Total Electric Power Industry' ELSE '{OTHER_PRODUCER}' END
           AS typeofproducer,
         l.l_returnflag AS energysource,
         {_sum('CAST(l.l_quantity AS DECIMAL(18,2))')} AS generation
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3, 4, 5),
total AS (SELECT *, CAST(year AS VARCHAR) || '-' || CAST(month AS VARCHAR) || '-01' AS year_month
          FROM sheet WHERE typeofproducer = 'Total Electric Power Industry')
"""


@register("generation_long", SHEET_SQL + """
SELECT year, month, state, typeofproducer,
       CASE energysource WHEN 'A' THEN 'EGA' WHEN 'N' THEN 'EGN' ELSE energysource END AS energysource,
       generation, year_month
FROM total""")
def q_generation_long(spark, d):
    """Monthly rows of the total producer, sources recoded (one unmapped)."""
    return energy_panel.generation_long(generation_sheet(spark, d), source_codes=SHEET_SOURCES)


@register("generation_monthly_wide", SHEET_SQL + """
SELECT year, month, state, typeofproducer, year_month,
       max(generation) FILTER (WHERE energysource = 'A') AS A,
       max(generation) FILTER (WHERE energysource = 'N') AS N,
       max(generation) FILTER (WHERE energysource = 'R') AS R
FROM total GROUP BY year, month, state, typeofproducer, year_month""")
def q_generation_monthly_wide(spark, d):
    """Monthly table spread wide by source, columns from the data."""
    return energy_panel.generation_monthly(generation_sheet(spark, d))


def _annual_col(code: str) -> str:
    s = f"SUM(CAST(generation AS DECIMAL(18,2))) FILTER (WHERE energysource = '{code}')"
    return f"CAST(COALESCE({s}, 0) AS DOUBLE) AS {code}"


@register("generation_annual_wide", SHEET_SQL + f"""
, g AS (SELECT year, CASE WHEN state IN ('US-TOTAL', 'US-Total') THEN 'US' ELSE state END AS state,
               CASE energysource WHEN 'A' THEN 'EGA' WHEN 'N' THEN 'EGN' ELSE energysource END AS energysource,
               generation
        FROM total),
w AS (SELECT year, state, {_annual_col('EGA')}, {_annual_col('EGN')}, {_annual_col('R')} FROM g GROUP BY year, state)
SELECT year, state AS statecode, EGA, EGN, R, state || '_' || CAST(year AS VARCHAR) AS codeyr, EGA + EGN AS EGREP
FROM w""")
def q_generation_annual_wide(spark, d):
    """Annual sums per state wide by source code, national spellings unified, zero-filled, renewables total."""
    return energy_panel.generation_annual(generation_sheet(spark, d), source_codes=SHEET_SOURCES,
                                          renewables=SHEET_RENEWABLES, exact_scale=2)


# ------------------------------------------------------------------ nested series, panel and codebook

SERIES_UNITS = "Orders"


def order_series(spark: SparkSession, d: str) -> DataFrame:
    """Series records shaped like the nested JSON input, derived from orders.

    One record per (customer nation, order priority): ``geoset_id`` ``ORDS.<5 letters>.A``,
    ``geography`` ``NAT-<2-digit nation key>`` (6 characters), a description naming the
    nation, and ``data`` = [year, order count] pairs as text.  One national record per
    priority sums the nations (``geography`` ``USA``).  Each ``data`` list holds one
    pair per year, so the arrays stay small however many orders there are.
    """
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority",
                                         F.year("o_orderdate").cast("int").alias("yr"))
    cust = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    # Orders are counted per customer and year before the joins; nations and the nation as a whole come from one pass.
    o = o.groupBy("c_custkey", "o_orderpriority", "yr").agg(F.count(F.lit(1)).alias("n"))
    period = ["o_orderpriority", "yr"]
    counts = (o.join(cust, "c_custkey").join(nat, "n_nationkey")
              .groupingSets([["n_nationkey", "n_name", *period], period], "n_nationkey", "n_name", *period)
              .agg(F.sum("n").alias("n"), F.grouping("n_nationkey").alias("_all")))
    whole = F.col("_all") == 1
    records = counts.select(
        F.when(whole, F.lit("USA")).otherwise(F.concat(F.lit("NAT-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")))
        .alias("geography"), F.when(whole, F.lit("United States")).otherwise(F.col("n_name")).alias("place"), *period, "n")
    letters = F.rpad(F.upper(F.regexp_replace("o_orderpriority", "[^A-Za-z]", "")), 5, "X")
    pair = F.array(F.col("yr").cast("string"), F.col("n").cast("string"))
    return (records
            .groupBy("geography", "place", "o_orderpriority")
            .agg(F.array_sort(F.collect_list(pair)).alias("data"))
            .select(F.concat(F.lit("ORDS."), letters, F.lit(".A")).alias("geoset_id"), "geography",
                    F.concat(F.lit("Orders by priority, "), F.col("place"), F.lit(", See the notes, more"))
                    .alias("description"),
                    F.lit(SERIES_UNITS).alias("units"), "data"))


def order_state_lookup(spark: SparkSession, d: str) -> DataFrame:
    """(name, statecode) for nations outside region 4 (the others stay unmatched)."""
    return (table(spark, d, "nation").where(F.col("n_regionkey") != 4)
            .select(F.col("n_name").alias("name"),
                    F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("statecode")))


ORDER_SERIES_SQL = """
WITH o AS (SELECT n.n_nationkey, n.n_name, o.o_orderpriority AS prio, CAST(year(o.o_orderdate) AS INTEGER) AS yr,
                  COUNT(*) AS n
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
           GROUP BY 1, 2, 3, 4),
r AS (SELECT 'NAT-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geography, n_name AS place, prio, yr, n FROM o
      UNION ALL
      SELECT 'USA', 'United States', prio, yr, SUM(n) FROM o GROUP BY prio, yr),
s AS (SELECT CASE WHEN length(geography) <> 6 THEN geography ELSE substr(geography, 5, 2) END AS g0,
             place, prio, yr, n,
             rpad(upper(regexp_replace(prio, '[^A-Za-z]', '', 'g')), 5, 'X') AS grp
      FROM r)
"""


# Place names as the oracle removes them, written out on their own.
STATE_NAMES_SQL = (
    "Alabama|Alaska|Arizona|Arkansas|California|Colorado|Connecticut|Delaware|District of Columbia|Florida|Georgia|"
    "Hawaii|Idaho|Illinois|Indiana|Iowa|Kansas|Kentucky|Louisiana|Maine|Maryland|Massachusetts|Michigan|Minnesota|"
    "Mississippi|Missouri|Montana|Nebraska|Nevada|New Hampshire|New Jersey|New Mexico|New York|North Carolina|"
    "North Dakota|Ohio|Oklahoma|Oregon|Pennsylvania|Rhode Island|South Carolina|South Dakota|Tennessee|Texas|"
    "United States|Utah|Vermont|Virginia|Washington|West Virginia|Wisconsin|Wyoming")


def _panel_col(grp: str) -> str:
    return f"max(CAST(n AS DOUBLE)) FILTER (WHERE grp = '{grp}') AS {grp}"


@register("state_year_panel", ORDER_SERIES_SQL + f"""
, long AS (SELECT CASE WHEN g0 = 'USA' THEN 'US' ELSE g0 END AS code, yr, grp, n FROM s),
w AS (SELECT code, yr AS year, code || '_' || CAST(yr AS VARCHAR) AS codeyr,
             {_panel_col('HIGHX')}, {_panel_col('LOWXX')}, {_panel_col('MEDIU')}, {_panel_col('NOTSP')},
             {_panel_col('URGEN')}
      FROM long GROUP BY code, yr)
SELECT w.*, lk.name
FROM w LEFT JOIN (SELECT n_name AS name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS statecode
                  FROM nation WHERE n_regionkey <> 4) lk ON w.code = lk.statecode""")
def q_state_year_panel(spark, d):
    """Nested [year, value] records exploded, keyed, spread wide by group, names joined, sorted (P10)."""
    return energy_panel.state_year_panel(order_series(spark, d), order_state_lookup(spark, d))


@register("codebook", ORDER_SERIES_SQL + f"""
, cb AS (SELECT DISTINCT grp AS Variable, place, '{SERIES_UNITS}' AS Units FROM s)
SELECT DISTINCT Variable,
       regexp_replace(regexp_replace(regexp_replace('Orders by priority, ' || place || ', See the notes, more',
                                                    '{STATE_NAMES_SQL}', '', 'g'),
                                     'See.*$', ''),
                      ',', '') AS Description,
       Units
FROM cb""")
def q_codebook(spark, d):
    """Variable, description without place names and notes, units; distinct and sorted."""
    return energy_panel.codebook(order_series(spark, d))


@register("clean_distinct_values", f"""
SELECT l.l_orderkey, l.l_linenumber,
       regexp_replace(regexp_replace(regexp_replace('Sold in ' || n.n_name || ', ' || CASE l.l_returnflag WHEN 'A' THEN 'Ohio, See more' ELSE 'Utah or Iowa' END,
                                                    '{STATE_NAMES_SQL}', '', 'g'), 'See.*$', ''), ',', '') AS description
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def q_clean_distinct_values(spark, d):
    """Every line item's description without place names and notes; a pattern of 52 names runs once per different description (STR-6)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    place = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    rows = sized_join(li, place.join(table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey"), ["l_suppkey"])
    note = F.when(F.col("l_returnflag") == "A", "Ohio, See more").otherwise("Utah or Iowa")
    rows = rows.select("l_orderkey", "l_linenumber", F.concat(F.lit("Sold in "), "n_name", F.lit(", "), note).alias("description"))
    return map_distinct(rows, "description", energy_panel.clean_description)


def _ctes(sql: str) -> str:
    """The CTE list of a ``WITH ...`` prefix, to combine two prefixes in one statement."""
    body = sql.strip()
    assert body.upper().startswith("WITH")
    return body[4:]


_ANNUAL_CTES = f"""
, g AS (SELECT year, CASE WHEN state IN ('US-TOTAL', 'US-Total') THEN 'US' ELSE state END AS state,
               CASE energysource WHEN 'A' THEN 'EGA' WHEN 'N' THEN 'EGN' ELSE energysource END AS energysource,
               generation
        FROM total),
w AS (SELECT year, state, {_annual_col('EGA')}, {_annual_col('EGN')}, {_annual_col('R')} FROM g GROUP BY year, state),
annual AS (SELECT year, state AS statecode, EGA, EGN, R, state || '_' || CAST(year AS VARCHAR) AS codeyr,
                  EGA + EGN AS EGREP FROM w)
"""

_PANEL_CTES = f"""
, long AS (SELECT CASE WHEN g0 = 'USA' THEN 'US' ELSE g0 END AS code, yr, grp, n FROM s),
pw AS (SELECT code, yr AS year, code || '_' || CAST(yr AS VARCHAR) AS codeyr,
              {_panel_col('HIGHX')}, {_panel_col('LOWXX')}, {_panel_col('MEDIU')}, {_panel_col('NOTSP')},
              {_panel_col('URGEN')}
       FROM long GROUP BY code, yr),
panel AS (SELECT pw.*, lk.name
          FROM pw LEFT JOIN (SELECT n_name AS name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS statecode
                             FROM nation WHERE n_regionkey <> 4) lk ON pw.code = lk.statecode)
"""


@register("combined_panel", "WITH " + _ctes(ORDER_SERIES_SQL) + _PANEL_CTES + ", " + _ctes(SHEET_SQL)
          + _ANNUAL_CTES + """
SELECT panel.*, annual.EGA, annual.EGN, annual.R, annual.EGREP
FROM panel LEFT JOIN annual ON panel.codeyr = annual.codeyr""")
def q_combined_panel(spark, d):
    """State-year panel left-joined with annual generation on ``code_year``; the panel's year wins."""
    panel = energy_panel.state_year_panel(order_series(spark, d), order_state_lookup(spark, d))
    annual = energy_panel.generation_annual(generation_sheet(spark, d), source_codes=SHEET_SOURCES,
                                            renewables=SHEET_RENEWABLES, exact_scale=2)
    return energy_panel.combined_panel(panel, annual)


# ------------------------------------------------------------------ enriched facts

# Fixed values for the mine-type lookup on return flags (R is left out on purpose).
FLAG_MINE_TYPES = [("A", "Underground"), ("N", "Surface")]


def production_text(spark: SparkSession, d: str) -> DataFrame:
    """Line items as a text 'production' table, the way the delimited files arrive.

    MINE_ID is the supplier as zero-padded text; coal/metal comes from the line
    status; every measure is text, and line 7 carries a non-numeric value.
    """
    li = table(spark, d, "lineitem")
    return li.select(
        F.lpad(F.col("l_suppkey").cast("string"), 7, "0").alias("MINE_ID"),
        F.year("l_shipdate").cast("string").alias("CAL_YR"),
        F.quarter("l_shipdate").cast("string").alias("CAL_QTR"),
        F.col("l_returnflag").alias("SUBUNIT_CD"),
        F.when(F.col("l_linestatus") == "F", F.lit("C")).otherwise(F.lit("M")).alias("COAL_METAL_IND"),
        F.when(F.col("l_returnflag") == "R", F.lit("WV")).otherwise(F.lit("KY")).alias("STATE"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("COAL_PRODUCTION"),
        F.col("l_linenumber").cast("string").alias("AVG_EMPLOYEE_CNT"))


def mines_text(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as a 'mines' table; its STATE clashes with production's and must lose."""
    sup = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    return sup.join(nat, "n_nationkey").select(
        F.lpad(F.col("s_suppkey").cast("string"), 7, "0").alias("MINE_ID"),
        F.col("n_name").alias("FIPS_CNTY_NM"), F.lit("XX").alias("STATE"))


@register("enriched_facts", """
WITH p AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS MINE_ID, CAST(year(l_shipdate) AS VARCHAR) AS CAL_YR,
         CAST(quarter(l_shipdate) AS VARCHAR) AS CAL_QTR, l_returnflag AS SUBUNIT_CD,
         CASE WHEN l_linestatus = 'F' THEN 'C' ELSE 'M' END AS COAL_METAL_IND,
         CASE WHEN l_returnflag = 'R' THEN 'WV' ELSE 'KY' END AS STATE,
         CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS COAL_PRODUCTION,
         CAST(l_linenumber AS VARCHAR) AS AVG_EMPLOYEE_CNT
  FROM lineitem),
m AS (SELECT lpad(CAST(s.s_suppkey AS VARCHAR), 7, '0') AS MINE_ID, n.n_name AS FIPS_CNTY_NM
      FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
cl AS (SELECT lower(n.n_name) AS county, r.r_name AS Region
       FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name <> 'ASIA'),
ml AS (SELECT * FROM (VALUES ('A', 'Underground'), ('N', 'Surface')) t(SUBUNIT_CD, mtype))
SELECT p.SUBUNIT_CD, lower(m.FIPS_CNTY_NM) AS FIPS_CNTY_NM, p.MINE_ID,
       CAST(TRY_CAST(p.CAL_YR AS DOUBLE) AS INTEGER) AS CAL_YR, CAST(TRY_CAST(p.CAL_QTR AS DOUBLE) AS INTEGER) AS CAL_QTR,
       p.COAL_METAL_IND, p.STATE, TRY_CAST(p.COAL_PRODUCTION AS DOUBLE) AS COAL_PRODUCTION,
       TRY_CAST(p.AVG_EMPLOYEE_CNT AS DOUBLE) AS AVG_EMPLOYEE_CNT, p.CAL_YR || '-' || p.CAL_QTR AS Date_qtr,
       cl.Region, ml.mtype
FROM p JOIN m ON p.MINE_ID = m.MINE_ID
       JOIN cl ON lower(m.FIPS_CNTY_NM) = cl.county
       JOIN ml ON p.SUBUNIT_CD = ml.SUBUNIT_CD
WHERE p.COAL_METAL_IND = 'C'""")
def q_enriched_facts(spark, d):
    """Production x mines (left columns win), coal only, county region and mine type, text cast to numbers."""
    county = geography(spark, d).where(F.col("r_name") != "ASIA").select(
        F.lower("n_name").alias("county"), F.col("r_name").alias("Region"))
    mtypes = spark.createDataFrame(FLAG_MINE_TYPES, "SUBUNIT_CD string, mtype string")
    return mining.enrich_facts(production_text(spark, d), mines_text(spark, d), county, mtypes)


# ------------------------------------------------------------------ housing table

# Fixed values for the housing analogue: place word by market segment (HOUSEHOLD has no state part).
SEGMENT_PLACE = {"AUTOMOBILE": " County, ", "BUILDING": " Parish, ", "FURNITURE": " Borough, ",
                 "MACHINERY": " Census Area, "}


def housing_matrix_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows shaped like read yearly matrices (``source`` file name, NAME, code columns), from orders.

    One row per order: the file name carries the order year, NAME is "<customer><place word>,
    <nation>" (one segment has no comma), and three codes carry order fields; the
    other codes are absent, as a code missing from a year's file is.
    """
    from panelspark.plans import housing

    o = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority",
        F.year("o_orderdate").alias("yr"))
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment",
                                              F.col("c_nationkey").alias("n_nationkey"))
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    rows = sized_join(o, cust.join(nat, "n_nationkey"), ["c_custkey"])
    place = recode("c_mktsegment", SEGMENT_PLACE)
    name = F.when(F.col("c_mktsegment").isin(*SEGMENT_PLACE), F.concat("c_name", place, "n_name")) \
        .otherwise(F.col("c_name"))
    codes = housing.HOUSING_CODES
    given = {codes["OccHU"]: F.col("o_orderkey").cast("string"),
             codes["YrBuilt_2014plus"]: F.col("n_nationkey").cast("string"),
             codes["Heating_LPGas"]: F.col("o_orderpriority")}
    return rows.select(
        F.concat(F.lit("housing_"), F.col("yr").cast("string"), F.lit(".json")).alias("source"),
        name.alias("NAME"),
        *[given.get(code, F.lit(None).cast("string")).alias(code) for code in codes.values()])


def _housing_code_sql(out: str) -> str:
    given = {"OccHU": "CAST(o_orderkey AS VARCHAR)", "YrBuilt_2014plus": "CAST(n_nationkey AS VARCHAR)",
             "Heating_LPGas": "o_orderpriority"}
    return f"{given.get(out, 'CAST(NULL AS VARCHAR)')} AS {out}"


def _housing_sql() -> str:
    outs = ["YrBuilt_2014plus", "YrBuilt_2010_2013", "YrBuilt_2000_2009", "YrBuilt_1980_1999", "YrBuilt_1960_1979",
            "YrBuilt_1940_1959", "YrBuilt_1939OrLess", "Heating_LPGas", "Heating_Elec", "Heating_FuelOil", "Heating_Coal",
            "Heating_Other", "Heating_None", "OccHU"]
    places = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_PLACE.items())
    return f"""
WITH r AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS yr, o.o_orderkey, o.o_orderpriority, n.n_nationkey,
         CASE WHEN c.c_mktsegment IN ({", ".join(f"'{k}'" for k in SEGMENT_PLACE)})
              THEN c.c_name || CASE c.c_mktsegment {places} END || n.n_name ELSE c.c_name END AS NAME
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
ys AS (SELECT DISTINCT yr FROM r WHERE yr >= 1995),
gap AS (SELECT min(g) AS g FROM (SELECT yr + 1 AS g FROM ys UNION ALL SELECT 1995) c WHERE g NOT IN (SELECT yr FROM ys)),
k AS (SELECT * FROM r WHERE yr >= 1995 AND yr < (SELECT g FROM gap)),
s AS (SELECT *, regexp_replace(string_split(NAME, ',')[2], '^\\s+|\\s+$', '', 'g') AS State,
             lower(regexp_replace(regexp_replace(string_split(NAME, ',')[1],
                   'Parish|County|Census Area|Borough|Municipality|Municipio', ''), '^\\s+|\\s+$', '', 'g')) AS county
      FROM k)
SELECT CAST(s.yr AS VARCHAR) AS year, s.State, s.county, lk.statecode,
       {", ".join(_housing_code_sql(o) for o in outs)}
FROM s LEFT JOIN (SELECT n_name AS name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS statecode
                  FROM nation WHERE n_regionkey <> 4) lk ON s.State = lk.name"""


@register("housing_table", _housing_sql())
def q_housing_table(spark, d):
    """County rows: year from the file name (unbroken run only), NAME split, place word removed,
    state code looked up, codes renamed and kept by prefix (P15)."""
    from panelspark.plans import housing
    years = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"))       # as the file names give them
    return housing.housing_table(housing_matrix_rows(spark, d), order_state_lookup(spark, d), start=1995, years=years)


@register("series_long", ORDER_SERIES_SQL + """
SELECT CASE WHEN g0 = 'USA' THEN 'US' ELSE g0 END AS code, yr AS year,
       CASE WHEN g0 = 'USA' THEN 'US' ELSE g0 END || '_' || CAST(yr AS VARCHAR) AS codeyr,
       grp AS "group", CAST(n AS DOUBLE) AS value
FROM s""")
def q_series_long(spark, d):
    """The long form behind the panel: one row per (code, year, group) with its value (P10, long)."""
    return energy_panel.series_long(order_series(spark, d))


# ------------------------------------------------------------------ more published forms

@register("region_page", _CUBE_SQL + f"""
, det AS (SELECT l_returnflag, yr, qtr, {_sum_cube('prod')} AS clpttp FROM cube WHERE r_name = 'ASIA' GROUP BY l_returnflag, yr, qtr),
det_g AS (SELECT *, {_g('clpttp', 4, 'w')} AS clpttp_YOY_Mtype, {_g('clpttp', 1, 'w')} AS clpttp_Qtr_Mtype
          FROM det WINDOW w AS (PARTITION BY l_returnflag ORDER BY yr, qtr)),
tot AS (SELECT yr, qtr, {_sum_cube('prod')} AS clpttp FROM cube WHERE r_name = 'ASIA' GROUP BY yr, qtr),
tot_g AS (SELECT *, {_g('clpttp', 4, 'w')} AS clpttp_YOY_ASIA, {_g('clpttp', 1, 'w')} AS clpttp_Qtr_ASIA, 'Total' AS l_returnflag
          FROM tot WINDOW w AS (ORDER BY yr, qtr)),
u AS (SELECT * FROM det_g UNION ALL BY NAME SELECT * FROM tot_g)
SELECT l_returnflag, yr, qtr, clpttp, {_bf('clpttp_YOY_Mtype', 'clpttp_YOY_ASIA')} AS clpttp_YOY_Mtype,
       {_bf('clpttp_Qtr_Mtype', 'clpttp_Qtr_ASIA')} AS clpttp_Qtr_Mtype, clpttp_YOY_ASIA, clpttp_Qtr_ASIA, {_label_sql()} AS date_qtr
FROM u""")
def q_region_page(spark, d):
    """One region's page with totals named after the region."""
    return mining.region_page(mining.production_region_pages(cube(spark, d), MINE), "ASIA", MINE)


@register("county_production_series", _CUBE_SQL + _COUNTY_LOOKUP_SQL + f"""
, cty AS (SELECT county, yr, qtr, {_sum_cube('prod')} AS clpctp FROM cube GROUP BY county, yr, qtr),
g AS (SELECT *, {_g('clpctp', 4, 'w')} AS clpctp_YOY_County, {_g('clpctp', 1, 'w')} AS clpctp_Qtr_County
      FROM cty WINDOW w AS (PARTITION BY county ORDER BY yr, qtr)),
j AS (SELECT g.*, lk.r_name FROM g LEFT JOIN lk ON g.county = lk.county),
p AS (SELECT * REPLACE ({_sentence('county')} AS county) FROM j)
SELECT * REPLACE (CASE WHEN county = 'Mclean' THEN 'McLean' WHEN county = 'Mccreary' THEN 'McCreary' ELSE county END AS county),
       {_label_sql()} AS date_qtr
FROM p""")
def q_county_production_series(spark, d):
    """P6 with lags kept inside each county and both name fixes applied (the default mode)."""
    return mining.production_by_county(cube(spark, d), county_lookup(spark, d), MINE)


@register("mtype_employment_series", _P7_SQL.replace("ORDER BY l_returnflag, yr, qtr", "PARTITION BY l_returnflag ORDER BY yr, qtr"))
def q_mtype_employment_series(spark, d):
    """P7 with lags kept inside each mine type (the default mode)."""
    return mining.employment_by_mtype(cube(spark, d), MINE)


@register("region_employment_series", ORACLE["mining_employment_by_region"].replace("ORDER BY r_name, yr, qtr", "PARTITION BY r_name ORDER BY yr, qtr"))
def q_region_employment_series(spark, d):
    """P9 with lags kept inside each region (the default mode)."""
    return mining.employment_by_region(cube(spark, d), MINE)


@register("state_year_panel_published", ORACLE["state_year_panel"].replace("CASE WHEN g0 = 'USA' THEN 'US' ELSE g0 END AS code", "g0 AS code"))
def q_state_year_panel_published(spark, d):
    """P10 literally: the national code stays USA, which the generation tables never use."""
    return energy_panel.state_year_panel(order_series(spark, d), order_state_lookup(spark, d), compat=True)


@register("combined_panel_published", ORACLE["combined_panel"].replace("CASE WHEN g0 = 'USA' THEN 'US' ELSE g0 END AS code", "g0 AS code"))
def q_combined_panel_published(spark, d):
    """P13 literally: national rows (USA) miss the generation columns (US)."""
    panel = energy_panel.state_year_panel(order_series(spark, d), order_state_lookup(spark, d), compat=True)
    annual = energy_panel.generation_annual(generation_sheet(spark, d), source_codes=SHEET_SOURCES,
                                            renewables=SHEET_RENEWABLES, exact_scale=2)
    return energy_panel.combined_panel(panel, annual)


@register("drop_and_rename_matching", """
SELECT c_custkey AS custkey, c_nationkey AS nationkey, c_mktsegment AS mktsegment FROM customer""")
def q_drop_and_rename_matching(spark, d):
    """Columns dropped by a pattern, the rest renamed by one (PRJ-6, PRJ-7)."""
    return rename_matching(drop_matching(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
                                         "name|bal$"), "^c_", "")


# ------------------------------------------------------------------ the readers' parsing over driver rows

@register("parse_delimited", """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS ORDER_ID, CAST(l_linenumber AS VARCHAR) AS LINE,
       CASE WHEN l_linenumber = 3 THEN '"A' WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS FLAG,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE '# ' || l_linestatus END AS NOTE, l_linenumber = 2 AS damaged
FROM lineitem""")
def q_parse_delimited(spark, d):
    """Pipe-delimited lines (SRC-1): zeros, quotes and # stay data, short lines are padded and flagged."""
    flag = F.when(F.col("l_linenumber") == 3, '"A').otherwise(F.col("l_returnflag"))
    head = F.concat_ws("|", F.lpad(F.col("l_orderkey").cast("string"), 8, "0"), F.col("l_linenumber").cast("string"))
    whole = F.concat_ws("|", head, flag, F.concat(F.lit("# "), "l_linestatus"))
    lines = table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") == 2, head).otherwise(whole).alias("line"))
    rows = parse_delimited(lines, "line", ["ORDER_ID", "LINE", "FLAG", "NOTE"])
    return rows.withColumn("damaged", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


@register("parse_lookup", """
SELECT lower(c_name) AS county, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS Region FROM customer""")
def q_parse_lookup(spark, d):
    """Comma-separated lookup lines, one per customer, keys as text with their zeros (SRC-2)."""
    lines = table(spark, d, "customer").select(F.concat_ws(",", F.lower("c_name"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("line"))
    return parse_delimited(lines, "line", ["county", "Region"], sep=",").drop(CORRUPT)


@register("parse_series", """
SELECT 'CUST.' || c_custkey || '.A' AS geoset_id, 'NAT-' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS geography,
       c_name AS description, 'Dollars' AS units, '2001' AS first_year, CAST(c_custkey AS VARCHAR) AS first_value, 2 AS pairs
FROM customer""")
def q_parse_series(spark, d):
    """One JSON series record per row: fields and [year, value] pairs (SRC-3)."""
    c = table(spark, d, "customer")
    record = F.to_json(F.struct(
        F.concat(F.lit("CUST."), F.col("c_custkey").cast("string"), F.lit(".A")).alias("geoset_id"),
        F.concat(F.lit("NAT-"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("geography"),
        F.col("c_name").alias("description"), F.lit("Dollars").alias("units"), F.lit("unused").alias("extra"),
        F.array(F.array(F.lit("2001"), F.col("c_custkey").cast("string")), F.array(F.lit("2002"), F.lit("NA"))).alias("data")))
    rows = parse_series(c.select(record.alias("line")), "line")
    return rows.select("geoset_id", "geography", "description", "units", F.col("data")[0][0].alias("first_year"),
                       F.col("data")[0][1].alias("first_value"), F.size("data").alias("pairs"))


@register("parse_sheets", """
SELECT CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(year(l_shipdate) AS INTEGER) END AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       l_returnflag AS state, l_linestatus AS typeofproducer, CAST(l_orderkey AS VARCHAR) AS energysource,
       CAST(l_linenumber AS DOUBLE) AS generation
FROM lineitem""")
def q_parse_sheets(spark, d):
    """Positional sheet rows (SRC-4): title and header rows go, a damaged year stays as NULL."""
    text = lambda c: c.cast("string")
    year = F.when(F.col("l_linenumber") == 4, F.lit("20x1")).otherwise(text(F.year("l_shipdate")))
    data = table(spark, d, "lineitem").select(
        year.alias("year"), text(F.month("l_shipdate")).alias("month"), F.col("l_returnflag").alias("state"),
        F.col("l_linestatus").alias("typeofproducer"), text(F.col("l_orderkey")).alias("energysource"), text(F.col("l_linenumber")).alias("generation"))
    header = table(spark, d, "region").select(
        *[F.when(F.col("r_regionkey") % 2 == 0, F.lit(h)).otherwise(F.col("r_name") if i == 0 else F.lit(None)).alias(n)
          for i, (n, h) in enumerate([("year", "YEAR"), ("month", "MONTH"), ("state", "STATE"), ("typeofproducer", "TYPE OF PRODUCER"),
                                      ("energysource", "ENERGY SOURCE"), ("generation", "GENERATION (Megawatthours)")])])
    return sheet_rows(header.unionByName(data))


@register("parse_matrices", """
SELECT 'order_' || l_orderkey AS source, l_returnflag AS flag, CAST(l_linenumber AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS absent
FROM lineitem""")
def q_parse_matrices(spark, d):
    """One small JSON matrix per order, header first; of a repeated header name the first counts (SRC-5, SRC-6)."""
    li = table(spark, d, "lineitem")
    row = F.array(F.col("l_returnflag"), F.col("l_linenumber").cast("string"), F.lit("second"))
    rows = li.groupBy("l_orderkey").agg(F.collect_list(row).alias("rows"))          # an order has a handful of lines
    header = F.array(F.array(F.lit("flag"), F.lit("line"), F.lit("flag")))
    files = rows.select(F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("source"),
                        F.to_json(F.concat(header, "rows")).alias("value"))
    return matrix_rows(files, ["flag", "line", "absent"])


@register("tag_source", """
SELECT o_orderkey AS key, 'orders.parquet' AS source FROM orders UNION ALL SELECT l_orderkey, 'lineitem.parquet' FROM lineitem""")
def q_tag_source(spark, d):
    """Rows of two tables, stacked, with the name of the table's file or folder that each came from (SRC-8)."""
    of = lambda name, key: table(spark, d, name).select(F.col(key).alias("key"), F.col("_metadata.file_path").alias("path"))
    rows = union_by_name(of("orders", "o_orderkey"), of("lineitem", "l_orderkey"))
    return rows.select("key", F.regexp_extract("path", "([a-z]+[.]parquet)", 1).alias("source"))


def main(argv: list[str] | None = None) -> None:
    """``python -m panelspark.plans.catalogue NAME [--sf DIR] [--show N] [--explain]``.

    Runs one registered query over the driver tables, prints up to N rows and, with
    ``--explain``, its formatted physical plan (AQE's initial plan; ``tests/plan_report.py``
    summarises final plans).
    """
    import argparse

    from panelspark.plans import catalogue, landed  # noqa: F401  (landed adds its queries)
    from panelspark.session import build_session
    ap = argparse.ArgumentParser(prog="panelspark.plans.catalogue")
    ap.add_argument("name", choices=sorted(catalogue.QUERIES))
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--explain", action="store_true")
    args = ap.parse_args(argv)
    spark = build_session()
    df = catalogue.QUERIES[args.name](spark, args.sf)
    df.show(args.show, truncate=False)
    if args.explain:
        df.explain("formatted")


if __name__ == "__main__":
    main()
