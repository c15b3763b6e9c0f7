"""State x year energy panel, monthly and annual generation, and a codebook.

Tables:
  series_long        long form of the nested series: (code, year, codeyr, group, value)
  state_year_panel   P10  one row per (code, year), one column per series group, state name joined
  generation_long    P16  monthly generation, total producer only, sources recoded
  generation_monthly P11  monthly generation wide, one column per (long) source name
  generation_annual  P12  annual sums per state wide, zero-filled, with the renewables total EGREP
  combined_panel     P13  panel joined with annual generation on ``codeyr``
  codebook           P14  variable, cleaned description, units

The long form is the main product: the wide panel has as many columns as there
are series groups, so it is derived from the long one and its column list comes
from a distinct over the (small) group column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.labels import month_label, recode, safe_double, safe_int, unify
from panelspark.functions.text import paste, remove_all, remove_first, substr_between
from panelspark.operators.dictionary import map_distinct
from panelspark.operators.frames import join_panels
from panelspark.operators.skew import lookup_join
from panelspark.operators.reshape import explode_pairs, fill_zero, pivot_sum, pivot_wide, row_sum
from panelspark.session import ensure_checkpoint_dir

# Producer kept, national spellings, and energy source -> series code.
TOTAL_PRODUCER = "Total Electric Power Industry"
NATIONAL_SPELLINGS = ["US-TOTAL", "US-Total"]
SOURCE_CODES = {
    "Total": "EGTEP",
    "Coal": "EGCLP",
    "Geothermal": "EGGEP",
    "Hydroelectric Conventional": "EGHYP",
    "Natural Gas": "EGNGP",
    "Nuclear": "EGNUP",
    "Petroleum": "EGPAP",
    "Pumped Storage": "EGPSP",
    "Solar Thermal and Photovoltaic": "EGSOP",
    "Wind": "EGWYP",
    "Wood and Wood Derived Fuels": "EGWDP",
    "Other": "EGOTP",
    "Other Gases": "EGOGP",
    "Other Biomass": "EGOBMP",
}
# The seven terms of the renewables total, in the published order.
RENEWABLE_CODES = ["EGSOP", "EGWDP", "EGOBMP", "EGPSP", "EGGEP", "EGWYP", "EGHYP"]
# Place names removed from codebook descriptions.
STATE_NAMES = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware",
    "District of Columbia", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa",
    "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota",
    "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey",
    "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio", "Oklahoma", "Oregon",
    "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas",
    "United States", "Utah", "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin",
    "Wyoming",
]
NATIONAL_GEOGRAPHY = {"USA": "US"}


# ---------------------------------------------------------------- P10

def series_long(series: DataFrame, compat: bool = False) -> DataFrame:
    """Explode [year, value] pairs and build keys.

    Six-character geographies keep characters 5-6 (the state code); others are
    kept whole.  By default the national geography is unified with the code the
    generation tables use (``USA`` -> ``US``), so national rows can join; with
    ``compat`` it is kept, and a NULL part of ``codeyr`` is written as ``NA``.
    Values are parsed to DOUBLE (unparsable -> NULL).
    """
    rows = explode_pairs(series, "data", ["geography", "geoset_id"], names=("V1", "V2"))
    geo = F.col("geography")
    rows = rows.withColumn("geography", F.when(F.char_length(geo) != 6, geo).otherwise(substr_between(geo, 5, 6)))
    if not compat:
        rows = rows.withColumn("geography", recode("geography", NATIONAL_GEOGRAPHY))
    rows = rows.where(F.col("geography").isNotNull())
    return rows.select(
        F.col("geography").alias("code"), safe_int("V1").alias("year"),
        paste("_", "geography", "V1", na_text=compat).alias("codeyr"),
        substr_between("geoset_id", 6, 10).alias("group"), safe_double("V2").alias("value"))


def state_year_panel(series: DataFrame, state_lookup: DataFrame, groups: list[str] | None = None,
                     compat: bool = False) -> DataFrame:
    """One row per (code, year); one column per group; state lookup columns joined; sorted.

    A repeated (code, year, group) fails the query, as a wide spread must.  Without ``groups`` the
    long form is written once (checkpoint): the column list and the table both read that.
    """
    long = series_long(series, compat)
    if groups is None:
        ensure_checkpoint_dir(long.sparkSession)
        long = long.checkpoint()
    wide = pivot_wide(long, "group", "value", ids=["code", "year", "codeyr"], values=groups)
    wide = lookup_join(wide, state_lookup, "code", "statecode", "left")
    return wide.orderBy(F.col("code").asc_nulls_last(), F.col("year").asc_nulls_last())


# ---------------------------------------------------------------- P16, P11

def generation_long(sheets: DataFrame, recode_sources: bool = True, source_codes: dict = SOURCE_CODES,
                    producer: str = TOTAL_PRODUCER) -> DataFrame:
    """Monthly generation of the total producer, with a ``year-month-01`` label.

    With ``recode_sources`` energy source names become series codes (unmapped
    names are kept).
    """
    g = sheets.select("year", "month", "state", "typeofproducer", "energysource", "generation")
    g = g.withColumn("year_month", month_label("year", "month")).where(F.col("typeofproducer") == producer)
    if recode_sources:
        g = g.withColumn("energysource", recode("energysource", source_codes))
    return g


def generation_monthly(sheets: DataFrame, sources: list[str] | None = None,
                       producer: str = TOTAL_PRODUCER) -> DataFrame:
    """Monthly generation wide, one column per source name (the long names).

    Without ``sources`` the long rows are written once (checkpoint) before their names are listed.
    """
    g = generation_long(sheets, recode_sources=False, producer=producer)
    if sources is None:
        ensure_checkpoint_dir(g.sparkSession)
        g = g.checkpoint()
    return pivot_wide(g, "energysource", "generation",
                      ids=["year", "month", "state", "typeofproducer", "year_month"], values=sources)


# ---------------------------------------------------------------- P12, P13

def generation_annual(sheets: DataFrame, codes: list[str] | None = None, source_codes: dict = SOURCE_CODES,
                      renewables: list[str] = RENEWABLE_CODES, producer: str = TOTAL_PRODUCER,
                      national: list[str] = NATIONAL_SPELLINGS, exact_scale: int | None = None) -> DataFrame:
    """Annual generation per state, wide by series code, zero-filled, with the renewables total EGREP.

    National spellings are unified to ``US``.  Only the pivoted value columns are
    zero-filled; a NULL key stays NULL.  ``codes`` fixes the column list; by
    default every code present becomes a column (sorted), as in the original.
    The monthly rows are summed and spread in one aggregation; without ``codes`` they are
    written once (checkpoint) before the codes are listed.
    """
    g = generation_long(sheets, source_codes=source_codes, producer=producer)
    g = g.withColumn("state", unify("state", national, "US"))
    if codes is None:
        ensure_checkpoint_dir(g.sparkSession)
        g = g.checkpoint()
    wide = pivot_sum(g, "energysource", "generation", ids=["year", "state"], values=codes, exact_scale=exact_scale)
    value_cols = [c for c in wide.columns if c not in ("year", "state")]
    missing = [c for c in renewables if c not in value_cols]
    if missing:
        raise KeyError(f"renewables total needs columns {missing}")
    wide = fill_zero(wide, value_cols)
    wide = wide.withColumns({"codeyr": paste("_", "state", "year"), "EGREP": row_sum(renewables)})
    return wide.withColumnRenamed("state", "statecode")


def combined_panel(panel: DataFrame, annual: DataFrame) -> DataFrame:
    """Left-join annual generation onto the panel by ``codeyr``; the panel's year wins.

    A generation column named like a panel column raises instead of producing
    suffixed twins.  Sorted by code and year.
    """
    joined = join_panels(panel, annual, "codeyr", drop_right=["year", "statecode"])
    return joined.orderBy(F.col("code").asc_nulls_last(), F.col("year").asc_nulls_last())


# ---------------------------------------------------------------- P14

def codebook(series: DataFrame) -> DataFrame:
    """Distinct (Variable, Description, Units) with place names and notes removed, sorted.

    The different records are taken before anything is cleaned, and a description is cleaned once however many
    records and series have it.
    """
    cb = series.where(F.col("geography").isNotNull()).select(
        F.col("geoset_id").alias("Variable"), F.col("description").alias("Description"),
        F.col("units").alias("Units")).distinct().checkpoint()
    cb = map_distinct(cb, "Description", clean_description)
    return (cb.select(substr_between("Variable", 6, 10).alias("Variable"), "Description", "Units")
            .distinct().orderBy(F.col("Variable").asc_nulls_last()))


def clean_description(column: str) -> Column:
    """A description without place names, without notes and without its first comma after that."""
    return remove_first(remove_first(remove_all(column, "|".join(STATE_NAMES)), "See.*$"), ",")
