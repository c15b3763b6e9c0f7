"""Run the three published pipelines end to end: landed files in, tables written out.

    python -m panelspark.plans.run mining --production P --mines M --county-lookup C \
        --mtype-lookup T --out DIR [--state KY] [--compat] [--format csv|parquet]
    python -m panelspark.plans.run energy --series S --sheets DIR --state-lookup L --out DIR [--compat]
    python -m panelspark.plans.run housing --housing DIR --state-lookup L --out DIR [--start 2010]

Each table is written to its own folder under ``--out`` by all tasks in
parallel (CSV with a header and NULL written as ``NA`` by default, parquet as an
option).  ``--compat`` reproduces the published tables literally; without it
the corrected semantics apply (see README).
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from panelspark.plans import energy_panel, housing, mining
from panelspark.session import ensure_checkpoint_dir
from panelspark.sources import (CORRUPT, corrupt_rows, landed_years, read_delimited, read_lookup, read_series_ndjson,
                                read_sheet_set, write_table)


def read_input(spark: SparkSession, path: str) -> DataFrame:
    """A landed parquet table (a folder of parquet files, e.g. from ``streaming.land_delimited``)
    or pipe-delimited text, read by header name.

    Spark lists the files, so the path may be on any store it knows.  Damaged text rows stay;
    their number is reported (one pass over the text).
    """
    files = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    if files and all(f.endswith(".parquet") for f in files):
        return spark.read.parquet(path).drop("_source")
    rows = read_delimited(spark, path)
    bad = corrupt_rows(rows)
    if bad:
        print(f"{path}: {bad} rows with another number of fields than the header", file=sys.stderr)
    return rows.drop(CORRUPT)


def _once(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """The table written once and read back, so that what derives from it does not make it again."""
    if fmt == "parquet":
        write_table(df, path, fmt=fmt)
        return df.sparkSession.read.parquet(path)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _write(tables: dict[str, DataFrame], out: str, fmt: str) -> dict[str, str]:
    paths = {}
    for name, df in tables.items():
        paths[name] = os.path.join(out, name)
        write_table(df, paths[name], fmt=fmt, null_value="NA" if fmt == "csv" else None)
    return paths


def run_mining(spark: SparkSession, production: str, mines: str, county_lookup: str, mtype_lookup: str,
               out: str, state: str = "KY", compat: bool = False, fmt: str = "csv") -> dict[str, str]:
    """Enriched facts (all states and one state) and every growth table.

    ``production`` and ``mines`` are delimited files, or parquet tables landed by
    ``streaming.land_delimited`` (year partitions are then pruned by the state and
    period filters Spark pushes down).
    """
    prod = read_input(spark, production)
    mine = read_input(spark, mines)
    cl = read_lookup(spark, county_lookup, key=mining.DEFAULT.lookup_county)
    ml = read_lookup(spark, mtype_lookup, key=mining.DEFAULT.subunit)
    facts = _once(mining.enrich_facts(prod, mine, cl, ml), os.path.join(out, "facts"), fmt)
    subset = mining.state_subset(facts, state)
    tables = {} if fmt == "parquet" else {"facts": facts}
    tables[f"facts_{state.lower()}"] = subset
    tables.update(mining.growth_tables(subset, cl, compat=compat))
    return {"facts": os.path.join(out, "facts"), **_write(tables, out, fmt)}


def run_energy(spark: SparkSession, series: str, sheets: str, state_lookup: str, out: str,
               compat: bool = False, fmt: str = "csv") -> dict[str, str]:
    """State-year panel, monthly and annual generation, combined panel and codebook."""
    ensure_checkpoint_dir(spark)
    ser = read_series_ndjson(spark, series).checkpoint()        # parsed once for panel and codebook
    sheet_rows = read_sheet_set(spark, sheets).checkpoint()     # parsed once for three tables
    panel = energy_panel.state_year_panel(ser, read_lookup(spark, state_lookup, key="statecode"), compat=compat)
    annual = energy_panel.generation_annual(sheet_rows)
    return _write({
        "state_year_panel": panel,
        "generation_monthly": energy_panel.generation_monthly(sheet_rows),
        "generation_long": energy_panel.generation_long(sheet_rows),
        "generation_annual": annual,
        "combined_panel": energy_panel.combined_panel(panel, annual),
        "codebook": energy_panel.codebook(ser),
    }, out, fmt)


def run_housing(spark: SparkSession, housing_dir: str, state_lookup: str, out: str, start: int = 2010,
                fmt: str = "csv") -> dict[str, str]:
    """The county housing table."""
    table = housing.housing_table(housing.read_housing(spark, housing_dir), read_lookup(spark, state_lookup, key="name"),
                                  start, years=landed_years(spark, housing_dir))
    return _write({"housing": table}, out, fmt)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="panelspark.plans.run")
    sub = ap.add_subparsers(dest="pipeline", required=True)
    m = sub.add_parser("mining")
    for a in ("--production", "--mines", "--county-lookup", "--mtype-lookup"):
        m.add_argument(a, required=True)
    m.add_argument("--state", default="KY")
    e = sub.add_parser("energy")
    for a in ("--series", "--sheets", "--state-lookup"):
        e.add_argument(a, required=True)
    h = sub.add_parser("housing")
    h.add_argument("--housing", required=True)
    h.add_argument("--state-lookup", required=True)
    h.add_argument("--start", type=int, default=2010)
    for p in (m, e, h):
        p.add_argument("--out", required=True)
        p.add_argument("--format", default="csv", choices=["csv", "parquet"])
        p.add_argument("--compat", action="store_true")
    args = ap.parse_args(argv)

    from panelspark.session import build_session
    spark = build_session()
    if args.pipeline == "mining":
        paths = run_mining(spark, args.production, args.mines, args.county_lookup, args.mtype_lookup, args.out,
                           args.state, args.compat, args.format)
    elif args.pipeline == "energy":
        paths = run_energy(spark, args.series, args.sheets, args.state_lookup, args.out, args.compat, args.format)
    else:
        paths = run_housing(spark, args.housing, args.state_lookup, args.out, args.start, args.format)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
