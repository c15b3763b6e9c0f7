"""County housing characteristics from yearly JSON matrices.

Each landed file holds one year's matrix (header row first); the year comes
from the file name, and only the unbroken run of years from ``start`` is kept.
Only the needed codes are taken out of each row's cell map, right at the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.labels import safe_int
from panelspark.functions.text import extract_first, remove_first, trim_space
from panelspark.operators.frames import select_spec, split_column
from panelspark.operators.skew import lookup_join
from panelspark.sources.readers import contiguous_year_prefix, read_json_matrix

# Output column -> table code, in header order.
HOUSING_CODES = {
    "OccHU": "S2504_C01_001E",
    "YrBuilt_2014plus": "S2504_C01_009E",
    "YrBuilt_2010_2013": "S2504_C01_010E",
    "YrBuilt_2000_2009": "S2504_C01_011E",
    "YrBuilt_1980_1999": "S2504_C01_012E",
    "YrBuilt_1960_1979": "S2504_C01_013E",
    "YrBuilt_1940_1959": "S2504_C01_014E",
    "YrBuilt_1939OrLess": "S2504_C01_015E",
    "UtilityGas": "S2504_C01_032E",
    "Heating_LPGas": "S2504_C01_033E",
    "Heating_Elec": "S2504_C01_034E",
    "Heating_FuelOil": "S2504_C01_035E",
    "Heating_Coal": "S2504_C01_036E",
    "Heating_Other": "S2504_C01_037E",
    "Heating_None": "S2504_C01_038E",
}
# Words removed (first match only) from county names.
COUNTY_WORDS = "Parish|County|Census Area|Borough|Municipality|Municipio"
OUTPUT = ["year", "State", "county", "statecode", ("prefix", "YrBuilt"), ("prefix", "Heating"),
          ("prefix", "OccHU")]


def housing_rows(matrices: DataFrame, start: int = 2010, years: DataFrame | None = None) -> DataFrame:
    """Rows of every year file in the unbroken run from ``start``; all values stay text.

    ``years`` are the years landed (``sources.landed_years``); without it, those with rows.
    """
    rows = matrices.withColumn("year", extract_first("source", "[0-9]{4}")).withColumn("_y", safe_int("year"))
    return contiguous_year_prefix(rows, "_y", start, years).drop("_y", "source")


def housing_table(matrices: DataFrame, state_lookup: DataFrame, start: int = 2010,
                  years: DataFrame | None = None) -> DataFrame:
    """The 18-column county table.

    ``NAME`` ("X County, State") is split on the comma; the state is trimmed, the
    county loses the first place word, is trimmed and lower-cased; the state code
    is looked up by state name (NULL when absent).  ``UtilityGas`` is renamed and
    then left out, as no kept prefix matches it.
    """
    rows = housing_rows(matrices, start, years)
    rows = split_column(rows, "NAME", ["County", "State"], sep=",")
    rows = rows.withColumn("State", trim_space("State"))
    # Build under a temporary name: Spark resolves "county" and "County" as one column.
    rows = (rows.withColumn("_county", F.lower(trim_space(remove_first("County", COUNTY_WORDS))))
            .drop("County").withColumnRenamed("_county", "county"))
    rows = lookup_join(rows, state_lookup, "State", "name", "left")
    rows = rows.withColumnsRenamed({code: name for name, code in HOUSING_CODES.items()})
    return select_spec(rows, OUTPUT)


def read_housing(spark: SparkSession, path: str) -> DataFrame:
    """Read the landed yearly files, keeping only ``NAME`` and the needed codes."""
    return read_json_matrix(spark, path, keys=["NAME", *HOUSING_CODES.values()])
