"""A bounded, repeatable sample of rows for fitting."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAIN = 1 << 30


def about(key: Column, wanted: int, rows: int) -> Column:
    """Condition that holds for about ``wanted`` of ``rows`` rows, by a hash of ``key``.

    It holds for every row if there are no more than that.  The rows are the same however the table is
    partitioned, and no task gathers candidates of others.
    """
    share = 1.0 if rows <= wanted else wanted / rows
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(GRAIN)) < F.lit(math.ceil(share * GRAIN))
