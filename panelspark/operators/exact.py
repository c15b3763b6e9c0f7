"""Exact grouped sums of any doubles.

A double is a whole number of at most 53 bits times a power of two.  Each value is cut at fixed powers of
two (every ``BITS`` bits) into at most four whole numbers of ``BITS`` bits, one for each *bin* that it reaches into; bins are
summed as longs, which is exact whatever the order and the partitioning, and a group's bins (about 90 at most)
are put together and rounded once.  So the result is the double nearest to the true sum, whatever the sizes of the values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24                       # 2^39 rows a group fit into a long
POSITIVE, NEGATIVE = 1000, -1000        # bins of infinities
PIECE = "array<struct<bin: int, part: bigint>>"


def _two_to(k: Column) -> Column:
    return F.pow(F.lit(2.0), k.cast("double"))


def pieces(value: Column) -> Column:
    """``with_parts`` as one column, (bin, part) of a double: the sum of part * 2^(BITS * bin) is the value.  Missing values and zero give one part 0."""
    size = F.abs(value)
    guess = F.floor(F.log2(size) / BITS)
    bin_ = (F.when(size >= _two_to(BITS * (guess + 1)), guess + 1).when(size < _two_to(BITS * guess), guess - 1).otherwise(guess)).cast("int")
    unit = F.lit(float(1 << BITS))
    top = F.transform(F.array(bin_), lambda b: F.struct(b.alias("b"), (size * _two_to(-b * (BITS // 2)) * _two_to(-b * (BITS // 2))).alias("y")))
    sign = F.when(value < 0, -1).otherwise(1)

    def cut(t: Column) -> Column:
        out, rest = [], t["y"]
        for i in range(4):
            part = F.floor(rest)
            out.append(F.struct((t["b"] - i).alias("bin"), (part * sign).cast("long").alias("part")))
            rest = (rest - part) * unit
        return F.filter(F.array(*out), lambda p: p["part"] != 0)

    one = lambda b, p: F.array(F.struct(F.lit(b).alias("bin"), F.lit(p).alias("part"))).cast(PIECE)
    return (F.when(value.isNull() | F.isnan(value) | (value == 0), one(0, 0))
            .when(value == float("inf"), one(POSITIVE, 1)).when(value == float("-inf"), one(NEGATIVE, 1))
            .otherwise(F.flatten(F.transform(top, cut)).cast(PIECE)))


def with_parts(df: DataFrame, value: str) -> DataFrame:
    """Adds the top bin ``_b`` of a double and its four parts ``_p0`` to ``_p3``: the value is the sum of part i * 2^(BITS * (bin - i)).

    Missing values and zero are in bin 0, infinities in bins of their own with a part 1.  Plain columns, one made of the other.
    """
    v = F.col(value)
    kind = F.when(v.isNull() | F.isnan(v) | (v == 0), 0).when(F.abs(v) == float("inf"), 1).otherwise(2)
    df = df.withColumns({"_kind": kind, "_size": F.abs(v)})
    finite, size = F.col("_kind") == 2, F.col("_size")
    df = df.withColumn("_guess", F.when(finite, F.floor(F.log2(size) / BITS).cast("int")))
    guess = F.col("_guess")
    df = df.withColumn("_b", F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 1, F.when(v > 0, POSITIVE).otherwise(NEGATIVE))
                       .when(size >= _two_to(BITS * (guess + 1)), guess + 1).when(size < _two_to(BITS * guess), guess - 1).otherwise(guess))
    unit, sign = F.lit(float(1 << BITS)), F.when(v < 0, -1).otherwise(1)
    df = df.withColumn("_half", _two_to(F.when(finite, -F.col("_b") * (BITS // 2))))
    df = df.withColumn("_rest", size * F.col("_half") * F.col("_half"))
    parts = {}
    for i in range(4):
        df = df.withColumn(f"_f{i}", F.floor("_rest"))
        parts[f"_p{i}"] = F.when(finite, (F.col(f"_f{i}") * sign).cast("long")).when((F.col("_kind") == 1) & F.lit(i == 0), 1).otherwise(0).cast("long")
        df = df.withColumn("_rest", (F.col("_rest") - F.col(f"_f{i}")) * unit)
    return df.withColumns(parts).drop("_kind", "_size", "_guess", "_half", "_rest", *[f"_f{i}" for i in range(4)])


def _carried(bins: Column) -> Column:
    """(carry, digits of BITS bits, lowest first) of bins in a row."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(acc: Column, s: Column) -> Column:
        total = s + acc["carry"]
        carry = F.shiftright(total, BITS)
        return F.struct(carry.alias("carry"), F.array_append(acc["digits"], total - F.shiftleft(carry, BITS)).alias("digits"))
    return F.aggregate(bins, start, step)


def _rounded(df: DataFrame, name: str) -> DataFrame:
    """Replaces the array of (bin, part) in column ``name`` by the nearest double."""
    finite = F.filter(name, lambda p: F.abs(p["bin"]) < POSITIVE)
    has = lambda b: F.exists(name, lambda p: p["bin"] == b)
    df = df.withColumns({"_inf": F.when(has(POSITIVE) & has(NEGATIVE), F.lit(float("nan"))).when(has(POSITIVE), F.lit(float("inf"))).when(has(NEGATIVE), F.lit(float("-inf"))),
                         "_map": F.map_from_entries(F.transform(finite, lambda p: F.struct(p["bin"], p["part"])))})
    df = df.withColumn("_low", F.coalesce(F.array_min(F.map_keys("_map")), F.lit(0)))
    every = F.sequence(F.col("_low"), F.coalesce(F.array_max(F.map_keys("_map")), F.lit(0)) + 3)      # room for the carry
    df = df.withColumn("_bins", F.transform(every, lambda b: F.coalesce(F.try_element_at("_map", b), F.lit(0).cast("long"))))
    df = df.withColumn("_minus", _carried(F.col("_bins"))["carry"] < 0)
    df = df.withColumn("_bins", F.when(F.col("_minus"), F.transform("_bins", lambda s: -s)).otherwise(F.col("_bins")))
    df = df.withColumn("_down", F.reverse(_carried(F.col("_bins"))["digits"]))                          # highest first
    df = df.withColumn("_first", F.array_position(F.transform("_down", lambda d: d != 0), True).cast("int"))
    digit = lambda i: F.coalesce(F.get("_down", F.col("_first") - 1 + i), F.lit(0).cast("long")).cast("double")
    unit = F.lit(float(1 << BITS))
    # both halves are exact, and so is the half unit that stands for whatever lies below: the one addition rounds
    sticky = F.when(F.exists(F.slice("_down", F.col("_first") + 4, F.size("_down")), lambda d: d != 0), F.lit(0.5)).otherwise(F.lit(0.0))
    mantissa = (digit(0) * unit + digit(1)) * F.lit(2.0 ** (2 * BITS)) + (digit(2) * unit + digit(3) + sticky)
    last_bin = F.col("_low") + F.size("_down") - F.col("_first") - 3                                # of the fourth digit
    half = last_bin * (BITS // 2)
    total = F.when(F.col("_first") == 0, F.lit(0.0)).otherwise(mantissa * _two_to(half) * _two_to(half))
    total = F.when(F.col("_minus"), -total).otherwise(total)
    return df.withColumn(name, F.coalesce("_inf", total)).drop("_inf", "_map", "_low", "_bins", "_minus", "_down", "_first")


def exact_sums(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """One row per key with the correctly rounded sums ``out`` of the columns ``src``, NULL and NaN removed.

    An all-missing group sums to 0.  Infinities give +Inf, -Inf or (both) NaN; a sum beyond the doubles is infinite.  Tasks combine their
    rows per key and top bin before the shuffle, so a hot key costs a task some ninety rows; a row is never spread over its bins.
    """
    keys, names = list(keys), list(measures)

    values = F.array(*[F.col(src).cast("double") for src in measures.values()])
    rows = with_parts(df.select(*keys, F.posexplode(values).alias("m", "_v")), "_v")
    tops = rows.groupBy(*keys, "m", "_b").agg(*[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(4)])
    spread = F.array(*[F.struct((F.col("_b") - i).alias("bin"), F.col(f"_p{i}").alias("part")) for i in range(4)])
    kept = F.filter(spread, lambda p: (p["part"] != 0) | (p["bin"] == F.col("_b")))
    bins = tops.select(*keys, "m", F.explode(kept).alias("_p")).select(*keys, "m", "_p.*").groupBy(*keys, "m", "bin").agg(F.sum("part").alias("part"))
    out = bins.groupBy(*keys).agg(*[F.collect_list(F.when(F.col("m") == i, F.struct("bin", "part"))).alias(n) for i, n in enumerate(names)])
    for n in names:
        out = _rounded(out, n)
    return out
