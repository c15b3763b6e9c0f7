import math

from pyspark.sql import functions as F

from panelspark.functions import (backfill, extract_first, growth_rate, ieee_divide, if_else, int_text,
                                  is_missing, month_label, nan_to_null, paste, quarter_end_date,
                                  quarter_end_label, quarter_label, recode, remove_all, remove_first,
                                  safe_double, sentence_case, split_piece, substr_between, sum_skip_missing,
                                  trim_space, unify)


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_ieee_divide_zero_base(spark):
    data = [(5.0, 0.0), (-5.0, 0.0), (0.0, 0.0), (float("nan"), 0.0), (6.0, 3.0), (None, 0.0), (1.0, None)]
    out = one(spark, ieee_divide("a", "b"), data, "a double, b double")
    assert out[0] == math.inf and out[1] == -math.inf
    assert math.isnan(out[2]) and math.isnan(out[3])
    assert out[4] == 2.0 and out[5] is None and out[6] is None
    nulls = one(spark, ieee_divide("a", "b", zero_base="null"), data, "a double, b double")
    assert nulls[:4] == [None, None, None, None] and nulls[4] == 2.0


def test_growth_rate(spark):
    out = one(spark, growth_rate("x", "p"), [(12.0, 10.0), (0.0, 10.0), (3.0, 0.0), (0.0, 0.0)], "x double, p double")
    assert out[0] == (12.0 - 10.0) / 10.0 and out[1] == -1.0 and out[2] == math.inf and math.isnan(out[3])


def test_sum_skip_missing_all_missing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 1.5), ("b", float("nan")), ("b", 2.25)],
                               "k string, v double")
    got = dict(df.groupBy("k").agg(sum_skip_missing("v").alias("s")).collect())
    assert got == {"a": 0.0, "b": 3.75}
    exact = dict(df.groupBy("k").agg(sum_skip_missing("v", 2).alias("s")).collect())
    assert exact == {"a": 0.0, "b": 3.75}


def test_backfill_nan_replaced_inf_kept(spark):
    data = [(None, 1.0), (float("nan"), 2.0), (math.inf, 3.0), (4.0, 5.0), (float("nan"), None)]
    out = one(spark, backfill("a", "b"), data, "a double, b double")
    assert out == [1.0, 2.0, math.inf, 4.0, None]
    assert one(spark, backfill("a", "b", numeric=False), [(None, "x"), ("y", "x")], "a string, b string") == ["x", "y"]


def test_nan_to_null_and_is_missing(spark):
    data = [(float("nan"),), (None,), (1.0,), (math.inf,)]
    assert one(spark, nan_to_null("a"), data, "a double") == [None, None, 1.0, math.inf]
    assert one(spark, is_missing("a"), data, "a double") == [True, True, False, False]


def test_if_else_null_condition_gives_null(spark):
    out = one(spark, if_else(F.col("c"), F.lit("y"), F.lit("n")), [(True,), (False,), (None,)], "c boolean")
    assert out == ["y", "n", None]


def test_sentence_case_differs_from_initcap(spark):
    out = one(spark, sentence_case("s"), [("le flore",), ("MCCREARY",), ("",), (None,)], "s string")
    assert out == ["Le flore", "Mccreary", "", None]


def test_substr_between(spark):
    out = one(spark, substr_between("s", 6, 10), [("SEDS.ABICB.A",), ("SEDS",)], "s string")
    assert out == ["ABICB", ""]
    assert one(spark, substr_between("s", 5, 6), [("USA-KY",)], "s string") == ["KY"]


def test_remove_first_only_first(spark):
    out = one(spark, remove_first("s", "Parish|County|Borough"),
              [("Parish County",), ("Juneau City and Borough",), ("none here",), ("a\nCounty",)], "s string")
    assert out == [" County", "Juneau City and ", "none here", "a\n"]
    assert one(spark, remove_first("s", "See.*$"), [("Total, See notes",)], "s string") == ["Total, "]
    assert one(spark, remove_first("s", ","), [("a, b, c",)], "s string") == ["a b, c"]


def test_remove_all_leftmost_alternative(spark):
    out = one(spark, remove_all("s", "Kansas|Arkansas|Virginia|West Virginia"),
              [("Arkansas and West Virginia",)], "s string")
    # The leftmost position wins: "Arkansas" and "West Virginia" go whole although
    # "Kansas" and "Virginia" come first in the list.
    assert out == [" and "]
    assert one(spark, remove_all("s", "MO|PROMO"), [("PROMO BRASS",)], "s string") == [" BRASS"]


def test_trim_space(spark):
    assert one(spark, trim_space("s"), [("\t a b \n",), (None,)], "s string") == ["a b", None]


def test_extract_first_no_match_is_null(spark):
    out = one(spark, extract_first("s", "[0-9]{4}"), [("housing_2010.json",), ("none",)], "s string")
    assert out == ["2010", None]


def test_split_piece(spark):
    data = [("Pike County, Kentucky",), ("District of Columbia",), ("a,b,c",)]
    assert one(spark, split_piece("s", ",", 2), data, "s string") == [" Kentucky", None, "b"]


def test_paste_null_rules(spark):
    data = [("KY", 2015), (None, 2016)]
    assert one(spark, paste("_", "g", "y"), data, "g string, y int") == ["KY_2015", None]
    assert one(spark, paste("_", "g", "y", na_text=True), data, "g string, y int") == ["KY_2015", "NA_2016"]


def test_labels(spark):
    data = [(2015.0, 3.0, 7)]
    schema = "y double, q double, m int"
    assert one(spark, int_text("y"), data, schema) == ["2015"]
    assert one(spark, quarter_label("y", "q"), data, schema) == ["2015-3"]
    assert one(spark, quarter_end_label("y", "q"), data, schema) == ["2015-9-01"]
    assert one(spark, month_label("y", "m"), data, schema) == ["2015-7-01"]
    assert str(one(spark, quarter_end_date("y", "q"), data, schema)[0]) == "2015-09-01"


def test_safe_double(spark):
    out = one(spark, safe_double("s"), [(" 12 ",), ("",), ("n/a",), ("1e3",), (None,)], "s string")
    assert out == [12.0, None, None, 1000.0, None]


def test_recode_and_unify(spark):
    data = [("Coal",), ("Wind",), ("Battery",), (None,)]
    assert one(spark, recode("s", {"Coal": "EGCLP", "Wind": "EGWYP"}), data, "s string") == \
        ["EGCLP", "EGWYP", "Battery", None]
    assert one(spark, unify("s", ["US-TOTAL", "US-Total"], "US"), [("US-TOTAL",), ("US-Total",), ("KY",), (None,)],
               "s string") == ["US", "US", "KY", None]


def test_exact_sum_raises_on_more_decimals(spark):
    import pytest
    from pyspark.errors import PySparkException

    from panelspark.functions.missing import sum_skip_missing
    fine = spark.createDataFrame([(0.07,), (123456789012.34,), (None,), (float("nan"),), (-0.01,)], "v double")
    assert fine.agg(sum_skip_missing("v", 2)).first()[0] == 123456789012.40
    with pytest.raises(PySparkException, match="more than 2 decimals"):
        spark.createDataFrame([(0.004,)] * 3, "v double").agg(sum_skip_missing("v", 2)).collect()
    assert spark.createDataFrame([(0.004,)] * 3, "v double").agg(sum_skip_missing("v", 3)).first()[0] == 0.012
