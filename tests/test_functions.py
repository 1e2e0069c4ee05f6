"""Literal-row tests for the column functions (FIXTURES.md §7), incl. NULL fall-throughs."""

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import functions as RF
from revlens.operators.risk import risk_score, risk_tier


def col_values(spark, values, dtype, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType(
        [T.StructField("i", T.IntegerType()), T.StructField("x", dtype)]))
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_sentiment_null_is_neutral(spark):
    got = col_values(spark, [5, 4, 3, 2, 1, None], T.IntegerType(), RF.sentiment_from_rating)
    assert got == ["positive", "positive", "neutral", "negative", "negative", "neutral"]


def test_sentiment_thresholds_are_parameters(spark):
    got = col_values(spark, [5, 4, 2], T.IntegerType(), lambda c: RF.sentiment_from_rating(c, positive=5, negative=1))
    assert got == ["positive", "neutral", "neutral"]


def test_length_bucket(spark):
    assert col_values(spark, [49, 50, 299, 300], T.LongType(), RF.review_length_bucket) == ["short", "medium", "medium", "long"]


def test_has_votes_null_is_true(spark):
    assert col_values(spark, [0, 3, None], T.IntegerType(), RF.has_votes) == [False, True, True]


def test_price_parse_and_bucket(spark):
    vals = ["None", "", None, "9.99", "10", "100", "10d", "1_000", "$5"]
    got = col_values(spark, vals, T.StringType(), lambda c: RF.price_bucket(RF.parse_price(c)))
    assert got == ["unknown", "unknown", "unknown", "under_10", "10_to_25", "over_100", "unknown", "over_100", "unknown"]


EDGE_PRICES = [
    "None", "", "9.99", "10", " 5 ", "1e3", "NaN", "inf", "-inf", "$5", "1,000", "10d", "10f", "2.5D", "3F",
    "1_000", "1__0", "_1", "1_", "0x10", "+7", "-0.5", ".5", "5.", "1e", "e3", "12.99 ", "from 12.99", "1.2.3",
    "Infinity", "nan", "1_000.5",
]


def test_price_parse_matches_duckdb_try_cast(spark):
    """Our parse equals the warehouse engine's try_cast on edge strings."""
    got = col_values(spark, EDGE_PRICES, T.StringType(), RF.parse_price)
    con = duckdb.connect()
    want = []
    for s in EDGE_PRICES:
        if s in ("None", ""):
            want.append(None)
        else:
            want.append(con.execute("select try_cast(? as double)", [s]).fetchone()[0])
    for s, g, w in zip(EDGE_PRICES, got, want):
        if isinstance(w, float) and w != w:
            assert g != g, s
        else:
            assert g == w, (s, g, w)


def test_is_null_or_zero(spark):
    assert col_values(spark, [None, 0, 3], T.IntegerType(), RF.is_null_or_zero) == [True, True, False]


def test_volume_bucket(spark):
    got = col_values(spark, [None, 4, 5, 19, 20], T.LongType(), RF.review_volume_bucket)
    assert got == ["no_reviews", "sparse", "moderate", "moderate", "well_reviewed"]


def test_engagement_bucket(spark):
    got = col_values(spark, [1, 2, 4, 5, 20, 21], T.LongType(), RF.engagement_bucket)
    assert got == ["one_shot", "occasional", "occasional", "regular", "regular", "power_reviewer"]


def test_consistency_bucket(spark):
    got = col_values(spark, [None, 0.49, 0.5, 1.0, 1.5], T.DoubleType(), RF.rating_consistency)
    assert got == ["insufficient_data", "very_consistent", "consistent", "variable", "highly_variable"]


def test_tendency(spark):
    df = spark.createDataFrame([(2, 0.0), (3, -0.76), (3, -0.75), (3, 0.75), (3, 0.76)], "n long, d double")
    got = [r[0] for r in df.select(RF.reviewer_tendency("n", "d")).collect()]
    assert got == ["insufficient_data", "harsh", "balanced", "balanced", "generous"]


def test_health(spark):
    df = spark.createDataFrame([(4.3, 14.9), (4.3, 15.0), (3.8, 25.0), (3.2, 0.0)], "a double, p double")
    got = [r[0] for r in df.select(RF.category_health("a", "p")).collect()]
    assert got == ["healthy", "stable", "watch", "struggling"]


def test_risk_tier(spark):
    df = spark.createDataFrame([(4, 100.0), (20, 40.0), (19, 40.0), (9, 25.0), (5, 14.9)], "n long, p double")
    got = [r[0] for r in df.select(risk_tier(F.col("p"), F.col("n"))).collect()]
    assert got == ["insufficient_data", "critical", "high", "medium", "low"]


def test_risk_score_caps_and_damper(spark):
    # every signal at its maximum: 40 + 20 + 20 + 10 + 10 = 100, damped by 0.3 below 5 reviews
    df = spark.createDataFrame([(4, 100.0, 10, -1.0, 0.0, True), (20, 100.0, 10, -1.0, 0.0, True)],
                               "n long, neg double, hsn long, delta double, ver double, prem boolean")
    got = [r[0] for r in df.select(risk_score(F.col("neg"), F.col("hsn"), F.col("delta"), F.col("ver"),
                                              F.col("prem"), F.col("n"))).collect()]
    assert got == [30.0, 100.0]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 2)], "n int, d int")
    got = [r[0] for r in df.select(RF.safe_divide("n", "d")).collect()]
    assert got == [None, None, 0.5]
    assert df.limit(1).select(RF.safe_divide("n", "d", 0)).first()[0] == 0.0


def test_word_count_counts_spaces(spark):
    assert col_values(spark, ["a  b c", "one"], T.StringType(), RF.word_count_approx) == [4, 1]


def test_round_half_away_scales_binary_value(spark):
    df = spark.createDataFrame([(41 / 40,), (-2.5,), (0.125,), (None,)], "x double")
    got = [r[0] for r in df.select(RF.round_half_away("x", 2)).collect()]
    con = duckdb.connect()
    want = [con.execute("select round(?::double, 2)", [v]).fetchone()[0] for v in (41 / 40, -2.5, 0.125, None)]
    assert got == want
    assert got[0] == 1.02


def test_stddev_int_matches_definition(spark):
    df = spark.createDataFrame([(1, 5), (1, 4), (1, 1), (2, 3)], "g int, x int")
    got = dict(df.groupBy("g").agg(RF.stddev_samp_int("x").alias("s")).collect())
    import statistics
    assert got[1] == pytest.approx(statistics.stdev([5, 4, 1]), rel=1e-15)
    assert got[2] is None


def test_surrogate_key_null_marker(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    got = df.select(RF.surrogate_key("a", "b")).first()[0]
    import hashlib
    assert got == hashlib.md5(("a-" + RF.SURROGATE_NULL).encode()).hexdigest()


def test_weekend_and_trusted(spark):
    df = spark.createDataFrame([("2024-01-06",), ("2024-01-07",), ("2024-01-08",)], "d string")
    got = [r[0] for r in df.select(RF.is_weekend(F.to_date("d"))).collect()]
    assert got == [True, True, False]
    t = spark.createDataFrame([(True, "balanced", 50.1), (True, "balanced", 50.0), (None, "balanced", 90.0)],
                              "p boolean, t string, v double")
    assert [r[0] for r in t.select(RF.is_trusted("p", "t", "v")).collect()] == [True, False, False]
