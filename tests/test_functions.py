import pytest
from pyspark.sql import functions as F

from gridtally.functions import (
    after_last,
    before_first,
    days_in_year,
    deadband,
    drop_suffix,
    file_extension,
    file_prefix,
    first_number,
    gigawatt_hours,
    hour_of_year,
    hour_start,
    lenient_sum,
    named_or_unknown,
    strict_avg,
    strict_sum,
    weighted_mean,
    weighted_ratio,
    year_start,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def aggregate(spark, rows, schema, column):
    return spark.createDataFrame(rows, schema).agg(column.alias("x")).first().x


@pytest.mark.parametrize(
    "values, total, mean, loose",
    [([1.0, 3.0], 4.0, 2.0, 4.0), ([1.0, None], None, None, 1.0), ([None], None, None, 0.0)],
)
def test_null_rules(spark, values, total, mean, loose):
    rows = [(v,) for v in values]
    assert aggregate(spark, rows, "v double", strict_sum("v")) == total
    assert aggregate(spark, rows, "v double", strict_avg("v")) == mean
    assert aggregate(spark, rows, "v double", lenient_sum("v")) == loose


def test_strict_sum_of_some_rows(spark):
    rows = [("a", 1.0), ("a", 2.0), ("b", None)]
    assert aggregate(spark, rows, "k string, v double", strict_sum("v", F.col("k") == "a")) == 3
    assert (
        aggregate(spark, rows, "k string, v double", strict_sum("v", F.col("k") == "b")) is None
    )
    assert (
        aggregate(spark, rows, "k string, v double", strict_sum("v", F.col("k") == "c")) is None
    )


@pytest.mark.parametrize(
    "rows, mean, ratio",
    [
        ([(10.0, 1.0), (20.0, 3.0)], 17.5, 17.5),
        ([(10.0, 1.0), (None, 0.0)], 10.0, None),  # weight 0 may lack a price
        ([(10.0, 1.0), (None, 2.0)], None, None),
        ([(10.0, 1.0), (20.0, None)], None, None),
        ([(10.0, 1.0), (20.0, -1.0)], None, None),  # weights sum to zero
        ([(10.0, 3.0), (20.0, -1.0)], 5.0, 5.0),
    ],
)
def test_weighted(spark, rows, mean, ratio):
    p, w = F.col("p"), F.col("w")
    assert aggregate(spark, rows, "p double, w double", weighted_mean(p, w)) == mean
    assert aggregate(spark, rows, "p double, w double", weighted_ratio(p, w)) == ratio


def test_weighted_skipping_nulls(spark):
    rows = [(10.0, 1.0), (None, 2.0), (20.0, 3.0)]
    column = weighted_ratio(F.col("p"), F.col("w"), skip_nulls=True)
    assert aggregate(spark, rows, "p double, w double", column) == 17.5


@pytest.mark.parametrize(
    "value, wanted", [(0.00005, 0.0), (-0.00005, 0.0), (0.0001, 0.0001), (-2.0, -2.0)]
)
def test_deadband(spark, value, wanted):
    assert one(spark, deadband(F.lit(value))) == wanted


def test_scaling(spark):
    assert one(spark, gigawatt_hours(F.lit(1234567.0), 1)) == 1234.6
    assert one(spark, gigawatt_hours(F.lit(1234567.8))) == 1234.568


@pytest.mark.parametrize(
    "function, text, wanted",
    [
        (lambda c: before_first(c, "_"), "NSW_QNI", "NSW"),
        (lambda c: after_last(c, "_"), "NSW_QNI", "QNI"),
        (lambda c: before_first(c, "_"), "NSW", "NSW"),
        (lambda c: after_last(c, "_"), "A_B_C", "C"),
        (lambda c: before_first(c, "."), "BW01.Generator", "BW01"),
        (lambda c: drop_suffix(c, "1"), "NSW_QLD1", "NSW_QLD"),
        (lambda c: drop_suffix(c, "1.Price_5min"), "NSW1.Price_5min", "NSW"),
        (lambda c: drop_suffix(c, "1"), "M1_TAS", "M1_TAS"),
        (first_number, "Cap 2030 MW 5", "2030"),
        (first_number, "Cap", None),
        (file_extension, "INPUT_DATA.v2.xlsx", "xlsx"),
        (file_prefix, "INPUT_DATA_ZONAL_1.xlsx", "INPUT"),
        (named_or_unknown, None, "UNKNOWN"),
    ],
)
def test_text(spark, function, text, wanted):
    assert one(spark, function(F.lit(text).cast("string"))) == wanted


def test_times(spark, at):
    stamp = F.lit("2021-03-01 05:55:30").cast("timestamp_ntz")
    assert one(spark, hour_start(stamp)) == at("03-01 05:00")
    on_hour = F.lit("2021-03-01 05:00:00").cast("timestamp_ntz")
    assert one(spark, hour_start(on_hour, 5)) == at("03-01 04:00")
    assert one(spark, hour_of_year(stamp)) == (31 + 28) * 24 + 6
    assert one(spark, year_start(2021)) == at("01-01 00:00")
    assert [one(spark, days_in_year(y)) for y in (2020, 2021, 2100, 2000)] == [366, 365, 365, 366]


def test_hours_do_not_depend_on_the_session_zone(spark):
    """02:30 does not exist in this zone on this day; zone-free time keeps it."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        stamp = F.lit("2021-03-14 02:30:00").cast("timestamp_ntz")
        assert str(one(spark, hour_start(stamp))) == "2021-03-14 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
