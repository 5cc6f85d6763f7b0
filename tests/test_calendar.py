"""Model time and windows against a plain expansion of their definitions."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridtally.operators.calendar import (
    HorizonMap,
    expand_hours,
    hour_of_timestamp,
    label_horizons,
    stamp_horizons,
    time_map,
    timestamp_of_hour,
)
from gridtally.operators.windows import pad_year, rolling_horizons


def expected_map(year, h, hours, stamps):
    """The chain of horizons written out."""
    chain = [(h.first_horizon, p) for p in range(h.first_time, h.horizon_length + 1)]
    for k in range(h.first_horizon + 1, h.last_horizon):
        chain += [(k, p) for p in range(1, h.horizon_length + 1)]
    chain += [(h.last_horizon, p) for p in range(1, h.last_time + 1)]
    assert len(chain) == hours == len(stamps)
    return [(f"r{k}", p, year, t) for (k, p), t in zip(chain, stamps)]


def hours_from(year, n, skip=None):
    stamps = [datetime(year, 1, 1) + timedelta(hours=i) for i in range(n)]
    return stamps if skip is None else stamps[: skip - 1] + stamps[skip + 23 :]


@pytest.mark.parametrize(
    "year, leap, stamps",
    [
        (2021, "skip_feb28", hours_from(2021, 8760)),
        (2020, "skip_feb28", hours_from(2020, 8784, 1393)),
        (2020, "skip_feb29", hours_from(2020, 8784, 1417)),
        (2020, "first_8760", hours_from(2020, 8760)),
    ],
)
def test_time_map(spark, rows, year, leap, stamps):
    h = HorizonMap(leap=leap)
    wanted = expected_map(year, h, 8760, stamps)
    assert rows(time_map(spark, [year], h)) == sorted(wanted, key=repr)


def test_full_leap_year(spark):
    h = HorizonMap(last_horizon=137, last_time=8, leap="full")
    found = time_map(spark, [2020], h)
    assert found.count() == 8784
    assert found.agg(F.max("date_time")).first()[0] == datetime(2020, 12, 31, 23)


def test_skipped_days(spark):
    stamps = [datetime(2020, 2, 27, 23), datetime(2020, 2, 28, 0), datetime(2020, 2, 29, 0),
              datetime(2020, 3, 1, 0)]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
    found = {
        leap: [r.h for r in df.select(hour_of_timestamp(F.col("t"), leap).alias("h")).collect()]
        for leap in ("skip_feb28", "skip_feb29", "full")
    }
    assert found == {
        "skip_feb28": [1392, None, 1393, 1417],
        "skip_feb29": [1392, 1393, None, 1417],
        "full": [1392, 1393, 1417, 1441],
    }


def test_time_map_over_many_years(spark):
    """The documented example: 29 years of 8,760 hours."""
    found = time_map(spark, range(2021, 2050), HorizonMap(70, 11, 45, 136, 54, "first_8760"))
    assert found.count() == 254_040
    ends = found.groupBy("year").agg(
        F.min_by(F.struct("horizon", "period"), "date_time").alias("a"),
        F.max_by(F.struct("horizon", "period"), "date_time").alias("b"),
    )
    assert {(tuple(r.a), tuple(r.b)) for r in ends.collect()} == {(("r11", 45), ("r136", 54))}


@pytest.mark.parametrize("year", [2020, 2021])
def test_stamping_equals_a_join_with_the_map(spark, rows, year):
    h = HorizonMap()
    model = (
        spark.range(1, 10_001)
        .withColumn("horizon", F.concat(F.lit("r"), F.floor((F.col("id") - 1) / 70) + 1))
        .withColumn("period", ((F.col("id") - 1) % 70 + 1).cast("int"))
    )
    header = spark.createDataFrame([(0, None, 1), (-1, "from", 2)], "id long, horizon string, period int")
    model = model.unionByName(header)
    joined = model.join(time_map(spark, [year], h), ["horizon", "period"])
    wanted = rows(joined, "id", "date_time")
    assert len(wanted) == 8760
    assert rows(stamp_horizons(model, year, h), "id", "date_time") == wanted


def test_labels_invert_stamps(spark):
    h = HorizonMap()
    mapped = time_map(spark, [2020], h)
    back = label_horizons(mapped.select("date_time", F.col("horizon").alias("k"), F.col("period").alias("p")), h)
    assert back.where("horizon <> k OR period <> p OR horizon IS NULL").count() == 0
    outside = spark.createDataFrame([(datetime(2020, 2, 28, 5),)], "date_time timestamp_ntz")
    assert label_horizons(outside, h).first().horizon is None


def test_horizon_length_is_used(spark):
    """Middle horizons have horizon_length periods, whatever the length."""
    h = HorizonMap(100, 1, 1, 88, 60, "first_8760")
    found = time_map(spark, [2021], h).groupBy("horizon").count()
    assert {r["count"] for r in found.collect()} == {100, 60}


def test_checks():
    with pytest.raises(ValueError, match="hours"):
        HorizonMap(last_time=53).check_year(2021)
    with pytest.raises(ValueError, match="leap"):
        HorizonMap(leap="no")
    assert not HorizonMap().check_padding(720)  # the year starts a day after the padding
    assert HorizonMap(first_time=21, last_time=30).check_padding(720)


def test_hour_spine(spark):
    years = spark.createDataFrame([(2020,), (2021,)], "year int")
    counts = {r.year: r["count"] for r in expand_hours(years).groupBy("year").count().collect()}
    assert counts == {2020: 8784, 2021: 8760}


def test_timestamp_of_hour(spark):
    df = spark.createDataFrame([(1,), (1392,), (1393,), (8760,)], "h int")
    found = [r.t for r in df.select(timestamp_of_hour(F.col("h"), 2020).alias("t")).collect()]
    assert found == [
        datetime(2020, 1, 1), datetime(2020, 2, 27, 23), datetime(2020, 2, 29),
        datetime(2020, 12, 31, 23),
    ]


def padded(n, pad, template):
    x = list(range(1, n + 1))
    tail = template - n - pad
    return x[:pad] + x + (x[n - tail :] if tail > 0 else [])


@pytest.mark.parametrize("n, pad, template", [(8760, 720, 9504), (50, 10, 65), (50, 10, 60), (50, 10, 40)])
def test_pad_year(spark, n, pad, template):
    series = spark.range(1, n + 1).select(F.col("id").alias("t"), F.col("id").alias("v"))
    found = {r.t: r.v for r in pad_year(series, n, pad, template).collect()}
    wanted = padded(n, pad, template)
    assert found == dict(enumerate(wanted, 1))


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 60), st.integers(1, 12), st.data())
def test_rolling_horizons(spark, n, length, data):
    cutoff = data.draw(st.integers(0, length - 1))
    stride = length - cutoff
    series = spark.range(1, n + 1).select(F.col("id").alias("t"), F.col("id").alias("v"))
    found = rolling_horizons(series, length, cutoff)
    wanted, k = set(), 1
    while stride * (k - 1) + 1 <= n:
        start = stride * (k - 1)
        wanted |= {(k, p, start + p) for p in range(1, length + 1) if start + p <= n}
        k += 1
    assert {(r.horizon, r.period, r.v) for r in found.collect()} == wanted


def test_default_horizons(spark):
    """The padded year has 136 horizons; the last holds 54 hours, neighbours share 30."""
    series = spark.range(1, 9505).select(F.col("id").alias("t"))
    placed = rolling_horizons(series)
    sizes = {r.horizon: r["count"] for r in placed.groupBy("horizon").count().collect()}
    assert max(sizes) == 136 and sizes[1] == 100 and sizes[136] == 54
    shared = placed.alias("a").join(placed.alias("b"), "t").where("a.horizon + 1 = b.horizon")
    counts = shared.groupBy("a.horizon").count()
    assert {r["count"] for r in counts.where("horizon < 135").collect()} == {30}
    assert rolling_horizons(series, horizons=10).agg(F.max("horizon")).first()[0] == 10
