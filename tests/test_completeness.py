"""Slot bitmaps against sets of stamps."""

import random
from datetime import date, datetime, timedelta

import pytest

from gridtally.operators.completeness import coverage, missing_slots, slot_days

SCHEMA = "station string, date_time timestamp_ntz"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("step", "shift"), [(5, 0), (5, 5), (30, 30), (60, 0), (1, 0), (1440, 0)])
def test_gaps_and_repeats(spark, step, shift):
    r = random.Random(step + shift)
    start, n = datetime(2024, 2, 27, 22, 0), 4 * 1440 // step
    rows = []
    for name, share in (("a", 0.9), ("b", 0.4), (None, 0.7)):
        for k in range(n):
            if r.random() < share:
                stamp = start + timedelta(minutes=step * k + r.randrange(step) + shift)
                rows += [(name, stamp)] * r.choice([1, 1, 1, 2])
    rows.append(("a", None))
    feed = spark.createDataFrame(rows, SCHEMA)

    def slot(stamp):
        minute = (stamp - timedelta(minutes=shift)).replace(second=0)
        return minute - timedelta(minutes=(minute.hour * 60 + minute.minute) % step)

    seen = {}
    for name, stamp in rows:
        if stamp:
            seen.setdefault(name, []).append(slot(stamp))
    low, high = min(map(min, seen.values())), max(map(max, seen.values()))
    grid = [low + timedelta(minutes=step * k) for k in range(int((high - low).total_seconds() // 60 // step) + 1)]
    missing = {(name, g) for name, s in seen.items() for g in grid if g not in set(s)}
    found = missing_slots(feed, ["station"], step, end_of_interval_minutes=shift)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(missing, key=repr)
    table = {(c.station, c.day): tuple(c)[2:] for c in coverage(feed, ["station"], step, end_of_interval_minutes=shift).collect()}
    assert set(table) == {(name, d.date()) for name in seen for d in grid}
    for (name, day), counts in table.items():
        own = [s for s in seen[name] if s.date() == day]
        expected = sum(g.date() == day for g in grid)
        assert counts == (expected, len(own), expected - len(set(own)), len(own) - len(set(own)))


def test_a_given_grid_and_given_series(spark):
    feed = spark.createDataFrame(
        [("a", datetime(2021, 1, 1, 0, 0)), ("a", datetime(2021, 1, 1, 0, 5)), ("a", datetime(2021, 1, 3))], SCHEMA
    )
    series = spark.createDataFrame([("a",), ("b",)], "station string")
    found = missing_slots(feed, ["station"], 5, series=series, start="2021-01-01 00:00:00", end="2021-01-01 00:10:00")
    at = [datetime(2021, 1, 1, 0, m) for m in (0, 5, 10)]
    assert sorted(map(tuple, found.collect())) == [("a", at[2]), *(("b", t) for t in at)]
    days = coverage(feed, ["station"], 5, start="2021-01-01 00:00:00", end="2021-01-02 23:55:00").collect()
    assert sorted(map(tuple, days)) == [("a", date(2021, 1, 1), 288, 2, 286, 0), ("a", date(2021, 1, 2), 288, 0, 288, 0)]
    assert coverage(feed.where("false"), ["station"], 5).count() == 0


def test_bitmaps_need_no_sort_and_no_join(spark):
    feed = spark.createDataFrame([("a", datetime(2021, 1, 1))], SCHEMA)
    plan = plan_of(slot_days(feed, ["station"]))
    assert plan.count("HashAggregate") == 2 and "Sort" not in plan and "Join" not in plan
    with pytest.raises(ValueError, match="whole number"):
        slot_days(feed, ["station"], 7)
