"""Events in windows against a plain comparison of all pairs."""

import random
from datetime import datetime, timedelta

import pytest
from plan_tools import final_plan
from pyspark.sql import functions as F

from cohortloom.operators import sizing, windows
from cohortloom.operators.windows import events_in_windows

WINDOWS = "patient_key long, window long, opens timestamp_ntz, closes timestamp_ntz, _level string"
EVENTS = "patient_key long, event long, moment timestamp_ntz, other string"
ORIGIN = datetime(1969, 12, 20)


def some_rows(seed, n=150):
    rng = random.Random(seed)

    def moment(days):
        return ORIGIN + timedelta(days=rng.randrange(days), hours=rng.choice((0, 0, 5, 23)), microseconds=rng.choice((0, 0, 1)))

    opened = []
    for k in range(n):
        start = moment(4000) if rng.random() < 0.95 else None
        length = rng.choice((0, 1, 30, 31, 32, 400, 600, 9000, 200_000, -5))
        end = start and start + timedelta(days=length, hours=rng.choice((0, 12)))
        opened.append((rng.choice((1, 1, 1, 2, 3, None)), k, start, rng.choice((end, end, end, None)), "x"))
    events = [(rng.choice((1, 1, 1, 2, 4, None)), k, rng.choice((moment(4000), moment(100_000), None)), "y") for k in range(2 * n)]
    return opened, events


def pairs(opened, events):
    return sorted(
        (w[1], e[1])
        for w in opened
        for e in events
        if w[0] is not None and w[0] == e[0] and None not in (w[2], w[3], e[2]) and w[2] <= e[2] < w[3]
    )


def run(spark, opened, events):
    found = events_in_windows(spark.createDataFrame(opened, WINDOWS.replace("_level", "tag")), spark.createDataFrame(events, EVENTS), "opens", "closes", "moment")
    assert found.columns == ["patient_key", "window", "opens", "closes", "tag", "event", "moment", "other"]
    return found, sorted((r.window, r.event) for r in found.collect())


@pytest.mark.parametrize("limit", [None, -1])
def test_all_pairs_are_found_once(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    opened, events = some_rows(1 if limit is None else 2)
    assert run(spark, opened, events)[1] == pairs(opened, events) != []


def test_one_level_and_repeated_rows(spark):
    opened, events = some_rows(3)
    short = [w for w in opened if w[2] and w[3] and (w[3] - w[2]).days < 500]
    assert run(spark, short * 2, events * 2)[1] == sorted(pairs(short, events) * 4)


def test_empty_sides_and_clashing_names(spark):
    opened, events = some_rows(4, 20)
    assert run(spark, [], events)[1] == [] == run(spark, opened, [])[1]
    frame = spark.createDataFrame(events, EVENTS)
    with pytest.raises(ValueError, match="moment"):
        events_in_windows(frame, frame.withColumnRenamed("event", "e").withColumnRenamed("other", "o"), "moment", "moment", "moment")


def test_a_hot_person_is_split_by_time(spark, monkeypatch):
    """A third of all rows is one person's: no task holds them all, and both sides are shuffled."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        person = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("long").alias("patient_key")
        day = F.make_dt_interval((F.col("id") % 5000).cast("int"))
        start = (F.lit(ORIGIN).cast("timestamp_ntz") + day)
        opened = spark.range(20_000).select(person, F.col("id").alias("window"), start.alias("opens"), (start + F.make_dt_interval(F.lit(20))).alias("closes"))
        events = spark.range(20_000).select(person, F.col("id").alias("event"), start.alias("moment"))
        found = events_in_windows(opened, events, "opens", "closes", "moment")
        expected = opened.join(events, "patient_key").where("moment >= opens AND moment < closes")
        totals = [F.count(F.lit(1)), F.sum(F.xxhash64("window", "event").cast("decimal(20,0)"))]
        assert found.agg(*totals).first() == expected.agg(*totals).first()
        plan = final_plan(found)
        assert "hashpartitioning(patient_key" in plan and "_bucket" in plan.split("hashpartitioning(patient_key")[1][:60]
        assert opened.select(windows._bucket(F.col("opens"), F.lit(32))).distinct().count() > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
