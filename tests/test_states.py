"""Versions, order checks, profiles and states that are merged."""

import random
import subprocess
import sys
from pathlib import Path

import pytest
from clinic import rows
from pyspark.sql import functions as F

from cohortloom.operators.index import first_event
from cohortloom.operators.ordering import file_violations, order_violations
from cohortloom.operators.profiles import STATE, merge_profiles, profile, profile_state
from cohortloom.operators.states import merge_first_events, update_first_events
from cohortloom.sources import read_csv, write_csv
from cohortloom.sources.versions import committed_version, read_version, stage, version_rows, write_version

# -- versions ------------------------------------------------------------------------


def test_readers_see_committed_versions_only(spark, tmp_path):
    folder = str(tmp_path / "v")
    with pytest.raises(FileNotFoundError):
        read_version(spark, folder)
    assert committed_version(spark, folder) is None
    first = write_version(spark.range(3), folder)
    old = read_version(spark, folder)
    broken = spark.range(0, 2000, 1, 4).select(F.when(F.col("id") == 1999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_version(broken, folder)
    spark.range(9).write.parquet(f"{folder}/version=half")  # written, but its writer died before the commit
    assert committed_version(spark, folder) == first and read_version(spark, folder).count() == 3
    with pytest.raises(FileNotFoundError, match="half"):
        read_version(spark, folder, "half")
    second = write_version(spark.range(5), folder)
    assert read_version(spark, folder).count() == 5 and old.count() == read_version(spark, folder, first).count() == 3
    assert rows(version_rows(spark, folder).groupBy("version", "version_number").count()) == sorted([(first, 1, 3), (second, 2, 5)], key=repr)


KILLED = """
import sys, time
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from cohortloom.sources.versions import stage
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
stage(spark, {folder!r} + "/one", "a", lambda: spark.range(10)).count()
def slow(rows):
    for row in rows:
        yield row
        open({flag!r}, "w").close()
        time.sleep(600)
stage(spark, {folder!r} + "/two", "b", lambda: spark.range(4).mapInPandas(slow, "id long"))
"""


def test_a_killed_job_goes_on_behind_its_last_commit(spark, tmp_path):
    folder, flag = str(tmp_path / "job"), tmp_path / "writing"
    repo = str(Path(__file__).resolve().parents[1])
    job = subprocess.Popen([sys.executable, "-c", KILLED.format(repo=repo, folder=folder, flag=str(flag))], stderr=subprocess.DEVNULL)
    try:
        for _ in range(600):
            if flag.exists() or job.poll() is not None:
                break
            try:
                job.wait(0.2)
            except subprocess.TimeoutExpired:
                pass
        assert flag.exists()
    finally:
        job.kill()
        job.wait()
    built = []

    def build(name, n):
        built.append(name)
        return spark.range(n)

    assert committed_version(spark, f"{folder}/two", "b") is None
    assert stage(spark, f"{folder}/one", "a", lambda: build("one", 99)).count() == 10
    assert stage(spark, f"{folder}/two", "b", lambda: build("two", 4)).count() == 4
    assert built == ["two"]
    assert stage(spark, f"{folder}/two", "c", lambda: build("other key", 7)).count() == 7
    assert stage(spark, f"{folder}/two", "b", lambda: build("again", 0)).count() == 4 and built[1:] == ["other key"]


# -- order ---------------------------------------------------------------------------


def test_order_is_told_from_partitions(spark):
    frame = spark.range(3000).select((F.col("id") % 700).alias("a"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("b"))
    ordered = frame.repartitionByRange(7, "a", "b").sortWithinPartitions("a", "b")
    found = order_violations(ordered, ["a", "b"]).first()
    assert found.n_rows == 3000 and found.violations == 0 and found.n_parts > 1
    assert order_violations(frame.repartition(4), ["a"]).first().violations > 500
    assert order_violations(frame.orderBy("a"), ["a"]).first().violations == 0
    # In order inside partitions, out of order between them.
    pieces = spark.range(20, 30, 1, 1).unionAll(spark.range(10, 20, 1, 1)).unionAll(spark.range(15, 16, 1, 1))
    assert order_violations(pieces, ["id"]).first().violations == 2
    empty = spark.range(5, 9, 1, 1).unionAll(spark.range(0, 0, 1, 1)).unionAll(spark.range(1, 2, 1, 1))
    assert tuple(order_violations(empty, ["id"]).first()) == (5, 2, 1)
    assert tuple(order_violations(spark.range(0), ["id"]).first()) == (0, 0, 0)
    nulls = spark.createDataFrame([(1,), (None,)], "k long").coalesce(1)
    assert order_violations(nulls, ["k"]).first().violations == 1


def test_order_of_files(spark, tmp_path):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("two\nlines").alias("t"))
    ordered = frame.repartitionByRange(6, "k").sortWithinPartitions("k")
    write_csv(ordered, str(tmp_path / "csv"))
    found = file_violations(read_csv(spark, str(tmp_path / "csv"), "k long, t string"), ["k"]).first()
    assert (found.n_rows, found.violations) == (5000, 0) and found.n_parts > 1
    ordered.write.parquet(str(tmp_path / "parquet"))
    assert file_violations(spark.read.parquet(str(tmp_path / "parquet")), ["k"]).first().violations == 0
    write_csv(frame.repartition(3), str(tmp_path / "mixed"))
    assert file_violations(read_csv(spark, str(tmp_path / "mixed"), "k long, t string"), ["k"]).first().violations > 100


# -- profiles ------------------------------------------------------------------------


def test_profiles_of_small_domains_are_exact_and_merge(spark):
    rng = random.Random(5)
    data = [(rng.choice("abcd"), rng.choice((None, 9, 10, 100)), rng.choice((1.5, -2.0)), None) for _ in range(900)]
    frame = spark.createDataFrame(data, "t string, n long, d double, e int")
    whole = profile_state(frame)
    assert [f.name for f in whole.schema] == [c.split()[0] for c in STATE.split(", ")]
    parts = [profile_state(frame.where(c)) for c in ("t = 'a'", "t > 'a' AND n = 9", "t > 'a' AND (n > 9 OR n IS NULL)", "false")]
    merged = merge_profiles(*parts, numbers=["n", "d", "e"])
    expected = {
        "t": (900, 0, 4, "a", "d"),
        "n": (900, sum(r[1] is None for r in data), 3, "9", "100"),
        "d": (900, 0, 2, "-2.0", "1.5"),
        "e": (900, 900, 0, None, None),
    }
    for state in (whole, merged):
        found = {r.column_name: r for r in profile(state, [0.0, 0.5, 1.0]).collect()}
        assert {c: tuple(r)[1:6] for c, r in found.items()} == expected
        numbers = sorted(r[1] for r in data if r[1] is not None)
        assert found["n"].quantiles == [9.0, float(numbers[-(-len(numbers) // 2) - 1]), 100.0]
        assert found["t"].quantiles is None and found["e"].quantiles is None
    none = profile(profile_state(frame.limit(0))).collect()
    assert {tuple(r)[1:] for r in none} == {(0, 0, 0, None, None, None)}


def test_errors_of_large_domains_are_as_stated(spark):
    values = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("v"), (F.col("id") % 5000).cast("string").alias("t"))
    halves = [profile_state(values.where(F.col("v") % 2 == k)) for k in (0, 1)]
    found = {r.column_name: r for r in profile(merge_profiles(*halves, numbers=["v"]), [0.1, 0.5, 0.9]).collect()}
    assert abs(found["v"].n_distinct / 200_000 - 1) < 4 * 1.04 / 2**7
    assert abs(found["t"].n_distinct / 5_000 - 1) < 4 * 1.04 / 2**7
    for share, value in zip((0.1, 0.5, 0.9), found["v"].quantiles):
        assert abs(value / 200_003 - share) < 0.01
    assert (found["v"].least, found["v"].greatest) == ("0", "200002")


def test_states_do_not_grow_with_rows(spark):
    size = lambda n: max(len(r.distinct_sketch) + len(r.quantile_sketch) for r in profile_state(spark.range(n)).collect())
    assert size(2_000_000) < 1.5 * size(100_000) < 100_000


# -- first events ----------------------------------------------------------------------


def test_state_of_parts_is_the_state_of_all(spark, tmp_path):
    rng = random.Random(6)
    data = [(rng.choice((1, 2, 3, 4, None)), rng.choice((None, *range(9))), n) for n in range(300)]
    events = spark.createDataFrame(data, "person long, day int, event long")
    order = ("person", "day", "event")
    whole = rows(first_event(events, *order))
    lots = [events.where(F.col("event") % 4 == k) for k in range(4)]
    for some in (lots, lots[::-1], [*lots, lots[0]]):
        state = None
        for lot in some:
            state = merge_first_events(state, lot, *order)
        assert rows(state) == whole
    folder = str(tmp_path / "state")
    for lot in [*lots, lots[2], events.limit(0)]:
        state = update_first_events(spark, folder, lot, *order)
    assert rows(state) == whole
