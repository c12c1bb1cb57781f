"""Stored partial summaries: exact merges, and runs that read new periods only."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from arearisk.operators.aggregate import sum_measures
from arearisk.plans import partials as PP
from arearisk.session import fresh_path, local_path
from conftest import rows

SUMS = {"per_i": "per_i"}


def facts(spark, days, seed=0):
    data = [(f"a{(k + seed) % 5}", datetime.datetime(2012, 1, day, k % 24), k % 7) for day in days for k in range(20 + day)]
    return spark.createDataFrame(data, "area string, ts timestamp_ntz, per_i int")


def one_level(df):
    return rows(sum_measures(df, "area", SUMS, "n"))


def update(spark, f, p, **more):
    return PP.update_partials(spark, f, p, "area", SUMS, count_as="n", **more)


def spoil(path, period):
    """Make the files of a period unreadable, so that opening one would fail."""
    folder = os.path.join(local_path(path), f"period={period}")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(os.path.join(folder, name), "wb") as f:
                f.write(b"spoilt")
            crc = os.path.join(folder, f".{name}.crc")
            if os.path.exists(crc):
                os.remove(crc)


def test_a_second_run_reads_the_new_day_only(spark):
    f, p = fresh_path(spark, "facts"), fresh_path(spark, "partials")
    first, second = facts(spark, [1, 2, 3]), facts(spark, [4], seed=2)
    PP.store_facts(first, f, PP.by_day())
    assert update(spark, f, p)[0] == ["2012-01-01", "2012-01-02", "2012-01-03"]
    assert rows(PP.merged(spark, p, "area", ["n", "per_i"]), "area", "per_i", "n") == rows(sum_measures(first, "area", SUMS, "n"), "area", "per_i", "n")
    PP.store_facts(second, f, PP.by_day())
    for day in ("2012-01-01", "2012-01-02", "2012-01-03"):
        spoil(f, day)
    todo, part = update(spark, f, p)
    assert todo == ["2012-01-04"]
    assert "PartitionFilters: [isnotnull(period" in part._jdf.queryExecution().executedPlan().toString()
    got = rows(PP.merged(spark, p, "area", ["n", "per_i"]), "area", "per_i", "n")
    assert got == rows(sum_measures(first.unionByName(second), "area", SUMS, "n"), "area", "per_i", "n")
    assert update(spark, f, p) == ([], None)


def test_late_facts_replace_a_day(spark):
    f, p = fresh_path(spark, "facts"), fresh_path(spark, "partials")
    PP.store_facts(facts(spark, [1, 2]), f, PP.by_day())
    update(spark, f, p)
    late = facts(spark, [2], seed=3)
    PP.store_facts(late, f, PP.by_day())
    assert update(spark, f, p)[0] == []
    assert update(spark, f, p, again=["2012-01-02", "2030-01-01"])[0] == ["2012-01-02"]
    whole = facts(spark, [1, 2]).unionByName(late)
    assert rows(PP.merged(spark, p, "area", ["n", "per_i"]), "area", "per_i", "n") == rows(sum_measures(whole, "area", SUMS, "n"), "area", "per_i", "n")
    only = PP.merged(spark, p, "area", ["n", "per_i"], wanted=["2012-01-01"])
    assert rows(only, "area", "n") == rows(sum_measures(facts(spark, [1]), "area", SUMS, "n"), "area", "n")


def test_facts_without_a_time_and_of_months(spark):
    f, p = fresh_path(spark, "facts"), fresh_path(spark, "partials")
    df = facts(spark, [1, 9]).unionByName(spark.createDataFrame([("a1", None, 5), (None, None, None)], "area string, ts timestamp_ntz, per_i int"))
    PP.store_facts(df, f, PP.by_month())
    todo, _ = update(spark, f, p)
    assert todo == ["2012-01", PP.NONE]
    got = {r.area: (r.n, r.per_i) for r in PP.merged(spark, p, "area", ["n", "per_i"]).collect()}
    want = {r.area: (r.n, r.per_i) for r in sum_measures(df, "area", SUMS, "n").collect()}
    assert got == want and None in got


def test_no_partials(spark):
    with pytest.raises(ValueError):
        PP.merged(spark, fresh_path(spark, "partials"), "area", ["n"])
    assert update(spark, fresh_path(spark, "facts"), fresh_path(spark, "partials")) == ([], None)


def test_a_hot_day_is_written_by_several_tasks(spark):
    f = fresh_path(spark, "facts")
    df = spark.range(4000).select(F.col("id").cast("string").alias("area"), F.lit(datetime.datetime(2012, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit(1).alias("per_i"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the day were large
    try:
        PP.store_facts(df, f, PP.by_day())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [n for n in os.listdir(os.path.join(local_path(f), "period=2012-01-01")) if n.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(f).count() == 4000
