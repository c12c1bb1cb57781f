"""Nothing is cut or lost on the way: whole tables, empty labels, bad input, unresolved names, repeated rows."""

import os
import shutil

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from arearisk.functions import expr as X
from arearisk.operators import clean as CL
from arearisk.operators.aggregate import sort_totals
from arearisk.operators.joins import join_shape_guard, repeat_rows, resolve_names, unresolved_names
from arearisk.plans import base as B
from arearisk.plans import city as C
from arearisk.plans import registry as G
from arearisk.plans import reports as R
from arearisk.plans.fixtures import fixture
from arearisk.sources.tables import TABLES, table_path
from arearisk.sources.text import sample_rows
from conftest import SF001, rows
from tools.oracle_check import digest

ROLES = {"road": "road", "start": "start", "end": "end"}


def test_counts_cover_the_fact_table(spark):
    got = G.QUERIES["agg_count_per_key"](spark, SF001).agg(F.sum("total_accidents")).head()[0]
    assert got == spark.read.parquet(SF001 + "/lineitem.parquet").count()


def test_empty_descriptor_ranks(spark):
    data = [("1", "Street Condition", d, "NY") for d in ["", "", "", None, "", "Pothole", "Pothole"]]
    r = R.requests_by_area(spark.createDataFrame(data, "area string, kind string, descriptor string, city string")).head()
    assert r.total_complaints == 7 and r.top_descriptor_1 == ": 5: 71.43%" and r.top_descriptor_2 == ""
    totals = {x.category: x["count"] for x in C.request_totals(spark.createDataFrame(data, "area string, kind string, descriptor string, city string")).collect()}
    assert totals == {"total_complaints": 7, "STREET CONDITION": 7, "": 5, "Pothole": 2}


def test_names_without_postcode_and_repeated_segments(spark):
    lookup = spark.createDataFrame([("A", " 1 "), ("B", "2"), ("C", None), ("D", "  "), ("B", "9")], "name string, postcode string")
    seg = spark.createDataFrame([(1, "A", "B", "A", 30), (1, "A", "B", "A", 30), (2, "A", "C", "B", 5), (3, "D", "X", "B", 7)],
                                "segment long, road string, start string, end string, vehicles long")
    assert rows(resolve_names(seg, "segment", ROLES, lookup, carry=["vehicles"])) == [(1, 30, "1", "2", "1")] * 2
    assert rows(unresolved_names(seg, "segment", ROLES, lookup)) == [(2, "start", "C"), (3, "road", "D"), (3, "start", "X")]


def test_hot_name_is_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.3",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        seg = spark.range(0, 60000, 1, 8).select(
            F.col("id").alias("segment"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("road"),
            F.concat(F.lit("s"), F.col("id") + 1).alias("start"), F.concat(F.lit("s"), F.col("id") + 2).alias("end"))
        lookup = spark.range(0, 60002, 1, 4).select(F.concat(F.lit("s"), F.col("id")).alias("name"), F.lit("1").alias("postcode")).unionByName(
            spark.createDataFrame([("HOT", "2")], "name string, postcode string"))
        df = resolve_names(seg, "segment", ROLES, lookup)
        assert df.count() == 60000
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_integers(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("7",), (" 8 ",), ("x",), ("9" * 30,), ("",), (None,)], "t string")
        assert [r.n for r in df.select(X.lenient_int("t").alias("n")).collect()] == [7, 8, 0, 0, 0, 0]
        assert [r.n for r in spark.createDataFrame([("7",), (" 8 ",), (None,)], "t string").select(X.strict_int("t").alias("n")).collect()] == [7, 8, None]
        with pytest.raises(Exception, match="not an integer"):
            df.where("t = 'x'").select(X.strict_int("t").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_date_formats_in_any_zone(spark):
    data = ["1/2/2012 3:05:00 PM", "2012-01-02T15:05:00.000", "1/2/2012 15:05", "3/11/2012 2:30:00 AM", "nonsense", "13/45/2012 1:00:00 AM", None]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(d,) for d in data], "d string")
            got = [r.ts for r in df.select(CL.parse_datetime("d", C.P.REQUEST_TS_FORMATS).cast("string").alias("ts")).collect()]
            assert got == ["2012-01-02 15:05:00"] * 3 + ["2012-03-11 02:30:00", None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_every_line_is_accepted_or_rejected(spark):
    inc = fixture(spark, SF001, "raw_incident").unionByName(spark.createDataFrame([("1/1/1996,x",), ("",), ("a,b" + "," * 27,)], "value string"))
    dated = C.incident_fields(inc).withColumn("ts", CL.parse_datetime_parts("date", "time", C.P.INCIDENT_TS_FORMATS)).where("ts IS NOT NULL")
    assert dated.count() + C.incident_rejects(inc).count() == inc.count()
    req = fixture(spark, SF001, "raw_request")
    whole = C.request_lines(req).where(F.size("f") > 16).where("ts IS NOT NULL")
    assert whole.count() + C.request_rejects(req).count() == req.count()
    assert {r.reason for r in C.incident_rejects(inc).collect()} == {"fields", "date"}


def test_lines_are_split_and_dated_once(spark):
    plan = C.requests_from_lines(fixture(spark, SF001, "raw_request"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 1
    assert plan.count("gettimestamp(") == len(C.P.REQUEST_TS_FORMATS)
    plan = C.incidents_from_lines(fixture(spark, SF001, "raw_incident"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 1


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(20000).select("id")
    got = [rows(sample_rows(df.repartition(n), ["id"], 1, 100)) for n in (1, 2, 7)]
    assert got[0] == got[1] == got[2] and 100 < len(got[0]) < 320


def test_totals_come_sorted(spark):
    got = [(r["count"], r["category"]) for r in G.QUERIES["sort_totals"](spark, SF001).collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1]))
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "category string, count long")
    assert [r.category for r in sort_totals(df).collect()] == ["c", "a", "b"]


def test_shape_guard_drops_half_joined_rows(spark):
    df = spark.createDataFrame([(1, 2, None), (2, None, 3), (3, 4, 5)], "k int, a int, b int")
    assert rows(join_shape_guard(df, ["a", "b"])) == [(3, 4, 5)]


def test_first_seen_follows_the_line_id(spark):
    line = "{},7,{},1 AVE,2 ST,NB,d," + ",".join(["1"] * 24)
    df = spark.createDataFrame([(line.format(9, "B ST"),), (line.format(2, "A ST"),), (line.format(10, "C ST"),)], "value string")
    for n in (1, 3):
        assert rows(C.segments_from_lines(df.repartition(n))) == [("7", "A ST", "1 AVE", "2 ST", 72, 3)]


def test_risk_reads_the_facts_once(spark):
    """One scan of the facts makes the profile, and the report reads its cut; nothing stays in the session's cache."""
    text = B.profile(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert text.count("lineitem.parquet") == 1 and "InMemoryTableScan" not in text
    df = G.QUERIES["report_area_risk"](spark, SF001)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in text and "profile-" in text and "InMemoryTableScan" not in text
    assert df.count() == 9


@pytest.mark.parametrize("name", ["report_area_risk", "report_class_distribution", "classify_three_level", "rank_multi_metric"])
def test_a_replaced_table_shows_in_the_next_run(spark, tmp_path, name):
    d = str(tmp_path / "d")
    shutil.copytree(SF001, d)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(d, t)}')")

    def same():
        df, rel = G.QUERIES[name](spark, d), con.sql(G.ORACLE[name])
        return digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(list(rel.columns), rel.fetchall())[0]

    assert same()
    half = con.sql("SELECT * FROM lineitem WHERE l_orderkey % 2 = 0 OR l_suppkey % 3 = 1").to_arrow_table()
    os.chmod(table_path(d, "lineitem"), 0o644)
    pq.write_table(half, table_path(d, "lineitem"))
    assert same()


def test_names_resolve_without_row_numbers(spark):
    """The fold is keyed by the record: no number depends on the order in which rows arrive."""
    plan = G.QUERIES["report_segment_volume"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan
    lookup = spark.createDataFrame([("A", "1"), ("B", "2"), ("B", "2"), ("B", "7")], "name string, postcode string")
    seg = spark.createDataFrame([(1, "A", "B", "A", 30)] * 3 + [(1, "A", "B", "B", 30), (None, "A", "A", "A", None), (None, "A", "A", "A", None), (2, None, "A", "A", 1)],
                                "segment long, road string, start string, end string, vehicles long")
    want = [(None, None, "1", "1", "1")] * 2 + [(1, 30, "1", "2", "1")] * 3 + [(1, 30, "1", "2", "2")]
    for n in (1, 2, 7):
        got = resolve_names(seg.repartition(n), "segment", ROLES, lookup, carry=["vehicles"]).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_repeats_are_made_in_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 9), ("d", 4)], "k string, t long")
    got = {r.k: r["count"] for r in repeat_rows(df, "t", block=4).groupBy("k").count().collect()}
    assert got == {"a": 1, "b": 5, "c": 9, "d": 4} and repeat_rows(df, "t").columns == ["k"]
