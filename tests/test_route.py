"""Accepted and rejected records: every record has one outcome, bad values are named, nothing is lost or read twice."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.operators import route
from arearisk.plans import city as C
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans.fixtures import fixture
from arearisk.session import fresh_path
from conftest import SF001, rows
from test_city_lines import FAC, VEH, incident_line, lines, request_line

GOOD = [1, 0, 1, 0, 0, 0, 0, 0]


def text_file(spark, data):
    path = fresh_path(spark, "route")
    lines(spark, data).coalesce(1).write.text(path)
    return path


VOLUME = ["area,vehicles,samples", "10001,5,3", "10001,x,3", '"10002; north, west",7,1', "10003,8", "10004,8,1,9", "10005,,3", "10006,2.5,3",
          "10007,99999999999999999999,1", "10008, 4 ,+2", ",1,1", "10009,-3,0"]
BAD = [("10001,x,3", "value", "vehicles=x"), ("10003,8", "columns", None), ("10004,8,1,9", "columns", None), ("10005,,3", "value", "vehicles="),
       ("10006,2.5,3", "value", "vehicles=2.5"), ("10007,99999999999999999999,1", "value", "vehicles=99999999999999999999")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_volume_rows_fail_or_are_listed(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        judged = C.judged_volume(spark, text_file(spark, VOLUME))
        assert sorted(rows(route.rejected(judged))) == sorted(BAD)
        assert rows(route.accepted(judged)) == [("", 1, 1), ("10001", 5, 3), ("10002; north, west", 7, 1), ("10008", 4, 2), ("10009", -3, 0)]
        bad = C.volume_from_csv(spark, text_file(spark, ["a,b,c", "10001,x,3"]))
        for use in (bad, bad.select("area_expr"), R.volume_by_area(bad)):  # also where the bad column is not used
            with pytest.raises(Exception, match="vehicles=x"):
                use.collect()
        with pytest.raises(Exception, match="rejected"):
            C.volume_from_csv(spark, text_file(spark, ["a,b,c", "10001,3"])).count()
        assert C.volume_from_csv(spark, text_file(spark, VOLUME[:2])).count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_csv_fields_by_type_and_nullability(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType(), nullable=False)])
    path = text_file(spark, ["a,1,1.5", "b,,2", "c,3000000000,1", "d,1,", "e,1,abc", '"f""q",7,-1e3', "g,1,2,3", "h"])
    judged = route.judged_csv(spark, path, schema)
    assert rows(route.accepted(judged)) == [("a", 1, 1.5), ("b", None, 2.0), ('f"q', 7, -1000.0)]
    assert [(r.reason, r.detail) for r in route.rejected(judged).orderBy("value").collect()] == [
        ("value", "n=3000000000"), ("value", "x="), ("value", "x=abc"), ("columns", None), ("columns", None)]


def mixed():
    ok = incident_line("3/5/2012", "14:30", "10001", GOOD, FAC, VEH)
    return [ok, incident_line("12/31/2013", "23:59", "10002", GOOD, FAC, VEH, location='"(40.6, -73.9)"'),
            incident_line("3/5/2012", "14:30", "10003", ["x", 0, "", 0, 0, 0, 0, "1.0"], FAC, VEH), incident_line("3/5/2012", "14:30", "10004", [" 2 ", *GOOD[1:]], FAC, VEH),
            incident_line("3/5/2012", "14:30", "10005", [3_000_000_000, *GOOD[1:]], FAC, VEH), incident_line("n/a", "14:30", "10006", ["x", *GOOD[1:]], FAC, VEH),
            ",".join(ok.split(",")[:28]), ",".join(ok.split(",")[:18]), "a,b", "", incident_line("3/5/1999", "14:30", "", GOOD, FAC, VEH),
            "DATE,TIME,BOROUGH,ZIP CODE," + ",".join(["x"] * 25)]


def test_every_collision_line_has_one_outcome(spark):
    df = lines(spark, mixed())
    judged = C.judged_incidents(df)
    good, bad = C.routed(spark, judged, "incidents-routed")
    assert good.count() + bad.count() == len(mixed()) - 1  # the header is no record
    assert sorted((r.reason, r.detail) for r in bad.collect()) == [
        ("date", "n/a 14:30"), ("fields", "1"), ("fields", "18"), ("fields", "2"), ("fields", "28"),
        ("measure", "per_i=3000000000"), ("measure", "per_i=x, ped_i=, mot_k=1.0")]
    assert rows(good, "area", "per_i") == [("", 1), ("10001", 1), ("10002", 1), ("10004", 2)]
    assert rows(C.incidents_in_period(good), "area") == [("10001",), ("10002",), ("10004",)]
    assert {r.value for r in bad.collect()} <= set(mixed())


def test_routing_reads_the_source_once_and_each_outcome_its_own_files(spark):
    path = text_file(spark, mixed())
    judged = C.judged_incidents(spark.read.text(path))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    stored = route.write_routed(judged, fresh_path(spark, "routed"))
    for part, outcome in zip(route.routed(spark, stored, judged.schema), ("accepted", "rejected")):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(outcome" in plan and outcome in plan
    strict = C.incidents_from_lines(spark.read.text(path))
    with pytest.raises(Exception, match="not an integer"):
        strict.collect()


def test_an_outcome_without_records_is_empty(spark):
    for data, n in (([mixed()[0]], (1, 0)), (["a,b"], (0, 1)), ([], (0, 0))):
        good, bad = C.routed(spark, C.judged_incidents(lines(spark, data) if data else spark.createDataFrame([], "value string")), "routed")
        assert (good.count(), bad.count()) == n


def test_complaint_lines(spark):
    data = [request_line("01/02/2012 03:05:00 PM", "Street Condition", "Rough, Pitted", "10001", "BRONX"), request_line("n/a", "Street Condition", "Pothole", "10003", "BRONX"),
            "1,01/02/2012 03:05:00 PM,x", request_line("01/02/2014 03:05:00 PM", "Noise", "Loud", "10004", "BRONX")]
    good, bad = C.routed(spark, C.judged_requests(lines(spark, data)), "requests-routed")
    assert sorted((r.reason, r.detail) for r in bad.collect()) == [("date", "n/a"), ("fields", "3")]
    assert rows(good, "area", "descriptor") == [("10001", "Rough  Pitted"), ("10004", "Loud")]
    assert rows(C.requests_in_period(good), "area") == [("10001",)]


def test_accepted_facts_are_those_of_the_strict_job(spark):
    """Over input without bad measures both ways give the same facts."""
    raw = fixture(spark, SF001, "raw_incident")
    good, _ = C.routed(spark, C.judged_incidents(raw), "incidents-routed")
    cols = ["area", "ts", *P.MEASURES, *P.FACTOR_SLOTS, *P.VEHICLE_SLOTS]
    one = C.incidents_from_lines(raw, *P.TEST_INCIDENT_RANGE).select(*cols)
    two = C.incidents_in_period(good, *P.TEST_INCIDENT_RANGE).select(*cols)
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0 and one.count() > 0


def test_city_job_with_rejects(spark):
    collisions, complaints = fresh_path(spark, "raw"), fresh_path(spark, "raw")
    mixed_lines = fixture(spark, SF001, "raw_incident_mixed")
    mixed_lines.write.text(collisions)
    fixture(spark, SF001, "raw_request").write.text(complaints)
    volume = text_file(spark, ["area,vehicles,samples", "1,5000,3", "2,x,3", "3,7000,2", "4,9000"])
    out = fresh_path(spark, "city-job")
    ranges = {"collision_range": P.TEST_INCIDENT_RANGE, "complaint_range": ("2024-01-01 00:00:00", "2024-12-31 23:59:00")}
    risk = C.run_city_job(spark, collisions, complaints, volume, out, **ranges, rejects="route")
    assert {r.area for r in risk.collect()} <= {"1", "3"}
    bad = spark.read.option("header", True).csv(out + "/rejects")
    n = {(r.source, r.reason): r["count"] for r in bad.groupBy("source", "reason").count().collect()}
    assert n["volume", "value"] == n["volume", "columns"] == 1 and n["collision", "measure"] > 0 and n["collision", "date"] > 0 and n["complaint", "date"] > 0
    judged = C.judged_incidents(mixed_lines)
    assert sum(v for (s, _), v in n.items() if s == "collision") + route.accepted(judged).count() == mixed_lines.count()
    with pytest.raises(Exception, match="not an integer|rejected"):
        C.run_city_job(spark, collisions, complaints, volume, fresh_path(spark, "city-job"), **ranges)
    with pytest.raises(ValueError):
        C.run_city_job(spark, collisions, complaints, volume, out, rejects="drop")


def test_must_accept_passes_what_is_accepted(spark):
    df = spark.createDataFrame([("a", 1)], "value string, n int").select(*route.first_reason([("odd", F.col("n") > 5, F.lit(None).cast("string"))]), "value", "n")
    assert rows(route.must_accept(df)) == [(1,)]
    with pytest.raises(Exception, match="odd"):
        route.must_accept(df.withColumn("reason", F.lit("odd"))).count()


def test_judging_lines_is_compiled(spark, capsys):
    """No method of the generated code is longer than the 8,000 bytes up to which the JVM compiles it."""
    import re

    lines = spark.createDataFrame([("x",)], "value string")
    C.judged_incidents(lines).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_bad_measures_are_named(spark):
    """The first, the last and a too large count; blanks around one and a sign are fine."""
    counts = [["x", "1", "2", "3", "4", "5", "6", ""], [" 1 ", "+2", "-3", "4", "5", "6", "7", "8"], ["1", "99999999999", "3", "1.0", "5", "6", "7", "8"]]
    lines = [",".join(["1/2/2012", "1:05", "B", "83"] + ["a"] * 6 + c + [""] * 11) for c in counts]
    rows = {r.value: r for r in C.judged_incidents(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    first, fine, third = (rows[x] for x in lines)
    assert (first.reason, first.detail) == ("measure", "per_i=x, mot_k=")
    assert (third.reason, third.detail) == ("measure", "per_k=99999999999, ped_k=1.0")
    assert fine.reason is None and (fine.per_i, fine.per_k, fine.ped_i, fine.mot_k) == (1, 2, -3, 8)
