"""The whole job from raw files: lines and CSV written from the driver's
tables, read back as text, reported and written."""

import os

from arearisk.plans import city as C
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans.fixtures import fixture
from arearisk.session import fresh_path, local_path
from arearisk.sinks import write_csv
from conftest import SF001


def raw_file(spark, view):
    path = fresh_path(spark, view)
    fixture(spark, SF001, view).write.text(path)
    return path


def test_city_job_end_to_end(spark):
    collisions = raw_file(spark, "raw_incident")
    complaints = raw_file(spark, "raw_request")
    volume = write_csv(fixture(spark, SF001, "volume"), fresh_path(spark, "volume-csv"), single_file=True)
    prof = C.city_profile(spark, collisions, complaints, volume,
                          collision_range=P.TEST_INCIDENT_RANGE,
                          complaint_range=("2024-01-01 00:00:00", "2024-12-31 23:59:00"))
    out = fresh_path(spark, "city-out")
    risk = C.write_city_outputs(prof, out)
    n = risk.count()
    direct = R.area_risk(R.area_profile(
        R.volume_by_area(fixture(spark, SF001, "volume")),
        R.incidents_by_area(C.incidents_from_lines(fixture(spark, SF001, "raw_incident"), *P.TEST_INCIDENT_RANGE)),
        R.requests_by_area(C.requests_from_lines(fixture(spark, SF001, "raw_request"), None, "2024-01-01 00:00:00", "2024-12-31 23:59:00"))))
    assert sorted(map(tuple, risk.collect()), key=str) == sorted(map(tuple, direct.collect()), key=str)
    assert n > 0 and len(risk.columns) == 28
    classes = {r.safety_class for r in risk.collect()}
    assert classes <= {"Hazardous", "Ok", "Safe"}
    for part in ("results/final_result", "totals/rankings", "totals/aggregations"):
        files = [f for f in os.listdir(os.path.join(local_path(out), part)) if f.startswith("part-")]
        assert files
    assert spark.read.json(out + "/totals/aggregations").count() == 5
    assert spark.read.option("header", True).csv(out + "/results/final_result").count() == n


def test_city_job_download_outputs(spark):
    collisions = raw_file(spark, "raw_incident")
    complaints = raw_file(spark, "raw_request")
    volume = write_csv(fixture(spark, SF001, "volume"), fresh_path(spark, "volume-csv"), single_file=True)
    out = fresh_path(spark, "city-job")
    risk = C.run_city_job(spark, collisions, complaints, volume, out, collision_range=P.TEST_INCIDENT_RANGE,
                          complaint_range=("2024-01-01 00:00:00", "2024-12-31 23:59:00"), download=True)
    assert risk.count() > 0
    for part in ("results/incidents_by_area", "results/requests_by_area", "results/volume_by_area",
                 "totals/incidents", "totals/requests", "results/final_result"):
        assert spark.read.option("header", True).csv(out + "/" + part).count() > 0, part
    tot = {r["category"]: int(r["count"]) for r in
           spark.read.option("header", True).csv(out + "/totals/incidents").collect()}
    inc = spark.read.option("header", True).csv(out + "/results/incidents_by_area")
    assert tot["total_accidents"] == sum(int(r.total_accidents) for r in inc.collect())
