"""Report-level checks on the driver's tables: golden class counts, shapes,
partition-count invariance, and the entry contract."""

from pyspark.sql import functions as F

from arearisk.plans import base as B
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans.fixtures import fixture
from conftest import SF001, SF01, rows


def classes(spark, d, incident_range):
    inc = R.clean_incidents(fixture(spark, d, "incident"), *incident_range)
    prof = R.area_profile(B.volume_report(spark, d), R.incidents_by_area(inc), B.request_report(spark, d))
    return dict(rows(R.class_distribution(R.area_risk(prof))))


def test_golden_classes_whole_tables(spark):
    # Independent measurement over the whole incident table: Hazardous/Ok/Safe.
    assert classes(spark, SF001, (None, None)) == {"Hazardous": 2, "Ok": 5, "Safe": 2}
    assert classes(spark, SF01, (None, None)) == {"Hazardous": 13, "Ok": 77, "Safe": 5}


def test_golden_classes_test_range(spark):
    assert classes(spark, SF001, P.TEST_INCIDENT_RANGE) == {"Hazardous": 2, "Ok": 6, "Safe": 1}


def test_risk_shape(spark):
    df = B.risk(spark, SF001)
    assert len(df.columns) == 28 and df.columns[:3] == ["city", "area", "safety_class"]
    assert df.count() == 9


def test_incident_report_partition_invariance(spark):
    inc = B.incidents(spark, SF001)
    outs = [rows(R.incidents_by_area(inc.repartition(n))) for n in (1, 2, 7)]
    assert outs[0] == outs[1] == outs[2]


def test_request_report_city_vote_and_tiers(spark):
    rep = B.request_report(spark, SF001)
    r = rep.filter(F.col("total_complaints") > 0).collect()
    assert all(x.top_complaint_1 and x.city for x in r)
    # every area keeps three kinds -> three complaint columns when it has three
    assert all((x.top_complaint_3 == "") == (x.top_complaint_2 == "") for x in r)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 28
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 70


def test_class_totals_equal_area_count(spark):
    risk = B.risk(spark, SF01)
    dist = R.class_distribution(risk)
    assert sum(r.areas for r in dist.collect()) == risk.count() == B.profile(spark, SF01).count()
