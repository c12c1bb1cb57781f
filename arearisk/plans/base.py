"""Query registration and the shared fixture-derived inputs.

Every query reads the driver's tables of ``data_dir`` through the fixture
views (FIXTURES.md), whole — no row caps or id subsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans.fixtures import fixture
from arearisk.session import fresh_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ shared inputs

def incidents(spark: SparkSession, d: str) -> DataFrame:
    """All cleaned collision records, of every date."""
    return R.clean_incidents(fixture(spark, d, "incident"))


def requests(spark: SparkSession, d: str) -> DataFrame:
    """All cleaned street complaints, of every date."""
    return R.clean_requests(fixture(spark, d, "request"))


def incident_report(spark, d):
    """The composed report filters its period, as the job does."""
    return R.incidents_by_area(R.clean_incidents(fixture(spark, d, "incident"), *P.TEST_INCIDENT_RANGE))


def request_report(spark, d):
    return R.requests_by_area(R.clean_requests(fixture(spark, d, "request"), *P.TEST_REQUEST_RANGE))


def volume_report(spark, d):
    return R.volume_by_area(fixture(spark, d, "volume"))


def profile(spark, d):
    return R.area_profile(volume_report(spark, d), incident_report(spark, d), request_report(spark, d))


def risk(spark, d):
    return R.area_risk(profile(spark, d))


def fresh(spark: SparkSession, label: str) -> str:
    """A new location in the shared folder for a round-trip through a sink."""
    return fresh_path(spark, label)


def raw_lines(spark: SparkSession, d: str, view: str) -> DataFrame:
    """The raw fixture ``view``: text lines (column ``value``)."""
    return fixture(spark, d, view)
