"""Registered queries: one Spark plan per operator id, each with its oracle SQL.

Every query reads the driver's tables of ``data_dir`` through the fixture
views (FIXTURES.md), whole — no row caps or id subsets.
"""

from __future__ import annotations

from arearisk.plans import oracle as O
from arearisk.plans.base import (  # noqa: F401  (QUERIES, ORACLE and risk are re-exported)
    ORACLE, QUERIES, incident_report, profile, register, request_report, risk, volume_report,
)
from arearisk.plans import reports as R

# ------------------------------------------------------------ 2.9 reports

register("report_incidents_by_area",
         O.views("incident", extra=O.INC_CHAIN) + "SELECT * FROM inc_rep")(incident_report)
register("report_requests_by_area",
         O.views("request", extra=O.REQ_CHAIN) + "SELECT * FROM req_rep")(request_report)
register("report_volume_by_area",
         O.views("volume", extra=O.VOL_CHAIN) + "SELECT * FROM vol_rep")(volume_report)
register("report_area_profile",
         O.views(*O.REPORT_VIEWS, extra=O.PROFILE_CHAIN) + "SELECT * FROM prof")(profile)
register("report_area_risk",
         O.views(*O.REPORT_VIEWS, extra=O.RISK_CHAIN) + "SELECT * FROM risk")(risk)


@register("report_class_distribution",
          O.views(*O.REPORT_VIEWS, extra=O.RISK_CHAIN)
          + "SELECT safety_class, count(*) AS areas FROM risk GROUP BY safety_class")
def class_distribution(spark, d):
    return R.class_distribution(risk(spark, d))


# The operator catalogue registers itself on import.
from arearisk.plans import catalog_io, catalog_rows, catalog_groups, catalog_ranks, catalog_route  # noqa: E402,F401
