"""Ranking, top-k and sorting and classification (2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arearisk.operators import aggregate as AG
from arearisk.operators import topk as TK
from arearisk.operators.classify import classify_three_level
from arearisk.plans import oracle as O
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans import city as C
from arearisk.plans.base import incidents, profile, raw_lines, register, requests
from arearisk.plans.catalog_groups import TOTALS_REPORT_SQL, totals_report
from arearisk.plans.fixtures import fixture
from arearisk.session import cut_lineage

INC = O.views("incident", extra=[O.INC_CLEAN])
REQ = O.views("request", extra=[O.REQ_CLEAN])
A = P.RATE_COLUMNS[0]
VEH_COUNTS = (f"vc AS (SELECT area, category, count(*) AS n FROM (SELECT area, unnest([{', '.join(O.VEH)}]) "
              "AS category FROM inc) s WHERE category IS NOT NULL AND category <> '' GROUP BY area, category)")


@register("topk_per_key", O.views("incident", extra=[O.INC_CLEAN, VEH_COUNTS])
          + "SELECT area, category, n, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY area ORDER BY n DESC, "
          "category ASC) AS INTEGER) AS rank FROM vc) r WHERE rank <= 3")
def topk_per_key(spark, d):
    counts = AG.category_counts(incidents(spark, d), "area", P.VEHICLE_SLOTS)
    return TK.rank_within(counts, "area", "category", "n", 3).select("area", "category", "n", "rank")


def tiered_sql(label: str, tiers) -> str:
    return (REQ + "SELECT area, category, n, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY area "
            "ORDER BY n DESC, category ASC) AS INTEGER) AS rank, count(*) OVER (PARTITION BY area) AS width FROM "
            f"(SELECT area, {label} AS category, count(*) AS n FROM req GROUP BY area, {label}) c) r "
            f"WHERE rank <= {O.tier_sql('width', tiers)}")


@register("topk_tiered_5", tiered_sql("coalesce(descriptor, '')", P.TIERS_FIVE))
def topk_tiered_5(spark, d):
    counts = AG.label_counts(requests(spark, d), "area", "descriptor").withColumnRenamed("descriptor", "category")
    return TK.tiered_topk(counts, "area", "category", "n", P.TIERS_FIVE).select("area", "category", "n", "rank")


@register("topk_tiered_3", tiered_sql("upper(kind)", P.TIERS_THREE))
def topk_tiered_3(spark, d):
    r = requests(spark, d).withColumn("category", F.upper("kind"))
    counts = AG.label_counts(r, "area", "category")
    return TK.tiered_topk(counts, "area", "category", "n", P.TIERS_THREE).select("area", "category", "n", "rank")


@register("topk_to_columns", REQ + "SELECT area, " + ", ".join(
    f"coalesce(max(CASE WHEN rank = {i} THEN descriptor || ': ' || CAST(n AS VARCHAR) END), '') AS descriptor_{i}"
    for i in range(1, 6)) + " FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY n DESC, descriptor ASC) "
    "AS rank FROM (SELECT area, coalesce(descriptor, '') AS descriptor, count(*) AS n FROM req GROUP BY 1, 2) c) r GROUP BY area")
def topk_to_columns(spark, d):
    counts = AG.label_counts(requests(spark, d), "area", "descriptor")
    ranked = TK.rank_within(counts, "area", "descriptor", "n", 5)
    label = F.concat(F.col("descriptor"), F.lit(": "), F.col("n").cast("string"))
    return TK.topk_to_columns(ranked, "area", label, 5, "descriptor_")


PROFILE_ALL = O.views(*O.REPORT_VIEWS, extra=O.PROFILE_CHAIN)


@register("top_n_global", PROFILE_ALL + f"SELECT * FROM prof ORDER BY {A} DESC NULLS LAST, area ASC LIMIT 10")
def top_n_global(spark, d):
    return TK.top_n_global(profile(spark, d), A, "area", 10)


@register("bottom_n_global", PROFILE_ALL + f"SELECT * FROM prof ORDER BY {A} ASC NULLS LAST, area ASC LIMIT 10")
def bottom_n_global(spark, d):
    return TK.bottom_n_global(profile(spark, d), A, "area", 10)


@register("rank_multi_metric", O.views(*O.REPORT_VIEWS, extra=O.PROFILE_CHAIN + [O.RANK_LISTS]) + O.RANK_SELECT)
def rank_multi_metric(spark, d):
    prof = cut_lineage(profile(spark, d), "profile")  # ranked narrow, then joined back
    return TK.rank_multi_metric(prof, "area", P.RATE_COLUMNS, 10, keep=prof.columns)


@register("sort_totals", TOTALS_REPORT_SQL + " ORDER BY count DESC, category ASC")
def sort_totals(spark, d):
    return AG.sort_totals(totals_report(spark, d))


# ------------------------------------------------------------ classification

@register("classify_three_level", O.views(*O.REPORT_VIEWS, extra=O.PROFILE_CHAIN + [O.BOUNDS])
          + "SELECT p.area, " + O.CLASS_SQL + " AS safety_class FROM prof p CROSS JOIN bnd b")
def classify_q(spark, d):
    # bounds and rows read one cut of the small per-area profile
    c = classify_three_level(cut_lineage(profile(spark, d), "profile"), P.RATE_COLUMNS[0], P.RATE_COLUMNS[1], P.RATE_COLUMNS[2])
    return c.select("area", "safety_class")


@register("report_segment_volume", O.views("raw_segment", "lookup", extra=[
          O.SEG_LINES, O.SEG_FIRST, O.STREET_NAMED.replace("FROM street", "FROM seg"), *O.SEGMENT_CHAIN[1:]])
          + "SELECT area, vehicles, samples FROM app")
def report_segment_volume(spark, d):
    """Hourly count lines to segment totals to apportioned areas."""
    return C.segment_volume_from_lines(raw_lines(spark, d, "raw_segment"), fixture(spark, d, "lookup"))


# --------------------------------------------------- the job from raw lines

@register("report_incidents_from_lines", O.views("raw_incident", extra=O.INC_LINE_CHAIN) + "SELECT * FROM inc_rep")
def incidents_from_lines(spark, d):
    return R.incidents_by_area(C.incidents_from_lines(raw_lines(spark, d, "raw_incident"), *P.TEST_INCIDENT_RANGE))


@register("report_requests_from_lines", O.views("raw_request", extra=O.REQ_LINE_CHAIN) + "SELECT * FROM req_rep")
def requests_from_lines(spark, d):
    return R.requests_by_area(C.requests_from_lines(raw_lines(spark, d, "raw_request"), None, *P.TEST_REQUEST_RANGE))


@register("report_area_risk_from_lines", O.views("raw_incident", "raw_request", "volume", extra=[
          *O.INC_LINE_CHAIN, *O.REQ_LINE_CHAIN, *O.VOL_CHAIN, O.PROFILE, O.BOUNDS, O.RISK]) + "SELECT * FROM risk")
def area_risk_from_lines(spark, d):
    """The whole job from text: collision and complaint lines, area volumes, classified report."""
    return R.area_risk(R.area_profile(R.volume_by_area(fixture(spark, d, "volume")), incidents_from_lines(spark, d),
                                      requests_from_lines(spark, d)))


@register("rejected_lines", O.views("raw_incident", "raw_request", extra=[O.RI, O.RR])
          + "SELECT 'collision' AS source, value, CASE WHEN nf NOT IN (29, 30) THEN 'fields' ELSE 'date' END AS reason FROM ri "
          "WHERE nf NOT IN (29, 30) OR try_strptime(f[1] || ' ' || f[2], '%m/%d/%Y %H:%M') IS NULL "
          "UNION ALL SELECT 'complaint', value, CASE WHEN nf < 17 THEN 'fields' ELSE 'date' END FROM rr "
          "WHERE nf < 17 OR try_strptime(f[2], '%m/%d/%Y %I:%M:%S %p') IS NULL")
def rejected_lines(spark, d):
    """Lines that hold no record, with the reason, of both sources."""
    a = C.incident_rejects(raw_lines(spark, d, "raw_incident")).select(F.lit("collision").alias("source"), "value", "reason")
    return a.unionByName(C.request_rejects(raw_lines(spark, d, "raw_request")).select(F.lit("complaint").alias("source"), "value", "reason"))


@register("agg_request_totals", O.views("request", extra=[O.REQ_CLEAN])
          + "SELECT 'total_complaints' AS category, count(*) AS count FROM req "
          "UNION ALL SELECT upper(kind), count(*) FROM req WHERE kind <> '' GROUP BY 1 "
          "UNION ALL SELECT coalesce(descriptor, ''), count(*) FROM req GROUP BY 1")
def agg_request_totals(spark, d):
    return C.request_totals(requests(spark, d))

