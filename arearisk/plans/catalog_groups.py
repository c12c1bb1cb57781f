"""Joins and aggregations (2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arearisk.functions import expr as X
from arearisk.operators import aggregate as AG
from arearisk.operators import joins as J
from arearisk.plans import city as C
from arearisk.plans import oracle as O
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans.base import (
    incident_report, incidents, profile, raw_lines, register, request_report, requests, volume_report,
)
from arearisk.plans.catalog_rows import resolved_segments
from arearisk.plans.fixtures import fixture

INC = O.views("incident", extra=[O.INC_CLEAN])
REQ = O.views("request", extra=[O.REQ_CLEAN])

# ------------------------------------------------------------------ 2.4 joins


@register("join_inner_key", O.views("incident", "request", extra=[O.INC_CLEAN, O.REQ_CLEAN])
          + "SELECT a.area, a.total_accidents, b.total_complaints FROM "
          "(SELECT area, count(*) AS total_accidents FROM inc GROUP BY area) a JOIN "
          "(SELECT area, count(*) AS total_complaints FROM req GROUP BY area) b ON a.area = b.area")
def join_inner_key(spark, d):
    a = AG.count_per_key(incidents(spark, d), "area", "total_accidents")
    b = AG.count_per_key(requests(spark, d), "area", "total_complaints")
    return J.join_inner_key(a, b, "area")


@register("join_three_way", O.views(*O.REPORT_VIEWS, extra=O.INC_CHAIN + O.REQ_CHAIN + O.VOL_CHAIN)
          + "SELECT v.area, v.volume, i.total_accidents, q.total_complaints FROM vol_rep v "
          "JOIN inc_rep i ON v.area = i.area JOIN req_rep q ON v.area = q.area")
def join_three_way(spark, d):
    j = J.join_three_way(volume_report(spark, d), incident_report(spark, d), request_report(spark, d), "area")
    return j.select("area", "volume", "total_accidents", "total_complaints")


@register("join_shape_guard", O.views(*O.REPORT_VIEWS, extra=O.INC_CHAIN + O.REQ_CHAIN + O.VOL_CHAIN)
          + "SELECT v.area, v.volume, i.total_accidents, q.total_complaints FROM vol_rep v "
          "LEFT JOIN inc_rep i ON v.area = i.area LEFT JOIN req_rep q ON v.area = q.area "
          "WHERE i.total_accidents IS NOT NULL AND q.total_complaints IS NOT NULL")
def join_shape_guard(spark, d):
    j = (volume_report(spark, d).join(incident_report(spark, d), "area", "left").join(request_report(spark, d), "area", "left")
         .select("area", "volume", "total_accidents", "total_complaints"))
    return J.join_shape_guard(j, ["total_accidents", "total_complaints"])


@register("join_lookup_resolve", O.views("street", "lookup", extra=O.SEGMENT_CHAIN[:3])
          + "SELECT segment, vehicles, samples, road_zip, start_zip, end_zip FROM res")
def join_lookup_resolve(spark, d):
    return resolved_segments(spark, d)


@register("join_unresolved_report", O.views("street", "lookup", extra=O.SEGMENT_CHAIN[:2]) + " UNION ALL ".join(
    f"SELECT segment, '{role}' AS role, {col} AS name FROM st_n s "
    f"WHERE NOT EXISTS (SELECT 1 FROM lk l WHERE l.name = s.{col})"
    for role, col in (("road", "road"), ("start", "start"), ("end", '"end"'))))
def join_unresolved_report(spark, d):
    s = fixture(spark, d, "street")
    named = s.select("segment", X.ordinal_street_name("roadway").alias("road"),
                     X.ordinal_street_name("from_name").alias("start"),
                     X.ordinal_street_name("to_name").alias("end"))
    return J.unresolved_names(named, "segment", {"road": "road", "start": "start", "end": "end"},
                              fixture(spark, d, "lookup"), "name")


# ------------------------------------------------------------ 2.5 aggregates

@register("agg_count_per_key", INC + "SELECT area, count(*) AS total_accidents FROM inc GROUP BY area")
def agg_count_per_key(spark, d):
    return AG.count_per_key(incidents(spark, d), "area", "total_accidents")


@register("agg_sum_measures", INC + "SELECT area, "
          + ", ".join(f"CAST(sum({m}) AS BIGINT) AS total_{m}" for m in P.MEASURES) + " FROM inc GROUP BY area")
def agg_sum_measures(spark, d):
    return AG.sum_measures(incidents(spark, d), "area", {f"total_{m}": m for m in P.MEASURES})


@register("agg_sum_volume", O.views("volume", extra=[O.VOL_ROWS])
          + "SELECT area, CAST(sum(vehicles) AS BIGINT) AS vehicles, CAST(sum(samples) AS BIGINT) AS samples "
          "FROM vol_rows GROUP BY area")
def agg_sum_volume(spark, d):
    return AG.sum_measures(R.volume_rows(fixture(spark, d, "volume")), "area",
                           {"vehicles": "vehicles", "samples": "samples"})


@register("agg_nonempty_slots", INC + f"SELECT area, CAST(sum({O.NONEMPTY_VEH}) AS BIGINT) AS total_vehicles "
          "FROM inc GROUP BY area")
def agg_nonempty_slots(spark, d):
    inc = incidents(spark, d).select("area", AG.nonempty_slots(P.VEHICLE_SLOTS).alias("v"))
    return AG.sum_measures(inc, "area", {"total_vehicles": "v"})


@register("agg_category_counts", O.views("incident", extra=[O.INC_CLEAN])
          + f"SELECT area, category, count(*) AS n FROM (SELECT area, unnest([{', '.join(O.FAC + O.VEH)}]) "
          "AS category FROM inc) s WHERE category IS NOT NULL AND category <> '' GROUP BY area, category")
def agg_category_counts(spark, d):
    return AG.category_counts(incidents(spark, d), "area", P.FACTOR_SLOTS + P.VEHICLE_SLOTS)


@register("agg_label_counts", REQ + "SELECT area, coalesce(descriptor, '') AS descriptor, count(*) AS n FROM req GROUP BY 1, 2")
def agg_label_counts(spark, d):
    return AG.label_counts(requests(spark, d), "area", "descriptor")


MERGE_COLS = ["accidents", "per_i", "per_k"]


@register("agg_merge_partials", INC + "SELECT area, count(*) AS accidents, CAST(sum(per_i) AS BIGINT) AS per_i, "
          "CAST(sum(per_k) AS BIGINT) AS per_k FROM inc GROUP BY area")
def agg_merge_partials(spark, d):
    """Partial summaries per day, from one scan, merged into one summary per area."""
    days = AG.sum_measures(incidents(spark, d).withColumn("day", F.to_date("ts")), ["area", "day"],
                           {"per_i": "per_i", "per_k": "per_k"}, count_as="accidents")
    return AG.merge_partials([days], "area", MERGE_COLS)


@register("agg_representative_value", REQ
          + "SELECT area, city FROM (SELECT area, city, row_number() OVER (PARTITION BY area ORDER BY n DESC, "
          "city ASC) AS rk FROM (SELECT area, city, count(*) AS n FROM req GROUP BY area, city) c) r WHERE rk = 1")
def agg_representative_value(spark, d):
    return AG.representative_value(requests(spark, d), "area", "city")


@register("agg_first_seen", O.views("raw_segment", extra=[O.SEG_LINES, O.SEG_FIRST]) + "SELECT * FROM seg")
def agg_first_seen(spark, d):
    return C.segments_from_lines(raw_lines(spark, d, "raw_segment"))


GRAND = ["total_accidents", "total_vehicles", *[f"total_{m}" for m in P.MEASURES]]


@register("agg_grand_totals", O.views("incident", extra=[O.INC_CLEAN, O.INC_TOTALS]) + "SELECT "
          + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in GRAND) + " FROM inc_tot")
def agg_grand_totals(spark, d):
    per_area = AG.sum_measures(incidents(spark, d).withColumn("v", X.count_nonempty(P.VEHICLE_SLOTS)), "area",
                               {"total_vehicles": "v", **{f"total_{m}": m for m in P.MEASURES}},
                               count_as="total_accidents")
    return AG.grand_totals(per_area, GRAND)


TOTALS_REPORT_SQL = (
    O.views("incident", extra=[O.INC_CLEAN, O.INC_TOTALS])
    + "SELECT category, count FROM (SELECT " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in GRAND)
    + " FROM inc_tot) t UNPIVOT (count FOR category IN (" + ", ".join(GRAND) + ")) "
    f"UNION ALL SELECT category, count(*) AS count FROM (SELECT unnest([{', '.join(O.FAC + O.VEH)}]) AS category "
    "FROM inc) s WHERE category IS NOT NULL AND category <> '' GROUP BY category")


def totals_report(spark, d):
    measures = {"total_accidents": F.lit(1), "total_vehicles": X.count_nonempty(P.VEHICLE_SLOTS),
                **{f"total_{m}": m for m in P.MEASURES}}
    return AG.totals_report(incidents(spark, d), measures, P.FACTOR_SLOTS + P.VEHICLE_SLOTS)


register("agg_totals_report", TOTALS_REPORT_SQL)(totals_report)


@register("agg_category_vocabulary", O.views("incident", extra=[O.INC_CLEAN])
          + "SELECT category, CASE WHEN " + O.upper_case_sql("category") + " THEN 'vehicle' ELSE 'factor' END AS dim "
          f"FROM (SELECT DISTINCT unnest([{', '.join(O.FAC + O.VEH)}]) AS category FROM inc) s "
          f"WHERE category IS NOT NULL AND category <> '' AND category NOT IN ({O.sql_list(P.IGNORE_CATEGORIES)})")
def agg_category_vocabulary(spark, d):
    cats = AG.slot_values(incidents(spark, d), "area", P.FACTOR_SLOTS + P.VEHICLE_SLOTS)
    vocab = cats.select("category").distinct().filter(~F.col("category").isin(*P.IGNORE_CATEGORIES))
    return vocab.select("category", F.when(X.case_class_upper("category"), F.lit("vehicle"))
                        .otherwise(F.lit("factor")).alias("dim"))


STATS = ["count", "mean", "stddev", "min", "max"]
DESCRIBE_SQL = (O.views(*O.REPORT_VIEWS, extra=O.PROFILE_CHAIN) + " UNION ALL ".join(
    f"SELECT '{s}' AS summary, " + ", ".join(
        f"round(CAST({fn.format(c)} AS DOUBLE), 6) AS {c}" for c in P.RATE_COLUMNS) + " FROM prof"
    for s, fn in zip(STATS, ["count({})", "avg({})", "stddev_samp({})", "min({})", "max({})"])))


@register("agg_describe", DESCRIBE_SQL)
def agg_describe(spark, d):
    s = AG.describe(profile(spark, d), P.RATE_COLUMNS)
    # six decimals: parallel sums may differ in the last bit between runs
    return s.select("summary", *[F.round(c, 6).alias(c) for c in P.RATE_COLUMNS])


BOUNDS_COLS = [f"{c}_{s}" for c in P.RATE_COLUMNS[:3] for s in ("mean", "sd", "upper", "lower")]


@register("agg_mean_sigma_bounds", O.views(*O.REPORT_VIEWS, extra=O.PROFILE_CHAIN + [O.BOUNDS])
          + "SELECT " + ", ".join(BOUNDS_COLS) + " FROM bnd")
def agg_mean_sigma_bounds(spark, d):
    return AG.mean_sigma_bounds(profile(spark, d), P.RATE_COLUMNS[:3]).select(*BOUNDS_COLS)


@register("agg_extrapolate_volume", O.views("volume", extra=[O.VOL_ROWS])
          + "SELECT area, CAST(sum(vehicles) AS BIGINT) AS vehicles, CAST(sum(samples) AS BIGINT) AS samples, "
          f"CASE WHEN sum(samples) = 0 THEN NULL ELSE CAST(sum(vehicles) // sum(samples) * {P.DAYS_IN_PERIOD} "
          "AS BIGINT) END AS volume FROM vol_rows GROUP BY area")
def agg_extrapolate_volume(spark, d):
    sums = AG.sum_measures(R.volume_rows(fixture(spark, d, "volume")), "area",
                           {"vehicles": "vehicles", "samples": "samples"})
    return sums.withColumn("volume", AG.extrapolate_volume("vehicles", "samples", P.DAYS_IN_PERIOD))
