"""Row-level operators and scalar functions (2.8).

All narrow: projections and filters over the fixture views, no shuffle
except where a query first needs a per-area total.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from arearisk.functions import expr as X
from arearisk.operators import clean as CL
from arearisk.operators.aggregate import category_counts, sum_measures
from arearisk.operators.keys import apportion_by_agreement, explode_multi_key
from arearisk.operators.joins import resolve_names
from arearisk.plans import city as C
from arearisk.plans import oracle as O
from arearisk.plans import presets as P
from arearisk.plans.base import incidents, raw_lines, register
from arearisk.plans.fixtures import fixture
from arearisk.sources.text import field, split_array

RI_VIEWS = O.views("raw_incident", extra=[O.RI])
RR_VIEWS = O.views("raw_request", extra=[O.RR])


def raw(spark, d, view):
    """Raw lines with their naive split ``f``."""
    return CL.once(raw_lines(spark, d, view).select("value", split_array("value").alias("f")))


# ------------------------------------------------------------ 2.3 filters

@register("filter_arity", RI_VIEWS + "SELECT value, nf AS n_fields FROM ri WHERE nf IN (29, 30)")
def filter_arity(spark, d):
    ok = CL.filter_arity(raw(spark, d, "raw_incident"), "f", P.INCIDENT_ARITIES)
    return ok.select("value", F.size("f").cast("bigint").alias("n_fields"))


@register("project_by_arity", O.views("raw_incident", extra=[O.RI, O.INC_FIELDS_SQL]) + "SELECT * FROM ri_f")
def project_by_arity(spark, d):
    return C.incident_fields(raw_lines(spark, d, "raw_incident"))


@register("parse_datetime_parts", RI_VIEWS
          + "SELECT value, try_strptime(f[1] || ' ' || f[2], '%m/%d/%Y %H:%M') AS ts FROM ri")
def parse_datetime_parts(spark, d):
    r = raw(spark, d, "raw_incident").select("value", field(F.col("f"), 0).alias("date"),
                                             field(F.col("f"), 1).alias("time"))
    return r.select("value", CL.parse_datetime_parts("date", "time", P.INCIDENT_TS_FORMATS).alias("ts"))


@register("parse_datetime_or_drop", RR_VIEWS
          + "SELECT f[1] AS event_id, try_strptime(f[2], '%m/%d/%Y %I:%M:%S %p') AS ts FROM rr "
          "WHERE try_strptime(f[2], '%m/%d/%Y %I:%M:%S %p') IS NOT NULL")
def parse_datetime_or_drop(spark, d):
    r = raw(spark, d, "raw_request").select(field(F.col("f"), 0).alias("event_id"),
                                            field(F.col("f"), 1).alias("created"))
    return CL.parse_datetime_or_drop(r, "created", P.REQUEST_TS_FORMATS).select("event_id", "ts")


@register("filter_date_range", O.views("incident")
          + f"SELECT area, ts, id, line FROM incident WHERE {O.ts_between('ts', P.TEST_INCIDENT_RANGE)}")
def filter_date_range(spark, d):
    inc = fixture(spark, d, "incident").select("area", "ts", "id", "line")
    return CL.filter_date_range(inc, "ts", *P.TEST_INCIDENT_RANGE)


@register("filter_nonempty_key", RI_VIEWS + "SELECT value, f[4] AS area FROM ri WHERE f[4] <> ''")
def filter_nonempty_key(spark, d):
    r = raw(spark, d, "raw_incident").select("value", field(F.col("f"), 3).alias("area"))
    return CL.filter_nonempty(r, "area")


@register("filter_include_exclude", O.views("request")
          + "SELECT area, ts, kind FROM request WHERE contains(kind, 'Street') AND NOT contains(kind, 'Noise')")
def filter_include_exclude(spark, d):
    r = fixture(spark, d, "request").select("area", "ts", "kind")
    return CL.filter_include_exclude(r, "kind", P.REQUEST_INCLUDE, P.REQUEST_EXCLUDE)


@register("reject_malformed_key", O.views("volume") + "SELECT * FROM volume WHERE NOT contains(area_expr, 'NY')")
def reject_malformed_key(spark, d):
    return CL.reject_malformed_key(fixture(spark, d, "volume"), "area_expr", P.MALFORMED_KEY_MARKER)


@register("realign_shifted_fields", O.views("raw_request", extra=[O.RR, O.RR_REALIGN])
          + "SELECT event_id, kind, area, descriptor, city FROM rr_a")
def realign_shifted_fields(spark, d):
    f = F.col("f")
    kind = field(f, P.REQUEST_FIELDS["kind"])
    key, desc, city = CL.realign_shifted_fields(f, kind, P.REQUEST_FIELDS["area"], P.REQUEST_FIELDS["descriptor"],
                                                P.REQUEST_FIELDS["city"], P.TWO_SHIFT_MARKER)
    return raw(spark, d, "raw_request").select(field(f, 0).alias("event_id"), kind.alias("kind"),
                                                key.alias("area"), desc.alias("descriptor"), city.alias("city"))


@register("normalize_int_key", RR_VIEWS
          + f"SELECT f[1] AS event_id, f[9] AS raw_key, CASE WHEN {O.is_int_sql('f[9]')} "
          "THEN CAST(TRY_CAST(trim(f[9]) AS BIGINT) AS VARCHAR) END AS area FROM rr")
def normalize_int_key(spark, d):
    f = F.col("f")
    k = field(f, P.REQUEST_FIELDS["area"])
    return raw(spark, d, "raw_request").select(
        field(f, 0).alias("event_id"), k.alias("raw_key"),
        F.when(X.is_int_text(k), X.normalize_int_key(k)).alias("area"))


@register("strict_int_cast", O.views("raw_incident", extra=[O.RI, O.INC_FIELDS_SQL])
          + "SELECT date, time, area, " + ", ".join(f"CAST(trim({m}) AS INTEGER) AS {m}" for m in P.MEASURES)
          + " FROM ri_f")
def strict_int_cast(spark, d):
    f = C.incident_fields(raw_lines(spark, d, "raw_incident"))
    return f.select("date", "time", "area", *[X.strict_int(m).alias(m) for m in P.MEASURES])


HOURS = [f"h{i}" for i in range(24)]
HOURLY_TEXT_SQL = ("hw AS (SELECT segment, day, " + ", ".join(
    f"coalesce(CAST(max(CASE WHEN h = {i} THEN n END) AS VARCHAR), '') AS h{i}" for i in range(24))
    + " FROM hourly GROUP BY segment, day)")


def hourly_text(spark, d):
    """Hourly counts pivoted to 24 text columns per (segment, day); a missing
    hour is an empty field, as in the raw file."""
    h = fixture(spark, d, "hourly")
    return h.groupBy("segment", "day").agg(*[
        F.coalesce(F.max(F.when(F.col("h") == i, F.col("n"))).cast("string"), F.lit("")).alias(f"h{i}")
        for i in range(24)])


@register("lenient_int_cast", O.views("hourly", extra=[HOURLY_TEXT_SQL])
          + "SELECT segment, day, " + ", ".join(f"{O.lenient_sql(h)} AS {h}" for h in HOURS) + " FROM hw")
def lenient_int_cast(spark, d):
    return hourly_text(spark, d).select("segment", "day", *[X.lenient_int(h).alias(h) for h in HOURS])


@register("horizontal_sum", O.views("hourly", extra=[HOURLY_TEXT_SQL])
          + "SELECT segment, day, " + " + ".join(O.lenient_sql(h) for h in HOURS) + " AS vehicles FROM hw")
def horizontal_sum(spark, d):
    return hourly_text(spark, d).select("segment", "day",
                                        X.hsum([X.lenient_int(h) for h in HOURS]).alias("vehicles"))


@register("upper_label", O.views("request") + "SELECT area, ts, kind, upper(kind) AS label FROM request")
def upper_label(spark, d):
    return fixture(spark, d, "request").select("area", "ts", "kind", X.upper_label("kind").alias("label"))


@register("capitalize_label", O.views("request")
          + "SELECT area, ts, city, upper(left(city, 1)) || lower(substr(city, 2)) AS label FROM request")
def capitalize_label(spark, d):
    return fixture(spark, d, "request").select("area", "ts", "city", X.capitalize_label("city").alias("label"))


@register("ordinal_street_name", O.views("street")
          + "SELECT segment, " + O.ordinal_sql("roadway") + " AS road, " + O.ordinal_sql("from_name")
          + " AS start, " + O.ordinal_sql("to_name") + " AS \"end\" FROM street")
def ordinal_street_name(spark, d):
    s = fixture(spark, d, "street")
    return s.select("segment", X.ordinal_street_name("roadway").alias("road"),
                    X.ordinal_street_name("from_name").alias("start"),
                    X.ordinal_street_name("to_name").alias("end"))


EXPLODE_SQL = O.MULTI_KEYS.format(where="true")


@register("explode_multi_key", O.views("volume") + EXPLODE_SQL)
def explode_multi_key_q(spark, d):
    return explode_multi_key(fixture(spark, d, "volume"), "area_expr", ["vehicles", "samples"], out="area")


def resolved_segments(spark, d):
    s = fixture(spark, d, "street")
    named = s.select("segment", X.ordinal_street_name("roadway").alias("road"),
                     X.ordinal_street_name("from_name").alias("start"),
                     X.ordinal_street_name("to_name").alias("end"), "vehicles", "samples")
    return resolve_names(named, "segment", {"road": "road", "start": "start", "end": "end"},
                         fixture(spark, d, "lookup"), "name", "postcode", carry=["vehicles", "samples"])


@register("apportion_by_agreement", O.views("street", "lookup", extra=O.SEGMENT_CHAIN) + "SELECT * FROM app")
def apportion_q(spark, d):
    return apportion_by_agreement(resolved_segments(spark, d), "road_zip", "start_zip", "end_zip",
                                  ["vehicles", "samples"], keep=["segment"], out="area")


# ------------------------------------------------------- 2.8 scalar functions

def inc_totals(spark, d):
    return sum_measures(incidents(spark, d).withColumn("vehicles", X.count_nonempty(P.VEHICLE_SLOTS)),
                        "area", {"per_i": "per_i", "per_k": "per_k", "ped_i": "ped_i", "ped_k": "ped_k",
                                 "vehicles": "vehicles"}, count_as="accidents")


INC_TOT_SQL = ("tot AS (SELECT area, count(*) AS accidents, CAST(sum(per_i) AS BIGINT) AS per_i, "
               "CAST(sum(per_k) AS BIGINT) AS per_k, CAST(sum(ped_i) AS BIGINT) AS ped_i, "
               f"CAST(sum(ped_k) AS BIGINT) AS ped_k, CAST(sum({O.NONEMPTY_VEH}) AS BIGINT) AS vehicles "
               "FROM inc GROUP BY area)")
TOT_VIEWS = O.views("incident", extra=[O.INC_CLEAN, INC_TOT_SQL])


@register("rate_per_1000", TOT_VIEWS + "SELECT area, "
          + O.rate_sql("per_i", "accidents") + " AS injuries_per_1000_accidents, "
          + O.rate_sql("per_k", "accidents") + " AS deaths_per_1000_accidents FROM tot")
def rate_per_1000(spark, d):
    t = inc_totals(spark, d)
    return t.select("area", X.rate_per_1000("per_i", "accidents").alias("injuries_per_1000_accidents"),
                    X.rate_per_1000("per_k", "accidents").alias("deaths_per_1000_accidents"))


@register("ratio_rounded", TOT_VIEWS + "SELECT area, " + O.rate_sql("vehicles", "accidents", "")
          + " AS vehicles_per_accident FROM tot")
def ratio_rounded(spark, d):
    return inc_totals(spark, d).select("area", X.ratio_rounded("vehicles", "accidents").alias("vehicles_per_accident"))


@register("share_pct_safe", TOT_VIEWS + "SELECT area, " + O.share_sql("ped_i", "per_i") + " AS pedestrian_injured_pct, "
          + O.share_sql("ped_k", "per_k") + " AS pedestrian_killed_pct FROM tot")
def share_pct_safe(spark, d):
    t = inc_totals(spark, d)
    return t.select("area", X.share_pct("ped_i", "per_i").alias("pedestrian_injured_pct"),
                    X.share_pct("ped_k", "per_k").alias("pedestrian_killed_pct"))


@register("label_count_pct0", TOT_VIEWS + "SELECT area, " + O.pct0_sql("ped_i", "per_i") + " AS pedestrians_injured, "
          + O.pct0_sql("ped_k", "per_k") + " AS pedestrians_killed FROM tot")
def label_count_pct0(spark, d):
    t = inc_totals(spark, d)
    return t.select("area",
                    X.label_count_pct0("ped_i", X.share_pct("ped_i", "per_i")).alias("pedestrians_injured"),
                    X.label_count_pct0("ped_k", X.share_pct("ped_k", "per_k")).alias("pedestrians_killed"))


@register("label_name_count_pct", O.views("incident", extra=[O.INC_CLEAN, INC_TOT_SQL, O.INC_COUNTS])
          + "SELECT c.area, c.category, " + O.label_sql("c.category", "c.n", "t.vehicles")
          + " AS label FROM inc_cnt c JOIN tot t ON c.area = t.area")
def label_name_count_pct(spark, d):
    # The totals are one narrow row per area, joined by their measured size.
    inc = incidents(spark, d)
    counts = category_counts(inc, "area", P.FACTOR_SLOTS + P.VEHICLE_SLOTS).filter(~F.col("category").isin(*P.IGNORE_CATEGORIES))
    totals = sum_measures(inc.withColumn("v", X.count_nonempty(P.VEHICLE_SLOTS)), "area", {"total_vehicles": "v"})
    return counts.join(totals, "area").select("area", "category", X.label_name_count_pct(
        "category", "n", X.share_pct("n", "total_vehicles")).alias("label"))


@register("case_class", O.views("incident", extra=[O.INC_CLEAN])
          + "SELECT category, " + O.upper_case_sql("category") + " AS is_upper FROM "
          f"(SELECT DISTINCT unnest([{', '.join(O.FAC + O.VEH)}]) AS category FROM inc) s "
          "WHERE category IS NOT NULL AND category <> ''")
def case_class(spark, d):
    cats = incidents(spark, d).select(F.explode(F.array(*P.FACTOR_SLOTS, *P.VEHICLE_SLOTS)).alias("category"))
    cats = cats.filter(X.nonempty("category")).distinct()
    return cats.select("category", X.case_class_upper("category").alias("is_upper"))


@register("concat_fields", RR_VIEWS + "SELECT f[1] AS event_id, concat_ws(' ', f[7], f[8]) AS text FROM rr")
def concat_fields(spark, d):
    f = F.col("f")
    return raw(spark, d, "raw_request").select(field(f, 0).alias("event_id"),
                                                X.concat_fields(field(f, 6), field(f, 7)).alias("text"))


@register("trim_fields", O.views("volume")
          + "SELECT area_expr, trim(string_split_regex(area_expr, '[;:]')[1]) AS first_key, "
          "trim(string_split_regex(area_expr, '[;:]')[2]) AS second_key FROM volume "
          "WHERE contains(area_expr, ';') OR contains(area_expr, ':')")
def trim_fields(spark, d):
    v = fixture(spark, d, "volume")
    v = v.filter(F.col("area_expr").contains(";") | F.col("area_expr").contains(":"))
    parts = F.split("area_expr", "[;:]", -1)
    return v.select("area_expr", X.trim_field(F.try_element_at(parts, F.lit(1))).alias("first_key"),
                    X.trim_field(F.try_element_at(parts, F.lit(2))).alias("second_key"))


@register("floor_fraction", O.views("volume")
          + "SELECT area_expr, vehicles // 2 AS half, vehicles // 3 AS third, (vehicles // 3) * 2 AS two_thirds "
          "FROM volume")
def floor_fraction(spark, d):
    v = fixture(spark, d, "volume")
    return v.select("area_expr", X.floor_fraction("vehicles", 2).alias("half"),
                    X.floor_fraction("vehicles", 3).alias("third"),
                    X.floor_fraction("vehicles", 3, 2).alias("two_thirds"))
