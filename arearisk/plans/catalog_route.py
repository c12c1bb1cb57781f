"""Accepted and rejected records, and stored partial summaries (2.5).

The routing queries judge every record of a raw view, store both outcomes in the shared folder in one pass, and return
the stored records: rejects with reason, detail and value, accepted ones with their typed columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from arearisk.operators import route
from arearisk.operators.aggregate import merge_partials
from arearisk.plans import city as C
from arearisk.plans import oracle as O
from arearisk.plans import partials as PP
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans.base import fresh, incidents, raw_lines, register
from arearisk.plans.fixtures import fixture


def stored(spark, judged, label):
    """Both outcomes, read back from the stored table."""
    good, bad = C.routed(spark, judged, label)
    empty = [F.lit(None).cast("string").alias(c) for c in route.VERDICT]
    return good.select(F.lit(route.ACCEPTED).alias("outcome"), *empty, "*").unionByName(
        bad.select(F.lit(route.REJECTED).alias("outcome"), "*"), allowMissingColumns=True)


def judged_sql(name: str, source: str, checks: list[tuple[str, str, str]], typed: dict[str, str]) -> list[str]:
    """CTE ``name``: rows of ``source`` with reason and detail, and the typed columns of the accepted ones."""
    reason = "CASE " + " ".join(f"WHEN {bad} THEN '{r}'" for r, bad, _ in checks) + " END"
    detail = "CASE " + " ".join(f"WHEN {bad} THEN {text}" for _, bad, text in checks) + " END"
    cols = ", ".join(f"CASE WHEN reason IS NULL THEN {x} END AS {c}" for c, x in typed.items())
    return [f"{name} AS (SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, reason, detail, "
            f"CASE WHEN reason IS NOT NULL THEN value END AS value, {cols} FROM (SELECT *, {reason} AS reason, {detail} AS detail FROM {source}) j)"]


# ------------------------------------------------------------------ collisions

RIM = "ri AS (SELECT value, string_split(value, ',') AS f, len(string_split(value, ',')) AS nf FROM raw_incident_mixed)"
RIM_FIELDS = ("rim AS (SELECT value, nf, f[1] || ' ' || f[2] AS dated, try_strptime(f[1] || ' ' || f[2], '%m/%d/%Y %H:%M') AS ts, "
              + ", ".join(f"CASE WHEN nf IN (29, 30) THEN {O.inc_field(i)} END AS {n}" for n, i in O.INCIDENT_SPEC.items() if n not in ("date", "time"))
              + " FROM ri)")


def int_sql(x: str, kind: str = "INTEGER") -> str:
    return f"CASE WHEN {O.is_int_sql(x)} THEN TRY_CAST(trim({x}) AS {kind}) END"


WRONG = ", ".join(f"CASE WHEN ({int_sql(m)}) IS NULL THEN '{m}=' || coalesce({m}, '') END" for m in P.MEASURES)
INCIDENT_CHECKS = [("fields", "nf NOT IN (29, 30)", "CAST(nf AS VARCHAR)"), ("date", "ts IS NULL", "dated"),
                   ("measure", f"concat_ws(', ', {WRONG}) <> ''", f"concat_ws(', ', {WRONG})")]
INCIDENT_TYPED = {"area": "area", "ts": "ts", **{m: int_sql(m) for m in P.MEASURES}, **{c: c for c in P.FACTOR_SLOTS + P.VEHICLE_SLOTS}}
INCIDENT_ROUTED = [RIM, RIM_FIELDS, *judged_sql("routed", "rim", INCIDENT_CHECKS, INCIDENT_TYPED)]


@register("route_incident_lines", O.views("raw_incident_mixed", extra=INCIDENT_ROUTED) + "SELECT * FROM routed")
def route_incident_lines(spark, d):
    return stored(spark, C.judged_incidents(raw_lines(spark, d, "raw_incident_mixed")), "incidents-routed")


@register("report_incidents_accepted", O.views("raw_incident_mixed", extra=[
          *INCIDENT_ROUTED, f"inc AS (SELECT * FROM routed WHERE outcome = 'accepted' AND {O.ts_between('ts', P.TEST_INCIDENT_RANGE)} AND {O.INC_KEPT})",
          O.INC_TOTALS, O.INC_COUNTS, O.INC_RANKED, O.INC_REPORT]) + "SELECT * FROM inc_rep")
def report_incidents_accepted(spark, d):
    """The per-area report over the accepted records of lines with bad measures among them."""
    good, _ = C.routed(spark, C.judged_incidents(raw_lines(spark, d, "raw_incident_mixed")), "incidents-routed")
    return R.incidents_by_area(C.incidents_in_period(good, *P.TEST_INCIDENT_RANGE))


# ------------------------------------------------------------------ complaints

REQUEST_CHECKS = [("fields", "nf < 17", "CAST(nf AS VARCHAR)"), ("date", "ts IS NULL", "created")]
REQUEST_ROUTED = [O.RR, O.RR_REALIGN.replace("rr_a AS (SELECT f[1]", "rr_a AS (SELECT value, nf, try_strptime(f[2], '%m/%d/%Y %I:%M:%S %p') AS ts, f[1]"),
                  *judged_sql("routed", "rr_a", REQUEST_CHECKS, {c: c for c in ("area", "ts", "kind", "descriptor", "city")})]


@register("route_request_lines", O.views("raw_request", extra=REQUEST_ROUTED) + "SELECT * FROM routed")
def route_request_lines(spark, d):
    return stored(spark, C.judged_requests(raw_lines(spark, d, "raw_request")), "requests-routed")


# ------------------------------------------------------------------ volumes

VOLUME_PARTS = ("rv AS (SELECT value, len(parts) AS nf, trim(parts[1], '\"') AS area_expr, parts[2] AS vehicles, parts[3] AS samples FROM "
                "(SELECT value, regexp_extract_all(value, '(\"[^\"]*\"|[^,]*)(,|$)', 1)[:len(string_split(regexp_replace(value, '\"[^\"]*\"', ''), ','))] "
                "AS parts FROM raw_volume) p)")
VOLUME_WRONG = ", ".join(f"CASE WHEN ({int_sql(m, 'BIGINT')}) IS NULL THEN '{m}=' || {m} END" for m in ("vehicles", "samples"))
VOLUME_CHECKS = [("columns", "nf <> 3", "NULL"), ("value", f"concat_ws(', ', {VOLUME_WRONG}) <> ''", f"concat_ws(', ', {VOLUME_WRONG})")]
VOLUME_ROUTED = [VOLUME_PARTS, *judged_sql("routed", "rv", VOLUME_CHECKS,
                                           {"area_expr": "area_expr", **{m: int_sql(m, "BIGINT") for m in ("vehicles", "samples")}})]


def volume_file(spark, d):
    path = fresh(spark, "raw-volume")
    fixture(spark, d, "raw_volume").write.text(path)
    return path


@register("route_volume_rows", O.views("raw_volume", extra=VOLUME_ROUTED) + "SELECT * FROM routed")
def route_volume_rows(spark, d):
    """Quoted CSV rows against their schema: another number of fields, values that are no integers."""
    return stored(spark, C.judged_volume(spark, volume_file(spark, d), header=False), "volume-routed")


@register("report_volume_accepted", O.views("raw_volume", extra=[
          *VOLUME_ROUTED, "volume AS (SELECT area_expr, vehicles, samples FROM routed WHERE outcome = 'accepted')", *O.VOL_CHAIN]) + "SELECT * FROM vol_rep")
def report_volume_accepted(spark, d):
    return R.volume_by_area(route.accepted(C.judged_volume(spark, volume_file(spark, d), header=False)))


# ------------------------------------------------------------------ stored partials

STORED_SUMS = {"per_i": "per_i", "per_k": "per_k"}
#: the facts come in two deliveries
DELIVERY = "1997-01-01"


@register("agg_stored_partials", O.views("incident", extra=[O.INC_CLEAN])
          + "SELECT area, count(*) AS accidents, CAST(sum(per_i) AS BIGINT) AS per_i, CAST(sum(per_k) AS BIGINT) AS per_k, "
          "count(DISTINCT strftime(ts, '%Y-%m')) AS periods FROM inc GROUP BY area")
def agg_stored_partials(spark, d):
    """Collisions delivered in two parts; each delivery adds the partial tables of its months, and the report merges them."""
    facts, parts = fresh(spark, "facts"), fresh(spark, "partials")
    inc = incidents(spark, d).select("area", "ts", *STORED_SUMS)
    late = F.col("ts") >= F.lit(DELIVERY).cast("timestamp_ntz")
    for delivery in (~late, late):  # each update reads the months of its delivery only
        PP.store_facts(inc.filter(delivery), facts, PP.by_month())
        PP.update_partials(spark, facts, parts, "area", STORED_SUMS, count_as="accidents")
    whole = PP.read_periods(spark, parts).withColumn("periods", F.lit(1))
    return merge_partials([whole], "area", ["accidents", *STORED_SUMS, "periods"])
