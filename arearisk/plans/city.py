"""The city job from raw files: collision lines, complaint lines, volume CSV,
hourly segment counts -> cleaned facts -> the reports of ``reports``.

Each function is narrow (split, project, cast, filter) until the report's
aggregate; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.functions.expr import count_nonempty, hsum, lenient_int, strict_int
from arearisk.operators.aggregate import describe, first_seen, sort_totals, totals_report
from arearisk.operators.topk import rank_multi_metric
from arearisk.operators import route
from arearisk.session import cut_lineage, fresh_path
from arearisk.operators.clean import (
    filter_arity, filter_date_range, filter_nonempty, once, parse_datetime, parse_datetime_parts,
    project_by_arity, realign_shifted_fields, text_filter,
)
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.sinks.writers import write_csv, write_records
from arearisk.sources.text import (
    drop_header_lines, drop_marker_lines, field, read_lines, split_array,
)


def incident_lines(lines: DataFrame, marker: str = P.INCIDENT_HEADER_MARKER) -> DataFrame:
    """Collision lines without header lines, split once: ``value`` and its fields ``f``."""
    return once(drop_marker_lines(lines, marker).select("value", split_array("value").alias("f")))


def incident_fields(lines: DataFrame, marker: str = P.INCIDENT_HEADER_MARKER,
                    extra: dict[str, int] | None = None) -> DataFrame:
    """Collision lines -> named text fields (arity 29 or 30, shift repaired);
    ``extra`` names further positions to keep."""
    ok = filter_arity(incident_lines(lines, marker), "f", P.INCIDENT_ARITIES)
    spec = {**P.INCIDENT_FIELDS, **P.INCIDENT_INT_FIELDS, **P.INCIDENT_FACTOR_FIELDS,
            **P.INCIDENT_VEHICLE_FIELDS, **(extra or {})}
    return project_by_arity(ok, "f", spec, P.INCIDENT_BASE_ARITY, P.INCIDENT_SHIFT_FROM)


def judged_incidents(lines: DataFrame, ts_formats: list[str] = P.INCIDENT_TS_FORMATS,
                     marker: str = P.INCIDENT_HEADER_MARKER) -> DataFrame:
    """Every collision line judged: ``fields`` (a wrong number of them), ``date`` (unreadable), ``measure`` (a count that
    is no integer); accepted ones in the ``incident`` shape, of any date and key."""
    src = incident_lines(lines, marker)
    spec = {**P.INCIDENT_FIELDS, **P.INCIDENT_INT_FIELDS, **P.INCIDENT_FACTOR_FIELDS, **P.INCIDENT_VEHICLE_FIELDS}
    src = src.select("value", F.size("f").alias("n_fields"), F.when(F.size("f").isin(*P.INCIDENT_ARITIES), F.col("f")).alias("f"))
    f = project_by_arity(src, "f", spec, P.INCIDENT_BASE_ARITY, P.INCIDENT_SHIFT_FROM, keep=["value", "n_fields"])
    ints = {f"{m}_int": m for m in P.MEASURES}
    f = route.with_ints(once(f.withColumn("ts", parse_datetime_parts("date", "time", ts_formats))), ints)
    bad, which = route.bad_ints(ints)
    verdict = route.first_reason([
        ("fields", ~F.col("n_fields").isin(*P.INCIDENT_ARITIES), F.col("n_fields").cast("string")),
        ("date", F.col("ts").isNull(), F.concat_ws(" ", "date", "time")), ("measure", bad, which)])
    return f.select("value", *verdict, "area", "ts", *[F.col(i).alias(m) for i, m in ints.items()],
                    *P.FACTOR_SLOTS, *P.VEHICLE_SLOTS)


def incidents_in_period(facts: DataFrame, lo: str = P.CITY_RANGE[0], hi: str = P.CITY_RANGE[1]) -> DataFrame:
    """Accepted collisions of a period that name an area."""
    return filter_nonempty(filter_date_range(facts, "ts", lo, hi), "area")


def incidents_from_lines(lines: DataFrame, lo: str = P.CITY_RANGE[0], hi: str = P.CITY_RANGE[1],
                         ts_formats: list[str] = P.INCIDENT_TS_FORMATS) -> DataFrame:
    """Cleaned collision facts in the ``incident`` shape: date range, non-empty
    key, the eight measures as strict integers (a bad value fails the job; ``judged_incidents`` routes it instead).
    Lines without a readable date or a full set of fields are ``incident_rejects``."""
    f = once(incident_fields(lines).withColumn("ts", parse_datetime_parts("date", "time", ts_formats)))
    f = incidents_in_period(f, lo, hi)
    return f.select("area", "ts", *[strict_int(m).alias(m) for m in P.MEASURES],
                    *P.FACTOR_SLOTS, *P.VEHICLE_SLOTS)


def incident_rejects(lines: DataFrame, ts_formats: list[str] = P.INCIDENT_TS_FORMATS) -> DataFrame:
    """(value, reason) of the collision lines that hold no record: a wrong number of fields, or an unreadable date."""
    f = incident_lines(lines).select(
        "value", F.size("f").isin(*P.INCIDENT_ARITIES).alias("whole"), field(F.col("f"), 0).alias("date"), field(F.col("f"), 1).alias("time"))
    f = once(f.withColumn("dated", parse_datetime_parts("date", "time", ts_formats).isNotNull()))
    return f.filter(~(F.col("whole") & F.col("dated"))).select(
        "value", F.when(~F.col("whole"), F.lit("fields")).otherwise(F.lit("date")).alias("reason"))


def request_lines(lines: DataFrame, header: str | None = None, ts_formats: list[str] = P.REQUEST_TS_FORMATS) -> DataFrame:
    """Complaint lines split and dated once: ``value``, ``f``, ``ts``."""
    src = drop_header_lines(lines, header) if header is not None else lines
    parts = once(src.select("value", split_array("value").alias("f")))
    dated = parts.withColumn("created", field(F.col("f"), P.REQUEST_FIELDS["date"])).withColumn("ts", parse_datetime("created", ts_formats))
    return once(dated.select("value", "f", "ts"))


def request_fields(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Complaint lines -> (key, ts, kind, descriptor, city) with the stray-comma
    realignment; unparsable dates are dropped (see ``request_rejects``)."""
    a = F.col("f")
    kind = field(a, P.REQUEST_FIELDS["kind"])
    key, desc, city = realign_shifted_fields(a, kind, P.REQUEST_FIELDS["area"],
                                             P.REQUEST_FIELDS["descriptor"], P.REQUEST_FIELDS["city"],
                                             P.TWO_SHIFT_MARKER)
    return request_lines(lines, header).filter(F.col("ts").isNotNull()).select(
        key.alias("area"), "ts", kind.alias("kind"), desc.alias("descriptor"), city.alias("city"))


def request_rejects(lines: DataFrame, header: str | None = None) -> DataFrame:
    """(value, reason) of the complaint lines that hold no record: too few fields, or an unreadable date."""
    r = request_lines(lines, header)
    short = F.size("f") <= P.REQUEST_FIELDS["city"]
    return r.filter(short | F.col("ts").isNull()).select("value", F.when(short, F.lit("fields")).otherwise(F.lit("date")).alias("reason"))


def judged_requests(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Every complaint line judged: ``fields`` (too few) or ``date`` (unreadable); accepted ones in the ``request`` shape,
    of any date, key and type."""
    a, last = F.col("f"), P.REQUEST_FIELDS["city"]
    kind = field(a, P.REQUEST_FIELDS["kind"])
    key, desc, city = realign_shifted_fields(a, kind, P.REQUEST_FIELDS["area"], P.REQUEST_FIELDS["descriptor"], last, P.TWO_SHIFT_MARKER)
    verdict = route.first_reason([
        ("fields", F.size("f") <= last, F.size("f").cast("string")),
        ("date", F.col("ts").isNull(), field(a, P.REQUEST_FIELDS["date"]))])
    return request_lines(lines, header).select("value", *verdict, key.alias("area"), "ts", kind.alias("kind"),
                                               desc.alias("descriptor"), city.alias("city"))


def requests_in_period(facts: DataFrame, lo: str = P.CITY_RANGE[0], hi: str = P.CITY_RANGE[1]) -> DataFrame:
    """Accepted street complaints of a period that name an area and a city."""
    r = filter_nonempty(filter_date_range(facts, "ts", lo, hi), "area", "city")
    return r.filter(text_filter("kind", P.REQUEST_INCLUDE, P.REQUEST_EXCLUDE))


def requests_from_lines(lines: DataFrame, header: str | None = None, lo: str = P.CITY_RANGE[0],
                        hi: str = P.CITY_RANGE[1]) -> DataFrame:
    """Cleaned complaint facts in the ``request`` shape."""
    return requests_in_period(request_fields(lines, header), lo, hi)


VOLUME_SCHEMA = T.StructType([T.StructField("area_expr", T.StringType()),
                              T.StructField("vehicles", T.LongType(), nullable=False),
                              T.StructField("samples", T.LongType(), nullable=False)])


def judged_volume(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Every row of the area volume CSV judged: ``columns`` or ``value``."""
    return route.judged_csv(spark, path, VOLUME_SCHEMA, header=header)


def volume_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Area volume CSV (header line): ``area_expr, vehicles, samples``. A row without two integers, or with another number
    of fields, fails the job; ``judged_volume`` routes it instead."""
    return route.must_accept(judged_volume(spark, path))


def segment_days(lines: DataFrame, marker: str = P.SEGMENT_HEADER_MARKER) -> DataFrame:
    """Hourly count lines -> (segment, names, vehicles of the row); hours
    that are not integers count as 0."""
    arr = once(drop_marker_lines(lines, marker).select(split_array("value").alias("f")))
    a = F.col("f")
    return arr.select(*[F.trim(field(a, i)).alias(n) for n, i in P.SEGMENT_FIELDS.items()],
                      hsum([lenient_int(field(a, i)) for i in P.SEGMENT_HOUR_FIELDS]).alias("vehicles"),
                      F.trim(field(a, P.SEGMENT_LINE_FIELD)).try_cast("bigint").alias("line"))


def segments_from_lines(lines: DataFrame) -> DataFrame:
    """Per segment: first-seen names, summed vehicles, number of samples.

    First is the line with the smallest line id, a field of the record; reading order is no order of files."""
    return first_seen(segment_days(lines), "segment", "line", ["roadway", "from_name", "to_name"],
                      {"vehicles": "vehicles"}, "samples")


def request_totals(req: DataFrame) -> DataFrame:
    """``(category, count)``: all complaints, each type in capitals, each descriptor (an empty one too)."""
    return totals_report(req.withColumn("complaint", F.upper("kind")), {"total_complaints": F.lit(1)}, ["complaint"], ["descriptor"])


def city_profile(spark: SparkSession, collisions: str, complaints: str, volume: str,
                 complaints_header: str | None = None, collision_range: tuple[str, str] = P.CITY_RANGE,
                 complaint_range: tuple[str, str] = P.CITY_RANGE) -> DataFrame:
    """The joined per-area profile (27 columns) from the three raw inputs."""
    inc = R.incidents_by_area(incidents_from_lines(read_lines(spark, collisions), *collision_range))
    req = R.requests_by_area(requests_from_lines(read_lines(spark, complaints), complaints_header,
                                                 *complaint_range))
    vol = R.volume_by_area(volume_from_csv(spark, volume))
    return R.area_profile(vol, inc, req)


def city_report(spark: SparkSession, collisions: str, complaints: str, volume: str,
                complaints_header: str | None = None, collision_range: tuple[str, str] = P.CITY_RANGE,
                complaint_range: tuple[str, str] = P.CITY_RANGE) -> DataFrame:
    """The whole classified area report from the three raw inputs."""
    return R.area_risk(city_profile(spark, collisions, complaints, volume, complaints_header,
                                    collision_range, complaint_range))


def write_city_outputs(profile: DataFrame, out_dir: str) -> DataFrame:
    """The job's outputs from one profile: the classified report as CSV
    with header, the top/bottom-10 lists of the four rates and the rate
    statistics as JSON records. Returns the classified report."""
    profile = cut_lineage(profile, "city-profile")
    risk = R.area_risk(profile)
    write_csv(risk, f"{out_dir}/results/final_result")
    write_records(rank_multi_metric(profile, "area", P.RATE_COLUMNS, 10, keep=profile.columns),
                  f"{out_dir}/totals/rankings", single_file=True, order=["list", "rank"])
    write_records(describe(profile, P.RATE_COLUMNS), f"{out_dir}/totals/aggregations", single_file=True)
    return risk


def segment_volume_from_lines(lines: DataFrame, lookup: DataFrame) -> DataFrame:
    """Hourly segment-count lines + a name -> postcode lookup ``(name, postcode)``
    -> apportioned ``(area, vehicles, samples)`` rows, the input of the area
    volume report."""
    return R.segment_volume(segments_from_lines(lines), lookup)


def routed(spark: SparkSession, judged: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a judged frame, stored in the shared folder by one pass over its source."""
    return route.routed(spark, route.write_routed(judged, fresh_path(spark, label)), judged.schema)


def run_city_job(spark: SparkSession, collisions: str, complaints: str, volume: str, out_dir: str,
                 complaints_header: str | None = None, collision_range: tuple[str, str] = P.CITY_RANGE,
                 complaint_range: tuple[str, str] = P.CITY_RANGE, download: bool = False, rejects: str = "fail") -> DataFrame:
    """The whole job: classified report, ranking lists and statistics; with
    ``download`` also the three per-area reports and the two totals tables
    (CSV with header). Sub-reports are computed once: they are
    cut into the shared folder and every output reads the cut tables.

    ``rejects``: "fail" stops at a bad measure or volume row, and skips lines without a record. "route" stores each
    input's accepted and rejected records in one pass, reports on the accepted ones, and writes the rejects of all
    three inputs, with their reasons, as CSV with header under ``rejects``."""
    if rejects not in ("fail", "route"):
        raise ValueError("rejects is 'fail' or 'route'")
    if rejects == "fail":
        inc_facts = incidents_from_lines(read_lines(spark, collisions), *collision_range)
        req_facts = requests_from_lines(read_lines(spark, complaints), complaints_header, *complaint_range)
        vol_facts = volume_from_csv(spark, volume)
    else:
        inc_all, inc_bad = routed(spark, judged_incidents(read_lines(spark, collisions)), "incidents-routed")
        req_all, req_bad = routed(spark, judged_requests(read_lines(spark, complaints), complaints_header), "requests-routed")
        vol_facts, vol_bad = routed(spark, judged_volume(spark, volume), "volume-routed")
        inc_facts = incidents_in_period(inc_all, *collision_range)
        req_facts = requests_in_period(req_all, *complaint_range)
        bad = [b.select(F.lit(n).alias("source"), "*") for n, b in (("collision", inc_bad), ("complaint", req_bad), ("volume", vol_bad))]
        write_csv(bad[0].unionByName(bad[1]).unionByName(bad[2]), f"{out_dir}/rejects")
    inc = cut_lineage(R.incidents_by_area(inc_facts), "incidents-by-area")
    req = cut_lineage(R.requests_by_area(req_facts), "requests-by-area")
    vol = cut_lineage(R.volume_by_area(vol_facts), "volume-by-area")
    risk = write_city_outputs(R.area_profile(vol, inc, req), out_dir)
    if download:
        write_csv(inc, f"{out_dir}/results/incidents_by_area")
        write_csv(req, f"{out_dir}/results/requests_by_area")
        write_csv(vol, f"{out_dir}/results/volume_by_area")
        inc_measures = {"total_accidents": F.lit(1), "total_vehicles": count_nonempty(P.VEHICLE_SLOTS),
                        **{f"total_{m}": m for m in P.MEASURES}}
        write_csv(sort_totals(totals_report(inc_facts, inc_measures, P.FACTOR_SLOTS + P.VEHICLE_SLOTS)),
                  f"{out_dir}/totals/incidents")
        write_csv(sort_totals(request_totals(req_facts)), f"{out_dir}/totals/requests")
    return risk
