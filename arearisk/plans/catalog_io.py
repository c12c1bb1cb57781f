"""Sources and sinks over the raw fixture views.

Text scans and sinks round-trip through a fresh location in the shared
folder: the raw view (derived from the driver's tables) is written, then
read back by the operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.plans import city as C
from arearisk.plans import oracle as O
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans.base import (
    fresh, incident_report, incidents, profile, raw_lines, register, request_report,
)
from arearisk.plans.fixtures import fixture
from arearisk.session import cut_lineage
from arearisk.sinks.writers import write_csv, write_facts, write_lines, write_records
from arearisk.sources.text import (
    conform, read_lines, read_lines_drop_header, read_lines_drop_marker, read_quoted_csv, sample_rows,
    split_fields,
)
from arearisk.operators.topk import rank_multi_metric

# Header lines of the two raw files (column titles of the public data sets).
INCIDENT_HEADER = ",".join([
    "DATE", "TIME", "BOROUGH", "ZIP CODE", "LATITUDE", "LONGITUDE", "LOCATION", "ON STREET NAME",
    "CROSS STREET NAME", "OFF STREET NAME", "NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED",
    "NUMBER OF PEDESTRIANS INJURED", "NUMBER OF PEDESTRIANS KILLED", "NUMBER OF CYCLIST INJURED",
    "NUMBER OF CYCLIST KILLED", "NUMBER OF MOTORIST INJURED", "NUMBER OF MOTORIST KILLED",
    "CONTRIBUTING FACTOR VEHICLE 1", "CONTRIBUTING FACTOR VEHICLE 2", "CONTRIBUTING FACTOR VEHICLE 3",
    "CONTRIBUTING FACTOR VEHICLE 4", "CONTRIBUTING FACTOR VEHICLE 5", "UNIQUE KEY",
    "VEHICLE TYPE CODE 1", "VEHICLE TYPE CODE 2", "VEHICLE TYPE CODE 3", "VEHICLE TYPE CODE 4",
    "VEHICLE TYPE CODE 5"])
REQUEST_HEADER = ",".join([
    "Unique Key", "Created Date", "Closed Date", "Agency", "Agency Name", "Complaint Type", "Descriptor",
    "Location Type", "Incident Zip", "Incident Address", "Street Name", "Cross Street 1", "Cross Street 2",
    "Intersection Street 1", "Intersection Street 2", "Address Type", "City", "Landmark", "Facility Type"])


def raw_with_header(spark, d, view: str, header: str, label: str) -> str:
    """Write header + raw view lines as text files; return the location."""
    path = fresh(spark, label)
    head = spark.createDataFrame([(header,)], "value string")
    head.unionByName(fixture(spark, d, view)).write.text(path)
    return path


# ------------------------------------------------------------------ scans

@register("scan_lines_drop_marker", O.views("raw_incident") + "SELECT value FROM raw_incident")
def scan_lines_drop_marker(spark, d):
    path = raw_with_header(spark, d, "raw_incident", INCIDENT_HEADER, "raw-incident")
    return read_lines_drop_marker(spark, path, P.INCIDENT_HEADER_MARKER)


@register("scan_lines_drop_header", O.views("raw_request") + "SELECT value FROM raw_request")
def scan_lines_drop_header(spark, d):
    path = raw_with_header(spark, d, "raw_request", REQUEST_HEADER, "raw-request")
    return read_lines_drop_header(spark, path, REQUEST_HEADER)


@register("split_positional", O.views("raw_incident", extra=[O.RI])
          + "SELECT value, f[1] AS date, f[2] AS time, f[4] AS area, f[24] AS field_23, f[29] AS field_28 FROM ri")
def split_positional(spark, d):
    return split_fields(raw_lines(spark, d, "raw_incident"),
                        {"date": 0, "time": 1, "area": 3, "field_23": 23, "field_28": 28}, keep=["value"])


QUOTED_SCHEMA = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(P.INCIDENT_BASE_ARITY)])


@register("scan_quoted_csv", O.views("raw_incident", extra=[O.RI])
          + "SELECT f[1] AS date, f[4] AS area, "
          "CASE WHEN nf = 30 THEN replace(f[7] || ',' || f[8], '\"', '') ELSE f[7] END AS location, "
          "CASE WHEN nf = 30 THEN f[25] ELSE f[24] END AS unique_key, "
          "coalesce(CASE WHEN nf = 30 THEN f[30] ELSE f[29] END, '') AS last_field FROM ri")
def scan_quoted_csv(spark, d):
    path = fresh(spark, "raw-incident-csv")
    fixture(spark, d, "raw_incident").write.text(path)
    df = read_quoted_csv(spark, path, QUOTED_SCHEMA)
    return df.select(F.col("c0").alias("date"), F.col("c3").alias("area"), F.col("c6").alias("location"),
                     F.col("c23").alias("unique_key"), F.col("c28").alias("last_field"))


PROFILE_SCHEMA = T.StructType(
    [T.StructField("city", T.StringType()), T.StructField("area", T.StringType())]
    + [T.StructField(c, T.FloatType()) for c in P.RATE_COLUMNS]
    + [T.StructField("total_accidents", T.IntegerType()), T.StructField("total_vehicles", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in R.PROFILE_COLUMNS[8:-1]]
    + [T.StructField("total_complaints", T.IntegerType())])


@register("typed_projection", O.views(*O.REPORT_VIEWS, extra=O.PROFILE_CHAIN) + "SELECT city, area, "
          + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in P.RATE_COLUMNS)
          + ", CAST(total_accidents AS INTEGER) AS total_accidents, "
          "CAST(total_vehicles AS INTEGER) AS total_vehicles, " + ", ".join(R.PROFILE_COLUMNS[8:-1])
          + ", CAST(total_complaints AS INTEGER) AS total_complaints FROM prof")
def typed_projection(spark, d):
    return conform(profile(spark, d), PROFILE_SCHEMA)


SAMPLE_KEEP, SAMPLE_OF = 1, 10000  # one record in ten thousand


@register("sample_rows", O.views("incident", extra=[O.INC_CLEAN]) + "SELECT id, line, area, ts FROM inc WHERE "
          "CAST('0x' || substr(md5(concat_ws('|', CAST(id AS VARCHAR), CAST(line AS VARCHAR))), 1, 8) AS BIGINT) "
          f"% {SAMPLE_OF} < {SAMPLE_KEEP}")
def sample_rows_query(spark, d):
    return sample_rows(incidents(spark, d).select("id", "line", "area", "ts"), ["id", "line"], SAMPLE_KEEP, SAMPLE_OF)


# ------------------------------------------------------------------ sinks

REQUEST_REPORT_SCHEMA = T.StructType(
    [T.StructField("area", T.StringType()), T.StructField("total_complaints", T.LongType())]
    + [T.StructField(f"top_complaint_{i}", T.StringType()) for i in range(1, 4)]
    + [T.StructField(f"top_descriptor_{i}", T.StringType()) for i in range(1, 6)]
    + [T.StructField("city", T.StringType())])


@register("sink_csv_with_header", O.views("request", extra=O.REQ_CHAIN) + "SELECT * FROM req_rep")
def sink_csv_with_header(spark, d):
    path = write_csv(request_report(spark, d), fresh(spark, "requests-csv"))
    return read_quoted_csv(spark, path, REQUEST_REPORT_SCHEMA, header=True)


@register("sink_records", O.views(*O.REPORT_VIEWS, extra=O.PROFILE_CHAIN + [O.RANK_LISTS]) + O.RANK_SELECT)
def sink_records(spark, d):
    """The eight top/bottom lists with whole area records, as JSON lines."""
    prof = cut_lineage(profile(spark, d), "profile")
    lists = rank_multi_metric(prof, "area", P.RATE_COLUMNS, 10, keep=prof.columns)
    path = write_records(lists, fresh(spark, "rank-lists"), single_file=True)
    return spark.read.schema(lists.schema).json(path)


@register("sink_plain_lines", O.views("incident", extra=O.INC_CHAIN)
          + "SELECT concat_ws(',', area, CAST(total_accidents AS VARCHAR), CAST(total_vehicles AS VARCHAR), "
          "CAST(persons_injured AS VARCHAR), CAST(persons_killed AS VARCHAR), pedestrians_injured, "
          "pedestrians_killed, cyclists_injured, cyclists_killed, motorists_injured, motorists_killed, "
          + ", ".join([f"top_factor_{i}" for i in range(1, 6)] + [f"top_vehicle_{i}" for i in range(1, 6)])
          + ") AS value FROM inc_rep")
def sink_plain_lines(spark, d):
    path = write_lines(incident_report(spark, d), fresh(spark, "incident-lines"))
    return read_lines(spark, path)


FACT_COLUMNS = ["date", "time", "area", *P.MEASURES, *P.FACTOR_SLOTS, *P.VEHICLE_SLOTS]
FACT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FACT_COLUMNS])


@register("sink_facts_drop_columns", O.views("raw_incident", extra=[O.RI, O.INC_FIELDS_SQL])
          + "SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in FACT_COLUMNS) + " FROM ri_f")
def sink_facts_drop_columns(spark, d):
    facts = C.incident_fields(raw_lines(spark, d, "raw_incident"), extra={"location": 6, "unique_key": 23})
    path = write_facts(facts, fresh(spark, "incident-facts"))
    return read_quoted_csv(spark, path, FACT_SCHEMA, header=True)
