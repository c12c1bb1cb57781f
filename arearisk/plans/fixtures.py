"""Fixture views: the reference's input shapes over the driver's test tables.

The SQL text is shared by the Spark queries and the DuckDB oracle, so both
engines read exactly the same derived input (see FIXTURES.md).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from arearisk.sources.tables import TABLES, load_table

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["incident"] = """
SELECT CAST(l_suppkey AS STRING) AS area, l_shipdate AS ts, l_orderkey AS id, l_linenumber AS line,
  l_linenumber % 2 + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END + CAST(l_quantity AS INT) % 3 AS per_i,
  CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END + CASE WHEN l_quantity = 49 THEN 1 ELSE 0 END AS per_k,
  l_linenumber % 2 AS ped_i, CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END AS ped_k,
  CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END AS cyc_i, 0 AS cyc_k,
  CAST(l_quantity AS INT) % 3 AS mot_i, CASE WHEN l_quantity = 49 THEN 1 ELSE 0 END AS mot_k,
  p_name AS fac_1, CASE WHEN l_returnflag = 'R' THEN 'Unspecified' ELSE '' END AS fac_2,
  CASE WHEN l_returnflag = 'A' THEN 'Glare' ELSE '' END AS fac_3, '' AS fac_4, '' AS fac_5,
  p_type AS veh_1, CASE WHEN l_linestatus = 'O' THEN upper(p_brand) ELSE '' END AS veh_2,
  CASE WHEN l_linenumber = 7 THEN 'UNKNOWN' ELSE '' END AS veh_3, '' AS veh_4, '' AS veh_5
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

FIXTURE_SQL["request"] = """
SELECT CAST(user_id AS STRING) AS area, ts,
  CASE event_type WHEN 'click' THEN 'Street Condition' WHEN 'view' THEN 'Street Light Condition'
    WHEN 'signup' THEN 'Street Sign - Missing' WHEN 'error' THEN 'Noise - Street/Sidewalk' ELSE 'Water System' END AS kind,
  CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('Item ', CAST(event_id % 7 AS STRING)) END AS descriptor, n_name AS city
FROM events JOIN nation ON n_nationkey = (user_id + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) % 25
"""

FIXTURE_SQL["volume"] = """
SELECT CASE WHEN s_suppkey % 9 = 1 THEN concat(CAST(s_suppkey AS STRING), ';', CAST(s_suppkey + 1 AS STRING))
    WHEN s_suppkey % 9 = 2 THEN concat(CAST(s_suppkey AS STRING), ': ', CAST(s_suppkey + 1 AS STRING))
    WHEN s_suppkey % 13 = 0 THEN concat('NY ', CAST(s_suppkey AS STRING))
    ELSE CAST(s_suppkey AS STRING) END AS area_expr,
  CAST(floor(abs(s_acctbal)) AS BIGINT) + 1000 AS vehicles, CAST(2 + s_suppkey % 11 AS BIGINT) AS samples
FROM supplier
"""

FIXTURE_SQL["hourly"] = """
SELECT user_id AS segment, CAST(ts AS DATE) AS day, hour(ts) AS h, count(*) AS n
FROM events GROUP BY user_id, CAST(ts AS DATE), hour(ts)
"""

FIXTURE_SQL["street"] = """
SELECT s_suppkey AS segment,
  concat('WEST ', CAST(s_suppkey AS STRING), ' ST') AS roadway,
  CASE WHEN s_suppkey % 10 = 0 THEN 'AVE OF THE AMER' ELSE concat(CAST(s_suppkey % 13 + 1 AS STRING), ' AVE') END AS from_name,
  concat(CAST(s_suppkey % 7 + 108 AS STRING), ' ST') AS to_name,
  CAST(floor(abs(s_acctbal)) AS BIGINT) AS vehicles, CAST(1 + s_suppkey % 8 AS BIGINT) AS samples
FROM supplier
"""

FIXTURE_SQL["lookup"] = """
SELECT concat(kind, CAST(n AS STRING), CASE WHEN n % 100 BETWEEN 11 AND 19 THEN 'th' WHEN n % 10 = 1 THEN 'st'
    WHEN n % 10 = 2 THEN 'nd' WHEN n % 10 = 3 THEN 'rd' ELSE 'th' END, tail) AS name,
  CASE WHEN kind <> '' AND n % 11 = 5 THEN NULL WHEN kind <> '' AND n % 11 = 6 THEN '  ' WHEN n % 4 = 1 THEN concat(' ', CAST(10000 + n % 3 AS STRING))
    ELSE CAST(10000 + n % 3 AS STRING) END AS postcode
FROM (SELECT p_partkey AS n, CASE WHEN p_partkey % 7 = 3 THEN 'W ' ELSE 'WEST ' END AS kind, ' ST' AS tail FROM part
  UNION ALL SELECT p_partkey AS n, '' AS kind, CASE WHEN p_partkey % 7 = 2 THEN ' STREET' ELSE ' ST' END AS tail FROM part
  UNION ALL SELECT p_partkey AS n, '' AS kind, CASE WHEN p_partkey % 13 = 0 THEN ' AVENUE' ELSE ' AVE' END AS tail FROM part) x
UNION ALL SELECT 'AVE OF THE AMERICAS' AS name, '10001' AS postcode
"""

FIXTURE_SQL["raw_incident"] = """
SELECT concat_ws(',',
  concat(CAST(month(l_shipdate) AS STRING), '/', CAST(day(l_shipdate) AS STRING), '/', CAST(year(l_shipdate) AS STRING)),
  concat(CAST(l_linenumber AS STRING), ':05'), 'B',
  CASE WHEN l_orderkey % 17 = 0 THEN '' ELSE CAST(l_suppkey AS STRING) END,
  '40.7', '-73.9', CASE WHEN l_orderkey % 2 = 0 THEN '"(40.7, -73.9)"' ELSE '' END, 'A', 'B', 'C',
  CAST(l_linenumber % 2 AS STRING), '0', CAST(l_linenumber % 2 AS STRING), '0', '0', '0', '0', '0',
  'Glare', '', '', '', '', CAST(l_orderkey AS STRING), l_returnflag, l_linestatus, '', '',
  CASE WHEN l_orderkey % 38 = 19 THEN NULL ELSE '' END) AS value
FROM lineitem
"""

# The same lines with counts that are no integers (empty, words, decimals, too large; blanks around one are fine) and
# dates that are none.
FIXTURE_SQL["raw_incident_mixed"] = FIXTURE_SQL["raw_incident"].replace(
    "CAST(l_linenumber % 2 AS STRING), '0', CAST", """CASE l_orderkey % 31 WHEN 3 THEN 'x' WHEN 5 THEN '' WHEN 7 THEN ' 2 ' WHEN 9 THEN '1.0'
    WHEN 11 THEN '99999999999' ELSE CAST(l_linenumber % 2 AS STRING) END, CASE WHEN l_orderkey % 62 = 3 THEN '-' ELSE '0' END, CAST""", 1).replace(
    "  concat(CAST(month(l_shipdate) AS STRING),", "  CASE WHEN l_orderkey % 41 = 6 THEN 'n/a' ELSE concat(CAST(month(l_shipdate) AS STRING),", 1).replace(
    "CAST(year(l_shipdate) AS STRING)),", "CAST(year(l_shipdate) AS STRING)) END,", 1)

# Volume rows as CSV lines, some with a word, nothing or a decimal for a count, too few or too many fields.
FIXTURE_SQL["raw_volume"] = """
SELECT CASE s_suppkey % 17 WHEN 4 THEN concat(area, ',x,3') WHEN 6 THEN concat(area, ',', vehicles) WHEN 8 THEN concat(area, ',', vehicles, ',3,4')
    WHEN 10 THEN concat(area, ',,3') WHEN 12 THEN concat(area, ',', vehicles, ',2.5') WHEN 14 THEN concat('"', area, ', north",', vehicles, ',2')
    ELSE concat(area, ',', vehicles, ', ', CAST(2 + s_suppkey % 11 AS STRING)) END AS value
FROM (SELECT s_suppkey, CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) + 1000 AS STRING) AS vehicles,
  CASE WHEN s_suppkey % 9 = 1 THEN concat(CAST(s_suppkey AS STRING), ';', CAST(s_suppkey + 1 AS STRING)) ELSE CAST(s_suppkey AS STRING) END AS area
  FROM supplier) x
"""

FIXTURE_SQL["raw_request"] = """
SELECT concat_ws(',', CAST(event_id AS STRING),
  CASE WHEN event_id % 23 = 0 THEN 'n/a' ELSE concat(lpad(CAST(month(ts) AS STRING), 2, '0'), '/', lpad(CAST(day(ts) AS STRING), 2, '0'), '/',
    CAST(year(ts) AS STRING), ' ', lpad(CAST(CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END AS STRING), 2, '0'), ':',
    lpad(CAST(minute(ts) AS STRING), 2, '0'), ':00 ', CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END) END,
  '', 'DOT', 'Dept',
  CASE WHEN event_type = 'signup' THEN 'Street Sign - Missing' WHEN event_type = 'error' THEN 'Noise - Street' ELSE 'Street Condition' END,
  CASE WHEN event_type = 'signup' THEN 'No Parking, Standing, Stopping' WHEN event_type = 'view' THEN 'Rough, Pitted' WHEN event_id % 13 = 4 THEN '' ELSE 'Pothole' END,
  'Street', CASE WHEN event_id % 29 = 0 THEN '' ELSE lpad(CAST(user_id AS STRING), 5, '0') END,
  'addr', 'street', 'c1', 'c2', 'i1', 'i2', 'type', concat('CITY ', CAST(user_id % 5 AS STRING)), 'lm', 'fac') AS value
FROM events
"""

# Hourly segment counts as lines: id, segment, three names, two unused fields, 24 hours; an hour without traffic is
# empty or no number, and the names of a segment's later lines differ from its first.
FIXTURE_SQL["raw_segment"] = """
SELECT concat_ws(',', CAST(line AS STRING), CAST(segment AS STRING),
  concat(CASE WHEN line % 5 = 2 THEN ' EAST ' ELSE ' WEST ' END, CAST(segment AS STRING), ' ST'),
  CASE WHEN segment % 10 = 0 THEN 'AVE OF THE AMER' ELSE concat(CAST(segment % 13 + 1 AS STRING), ' AVE') END,
  concat(CAST(segment % 7 + 108 AS STRING), ' ST '), 'NB', CAST(day AS STRING),
  HOURS) AS value
FROM (SELECT min(event_id) AS line, user_id AS segment, CAST(ts AS DATE) AS day, COUNTS FROM events GROUP BY user_id, CAST(ts AS DATE)) x
""".replace("HOURS", ", ".join(f"CASE WHEN c{i} = 0 THEN {chr(39)*2 if i % 2 else chr(39) + 'n/a' + chr(39)} ELSE CAST(c{i} AS STRING) END" for i in range(24))
            ).replace("COUNTS", ", ".join(f"sum(CASE WHEN hour(ts) = {i} THEN 1 ELSE 0 END) AS c{i}" for i in range(24)))


def tables_of(name: str) -> list[str]:
    """Driver tables a fixture view reads."""
    sql = FIXTURE_SQL[name]
    return [t for t in TABLES if re.search(rf"\b(FROM|JOIN)\s+{t}\b", sql)]


def fixture(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The fixture view ``name`` over the tables in ``data_dir``.

    The tables are passed to ``spark.sql`` as DataFrame parameters, so the
    session's catalog is left untouched."""
    tables = tables_of(name)
    sql = FIXTURE_SQL[name]
    for t in tables:
        sql = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(sql, **{t: load_table(spark, data_dir, t) for t in tables})


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named fixture views (for oracle SQL)."""
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in names) + "\n"
