"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Written as plain SQL over the fixture views — windows with counts, CASE
ladders and GROUP BY — rather than mirroring the Spark operator code.
"""

from __future__ import annotations

from arearisk.plans import presets as P
from arearisk.plans.fixtures import FIXTURE_SQL


def views(*names: str, extra: list[str] | None = None) -> str:
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in names] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"


def sql_list(xs) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


def ts_between(c: str, rng: tuple[str, str]) -> str:
    return f"{c} BETWEEN TIMESTAMP '{rng[0]}' AND TIMESTAMP '{rng[1]}'"


def tier_sql(width: str, tiers) -> str:
    parts = " ".join(f"WHEN {width} >= {lo} THEN {shown}" for lo, shown in sorted(tiers, reverse=True))
    return f"CASE {parts} ELSE 0 END"


def share_sql(part: str, total: str) -> str:
    return f"(CASE WHEN {total} = 0 THEN 0.0 ELSE {part} / {total} * 100.0 END)"


def label_sql(name: str, n: str, total: str) -> str:
    return (f"{name} || ': ' || CAST({n} AS VARCHAR) || ': ' || "
            f"CAST(round({share_sql(n, total)}, 2) AS VARCHAR) || '%'")


def pct0_sql(part: str, total: str) -> str:
    return f"CAST({part} AS VARCHAR) || ': ' || CAST(round({share_sql(part, total)}, 0) AS VARCHAR) || '%'"


def upper_case_sql(c: str) -> str:
    return f"(upper({c}) = {c} AND lower({c}) <> {c})"


VEH = [f"veh_{i}" for i in range(1, 6)]
FAC = [f"fac_{i}" for i in range(1, 6)]
MEAS = P.MEASURES

# ----------------------------------------------------------- CTE fragments

INC_KEPT = "area IS NOT NULL AND area <> ''"
REQ_KEPT = ("area IS NOT NULL AND area <> '' AND city IS NOT NULL AND city <> '' "
            "AND contains(kind, 'Street') AND NOT contains(kind, 'Noise')")
# whole tables for the operators, the report's period for the composed reports
INC_CLEAN = f"inc AS (SELECT * FROM incident WHERE {INC_KEPT})"
REQ_CLEAN = f"req AS (SELECT * FROM request WHERE {REQ_KEPT})"
INC_PERIOD = f"inc AS (SELECT * FROM incident WHERE {ts_between('ts', P.TEST_INCIDENT_RANGE)} AND {INC_KEPT})"
REQ_PERIOD = f"req AS (SELECT * FROM request WHERE {ts_between('ts', P.TEST_REQUEST_RANGE)} AND {REQ_KEPT})"

NONEMPTY_VEH = " + ".join(f"(CASE WHEN {v} IS NOT NULL AND {v} <> '' THEN 1 ELSE 0 END)" for v in VEH)

INC_TOTALS = ("inc_tot AS (SELECT area, count(*) AS total_accidents, "
              f"CAST(sum({NONEMPTY_VEH}) AS BIGINT) AS total_vehicles, "
              + ", ".join(f"CAST(sum({m}) AS BIGINT) AS total_{m}" for m in MEAS)
              + " FROM inc GROUP BY area)")

INC_COUNTS = (
    "inc_cnt AS (SELECT area, category, count(*) AS n FROM "
    f"(SELECT area, unnest([{', '.join(FAC + VEH)}]) AS category FROM inc) s "
    f"WHERE category IS NOT NULL AND category <> '' AND category NOT IN ({sql_list(P.IGNORE_CATEGORIES)}) "
    "GROUP BY area, category)")

INC_RANKED = (
    "inc_rank AS (SELECT area, dim, category, n, "
    "row_number() OVER (PARTITION BY area, dim ORDER BY n DESC, category ASC) AS rk, "
    "count(*) OVER (PARTITION BY area, dim) AS width FROM "
    f"(SELECT area, CASE WHEN {upper_case_sql('category')} THEN 'vehicle' ELSE 'factor' END AS dim, "
    "category, n FROM inc_cnt) r)")


def _top_cols(dim: str, prefix: str, k: int, total: str, tiers) -> list[str]:
    return [f"coalesce(max(CASE WHEN r.dim = '{dim}' AND r.rk = {i} AND r.rk <= {tier_sql('r.width', tiers)} "
            f"THEN {label_sql('r.category', 'r.n', total)} END), '') AS {prefix}{i}" for i in range(1, k + 1)]


INC_REPORT = (
    "inc_rep AS (SELECT t.area, t.total_accidents, t.total_vehicles, "
    "t.total_per_i AS persons_injured, t.total_per_k AS persons_killed, "
    f"{pct0_sql('t.total_ped_i', 't.total_per_i')} AS pedestrians_injured, "
    f"{pct0_sql('t.total_ped_k', 't.total_per_k')} AS pedestrians_killed, "
    f"{pct0_sql('t.total_cyc_i', 't.total_per_i')} AS cyclists_injured, "
    f"{pct0_sql('t.total_cyc_k', 't.total_per_k')} AS cyclists_killed, "
    f"{pct0_sql('t.total_mot_i', 't.total_per_i')} AS motorists_injured, "
    f"{pct0_sql('t.total_mot_k', 't.total_per_k')} AS motorists_killed, "
    + ", ".join(_top_cols("factor", "top_factor_", 5, "t.total_vehicles", P.TIERS_FIVE)
                + _top_cols("vehicle", "top_vehicle_", 5, "t.total_vehicles", P.TIERS_FIVE))
    + " FROM inc_tot t LEFT JOIN inc_rank r ON t.area = r.area "
    "GROUP BY t.area, t.total_accidents, t.total_vehicles, t.total_per_i, t.total_per_k, "
    "t.total_ped_i, t.total_ped_k, t.total_cyc_i, t.total_cyc_k, t.total_mot_i, t.total_mot_k)")

INC_CHAIN = [INC_PERIOD, INC_TOTALS, INC_COUNTS, INC_RANKED, INC_REPORT]

REQ_COUNTS = (
    "req_cnt AS (SELECT area, dim, category, count(*) AS n FROM ("
    "SELECT area, 'complaint' AS dim, upper(kind) AS category FROM req "
    "UNION ALL SELECT area, 'descriptor', coalesce(descriptor, '') FROM req "
    "UNION ALL SELECT area, 'city', city FROM req) u "
    "WHERE dim = 'descriptor' OR (category IS NOT NULL AND category <> '') GROUP BY area, dim, category)")
REQ_RANKED = (
    "req_rank AS (SELECT *, row_number() OVER (PARTITION BY area, dim ORDER BY n DESC, category ASC) AS rk, "
    "count(*) OVER (PARTITION BY area, dim) AS width FROM req_cnt)")
REQ_REPORT = (
    "req_rep AS (SELECT t.area, t.total_complaints, "
    + ", ".join(_top_cols("complaint", "top_complaint_", 3, "t.total_complaints", P.TIERS_THREE)
                + _top_cols("descriptor", "top_descriptor_", 5, "t.total_complaints", P.TIERS_FIVE))
    + ", coalesce(max(CASE WHEN r.dim = 'city' AND r.rk = 1 THEN r.category END), '') AS city "
    "FROM (SELECT area, count(*) AS total_complaints FROM req GROUP BY area) t "
    "LEFT JOIN req_rank r ON t.area = r.area GROUP BY t.area, t.total_complaints)")
REQ_CHAIN = [REQ_PERIOD, REQ_COUNTS, REQ_RANKED, REQ_REPORT]

MULTI_KEYS = (
    "SELECT CASE WHEN n = 1 THEN part ELSE trim(part) END AS area, vehicles // n AS vehicles, samples // n AS samples FROM ("
    "SELECT unnest(parts) AS part, len(parts) AS n, vehicles, samples FROM (SELECT vehicles, samples, "
    "CASE WHEN contains(area_expr, ';') THEN string_split(area_expr, ';') WHEN contains(area_expr, ':') THEN string_split(area_expr, ':') "
    "ELSE [area_expr] END AS parts FROM volume WHERE {where}) p) u")
VOL_ROWS = "vol_rows AS (" + MULTI_KEYS.format(where="NOT contains(area_expr, 'NY')") + ")"
VOL_REPORT = (
    "vol_rep AS (SELECT area, CASE WHEN sum(samples) = 0 THEN NULL "
    f"ELSE CAST(sum(vehicles) // sum(samples) * {P.DAYS_IN_PERIOD} AS BIGINT) END AS volume "
    "FROM vol_rows GROUP BY area)")
VOL_CHAIN = [VOL_ROWS, VOL_REPORT]


def rate_sql(a: str, b: str, scale: str = " * 1000") -> str:
    return f"CASE WHEN {b} = 0 THEN NULL ELSE round({a} / {b}{scale}, 2) END"


PROFILE = (
    "prof AS (SELECT q.city, v.area, "
    f"{rate_sql('i.total_accidents', 'v.volume')} AS accidents_per_1000_vehicles, "
    f"{rate_sql('i.persons_injured', 'i.total_accidents')} AS injuries_per_1000_accidents, "
    f"{rate_sql('i.persons_killed', 'i.total_accidents')} AS deaths_per_1000_accidents, "
    f"{rate_sql('i.total_vehicles', 'i.total_accidents', '')} AS vehicles_per_accident, "
    "i.total_accidents, i.total_vehicles, "
    + ", ".join([f"i.top_factor_{k}" for k in range(1, 6)] + [f"i.top_vehicle_{k}" for k in range(1, 6)]
                + [f"q.top_complaint_{k}" for k in range(1, 4)] + [f"q.top_descriptor_{k}" for k in range(1, 6)])
    + ", q.total_complaints FROM vol_rep v JOIN inc_rep i ON v.area = i.area JOIN req_rep q ON v.area = q.area)")

PROFILE_CHAIN = INC_CHAIN + REQ_CHAIN + VOL_CHAIN + [PROFILE]

A, I, D, V = P.RATE_COLUMNS
BOUNDS = (
    "bnd AS (SELECT *, "
    + ", ".join(f"round({c}_mean + {c}_sd, 4) AS {c}_upper, round({c}_mean - {c}_sd, 4) AS {c}_lower"
                for c in (A, I, D))
    + " FROM (SELECT "
    + ", ".join(f"round(avg({c}), 4) AS {c}_mean, round(stddev_samp({c}), 4) AS {c}_sd" for c in (A, I, D))
    + " FROM prof) m)")

CLASS_SQL = (
    f"CASE WHEN p.{A} IS NULL OR p.{I} IS NULL OR p.{D} IS NULL THEN NULL "
    f"WHEN p.{A} > b.{A}_upper THEN (CASE WHEN p.{I} < b.{I}_lower AND p.{D} < b.{D}_lower THEN 'Ok' ELSE 'Hazardous' END) "
    f"WHEN p.{A} < b.{A}_lower THEN (CASE WHEN p.{I} > b.{I}_upper AND p.{D} > b.{D}_upper THEN 'Ok' ELSE 'Safe' END) "
    f"WHEN p.{I} > b.{I}_upper AND p.{D} > b.{D}_upper THEN 'Hazardous' "
    f"WHEN p.{I} < b.{I}_lower AND p.{D} < b.{D}_lower THEN 'Safe' ELSE 'Ok' END")

RISK = ("risk AS (SELECT p.city, p.area, " + CLASS_SQL + " AS safety_class, "
        + ", ".join(f"p.{c}" for c in [A, I, D, V, "total_accidents", "total_vehicles"]
                    + [f"top_factor_{k}" for k in range(1, 6)] + [f"top_vehicle_{k}" for k in range(1, 6)]
                    + [f"top_complaint_{k}" for k in range(1, 4)] + [f"top_descriptor_{k}" for k in range(1, 6)]
                    + ["total_complaints"])
        + " FROM prof p CROSS JOIN bnd b)")

RISK_CHAIN = PROFILE_CHAIN + [BOUNDS, RISK]
REPORT_VIEWS = ("incident", "request", "volume")


# ------------------------------------------------------- raw line fixtures

RI = "ri AS (SELECT value, string_split(value, ',') AS f, len(string_split(value, ',')) AS nf FROM raw_incident)"
RR = "rr AS (SELECT value, string_split(value, ',') AS f, len(string_split(value, ',')) AS nf FROM raw_request)"


def inc_field(idx: int) -> str:
    """Collision field ``idx`` (0-based) with the 30-field shift, on ``ri``."""
    if idx < P.INCIDENT_SHIFT_FROM:
        return f"f[{idx + 1}]"
    return f"f[{idx + 1} + nf - {P.INCIDENT_BASE_ARITY}]"


INCIDENT_SPEC = {**P.INCIDENT_FIELDS, **P.INCIDENT_INT_FIELDS, **P.INCIDENT_FACTOR_FIELDS,
                 **P.INCIDENT_VEHICLE_FIELDS}
INC_FIELDS_SQL = ("ri_f AS (SELECT " + ", ".join(f"{inc_field(i)} AS {n}" for n, i in INCIDENT_SPEC.items())
                  + " FROM ri WHERE nf IN (29, 30))")

INT_RE = r"'\s*[+-]?[0-9]+\s*'"


def is_int_sql(x: str) -> str:
    return f"coalesce(regexp_full_match({x}, {INT_RE}), false)"


def lenient_sql(x: str) -> str:
    return f"CASE WHEN {is_int_sql(x)} THEN coalesce(TRY_CAST(trim({x}) AS BIGINT), 0) ELSE 0 END"


def ordinal_sql(x: str) -> str:
    w = "w"
    suffix = (f"CASE WHEN length({w}) >= 2 AND TRY_CAST(right({w}, 2) AS INTEGER) BETWEEN 11 AND 19 THEN 'th' "
              f"WHEN right({w}, 1) = '1' THEN 'st' WHEN right({w}, 1) = '2' THEN 'nd' "
              f"WHEN right({w}, 1) = '3' THEN 'rd' ELSE 'th' END")
    body = (f"trim(array_to_string(list_transform(string_split(trim({x}), ' '), lambda {w}: "
            f"CASE WHEN regexp_full_match({w}, '[0-9]+') THEN {w} || {suffix} ELSE {w} END), ' '))")
    return f"CASE WHEN trim({x}) = 'AVE OF THE AMER' THEN 'AVE OF THE AMERICAS' ELSE {body} END"


RR_REALIGN = (
    "rr_a AS (SELECT f[1] AS event_id, f[6] AS kind, f[2] AS created, "
    f"CASE WHEN {is_int_sql('f[9]')} THEN CAST(TRY_CAST(trim(f[9]) AS BIGINT) AS VARCHAR) WHEN f[9] = '' THEN NULL "
    "WHEN contains(f[6], 'Street Sign') THEN f[11] ELSE f[10] END AS area, "
    f"CASE WHEN {is_int_sql('f[9]')} THEN f[7] WHEN f[9] = '' THEN NULL "
    "WHEN contains(f[6], 'Street Sign') THEN concat_ws(' ', f[7], f[8], f[9]) ELSE concat_ws(' ', f[7], f[8]) END AS descriptor, "
    f"CASE WHEN {is_int_sql('f[9]')} THEN f[17] WHEN f[9] = '' THEN NULL "
    "WHEN contains(f[6], 'Street Sign') THEN f[19] ELSE f[18] END AS city FROM rr)")

STREET_NAMED = ("st_n AS (SELECT segment, " + ordinal_sql("roadway") + " AS road, " + ordinal_sql("from_name")
                + " AS start, " + ordinal_sql("to_name") + " AS \"end\", vehicles, samples FROM street)")
LOOKUP_ONE = "lk AS (SELECT trim(name) AS name, min(trim(postcode)) AS postcode FROM lookup WHERE trim(coalesce(postcode, '')) <> '' GROUP BY 1)"
RESOLVED = ("res AS (SELECT s.segment, s.vehicles, s.samples, a.postcode AS road_zip, b.postcode AS start_zip, "
            "c.postcode AS end_zip FROM st_n s JOIN lk a ON s.road = a.name JOIN lk b ON s.start = b.name "
            "JOIN lk c ON s.\"end\" = c.name)")


def _apportion_branch(cond: str, zip_: str, share: str) -> str:
    v = {"all": "vehicles", "third": "vehicles // 3", "two": "(vehicles // 3) * 2"}[share]
    s = {"all": "samples", "third": "samples // 3", "two": "(samples // 3) * 2"}[share]
    return f"SELECT segment, {zip_} AS area, {v} AS vehicles, {s} AS samples FROM res WHERE {cond}"


APPORTIONED = "app AS (" + " UNION ALL ".join([
    # from and to differ
    _apportion_branch("start_zip <> end_zip AND road_zip = start_zip", "start_zip", "two"),
    _apportion_branch("start_zip <> end_zip AND road_zip = start_zip", "end_zip", "third"),
    _apportion_branch("start_zip <> end_zip AND road_zip <> start_zip AND road_zip = end_zip", "start_zip", "third"),
    _apportion_branch("start_zip <> end_zip AND road_zip <> start_zip AND road_zip = end_zip", "end_zip", "two"),
    _apportion_branch("start_zip <> end_zip AND road_zip <> start_zip AND road_zip <> end_zip", "start_zip", "third"),
    _apportion_branch("start_zip <> end_zip AND road_zip <> start_zip AND road_zip <> end_zip", "end_zip", "third"),
    _apportion_branch("start_zip <> end_zip AND road_zip <> start_zip AND road_zip <> end_zip", "road_zip", "third"),
    # from and to agree
    _apportion_branch("start_zip = end_zip AND road_zip = start_zip", "road_zip", "all"),
    _apportion_branch("start_zip = end_zip AND road_zip <> start_zip", "start_zip", "two"),
    _apportion_branch("start_zip = end_zip AND road_zip <> start_zip", "road_zip", "third"),
]) + ")"
SEGMENT_CHAIN = [STREET_NAMED, LOOKUP_ONE, RESOLVED, APPORTIONED]

RANK_LISTS = "lists AS (" + " UNION ALL ".join(
    f"SELECT '{d}_{m}' AS list, CAST(row_number() OVER (ORDER BY {m} {o} NULLS LAST, area ASC) AS INTEGER) AS rank, "
    f"CAST({m} AS DOUBLE) AS value, prof.* FROM prof"
    for m in P.RATE_COLUMNS for d, o in (("top", "DESC"), ("bottom", "ASC"))) + ")"
RANK_SELECT = "SELECT * FROM lists WHERE rank <= 10"

# ------------------------------------------------- the reports from raw lines

INC_FROM_LINES = ("inc AS (SELECT * FROM (SELECT area, try_strptime(date || ' ' || time, '%m/%d/%Y %H:%M') AS ts, "
                  + ", ".join(f"CAST(trim({m}) AS INTEGER) AS {m}" for m in MEAS) + ", " + ", ".join(FAC + VEH)
                  + f" FROM ri_f) r WHERE {ts_between('ts', P.TEST_INCIDENT_RANGE)} AND {INC_KEPT})")
INC_LINE_CHAIN = [RI, INC_FIELDS_SQL, INC_FROM_LINES, INC_TOTALS, INC_COUNTS, INC_RANKED, INC_REPORT]
REQ_FROM_LINES = ("req AS (SELECT * FROM (SELECT area, try_strptime(created, '%m/%d/%Y %I:%M:%S %p') AS ts, kind, descriptor, city FROM rr_a) r "
                  f"WHERE {ts_between('ts', P.TEST_REQUEST_RANGE)} AND {REQ_KEPT})")
REQ_LINE_CHAIN = [RR, RR_REALIGN, REQ_FROM_LINES, REQ_COUNTS, REQ_RANKED, REQ_REPORT]
SEG_LINES = ("sl AS (SELECT CAST(f[1] AS BIGINT) AS line, trim(f[2]) AS segment, trim(f[3]) AS roadway, trim(f[4]) AS from_name, "
             "trim(f[5]) AS to_name, " + " + ".join(lenient_sql(f"f[{i + 1}]") for i in P.SEGMENT_HOUR_FIELDS)
             + " AS vehicles FROM (SELECT string_split(value, ',') AS f FROM raw_segment) r)")
SEG_FIRST = ("seg AS (SELECT segment, arg_min(roadway, line) AS roadway, arg_min(from_name, line) AS from_name, "
             "arg_min(to_name, line) AS to_name, CAST(sum(vehicles) AS BIGINT) AS vehicles, count(*) AS samples FROM sl GROUP BY segment)")
