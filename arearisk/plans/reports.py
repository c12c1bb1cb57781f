"""Report compositions (the reference's whole job, as lazy DataFrame plans).

Scale notes
-----------
* Each sub-report reads its source once: a record is exploded into one
  "totals" row plus one row per category slot, and a single
  ``groupBy(area, dim, category)`` with a map-side partial aggregate
  produces totals, category counts (and the city vote) together. Only this
  one shuffle moves data proportional to the input; everything after it
  works on per-area rows.
* Categories are ranked per (area, dim) by a ``row_number`` limit that Spark
  applies partially before the window's shuffle, so at most k rows per
  (area, dim) leave each task even for a hot area with many categories; the
  per-area fold that follows moves only those rows.
* The three summaries are per-area and small; AQE broadcasts them in the
  join when their measured size allows and sort-merges otherwise.
* The joined per-area profile is cut into the shared folder for classification
  and rankings, which read it more than once; the bounds are a one-row scalar
  subquery over the cut. Nothing is kept in the session's cache, so a report
  always shows the tables as they are when it is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arearisk.functions.expr import (
    case_class_upper, count_nonempty, label_count_pct0_sql, label_name_count_pct_sql, nonempty,
    ordinal_street_name, rate_per_1000, ratio_rounded, upper_label,
)
from arearisk.operators.aggregate import extrapolate_volume
from arearisk.operators.classify import classify_three_level
from arearisk.operators.clean import filter_date_range, filter_nonempty, reject_malformed_key, text_filter
from arearisk.operators.joins import join_three_way, resolve_names
from arearisk.operators.keys import apportion_by_agreement, explode_multi_key
from arearisk.operators.topk import tier_width
from arearisk.plans import presets as P
from arearisk.session import cut_lineage

TOTALS = "__totals__"
KEY = "area"


# ------------------------------------------------------------ shared pieces

def profile_by_key(df: DataFrame, key: str, sums: dict[str, object],
                   slots: list[tuple[object, object]], labels: tuple[str, ...] = ()) -> DataFrame:
    """One-pass per-key profile ``(key, dim, category, n, sums...)``.

    For each input row: one ``dim = '__totals__'`` row carrying the measures
    in ``sums`` (name -> column), and one row per ``(dim, category)`` pair of
    ``slots``; empty or NULL categories are dropped, except in the dims of
    ``labels``, where an empty value is a category too. ``n`` counts rows. The
    aggregate runs partial before its shuffle, so the exploded rows collapse
    inside each map task.
    """
    def c_(x):
        return F.col(x) if isinstance(x, str) else x

    def d_(x):
        return F.lit(x) if isinstance(x, str) else x

    nulls = [F.lit(None).cast("bigint").alias(s) for s in sums]
    structs = [F.struct(F.lit(TOTALS).alias("dim"), F.lit("").alias("category"),
                        *[c_(c).cast("bigint").alias(s) for s, c in sums.items()])]
    structs += [F.struct(d_(d).alias("dim"), F.coalesce(c_(c).cast("string"), F.lit("")).alias("category"), *nulls)
                for d, c in slots]
    long = df.select(key, F.explode(F.array(*structs)).alias("_p")).select(key, "_p.*")
    long = long.filter(F.col("dim").isin(TOTALS, *labels) | nonempty("category"))
    return long.groupBy(key, "dim", "category").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(s).cast("bigint").alias(s) for s in sums])


def summarize_profile(prof: DataFrame, key: str, totals: dict[str, str],
                      dims: dict[str, tuple[str, int, list]]) -> DataFrame:
    """One row per key from a ``profile_by_key`` frame: the totals row's
    values (``out name -> profile column``), and per dim the top entries
    ``<prefix><i>`` as ``struct(name, n)`` — NULL beyond the dim's tier width —
    plus ``<prefix>width``, the number of categories capped at the rank limit.

    ``dims``: dim -> (column prefix, k, tiers). The tier rule only compares
    the width with thresholds no larger than the rank limit, so the capped
    width (rows that survive ``rank <= limit``) decides it exactly. The window
    is therefore a pure ``row_number`` limit, which Spark runs partially
    before its shuffle: each task forwards at most ``limit`` rows per
    (key, dim), however many distinct categories a hot key has.
    """
    limit = max(max(k, max(lo for lo, _ in tiers)) for _, k, tiers in dims.values())
    w = Window.partitionBy(key, "dim").orderBy(F.col("n").desc(), F.col("category").asc())
    # the totals row is alone in its (key, dim) window, so it always ranks 1
    ranked = prof.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
    is_tot = F.col("dim") == TOTALS
    entry = F.struct(F.col("category").alias("name"), F.col("n").alias("n"))
    one = ranked.groupBy(key).agg(
        *[F.max(F.when(is_tot, F.col(c))).alias(o) for o, c in totals.items()],
        *[F.count_if(F.col("dim") == d).alias(f"{p}width") for d, (p, _, _) in dims.items()],
        *[F.max(F.when((F.col("dim") == d) & (F.col("rank") == i), entry)).alias(f"{p}{i}")
          for d, (p, k, _) in dims.items() for i in range(1, k + 1)])
    shown = {p: tier_width(F.col(f"{p}width"), tiers) for p, _, tiers in dims.values()}
    return one.select(key, *totals, *[f"{p}width" for p, _, _ in dims.values()], *[
        F.when(F.lit(i) <= shown[p], F.col(f"{p}{i}")).alias(f"{p}{i}")
        for p, k, _ in dims.values() for i in range(1, k + 1)])


def entry_label(c: str, total: str) -> F.Column:
    """"NAME: n: pct%" for a ranked struct column, '' when absent."""
    return F.expr(f"coalesce({label_name_count_pct_sql(c + '.name', c + '.n', total)}, '')")


# -------------------------------------------------------------- incidents

def clean_incidents(inc: DataFrame, lo: str | None = None, hi: str | None = None, key: str = KEY) -> DataFrame:
    """Date range (skipped when ``lo`` is None) and non-empty key."""
    dated = inc if lo is None else filter_date_range(inc, "ts", lo, hi)
    return filter_nonempty(dated, key)


def incidents_by_area(inc: DataFrame, key: str = KEY, ignore=None, tiers=None) -> DataFrame:
    """21-column collision summary per area.

    Category counts pool factor and vehicle slots by name and are routed by
    case: upper-case names are vehicle types, others factors; listed names
    (totals, catch-alls) never rank. Both shares divide by total vehicles.
    """
    ignore = P.IGNORE_CATEGORIES if ignore is None else ignore
    tiers = P.TIERS_FIVE if tiers is None else tiers
    sums = {m: m for m in P.MEASURES}
    sums["vehicles"] = count_nonempty(P.VEHICLE_SLOTS)
    prof = profile_by_key(inc, key, sums, [("slot", c) for c in P.FACTOR_SLOTS + P.VEHICLE_SLOTS])
    # Routing depends on the name only, so it runs on the aggregated
    # (area, name) rows rather than on every slot of every record.
    slot = F.col("dim") == "slot"
    prof = (prof.filter(~slot | ~F.col("category").isin(*ignore))
            .withColumn("dim", F.when(~slot, F.col("dim"))
                        .when(case_class_upper("category"), F.lit("vehicle")).otherwise(F.lit("factor"))))
    totals = {"total_accidents": "n", "total_vehicles": "vehicles", **{"total_" + m: m for m in P.MEASURES}}
    j = summarize_profile(prof, key, totals, {"factor": ("f", 5, tiers), "vehicle": ("v", 5, tiers)})

    def pct0(part: str, whole: str):
        return F.expr(label_count_pct0_sql(part, whole))

    return j.select(
        key, "total_accidents", "total_vehicles",
        F.col("total_per_i").alias("persons_injured"), F.col("total_per_k").alias("persons_killed"),
        pct0("total_ped_i", "total_per_i").alias("pedestrians_injured"),
        pct0("total_ped_k", "total_per_k").alias("pedestrians_killed"),
        pct0("total_cyc_i", "total_per_i").alias("cyclists_injured"),
        pct0("total_cyc_k", "total_per_k").alias("cyclists_killed"),
        pct0("total_mot_i", "total_per_i").alias("motorists_injured"),
        pct0("total_mot_k", "total_per_k").alias("motorists_killed"),
        *[entry_label(f"f{i}", "total_vehicles").alias(f"top_factor_{i}") for i in range(1, 6)],
        *[entry_label(f"v{i}", "total_vehicles").alias(f"top_vehicle_{i}") for i in range(1, 6)])


# --------------------------------------------------------------- requests

def clean_requests(req: DataFrame, lo: str | None = None, hi: str | None = None, key: str = KEY) -> DataFrame:
    """Date range (skipped when ``lo`` is None), non-empty key and city, street-but-not-noise complaint types."""
    r = filter_nonempty(req if lo is None else filter_date_range(req, "ts", lo, hi), key, "city")
    return r.filter(text_filter("kind", P.REQUEST_INCLUDE, P.REQUEST_EXCLUDE))


def requests_by_area(req: DataFrame, key: str = KEY) -> DataFrame:
    """11-column complaint summary per area: total, top 3 types (upper case),
    top 5 descriptors (an empty one counts and ranks), and the most frequent city (ties by name)."""
    prof = profile_by_key(req, key, {}, [("complaint", upper_label("kind")),
                                         ("descriptor", "descriptor"), ("city", "city")], labels=("descriptor",))
    j = summarize_profile(prof, key, {"total_complaints": "n"},
                          {"complaint": ("c", 3, P.TIERS_THREE), "descriptor": ("d", 5, P.TIERS_FIVE),
                           "city": ("city", 1, [(1, 1)])})
    return j.select(
        key, "total_complaints",
        *[entry_label(f"c{i}", "total_complaints").alias(f"top_complaint_{i}") for i in range(1, 4)],
        *[entry_label(f"d{i}", "total_complaints").alias(f"top_descriptor_{i}") for i in range(1, 6)],
        F.coalesce(F.col("city1.name"), F.lit("")).alias("city"))


# ----------------------------------------------------------------- volume

def volume_rows(vol: DataFrame, key_expr: str = "area_expr", key: str = KEY) -> DataFrame:
    """Reject malformed keys, split multi keys: ``(area, vehicles, samples)``."""
    v = reject_malformed_key(vol, key_expr, P.MALFORMED_KEY_MARKER)
    return explode_multi_key(v.select(key_expr, "vehicles", "samples"), key_expr,
                             ["vehicles", "samples"], out=key)


def volume_by_area(vol: DataFrame, key_expr: str = "area_expr", key: str = KEY,
                   days: int = P.DAYS_IN_PERIOD) -> DataFrame:
    """Estimated vehicles per area over the period: (sum v div sum s) * days."""
    sums = volume_rows(vol, key_expr, key).groupBy(key).agg(
        F.sum("vehicles").cast("bigint").alias("vehicles"), F.sum("samples").cast("bigint").alias("samples"))
    return sums.select(key, extrapolate_volume("vehicles", "samples", days).alias("volume"))


def segment_volume(street: DataFrame, lookup: DataFrame) -> DataFrame:
    """Segments -> ordinal names -> postcodes -> apportioned (area, vehicles, samples)."""
    named = street.select("segment", ordinal_street_name("roadway").alias("road"),
                          ordinal_street_name("from_name").alias("start"),
                          ordinal_street_name("to_name").alias("end"), "vehicles", "samples")
    resolved = resolve_names(named, "segment", {"road": "road", "start": "start", "end": "end"},
                             lookup, "name", "postcode", carry=["vehicles", "samples"])
    return apportion_by_agreement(resolved, "road_zip", "start_zip", "end_zip",
                                  ["vehicles", "samples"], out=KEY)


# ------------------------------------------------------- join and classify

PROFILE_COLUMNS = (["city", KEY] + P.RATE_COLUMNS + ["total_accidents", "total_vehicles"]
                   + [f"top_factor_{i}" for i in range(1, 6)] + [f"top_vehicle_{i}" for i in range(1, 6)]
                   + [f"top_complaint_{i}" for i in range(1, 4)]
                   + [f"top_descriptor_{i}" for i in range(1, 6)] + ["total_complaints"])


def area_profile(volume: DataFrame, incidents: DataFrame, requests: DataFrame, key: str = KEY) -> DataFrame:
    """27-column joined table with the four rates."""
    j = join_three_way(volume, incidents, requests, key)
    return j.select(
        "city", key,
        rate_per_1000("total_accidents", "volume").alias("accidents_per_1000_vehicles"),
        rate_per_1000("persons_injured", "total_accidents").alias("injuries_per_1000_accidents"),
        rate_per_1000("persons_killed", "total_accidents").alias("deaths_per_1000_accidents"),
        ratio_rounded("total_vehicles", "total_accidents").alias("vehicles_per_accident"),
        *PROFILE_COLUMNS[6:])


def area_risk(profile: DataFrame) -> DataFrame:
    """28-column classified report. The bounds and the rows both read the per-area profile, which is therefore cut: its
    plan runs once, now, and the small table it leaves in the shared folder answers every later read."""
    c = classify_three_level(cut_lineage(profile, "profile"), "accidents_per_1000_vehicles", "injuries_per_1000_accidents",
                             "deaths_per_1000_accidents", out="safety_class")
    return c.select("city", KEY, "safety_class", *PROFILE_COLUMNS[2:])


def class_distribution(risk: DataFrame) -> DataFrame:
    return risk.groupBy("safety_class").agg(F.count(F.lit(1)).alias("areas"))
