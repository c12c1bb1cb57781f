"""Joins of per-area summaries and name -> postcode resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.functions.expr import nonempty


def join_inner_key(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Inner equi-join; both sides are per-key aggregates, so AQE broadcasts
    whichever side is measured small at run time and sort-merges otherwise."""
    return a.join(b, key, "inner")


def join_three_way(volume: DataFrame, incidents: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """Keys missing on any of the three sides vanish."""
    return volume.join(incidents.join(requests, key, "inner"), key, "inner")


def join_shape_guard(df: DataFrame, required: list[str]) -> DataFrame:
    """Drop joined rows where any side's required column is missing."""
    return df.dropna(subset=required)


def usable_lookup(lookup: DataFrame, name: str, postcode: str) -> DataFrame:
    """``(name, postcode)`` trimmed; entries without a postcode answer nothing."""
    out = lookup.select(F.trim(F.col(name)).alias("name"), F.trim(F.col(postcode)).alias(postcode))
    return out.filter(nonempty(postcode))


def name_roles(df: DataFrame, roles: dict[str, str], keep: list[str]) -> DataFrame:
    """Long form ``(keep..., role, name)``: one row per named role."""
    arr = F.array(*[F.struct(F.lit(r).alias("role"), F.col(c).alias("name")) for r, c in roles.items()])
    return df.select(*keep, F.explode(arr).alias("_r")).select(*keep, "_r.role", "_r.name")


def resolve_names(df: DataFrame, seg: str, roles: dict[str, str], lookup: DataFrame,
                  name: str = "name", postcode: str = "postcode", carry: list[str] | None = None,
                  suffix: str = "_zip") -> DataFrame:
    """Resolve every role's name to a postcode (the smallest, if the lookup lists several); rows with a name that is
    unknown or has no postcode drop.

    The roles are joined in one join (not one per role), then folded back per record. A record is identified by its own
    values and how often they occur, never by a row number, so a task that runs again after a loss cannot mix records
    up; a repeated segment stays repeated. Where the input is already grouped by the segment, counting moves nothing.
    The lookup is joined as it is, without an aggregate between its shuffle and the join, so adaptive execution can
    split a name that many segments share.
    """
    record = list(dict.fromkeys([seg, *(carry or []), *roles.values()]))
    rows = df.groupBy(*record).agg(F.count(F.lit(1)).alias("_times"))
    keep = [*record, "_times"]
    hit = name_roles(rows, roles, keep).join(usable_lookup(lookup, name, postcode), "name", "inner")
    out = hit.groupBy(*keep).agg(*[F.min(F.when(F.col("role") == r, F.col(postcode))).alias(r + suffix) for r in roles])
    out = out.dropna(subset=[r + suffix for r in roles])
    return repeat_rows(out, "_times").select(seg, *(carry or []), *[r + suffix for r in roles])


def repeat_rows(df: DataFrame, times: str, block: int = 4096) -> DataFrame:
    """Each row as often as its column ``times`` says, which goes. The repeats are made in blocks, so no long array is held."""
    whole = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / block))
    blocks = df.select("*", F.explode(whole).alias("_block"))
    rest = F.least(F.lit(block).cast("long"), F.col(times) - F.col("_block") * block)
    return blocks.select("*", F.explode(F.sequence(F.lit(1).cast("long"), rest)).alias("_nth")).drop("_nth", "_block", times)


def unresolved_names(df: DataFrame, seg: str, roles: dict[str, str], lookup: DataFrame,
                     name: str = "name", postcode: str = "postcode") -> DataFrame:
    """The names that do not resolve, or only to an empty postcode: ``(seg, role, name)``."""
    return name_roles(df, roles, [seg]).join(usable_lookup(lookup, name, postcode).select("name"), "name", "left_anti").select(seg, "role", "name")
