"""Key reshaping: multi-key rows and apportioning a segment to its postcodes.

Both are narrow ``explode`` projections; neither shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.functions.expr import q


def explode_multi_key(df: DataFrame, key: str, measures: list[str],
                      seps: tuple[str, ...] = (";", ":"), out: str | None = None) -> DataFrame:
    """Rows keyed "A;B" (or "A:B", "A;B;C", ...) become one row per part (trimmed), each with
    floor(measure / parts); single keys pass through unchanged.

    The first separator in ``seps`` that occurs in the key decides how it is split.
    """
    out = out or key
    k = F.col(key)
    parts = None
    for s in seps:
        piece = F.transform(F.split(k, "\\" + s if s in ".$|()[]{}^?*+\\" else s, -1), lambda x: F.trim(x))
        parts = F.when(k.contains(s), piece) if parts is None else parts.when(k.contains(s), piece)
    others = [c for c in df.columns if c not in measures and c != key]
    split = df.withColumn("_parts", parts.otherwise(F.array(k)))
    return split.select(
        *others,
        F.explode("_parts").alias(out),
        *[F.expr(f"{q(m)} div size(_parts)").alias(m) for m in measures])


def apportion_by_agreement(df: DataFrame, road: str, start: str, end: str,
                           measures: list[str], keep: list[str] | None = None,
                           out: str = "area") -> DataFrame:
    """Split a segment's measures over the postcodes of its three names.

    The weight of a postcode is how many of the three roles (road, from, to)
    resolve to it. Weight 3 keeps the whole value; otherwise each postcode gets
    ``(v div 3) * weight`` — thirds floor first, two thirds are twice a third.
    One output row per distinct postcode of the segment.
    """
    r, s, e = F.col(road), F.col(start), F.col(end)
    one = F.lit(1)
    w_road = one + (s == r).cast("int") + (e == r).cast("int")
    w_start = one + (e == s).cast("int")
    roles = F.array(
        F.struct(r.alias("z"), w_road.alias("w"), F.lit(True).alias("emit")),
        F.struct(s.alias("z"), w_start.alias("w"), (s != r).alias("emit")),
        F.struct(e.alias("z"), one.alias("w"), ((e != r) & (e != s)).alias("emit")),
    )
    exploded = df.select(*(keep or []), *measures, F.explode(roles).alias("_role"))
    exploded = exploded.filter(F.col("_role.emit"))
    vals = []
    for m in measures:
        third = F.expr(f"{q(m)} div 3")
        vals.append(F.when(F.col("_role.w") == 3, F.col(m))
                    .otherwise(third * F.col("_role.w")).alias(m))
    return exploded.select(*(keep or []), F.col("_role.z").alias(out), *vals)
