"""Ranking: per-key top-k with tiered widths, global top/bottom lists.

Per-key ranks use ``row_number`` over a window filtered by ``rank <= k``;
Spark turns that into a WindowGroupLimit that also runs *before* the
shuffle, so each map task sends at most k rows per key — a hot key cannot
flood one reducer. Global lists use ``orderBy().limit()``, which plans as
TakeOrderedAndProject (a per-partition heap, no full sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def rank_within(counts: DataFrame, key, cat: str, n: str, k: int, rank: str = "rank") -> DataFrame:
    """Rows with the k largest ``n`` per key; equal counts ordered by name."""
    w = Window.partitionBy(*_keys(key)).orderBy(F.col(n).desc(), F.col(cat).asc())
    return counts.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def tier_width(width: Column, tiers: list[tuple[int, int]]) -> Column:
    """Number of entries to show for ``width`` categories.

    ``tiers`` are (minimum width, shown) pairs, e.g. [(1, 1), (3, 3), (5, 5)]:
    0 -> 0, 1-2 -> 1, 3-4 -> 3, 5+ -> 5.
    """
    expr = None
    for lo, shown in sorted(tiers, reverse=True):
        expr = F.when(width >= lo, F.lit(shown)) if expr is None else expr.when(width >= lo, F.lit(shown))
    return expr.otherwise(F.lit(0))


def tiered_topk(counts: DataFrame, key, cat: str, n: str, tiers: list[tuple[int, int]],
                rank: str = "rank") -> DataFrame:
    """Top categories per key where how many are shown depends on how many exist.

    The tiers compare the number of categories only with thresholds up to
    ``limit``, so counting the rows that survive ``rank <= limit`` (at most
    ``limit`` per key, after a group limit that also runs before the shuffle)
    decides the width exactly; no step sees a whole group.
    """
    limit = max(max(s for _, s in tiers), max(lo for lo, _ in tiers))
    ranked = rank_within(counts, key, cat, n, limit, rank)
    capped = F.count(F.lit(1)).over(Window.partitionBy(*_keys(key)))
    return (ranked.withColumn("_width", capped)
            .filter(F.col(rank) <= tier_width(F.col("_width"), tiers)).drop("_width"))


def topk_to_columns(ranked: DataFrame, key, value: Column | str, k: int, prefix: str,
                    rank: str = "rank", empty: str = "") -> DataFrame:
    """Ranked rows -> fixed columns ``prefix1..prefixk`` ('' when absent)."""
    v = F.col(value) if isinstance(value, str) else value
    return ranked.groupBy(*_keys(key)).agg(
        *[F.coalesce(F.max(F.when(F.col(rank) == i, v)), F.lit(empty)).alias(f"{prefix}{i}")
          for i in range(1, k + 1)])


def order_metric(metric: str, descending: bool) -> Column:
    c = F.col(metric)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def top_n_global(df: DataFrame, metric: str, key: str, n: int = 10, descending: bool = True) -> DataFrame:
    """The n rows with the highest (or lowest) metric; ties by key; NULLs last."""
    return df.orderBy(order_metric(metric, descending), F.col(key).asc()).limit(n)


def bottom_n_global(df: DataFrame, metric: str, key: str, n: int = 10) -> DataFrame:
    return top_n_global(df, metric, key, n, descending=False)


def rank_multi_metric(df: DataFrame, key: str, metrics: list[str], n: int = 10,
                      value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Top-n and bottom-n lists of several metrics in one frame:
    ``(list, rank, key, value, keep...)`` with list = 'top_<metric>' /
    'bottom_<metric>'; ``keep`` carries more columns of the row (e.g. all of it).

    Only narrow (list, key, signed value) rows are ranked, by one ``row_number``
    group limit that runs before the shuffle; the at most 2 * metrics * n rows
    are then joined back to ``df`` (pass a cut, ``session.cut_lineage``, to compute it once).
    """
    carry = [c for c in (keep or []) if c not in (key, value)]
    entries = [F.struct(F.lit(f"{name}_{m}").alias("list"), F.col(m).cast("double").alias(value),
                        (F.col(m).cast("double") * F.lit(sign)).alias("_signed"))
               for m in metrics for name, sign in (("top", -1.0), ("bottom", 1.0))]
    long = df.select(key, F.explode(F.array(*entries)).alias("_m")).select(key, "_m.*")
    w = Window.partitionBy("list").orderBy(F.col("_signed").asc_nulls_last(), F.col(key).asc())
    best = (long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).select("list", "rank", key, value))
    return best.join(df.select(key, *carry), key).select("list", "rank", key, value, *carry) if carry else best
