"""Aggregations. Every one is a declarative ``groupBy().agg()`` so Spark runs
a partial (map-side) aggregate before the shuffle: a hot key that holds a
third of the rows still leaves each map task as one partial row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.functions.expr import count_nonempty, idiv, nonempty


def count_per_key(df: DataFrame, key: str | list[str], out: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def sum_measures(df: DataFrame, key: str | list[str], measures: dict[str, str],
                 count_as: str | None = None) -> DataFrame:
    """Sum each measure per key (``out name -> input column``), optionally with a row count."""
    aggs = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    aggs += [F.sum(F.col(c)).cast("bigint").alias(o) for o, c in measures.items()]
    return df.groupBy(key).agg(*aggs)


def nonempty_slots(slots: list[str]) -> Column:
    """Per-row number of filled slots; sum it per key for e.g. vehicles involved."""
    return count_nonempty(slots)


def slot_values(df: DataFrame, key: str | list[str], slots: list[str],
                out: str = "category") -> DataFrame:
    """Long form ``(key, category)`` of several slot columns, empty slots dropped."""
    keys = [key] if isinstance(key, str) else list(key)
    long = df.select(*keys, F.explode(F.array(*[F.col(s) for s in slots])).alias(out))
    return long.filter(nonempty(out))


def category_counts(df: DataFrame, key: str | list[str], slots: list[str],
                    out: str = "category", n: str = "n") -> DataFrame:
    """How often each category occurs per key over several slot columns."""
    keys = [key] if isinstance(key, str) else list(key)
    return slot_values(df, keys, slots, out).groupBy(*keys, out).agg(F.count(F.lit(1)).alias(n))


def label_counts(df: DataFrame, key: str | list[str], label: str, n: str = "n") -> DataFrame:
    """Frequency of one label column per key (an empty label is a label too, and a missing one is empty)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(label, F.coalesce(F.col(label), F.lit(""))).groupBy(*keys, label).agg(F.count(F.lit(1)).alias(n))


def merge_partials(parts: list[DataFrame], key: str | list[str], sums: list[str]) -> DataFrame:
    """Merge partial summaries of the same keys: every measure adds up."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(key).agg(*[F.sum(s).cast("bigint").alias(s) for s in sums])


def representative_value(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Most frequent ``value`` per key; ties go to the smallest value."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("a"), F.col(value).alias("b")))
    return counts.groupBy(key).agg(pick.alias(out or value))


def first_seen(df: DataFrame, key: str, order: str, attrs: list[str],
               sums: dict[str, str], count_as: str) -> DataFrame:
    """The attributes of the row with the smallest ``order`` (ties by the attributes), plus sums and a row count per key.

    Rows are first folded per (key, attributes) by a hash aggregate; the first is picked among those few.
    """
    few = df.groupBy(key, *attrs).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"),
                                      *[F.sum(c).cast("bigint").alias(o) for o, c in sums.items()])
    first = F.min(F.struct(F.col("_first").isNull(), "_first", *attrs)).alias("_f")
    out = few.groupBy(key).agg(first, *[F.sum(o).cast("bigint").alias(o) for o in sums], F.sum("_n").alias(count_as))
    return out.select(key, *[F.col("_f")[a].alias(a) for a in attrs], *sums, count_as)


def grand_totals(df: DataFrame, sums: list[str]) -> DataFrame:
    """Fold a per-key summary into one row of global totals."""
    return df.agg(*[F.sum(s).cast("bigint").alias(s) for s in sums])


def totals_report(df: DataFrame, measures: dict[str, object], slots: list[str], labels: list[str] = ()) -> DataFrame:
    """One long ``(category, count)`` table of named measure totals and
    per-category counts over all rows, from a single pass: every record is
    exploded into one (kind, name, value) row per measure and per filled slot,
    then one partially aggregated ``groupBy`` sums them. ``kind`` keeps
    measure names and category names apart. An empty slot is no category, an
    empty value of a column in ``labels`` is one."""
    def c_(x):
        return F.col(x) if isinstance(x, str) else x

    rows = [F.struct(F.lit("measure").alias("kind"), F.lit(name).alias("category"),
                     c_(v).cast("bigint").alias("v")) for name, v in measures.items()]
    rows += [F.struct(F.lit("category").alias("kind"), F.col(sl).alias("category"), F.lit(1).cast("bigint").alias("v"))
             for sl in slots]
    rows += [F.struct(F.lit("label").alias("kind"), F.coalesce(F.col(c), F.lit("")).alias("category"), F.lit(1).cast("bigint").alias("v"))
             for c in labels]
    long = df.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    long = long.filter((F.col("kind") != "category") | nonempty("category"))
    return (long.groupBy("kind", "category").agg(F.sum("v").cast("bigint").alias("count"))
            .select("category", "count"))


def sort_totals(df: DataFrame) -> DataFrame:
    """Largest count first; equal counts by name."""
    return df.orderBy(F.col("count").desc(), F.col("category").asc())


def extrapolate_volume(sum_v: str, sum_s: str, days: int) -> Column:
    """``(sum_v div sum_s) * days``; NULL when there are no samples."""
    return idiv(sum_v, sum_s) * F.lit(days)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample stddev, min, max of each column as five typed rows
    (``summary`` + one DOUBLE column per input), from one aggregate pass."""
    stats = {
        "count": lambda c: F.count(F.col(c)).cast("double"),
        "mean": lambda c: F.avg(F.col(c)),
        "stddev": lambda c: F.stddev_samp(F.col(c)),
        "min": lambda c: F.min(F.col(c)).cast("double"),
        "max": lambda c: F.max(F.col(c)).cast("double"),
    }
    one = df.agg(*[fn(c).alias(f"{s}__{c}") for s, fn in stats.items() for c in cols])
    rows = F.array(*[F.struct(F.lit(s).alias("summary"),
                              *[F.col(f"{s}__{c}").alias(c) for c in cols]) for s in stats])
    return one.select(F.inline(rows))


def mean_sigma_bounds(df: DataFrame, cols: list[str], k: float = 1.0, digits: int = 4) -> DataFrame:
    """One row: per column its mean and sample stddev rounded to ``digits``,
    and bounds ``round(mean +- k*stddev, digits)``."""
    one = df.agg(*[x for c in cols for x in (
        F.round(F.avg(c), digits).alias(f"{c}_mean"),
        F.round(F.stddev_samp(c), digits).alias(f"{c}_sd"))])
    return one.select("*", *[x for c in cols for x in (
        F.round(F.col(f"{c}_mean") + F.lit(k) * F.col(f"{c}_sd"), digits).alias(f"{c}_upper"),
        F.round(F.col(f"{c}_mean") - F.lit(k) * F.col(f"{c}_sd"), digits).alias(f"{c}_lower"))])
