"""Stored partial summaries: facts come by period, each period is summarised once, and a report merges the partials.

``store_facts`` appends cleaned facts under ``period=...``. ``update_partials`` summarises the periods that have no
partial yet and stores one partial table per period; a run over a year of facts that got one more day reads that day
only. ``merged`` adds the stored partials up. Sums and counts merge exactly, so the result is the one-level aggregate.

A period counts as complete once it is summarised; late facts of it are taken in by naming it in ``again``, which
replaces its partial. Partials are replaced period by period on commit, so a run that is repeated after a failure leaves
each period once.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.operators.aggregate import merge_partials, sum_measures

PERIOD = "period"
#: periods that Spark names for a missing time
NONE = "__HIVE_DEFAULT_PARTITION__"


def by_day(ts: str = "ts") -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def by_month(ts: str = "ts") -> Column:
    return F.date_format(ts, "yyyy-MM")


def store_facts(facts: DataFrame, path: str, period: Column) -> None:
    """Append facts, a folder per period. Rows are dealt by period and spread within it, so that a hot period is
    written by several tasks; adaptive execution puts what is small together again."""
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(8))
    named = facts.withColumn(PERIOD, period)
    named.repartition(F.col(PERIOD), spread).write.mode("append").partitionBy(PERIOD).parquet(path)


def periods(spark: SparkSession, path: str) -> dict[str, str]:
    """The stored periods and their folders, by the folders' names; no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return {unquote(n.partition("=")[2]): n for n in names if n.startswith(PERIOD + "=")}


def read_periods(spark: SparkSession, path: str, wanted: list[str] | None = None) -> DataFrame:
    """The stored rows of the listed periods (default: all), with their period as text. The predicate is on the folder, so
    files of other periods are not opened, also not for the schema."""
    there = periods(spark, path)
    named = sorted(there if wanted is None else set(wanted) & there.keys())
    if not named:
        raise ValueError(f"{path} holds none of the periods {wanted}" if wanted is not None else f"{path} holds no periods")
    held = spark.read.parquet(f"{path}/{there[named[-1]]}").schema
    schema = T.StructType([*held.fields, T.StructField(PERIOD, T.StringType())])
    table = spark.read.schema(schema).parquet(path)
    if wanted is None:
        return table
    some = F.col(PERIOD).isin(*[w for w in named if w != NONE])
    return table.filter(some | F.col(PERIOD).isNull() if NONE in named else some)


def update_partials(spark: SparkSession, facts: str, partials: str, key: str | list[str], sums: dict[str, str],
                    count_as: str | None = None, again: list[str] | None = None) -> tuple[list[str], DataFrame | None]:
    """Summarise the periods of the stored ``facts`` that ``partials`` lacks, and those in ``again``. Returns the periods
    and the frame that was written (None: nothing to do). The number of periods is that of the calendar."""
    there = periods(spark, facts).keys()
    todo = sorted((there - periods(spark, partials).keys()) | (set(again or ()) & there))
    if not todo:
        return [], None
    keys = [key] if isinstance(key, str) else list(key)
    part = sum_measures(read_periods(spark, facts, todo), [*keys, PERIOD], sums, count_as)
    # one file a period: a partial is as small as its keys are few
    part.repartition(PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(partials)
    return todo, part


def merged(spark: SparkSession, partials: str, key: str | list[str], sums: list[str], wanted: list[str] | None = None) -> DataFrame:
    """The stored partials added up, of all or of the listed periods."""
    return merge_partials([read_periods(spark, partials, wanted)], key, sums)
