"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, data_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it.

    By default the scan's own splits (``spark.sql.files.maxPartitionBytes``) stand. A caller who knows that a table is
    one large row group deals it to more tasks: by ``partitions``, or for the session by
    ``spark.arearisk.partitions``, e.g. ``lineitem=8,events=8``.
    """
    df = spark.read.parquet(table_path(data_dir, name))
    stated = dict(x.split("=") for x in (spark.conf.get("spark.arearisk.partitions", None) or "").split(",") if x)
    partitions = partitions or int(stated.get(name, 0))
    return df.repartition(partitions) if partitions else df


def register_tables(spark: SparkSession, data_dir: str, names=TABLES) -> None:
    """Expose the tables as temporary views so fixture SQL can name them."""
    for name in names:
        load_table(spark, data_dir, name).createOrReplaceTempView(name)
