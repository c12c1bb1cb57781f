"""Sinks round-trip through the shared folder."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.session import fresh_path
from arearisk.sinks import write_csv, write_lines, write_records
from arearisk.sources.text import read_lines, read_quoted_csv
from conftest import rows

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("s", T.StringType())])


def frame(spark):
    return spark.createDataFrame([("a", 1, "x, y"), ("b", 2, ""), ("c", 3, '"q"')], SCHEMA)


def test_csv_with_header_round_trip(spark):
    path = write_csv(frame(spark), fresh_path(spark, "t-csv"), single_file=True)
    assert rows(read_quoted_csv(spark, path, SCHEMA, header=True)) == rows(frame(spark))


def test_records_round_trip(spark):
    path = write_records(frame(spark), fresh_path(spark, "t-json"))
    assert rows(spark.read.schema(SCHEMA).json(path)) == rows(frame(spark))


def test_plain_lines(spark):
    path = write_lines(frame(spark), fresh_path(spark, "t-lines"), sep="|")
    assert rows(read_lines(spark, path)) == [("a|1|x, y",), ("b|2|",), ("c|3|\"q\"",)]


def test_order_inside_a_single_file(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") * 7919 % 5000).alias("n")).repartition(6)
    path = write_csv(df, fresh_path(spark, "t-order"), single_file=True, order=["n"])
    got = [int(r.value.split(",")[1]) for r in spark.read.text(path).collect()[1:]]
    assert got == sorted(got) and len(got) == 5000
    with pytest.raises(ValueError):
        write_records(df, fresh_path(spark, "t-order"), order=["n"])
