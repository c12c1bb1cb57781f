"""Raw text sources: line scans, positional splits, quoted CSV, schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def read_lines_drop_marker(spark: SparkSession, path: str, marker: str) -> DataFrame:
    """Lines of ``path`` without any line that contains ``marker`` (header lines)."""
    return drop_marker_lines(read_lines(spark, path), marker)


def drop_marker_lines(df: DataFrame, marker: str, col: str = "value") -> DataFrame:
    return df.filter(~F.col(col).contains(marker))


def read_lines_drop_header(spark: SparkSession, path: str, header: str) -> DataFrame:
    """Lines of ``path`` without the lines equal to ``header``.

    The header text is an argument, so no extra job reads the first line.
    """
    return drop_header_lines(read_lines(spark, path), header)


def drop_header_lines(df: DataFrame, header: str, col: str = "value") -> DataFrame:
    return df.filter(F.col(col) != F.lit(header))


def split_array(col: str = "value", sep: str = ",") -> Column:
    """Naive split that keeps trailing empty fields (``'a,,'`` has 3 fields)."""
    return F.split(F.col(col), sep, -1)


def field(arr: Column, idx: int | Column) -> Column:
    """0-based field of a split record; NULL when the record is too short."""
    pos = F.lit(idx + 1) if isinstance(idx, int) else idx + F.lit(1)
    return F.try_element_at(arr, pos)


def split_fields(df: DataFrame, spec: dict[str, int], col: str = "value",
                 sep: str = ",", keep: list[str] | None = None) -> DataFrame:
    """Split ``col`` and project the fields named in ``spec`` (name -> 0-based index)."""
    arr = split_array(col, sep)
    return df.select(*(keep or []), *[field(arr, i).alias(n) for n, i in spec.items()])


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType,
                    header: bool = False, blank_as_empty: bool = True) -> DataFrame:
    """Quote-aware CSV with a fixed schema: a quoted ``"(lat, lon)"`` stays one field.

    Missing text is the empty string in this data model, so empty (or absent)
    text fields come back as '' rather than NULL unless ``blank_as_empty`` is off.
    """
    df = (spark.read.schema(schema)
          .option("header", header).option("quote", '"').option("escape", '"')
          .option("mode", "PERMISSIVE").csv(path))
    return empty_strings(df) if blank_as_empty else df


def empty_strings(df: DataFrame) -> DataFrame:
    """NULL text fields -> ''."""
    return df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and rename positionally to a named, typed, nullable schema."""
    cols = df.columns
    if len(cols) != len(schema.fields):
        raise ValueError(f"{len(cols)} columns for a {len(schema.fields)}-field schema")
    return df.select(*[F.col(c).cast(f.dataType).alias(f.name)
                       for c, f in zip(cols, schema.fields)])


def sample_rows(df: DataFrame, key: list[str], keep: int, of: int) -> DataFrame:
    """Sample without replacement: rows whose key hash (first 8 hex digits of md5) modulo ``of`` is below ``keep``.

    The draw depends on the key alone, so it is the same for any partitioning.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.filter(digest % F.lit(of) < F.lit(keep))
