"""Sinks. Reports are written by Spark's own writers (no driver collect)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _writer(df: DataFrame, single_file: bool, mode: str, order: list | None = None):
    # One file only for results bounded by construction (statistics, top-10 lists): it is written by one task, behind
    # a shuffle so that the stages before it keep their tasks. The shuffle keeps no order, so one is made after it.
    if single_file:
        df = df.repartition(1)
        df = df.sortWithinPartitions(*order) if order else df
    elif order:
        raise ValueError("an order inside the output needs single_file; sort the frame for many files")
    return df.write.mode(mode)


def write_csv(df: DataFrame, path: str, single_file: bool = False, header: bool = True,
              mode: str = "error", order: list | None = None) -> str:
    """Flat CSV with one header line per file; fields with commas are quoted and
    quotes doubled (RFC 4180), which ``read_quoted_csv`` reads back unchanged.
    ``order``: columns that the lines of a single file are sorted by."""
    (_writer(df, single_file, mode, order).option("header", header).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").csv(path))
    return path


def write_records(df: DataFrame, path: str, single_file: bool = False, mode: str = "error", order: list | None = None) -> str:
    """One JSON record per row (top/bottom lists, statistics); ``order`` as in ``write_csv``."""
    _writer(df, single_file, mode, order).json(path)
    return path


def write_lines(df: DataFrame, path: str, sep: str = ",", single_file: bool = False,
                mode: str = "error") -> str:
    """Header-less lines, fields joined by ``sep`` in column order."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    _writer(df.select(line.alias("value")), single_file, mode).text(path)
    return path


def write_facts(df: DataFrame, path: str, drop: tuple[str, ...] = ("unique_key", "location"),
                single_file: bool = False, mode: str = "error") -> str:
    """Cleaned per-record facts without the listed columns, as CSV with header."""
    return write_csv(df.drop(*drop), path, single_file=single_file, mode=mode)
