"""Accepting and rejecting records: one pass that judges every record, says why it is none, and keeps both kinds.

A judged frame holds one row per input record: ``reason`` (NULL: accepted), ``detail`` (what was read instead), ``value``
(the record as it came) and the typed columns. It is consumed in one of three ways: ``must_accept`` fails the job at
the first reject, ``accepted`` goes on without them, and ``write_routed`` stores both outcomes in one write, from which
``routed`` reads either. All are narrow: judging and storing read the source once and move nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.functions.expr import is_int_text
from arearisk.operators.clean import once

REASON, DETAIL, VALUE = "reason", "detail", "value"
VERDICT = [REASON, DETAIL, VALUE]
ACCEPTED, REJECTED = "accepted", "rejected"


def first_reason(checks: list[tuple[str, Column, Column]]) -> list[Column]:
    """``reason`` and ``detail`` of the first of (reason, bad, detail) that a record fails; NULL if it fails none. A
    check that is NULL counts as passed."""
    reason = detail = None
    for name, bad, text in checks:
        reason = F.when(bad, F.lit(name)) if reason is None else reason.when(bad, F.lit(name))
        detail = F.when(bad, text) if detail is None else detail.when(bad, text)
    return [reason.alias(REASON), detail.alias(DETAIL)]


def int_value(c: Column, kind: str = "int") -> Column:
    """The integer that the text holds; NULL if it holds none, or one too large for ``kind``."""
    return F.when(is_int_text(c), F.trim(c).try_cast(kind))


def with_ints(df: DataFrame, cols: dict[str, str], kind: str = "int") -> DataFrame:
    """``df`` and, under each name of ``cols``, the integer that the text column named there holds. Each is computed once
    a row: verdict, detail and value all ask for it, and a copy of the tests in each makes a row's code too long for
    the JVM's compiler."""
    return once(df.withColumns({out: int_value(F.col(text), kind) for out, text in cols.items()}))


def bad_ints(cols: dict[str, str]) -> tuple[Column, Column]:
    """Whether any of the texts is no integer (a missing or empty one is none), and "name=text" of each. ``cols`` as for
    ``with_ints``, the texts named as in the detail."""
    wrong = [F.when(F.col(out).isNull(), F.concat(F.lit(text + "="), F.coalesce(F.col(text), F.lit("")))) for out, text in cols.items()]
    return reduce(or_, [F.col(out).isNull() for out in cols]), F.concat_ws(", ", *wrong)


def accepted(judged: DataFrame) -> DataFrame:
    """The accepted records' typed columns."""
    return judged.filter(F.col(REASON).isNull()).drop(*VERDICT)


def rejected(judged: DataFrame) -> DataFrame:
    """(value, reason, detail) of the rejects."""
    return judged.filter(F.col(REASON).isNotNull()).select(VALUE, REASON, DETAIL)


def must_accept(judged: DataFrame) -> DataFrame:
    """The typed columns; a reject fails the job, whichever columns are used later and under any ANSI setting."""
    text = F.concat(F.lit("rejected ("), F.col(REASON), F.lit(": "), F.coalesce(F.col(DETAIL), F.lit("")), F.lit("): "),
                    F.coalesce(F.col(VALUE), F.lit("")))
    fine = F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    return judged.filter(fine).drop(*VERDICT)  # a filter is never pruned


def write_routed(judged: DataFrame, path: str, mode: str = "error") -> str:
    """Store every record under ``outcome=accepted`` or ``outcome=rejected``, in one pass over the source. An accepted
    record is stored by its typed columns alone, a reject by value, reason and detail alone."""
    ok = F.col(REASON).isNull()
    typed = [c for c in judged.columns if c not in VERDICT]
    out = once(judged).select(
        F.when(ok, ACCEPTED).otherwise(REJECTED).alias("outcome"), REASON, DETAIL, F.when(~ok, F.col(VALUE)).alias(VALUE),
        *[F.when(ok, F.col(c)).alias(c) for c in typed])
    out.write.mode(mode).partitionBy("outcome").parquet(path)
    return path


def routed(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a stored frame; ``schema`` is the judged frame's. Each reads its own files only, and is
    empty if there are none."""
    full = T.StructType([*schema.fields, T.StructField("outcome", T.StringType())])
    table = spark.read.schema(full).parquet(path)
    typed = [f.name for f in schema.fields if f.name not in VERDICT]
    return (table.filter(F.col("outcome") == ACCEPTED).select(*typed),
            table.filter(F.col("outcome") == REJECTED).select(VALUE, REASON, DETAIL))


# ------------------------------------------------------------------ quoted CSV

_WHOLE = "_record"


def judged_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """Quote-aware CSV judged against a schema of strings, integers and doubles.

    Reasons: ``columns`` (another number of fields, or broken quotes; the whole record is kept) and ``value`` (a field
    that is not of its type). A missing value is an empty text, NULL in a nullable field of another type, and a reject
    in one that is not nullable. Fields are read as text and cast here, so the outcome is the same under any ANSI
    setting, and whichever columns are used later.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_WHOLE, T.StringType())])
    read = (spark.read.schema(raw).option("header", header).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _WHOLE).csv(path))
    df = once(read)
    wrong, typed = [], []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            typed.append(F.coalesce(c, F.lit("")).alias(f.name))
            continue
        kind = f.dataType.simpleString()
        held = F.coalesce(F.trim(c), F.lit("")) != ""
        got = int_value(c, kind) if isinstance(f.dataType, T.IntegralType) else F.trim(c).try_cast(kind)
        bad = got.isNull() if not f.nullable else held & got.isNull()
        wrong.append(F.when(bad, F.concat(F.lit(f.name + "="), F.coalesce(c, F.lit("")))))
        typed.append(got.alias(f.name))
    checks = [("columns", F.col(_WHOLE).isNotNull(), F.lit(None).cast("string"))]
    if wrong:
        checks.append(("value", F.coalesce(*wrong).isNotNull(), F.concat_ws(", ", *wrong)))
    record = F.coalesce(F.col(_WHOLE), F.to_csv(F.struct(*[f.name for f in schema.fields])))
    return df.select(*first_reason(checks), record.alias(VALUE), *typed)
