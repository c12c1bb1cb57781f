"""Row-level cleaning: arity checks, positional projection, date parsing,
key realignment and text filters. All operators are narrow (no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.functions.expr import concat_fields, is_int_text, nonempty, normalize_int_key
from arearisk.sources.text import field


# ------------------------------------------------------------------ filters

def filter_arity(df: DataFrame, arr: str, arities: tuple[int, ...]) -> DataFrame:
    """Keep records whose split array has one of the allowed lengths."""
    return df.filter(F.size(F.col(arr)).isin(*arities))


def shifted_field(arr: Column, idx: int, base_arity: int, shift_from: int) -> Column:
    """Field ``idx`` of a record whose fields from ``shift_from`` on move right
    by one for every field beyond ``base_arity`` (a quoted value cut at its comma)."""
    if idx < shift_from:
        return field(arr, idx)
    return field(arr, F.lit(idx) + F.size(arr) - F.lit(base_arity))


def project_by_arity(df: DataFrame, arr: str, spec: dict[str, int], base_arity: int,
                     shift_from: int, keep: list[str] | None = None) -> DataFrame:
    """Project named fields of a split record, correcting for the arity shift."""
    a = F.col(arr)
    return df.select(*(keep or []),
                     *[shifted_field(a, i, base_arity, shift_from).alias(n) for n, i in spec.items()])


def parse_datetime_parts(date_col: str, time_col: str, fmts: str | list[str]) -> Column:
    """Date text + time text -> wall-clock TIMESTAMP_NTZ; NULL when it does not parse."""
    return parse_text_timestamp(F.concat_ws(" ", F.col(date_col), F.col(time_col)), fmts)


def parse_datetime(c: str, fmts: str | list[str]) -> Column:
    return parse_text_timestamp(F.col(c), fmts)


def parse_text_timestamp(text: Column, fmts: str | list[str]) -> Column:
    """Local date-time text as TIMESTAMP_NTZ: the wall clock as written, under
    any session time zone (no daylight-saving gap), by the first format that
    fits; NULL when none does. The text is read once per format, as an instant
    of UTC, and the instant's microseconds are counted from the epoch's wall clock."""
    fmts = [fmts] if isinstance(fmts, str) else fmts
    tries = [F.unix_micros(F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f + " xx"))) for f in fmts]
    micros = F.coalesce(*tries) if len(tries) > 1 else tries[0]
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def parse_datetime_or_drop(df: DataFrame, c: str, fmts: str | list[str], out: str = "ts") -> DataFrame:
    """Parse one text column to TIMESTAMP and drop the rows that do not parse."""
    return df.withColumn(out, parse_datetime(c, fmts)).filter(F.col(out).isNotNull())


def once(df: DataFrame) -> DataFrame:
    """``df`` with every column computed once per row: a generator over one struct stands between its expressions and
    whatever filters or projects them later, so the optimizer cannot copy a parse into each use."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.explode(F.array(row)).alias("_row")).select("_row.*")


def filter_date_range(df: DataFrame, c: str, lo: str, hi: str) -> DataFrame:
    """Closed range ``lo <= c <= hi`` (on Parquet it becomes a pushed filter)."""
    return df.filter(F.col(c).between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))


def filter_nonempty(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = nonempty(c) if cond is None else cond & nonempty(c)
    return df.filter(cond)


def text_filter(c: str, include: str, exclude: str) -> Column:
    """Contains ``include`` and not ``exclude`` (case-sensitive)."""
    return F.col(c).contains(include) & ~F.col(c).contains(exclude)


def filter_include_exclude(df: DataFrame, c: str, include: str, exclude: str) -> DataFrame:
    return df.filter(text_filter(c, include, exclude))


def reject_malformed_key(df: DataFrame, key: str, marker: str = "NY") -> DataFrame:
    """Drop keys that contain ``marker`` (a malformed duplicate of another row)."""
    return df.filter(~F.col(key).contains(marker))


# ------------------------------------------------------------ realignment

def realign_shifted_fields(arr: Column, kind: Column, key_idx: int, desc_idx: int,
                           city_idx: int, two_shift_marker: str) -> tuple[Column, Column, Column]:
    """Key, descriptor and city of a record whose descriptor may hold commas.

    * key field is an integer  -> no shift; key is normalised through int
    * key field is empty       -> NULL key (the record is dropped)
    * type contains the marker -> two stray commas: fields +2, descriptor of 3 parts
    * otherwise                -> one stray comma: fields +1, descriptor of 2 parts
    """
    k0 = field(arr, key_idx)
    ok = is_int_text(k0)
    empty = k0 == ""
    two = kind.contains(two_shift_marker)
    key = (F.when(ok, normalize_int_key(k0)).when(empty, F.lit(None))
           .when(two, field(arr, key_idx + 2)).otherwise(field(arr, key_idx + 1)))
    d = [field(arr, desc_idx + i) for i in range(3)]
    desc = (F.when(ok, d[0]).when(empty, F.lit(None))
            .when(two, concat_fields(*d)).otherwise(concat_fields(d[0], d[1])))
    city = (F.when(ok, field(arr, city_idx)).when(empty, F.lit(None))
            .when(two, field(arr, city_idx + 2)).otherwise(field(arr, city_idx + 1)))
    return key, desc, city
