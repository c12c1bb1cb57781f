"""Scalar column expressions.

All of these return ``Column`` objects built from Spark SQL functions, so
they stay inside whole-stage code generation; none is a Python UDF.
Arguments are column names or ``Column`` objects unless stated otherwise.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the reference's behaviour.
# Ordinal suffixes of street numbers: last digit 1, 2, 3 -> st, nd, rd;
# everything else, and any number whose last two digits are 11 to 19 -> th.
ORDINAL_SUFFIX = {"1": "st", "2": "nd", "3": "rd"}
ORDINAL_TEEN_LOW, ORDINAL_TEEN_HIGH = 11, 19
ORDINAL_DEFAULT = "th"
# The one abbreviated street name that is expanded before any other rule.
STREET_ALIASES = {"AVE OF THE AMER": "AVE OF THE AMERICAS"}


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> str:
    """Quote a column name for use inside ``F.expr``."""
    return "`" + name.replace("`", "``") + "`"


# ----------------------------------------------------------------- arithmetic

def idiv(a: str, b: str | int) -> Column:
    """Integral division that truncates (``a div b``), NULL when ``b`` is 0.

    ``a`` and ``b`` are column names (``b`` may be an int literal).
    """
    rhs = str(int(b)) if isinstance(b, int) else q(b)
    return F.expr(f"CASE WHEN {rhs} = 0 THEN NULL ELSE {q(a)} div {rhs} END")


def floor_fraction(a: str, k: int, times: int = 1) -> Column:
    """``(a div k) * times``: halves, thirds and two-thirds that floor first."""
    return F.expr(f"({q(a)} div {int(k)}) * {int(times)}")


def safe_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b`` as DOUBLE, NULL when ``b`` is 0 or NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def rate_per_1000(a: ColumnOrName, b: ColumnOrName, digits: int = 2) -> Column:
    """round(a / b * 1000, digits); NULL (not an error) for a zero denominator."""
    return F.round(safe_ratio(a, b) * F.lit(1000.0), digits)


def ratio_rounded(a: ColumnOrName, b: ColumnOrName, digits: int = 2) -> Column:
    """round(a / b, digits); NULL for a zero denominator."""
    return F.round(safe_ratio(a, b), digits)


def share_pct(part: ColumnOrName, total: ColumnOrName) -> Column:
    """part / total * 100, and 0 when the total is 0."""
    t = col(total).cast("double")
    return (F.when(t == 0, F.lit(0.0))
            .otherwise(col(part).cast("double") / t * F.lit(100.0)))


def hsum(cols: list[ColumnOrName]) -> Column:
    """Horizontal sum of several numeric columns of one row."""
    return reduce(add, [col(c) for c in cols])


# --------------------------------------------------------------------- labels
# SQL-text forms build a whole label in one JVM call (wide report projections
# would otherwise cost a round trip per operator); the Column forms below
# compute the same values.

def share_pct_sql(part: str, total: str) -> str:
    return f"(CASE WHEN {total} = 0 THEN 0D ELSE CAST({part} AS DOUBLE) / {total} * 100D END)"


def label_name_count_pct_sql(name: str, n: str, total: str) -> str:
    return (f"concat({name}, ': ', CAST({n} AS STRING), ': ', "
            f"CAST(round({share_pct_sql(n, total)}, 2) AS STRING), '%')")


def label_count_pct0_sql(part: str, total: str) -> str:
    return f"concat(CAST({part} AS STRING), ': ', CAST(round({share_pct_sql(part, total)}, 0) AS STRING), '%')"


def num_text(c: ColumnOrName) -> Column:
    """Shortest decimal text of a DOUBLE ("38.0", "4.4", "18.18")."""
    return col(c).cast("double").cast("string")


def label_count_pct0(n: ColumnOrName, pct: ColumnOrName) -> Column:
    """"241: 38.0%" — count, then the share rounded to a whole number."""
    return F.concat(col(n).cast("string"), F.lit(": "),
                    num_text(F.round(col(pct), 0)), F.lit("%"))


def label_name_count_pct(name: ColumnOrName, n: ColumnOrName, pct: ColumnOrName) -> Column:
    """"TAXI: 1330: 19.98%" — name, count, share rounded to 2 decimals."""
    return F.concat(col(name), F.lit(": "), col(n).cast("string"), F.lit(": "),
                    num_text(F.round(col(pct), 2)), F.lit("%"))


# ---------------------------------------------------------------- text rules

def case_class_upper(c: ColumnOrName) -> Column:
    """True when the text has a cased letter and no lower-case one."""
    x = col(c)
    return (F.upper(x) == x) & (F.lower(x) != x)


def is_int_text(c: ColumnOrName) -> Column:
    """Text that an integer parser accepts: optional blanks and sign, digits."""
    return col(c).rlike(r"^\s*[+-]?[0-9]+\s*$")


def lenient_int(c: ColumnOrName) -> Column:
    """Integer value of the text, 0 when it is not an integer or too large for one."""
    x = col(c).cast("string")
    return F.coalesce(F.when(is_int_text(x), F.trim(x).try_cast("bigint")), F.lit(0)).cast("bigint")


def strict_int(c: ColumnOrName) -> Column:
    """Integer value of the text; a bad value fails the job, whatever the session's ANSI setting. NULL stays NULL."""
    x = col(c)
    bad = F.raise_error(F.concat(F.lit("not an integer: "), x)).cast("int")
    return F.when(x.isNotNull(), F.coalesce(F.trim(x).try_cast("int"), bad))


def normalize_int_key(c: ColumnOrName) -> Column:
    """Key text through an integer round trip: "00083" -> "83"."""
    return F.trim(col(c)).try_cast("bigint").cast("string")


def upper_label(c: ColumnOrName) -> Column:
    return F.upper(col(c))


def capitalize_label(c: ColumnOrName) -> Column:
    """First character upper, the rest lower ("NEW YORK" -> "New york")."""
    x = col(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


def concat_fields(*cols: ColumnOrName, sep: str = " ") -> Column:
    return F.concat_ws(sep, *[col(c) for c in cols])


def trim_field(c: ColumnOrName) -> Column:
    return F.trim(col(c))


def ordinal_word(w: Column) -> Column:
    """Append st/nd/rd/th to a word made only of digits."""
    last2 = F.substring(w, -2, 2).try_cast("int")
    last1 = F.substring(w, -1, 1)
    suffix = F.when((F.length(w) >= 2) & last2.between(ORDINAL_TEEN_LOW, ORDINAL_TEEN_HIGH),
                    F.lit(ORDINAL_DEFAULT))
    for digit, s in ORDINAL_SUFFIX.items():
        suffix = suffix.when(last1 == digit, F.lit(s))
    suffix = suffix.otherwise(F.lit(ORDINAL_DEFAULT))
    return F.when(w.rlike("^[0-9]+$"), F.concat(w, suffix)).otherwise(w)


def ordinal_street_name(c: ColumnOrName) -> Column:
    """Street name with ordinal numbers: "WEST 14 ST" -> "WEST 14th ST".

    The name is trimmed; a listed abbreviation is expanded as a whole;
    otherwise each blank-separated word that is all digits gets its suffix.
    """
    x = F.trim(col(c))
    words = F.split(x, " ", -1)
    out = F.trim(F.array_join(F.transform(words, lambda w: ordinal_word(F.trim(w))), " "))
    expr = None
    for short, full in STREET_ALIASES.items():
        expr = (F.when(x == short, F.lit(full)) if expr is None
                else expr.when(x == short, F.lit(full)))
    return expr.otherwise(out) if expr is not None else out


def nonempty(c: ColumnOrName) -> Column:
    x = col(c)
    return x.isNotNull() & (x != "")


def count_nonempty(cols: list[ColumnOrName]) -> Column:
    """Number of non-empty values among several slot columns of one row."""
    return reduce(add, [F.when(nonempty(c), F.lit(1)).otherwise(F.lit(0)) for c in cols])
