"""Three-level classification against mean +- k sigma bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.operators.aggregate import mean_sigma_bounds

HAZARDOUS, OK, SAFE = "Hazardous", "Ok", "Safe"


def classify_expr(a: Column, i: Column, d: Column, ua, la, ui, li, ud, ld) -> Column:
    """Class of one row from its three rates and the six bounds (all strict).

    | rate A          | I and D                     | class     |
    | A > upper       | I < lower and D < lower     | Ok        |
    | A > upper       | otherwise                   | Hazardous |
    | A < lower       | I > upper and D > upper     | Ok        |
    | A < lower       | otherwise                   | Safe      |
    | within          | I > upper and D > upper     | Hazardous |
    | within          | I < lower and D < lower     | Safe      |
    | within          | otherwise                   | Ok        |

    A NULL rate (no traffic volume) gives a NULL class.
    """
    both_low = (i < li) & (d < ld)
    both_high = (i > ui) & (d > ud)
    return (F.when(a.isNull() | i.isNull() | d.isNull(), F.lit(None).cast("string"))
            .when(a > ua, F.when(both_low, F.lit(OK)).otherwise(F.lit(HAZARDOUS)))
            .when(a < la, F.when(both_high, F.lit(OK)).otherwise(F.lit(SAFE)))
            .when(both_high, F.lit(HAZARDOUS))
            .when(both_low, F.lit(SAFE))
            .otherwise(F.lit(OK)))


def classify_three_level(df: DataFrame, a: str, i: str, d: str, out: str = "safety_class",
                         k: float = 1.0) -> DataFrame:
    """Add the class column. The bounds are one global aggregate row, used as
    a scalar subquery that Spark executes once and reuses for all six
    comparisons (no join, nothing collected to the driver). The subquery
    re-reads ``df``, so pass a small or cut table (``session.cut_lineage``),
    not a long lineage."""
    bounds = mean_sigma_bounds(df, [a, i, d], k=k)
    b = bounds.select(F.struct(*bounds.columns).alias("b")).scalar()

    def g(c: str, side: str) -> Column:
        return b.getField(f"{c}_{side}")

    return df.withColumn(out, classify_expr(
        F.col(a), F.col(i), F.col(d),
        g(a, "upper"), g(a, "lower"), g(i, "upper"), g(i, "lower"), g(d, "upper"), g(d, "lower")))
