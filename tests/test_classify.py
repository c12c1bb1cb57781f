"""Truth table of the three-level classifier, bounds exactly on a rate."""

from pyspark.sql import functions as F

from arearisk.operators.aggregate import mean_sigma_bounds
from arearisk.operators.classify import classify_expr


def classify(spark, a, i, d):
    # bounds: A in [1, 3], I in [10, 30], D in [1, 3]
    fl = [None if x is None else float(x) for x in (a, i, d)]
    df = spark.createDataFrame([tuple(fl)], "a double, i double, d double")
    e = classify_expr(F.col("a"), F.col("i"), F.col("d"), 3.0, 1.0, 30.0, 10.0, 3.0, 1.0)
    return df.select(e.alias("c")).first().c


def test_truth_table(spark):
    assert classify(spark, 4, 5, 0.5) == "Ok"          # A high, I and D low
    assert classify(spark, 4, 5, 2) == "Hazardous"     # A high otherwise
    assert classify(spark, 0.5, 40, 4) == "Ok"         # A low, I and D high
    assert classify(spark, 0.5, 40, 2) == "Safe"       # A low otherwise
    assert classify(spark, 2, 40, 4) == "Hazardous"    # A within, I and D high
    assert classify(spark, 2, 5, 0.5) == "Safe"        # A within, I and D low
    assert classify(spark, 2, 20, 2) == "Ok"           # A within otherwise


def test_bounds_are_strict(spark):
    assert classify(spark, 3.0, 30.0, 3.0) == "Ok"     # on the upper bounds: within
    assert classify(spark, 1.0, 10.0, 1.0) == "Ok"     # on the lower bounds: within


def test_null_rate_has_no_class(spark):
    assert classify(spark, None, 20, 2) is None


def test_published_statistics_give_the_published_bounds(spark):
    """Mean and sample deviation of the four rates over the 144 published areas, and the bounds derived from
    them. Two rows have a given mean and sample deviation, so they stand for the areas."""
    published = {"accidents": (0.1597, 0.1457, 0.0140, 0.3054), "injuries": (274.1158, 79.1831, 194.9327, 353.2989),
                 "deaths": (1.3897, 1.3042, 0.0855, 2.6939), "vehicles": (1.9678, 0.0474, 1.9204, 2.0152)}
    half = 0.5 ** 0.5
    rows_ = [tuple(m + sign * sd * half for m, sd, _, _ in published.values()) for sign in (-1, 1)]
    df = spark.createDataFrame(rows_, ", ".join(f"{c} double" for c in published))
    r = mean_sigma_bounds(df, list(published)).head()
    for c, (mean, sd, lower, upper) in published.items():
        assert (r[f"{c}_mean"], r[f"{c}_sd"], r[f"{c}_lower"], r[f"{c}_upper"]) == (mean, sd, lower, upper)
