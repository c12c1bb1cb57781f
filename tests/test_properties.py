"""Street names against written-out cases, and property tests (hypothesis): volume conservation of multi keys, class totals."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arearisk.functions import expr as X
from arearisk.operators.keys import explode_multi_key

# written-out cases of the street-name rule
NAMES = {
    "WEST 1 ST": "WEST 1st ST", "WEST 2 ST": "WEST 2nd ST", "EAST 3 ST": "EAST 3rd ST", "EAST 4 ST": "EAST 4th ST",
    "11 AVE": "11th AVE", "12 AVE": "12th AVE", "13 AVE": "13th AVE", "19 AVE": "19th AVE", "21 AVE": "21st AVE",
    "111 PL": "111th PL", "112 PL": "112th PL", "213 ST": "213th ST", "222 ST": "222nd ST", "1000 ST": "1000th ST",
    "0 ST": "0th ST", "BROADWAY": "BROADWAY", "  3 AVE  ": "3rd AVE", "AVE OF THE AMER": "AVE OF THE AMERICAS",
    "5A AVE": "5A AVE", "": "",
}


def test_ordinal_names(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    assert {r.n: r.o for r in df.select("n", X.ordinal_street_name("n").alias("o")).collect()} == NAMES


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_ordinal_suffix_follows_the_last_two_digits(spark, n):
    got = spark.range(1).select(X.ordinal_street_name(F.lit(f"{n} ST")).alias("o")).head().o
    last = spark.range(1).select(X.ordinal_street_name(F.lit(f"{n % 100:02d} ST")).alias("o")).head().o
    assert got.startswith(str(n)) and got.removeprefix(str(n)) == last[2:]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(10000, 10100), st.integers(10000, 10100), st.sampled_from([";", ":", ": ", None]),
                          st.integers(0, 10 ** 7), st.integers(1, 400)), min_size=30, max_size=60))
def test_multi_key_volume_conservation(spark, rows_):
    data = [(f"{a}{sep}{b}" if sep else str(a), v, s) for a, b, sep, v, s in rows_]
    df = spark.createDataFrame(data, "area_expr string, vehicles long, samples long")
    out = explode_multi_key(df, "area_expr", ["vehicles", "samples"], out="area")
    got = out.groupBy().sum("vehicles").first()[0]
    total = sum(v for _, v, _ in data)
    multi = sum(1 for _, b, sep, _, _ in rows_ if sep)
    # each split loses at most one unit per half
    assert total - multi <= got <= total
    assert out.count() == len(data) + multi
