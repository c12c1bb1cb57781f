"""Multi keys, rejected keys, apportioning, merging partials (edge rows)."""

from arearisk.operators.keys import apportion_by_agreement, explode_multi_key
from arearisk.plans import reports as R
from conftest import rows


def test_explode_multi_key(spark):
    df = spark.createDataFrame([("11220;11204", 39294, 6), ("10309:10312", 45001, 8), ("10001", 5, 1),
                                ("10010: 10011", 7, 3), ("1;2; 3", 90, 7)], "area_expr string, vehicles long, samples long")
    got = rows(explode_multi_key(df, "area_expr", ["vehicles", "samples"], out="area"))
    assert got == [("1", 30, 2), ("10001", 5, 1), ("10010", 3, 1), ("10011", 3, 1), ("10309", 22500, 4), ("10312", 22500, 4),
                   ("11204", 19647, 3), ("11220", 19647, 3), ("2", 30, 2), ("3", 30, 2)]


def test_volume_rejects_ny_and_merges(spark):
    df = spark.createDataFrame([("NY 10026", 12496, 6), ("10026", 100, 2), ("10026", 50, 3)],
                               "area_expr string, vehicles long, samples long")
    got = rows(R.volume_by_area(df))
    assert got == [("10026", 21930)]  # 150 div 5 * 731


def test_volume_zero_samples_is_null(spark):
    df = spark.createDataFrame([("10001", 100, 0)], "area_expr string, vehicles long, samples long")
    assert rows(R.volume_by_area(df)) == [("10001", None)]


def test_apportion_cases(spark):
    df = spark.createDataFrame([
        (1, "A", "A", "A", 100, 7),   # all equal
        (2, "A", "B", "B", 100, 7),   # from = to != road
        (3, "A", "A", "B", 100, 7),   # road = from
        (4, "A", "B", "A", 100, 7),   # road = to
        (5, "A", "B", "C", 100, 7),   # all differ
    ], "segment long, r string, s string, e string, vehicles long, samples long")
    got = rows(apportion_by_agreement(df, "r", "s", "e", ["vehicles", "samples"], keep=["segment"]))
    assert got == [(1, "A", 100, 7),
                   (2, "A", 33, 2), (2, "B", 66, 4),
                   (3, "A", 66, 4), (3, "B", 33, 2),
                   (4, "A", 66, 4), (4, "B", 33, 2),
                   (5, "A", 33, 2), (5, "B", 33, 2), (5, "C", 33, 2)]


def test_volume_is_partition_count_invariant(spark):
    """The merge of partial sums must not depend on how rows are split."""
    data = [(str(10000 + i % 7), 100 + i, 2 + i % 3) for i in range(200)]
    df = spark.createDataFrame(data, "area_expr string, vehicles long, samples long")
    outs = {n: rows(R.volume_by_area(df.repartition(n))) for n in (1, 2, 7)}
    assert outs[1] == outs[2] == outs[7]
