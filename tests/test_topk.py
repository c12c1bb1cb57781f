"""Tiered widths, ties, global lists."""

from arearisk.operators.topk import rank_multi_metric, tiered_topk, top_n_global
from arearisk.plans import presets as P
from conftest import rows


def counts_frame(spark):
    data = []
    for width in range(0, 7):          # area "w{width}" has `width` categories
        for c in range(width):
            data.append((f"w{width}", f"c{c}", 10 - c))
    data.append(("tie", "b", 5))
    data.append(("tie", "a", 5))
    data.append(("tie", "c", 5))
    return spark.createDataFrame(data, "area string, category string, n long")


def test_tier_widths(spark):
    got = tiered_topk(counts_frame(spark), "area", "category", "n", P.TIERS_FIVE)
    shown = {a: n for a, n in rows(got.groupBy("area").count())}
    assert {k: v for k, v in shown.items() if k.startswith("w")} == {"w1": 1, "w2": 1, "w3": 3, "w4": 3,
                                                                   "w5": 5, "w6": 5}


def test_ties_by_name(spark):
    got = tiered_topk(counts_frame(spark), "area", "category", "n", P.TIERS_THREE)
    tie = [(r["rank"], r["category"]) for r in got.filter("area = 'tie'").orderBy("rank").collect()]
    assert tie == [(1, "a"), (2, "b"), (3, "c")]


def test_global_lists_nulls_last_and_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 1.0), ("d", 0.5)], "area string, m double")
    assert [r.area for r in top_n_global(df, "m", "area", 3).collect()] == ["a", "c", "d"]
    assert [r.area for r in top_n_global(df, "m", "area", 3, descending=False).collect()] == ["d", "a", "c"]
    lists = rank_multi_metric(df, "area", ["m"], 2)
    assert rows(lists, "list", "rank", "area") == [("bottom_m", 1, "d"), ("bottom_m", 2, "a"),
                                                    ("top_m", 1, "a"), ("top_m", 2, "c")]
