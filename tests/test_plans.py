"""Physical-plan properties that matter at scale (checked on the explain text)."""

import contextlib
import io
import re

from arearisk.plans import base as B
from arearisk.plans import registry as G
from conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Arguments: (hashpartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\)|SinglePartition)", text)


def test_incident_report_single_scan_bounded_shuffles(spark):
    text = plan(B.incident_report(spark, SF001))
    assert text.count("lineitem.parquet") == 1                     # one scan of the facts
    assert "GreaterThanOrEqual(l_shipdate" in text                 # date range pushed into the scan
    schema = re.search(r"ReadSchema: (struct<l_[^\n]*)", text).group(1)
    assert "l_extendedprice" not in schema and "l_discount" not in schema
    hashed = [e for e in exchanges(text) if e.startswith("hashpartitioning")]
    # profile aggregate (partial before it), rank window (group limit before it), per-area fold
    assert len(hashed) == 3
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2   # partial + final top-k
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_request_report_single_scan(spark):
    text = plan(B.request_report(spark, SF001))
    assert text.count("events.parquet") == 1
    assert len([e for e in exchanges(text) if e.startswith("hashpartitioning")]) == 3
    assert "WindowGroupLimit" in text


def test_global_lists_use_take_ordered(spark):
    text = plan(G.QUERIES["top_n_global"](spark, SF001))
    assert "TakeOrderedAndProject" in text


def test_per_key_topk_uses_group_limit(spark):
    text = plan(G.QUERIES["topk_per_key"](spark, SF001))
    assert "WindowGroupLimit" in text


def test_no_python_udfs_anywhere(spark):
    for name in ("report_area_profile", "report_segment_volume", "realign_shifted_fields", "agg_first_seen"):
        text = plan(G.QUERIES[name](spark, SF001))
        assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "BatchEvalPython" not in text


def test_classification_bounds_computed_once(spark):
    df = G.QUERIES["report_area_risk"](spark, SF001)
    df.collect()                      # subquery reuse shows in the final adaptive plan
    text = plan(df)
    assert "ReusedSubquery" in text and "CartesianProduct" not in text
