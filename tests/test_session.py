"""Shared folder, lineage and lineage cuts."""

import pytest

from arearisk.session import cut_lineage, local_path, shared_dir
from conftest import rows


def test_shared_dir_is_the_checkpoint_dir(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_cut_lineage_round_trip(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    cut = cut_lineage(df, "t-cut")
    assert rows(cut) == rows(df)
    base = local_path(shared_dir(spark))
    files = [local_path(f) for f in cut.inputFiles()]
    assert files and all(f.startswith(base) and f.endswith(".parquet") for f in files)


def test_scratch_is_dropped(spark):
    import os

    from arearisk.session import _MADE, app_key, drop_scratch

    others = _MADE.pop(app_key(spark), [])
    cut = cut_lineage(spark.range(3), "t-drop")
    (path,) = {os.path.dirname(local_path(f)) for f in cut.inputFiles()}
    assert drop_scratch(spark) == 1 and not os.path.exists(path)
    _MADE[app_key(spark)] = others


def test_shared_dir_needs_a_setting_on_a_cluster():
    from arearisk.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())
