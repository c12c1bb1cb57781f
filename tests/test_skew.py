"""One area holding a third of all records: the reports stay exact."""

import duckdb
from pyspark.sql import functions as F

from arearisk.plans import oracle as O
from arearisk.plans import presets as P
from arearisk.plans import reports as R
from arearisk.plans.fixtures import FIXTURE_SQL, fixture
from arearisk.sources.tables import TABLES, table_path
from conftest import SF01
from tools.oracle_check import digest

HOT = "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE area END"


def test_incident_report_with_hot_area(spark):
    inc = fixture(spark, SF01, "incident").withColumn("area", F.expr(HOT))
    rep = R.incidents_by_area(R.clean_incidents(inc, *P.TEST_INCIDENT_RANGE))
    got_cols, got = rep.columns, [tuple(r) for r in rep.collect()]

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF01, t)}')")
    skewed = f"incident AS (SELECT * REPLACE ({HOT} AS area) FROM ({FIXTURE_SQL['incident'].strip()}) x)"
    rel = con.sql("WITH " + ",\n".join([skewed] + O.INC_CHAIN) + "\nSELECT * FROM inc_rep")
    want_cols, want = list(rel.columns), rel.fetchall()

    hot = [r for r in got if r[got_cols.index("area")] == "HOT"][0]
    assert hot[got_cols.index("total_accidents")] > sum(r[got_cols.index("total_accidents")] for r in got) / 4
    assert len(got) == len(want)
    assert digest(got_cols, got)[0] == digest(want_cols, want)[0]
