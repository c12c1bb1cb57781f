"""Area-risk analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (or a ``Column``
expression) built from Spark's own SQL functions, so each report is one
Catalyst plan: filters reach the Parquet scan, aggregates run partial/final,
and per-area top-k lists use window group limits.

Sub-packages:

* ``sources``   — table loading, raw-line scans, positional splits, schemas
* ``sinks``     — CSV / JSON / text writers
* ``functions`` — scalar column expressions (rates, labels, name rules)
* ``operators`` — cleaning, keys, aggregates, top-k, joins, classification
* ``plans``     — report compositions, test fixtures, the query registry
* ``streaming`` — the same operators over a file stream
"""

__version__ = "0.1.0"
