"""Compositions of the operators: the reports (``reports``), the job from raw
files (``city``), its parameters (``presets``), the test fixture views
(``fixtures``), the DuckDB oracle (``oracle``) and the registry of one query
per operator id (``base``, ``catalog_*``, ``registry``)."""
