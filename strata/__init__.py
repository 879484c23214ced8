"""strata: layered (bronze / silver / gold) analytics written as plain
PySpark DataFrame and SQL code.

Sub-packages
------------
functions   Column builders (derived columns, keys, labels, rounding).
operators   DataFrame -> DataFrame transforms (rules, joins, aggregates,
            windows, quality checks, upsert).
sources     Readers and writers (files, catalog tables, audit rows).
plans       Composite pipelines (bronze, silver, gold, staging/mart,
            quality gate, small ETLs) and the adapter onto the test tables.
streaming   Structured Streaming monitor and keyed JSON publisher.
"""

__version__ = "0.1.0"
