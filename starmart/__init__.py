"""starmart: a Spark-native warehouse pipeline and reporting library.

Layers
------
- ``starmart.sources``   file sources/sinks: CSV ingest, Parquet tables, daily snapshots,
                         year-partitioned fact layout, versioned tables.
- ``starmart.functions`` column expressions (Unicode strip, date parsing, date keys, money).
- ``starmart.operators`` DataFrame operators: cleaning, dimensions and surrogate keys,
                         key resolution joins, keyed changes with audit, quality checks.
- ``starmart.plans``     named reports and the two end-to-end pipelines.
- ``starmart.streaming`` incremental (availableNow) landing-folder ingest into Bronze.

Everything is expressed with DataFrames and built-in functions so Catalyst can push
filters and projections into the Parquet scans and keep work inside whole-stage codegen.
"""

from starmart.session import build_session, shared_root

__all__ = ["build_session", "shared_root"]
