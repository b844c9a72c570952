"""starmart: near-real-time retail star-schema analytics on Spark.

Layout
------
sources/    readers and writers: master CSVs, the transaction stream, the
            Parquet warehouse, and the mapping of the TPC-H-like test tables
functions/  column expressions (dates, measures, cleansing)
operators/  DataFrame operators: cleansing and rejects, surrogate keys,
            dimension upserts, enrichment joins, OLAP helpers
plans/      the business reports, diagnostics, views and their SQL oracles
streaming/  the Structured Streaming loader (foreachBatch, replay-safe)

``python -m starmart`` runs the same steps from a shell: load, report,
retry, compact.
"""

from starmart.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
