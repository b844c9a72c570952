"""Structured Streaming enrichment pipeline.

    landing folder --readStream--> micro-batch --foreachBatch--> loader
                                                   (dims, facts, rejects)

* micro-batching and back-pressure: ``maxBytesPerTrigger`` (or
  ``maxFilesPerTrigger``) bounds a batch, so batch size stays fixed while
  the number of batches grows with the data;
* oldest files first (``latestFirst`` false);
* drain and stop: ``availableNow`` processes what is there, then stops;
  ``processingTime`` keeps polling;
* exactly-once: the source offsets and the batch id live in the
  checkpoint folder; the loader's writes are idempotent per batch id, so a
  batch re-run after a failure rewrites the same partitions;
* progress: ``StreamingQuery.lastProgress`` plus the loader's per-batch
  loaded / rejected counts.

The checkpoint folder must be on shared storage (by default it is in the
warehouse, by landing folder) so the query survives the loss of any executor
or a driver restart.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starmart.sources.files import stream_transactions
from starmart.sources.warehouse import Warehouse
from starmart.streaming.loader import WarehouseLoader
from starmart.streaming.progress import ProgressTable

#: Input of one micro-batch.
DEFAULT_TRIGGER_BYTES = "4g"


def _drain(q: StreamingQuery, timeout_s: float | None) -> None:
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream did not drain within {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def start_loader(spark: SparkSession, warehouse: Warehouse, landing_dir: str,
                 checkpoint_location: str | None = None, fmt: str = "csv",
                 max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = DEFAULT_TRIGGER_BYTES,
                 available_now: bool = True,
                 processing_time: str = "10 seconds", glob: str | None = None,
                 loader: WarehouseLoader | None = None,
                 progress: ProgressTable | None = None) -> tuple[StreamingQuery, WarehouseLoader]:
    """Start the streaming load of ``landing_dir`` into ``warehouse``.

    Micro-batches are bounded by bytes, or by files if ``max_files_per_trigger`` is
    given. The checkpoint lives in the warehouse, one per landing folder, so a new
    process goes on where the last one stopped. The micro-batches' ids lie in a range
    of the landing folder's own, so streams and one-shot loads never share one."""
    loader = loader or WarehouseLoader(warehouse)
    source = hashlib.sha256(landing_dir.rstrip("/").encode()).hexdigest()[:16]
    first_id = warehouse.stream_first_id(f"stream:{source}")
    ckpt = checkpoint_location or f"{warehouse.root.rstrip('/')}/_checkpoints/{source}"
    if max_files_per_trigger:
        max_bytes_per_trigger = None  # the two limits are exclusive
    stream = stream_transactions(spark, landing_dir, fmt=fmt,
                                 max_files_per_trigger=max_files_per_trigger,
                                 max_bytes_per_trigger=max_bytes_per_trigger, glob=glob)
    w = stream.writeStream.foreachBatch(
        lambda df, n: loader.micro_batch(df, first_id + n, f"stream:{source}")).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    if progress:
        name = f"starmart-{source}-{uuid.uuid4().hex[:8]}"
        progress.follow(name, first_id)
        w = w.queryName(name)
    return w.start(), loader


def run_to_completion(spark: SparkSession, warehouse: Warehouse, landing_dir: str,
                      timeout_s: float | None = None, **kw) -> WarehouseLoader:
    """Drain ``landing_dir`` with ``availableNow`` and wait for the stop, as long as it takes."""
    q, loader = start_loader(spark, warehouse, landing_dir, available_now=True, **kw)
    _drain(q, timeout_s)
    return loader


def stream_static_join(stream: DataFrame, master: DataFrame, on: Column | str | list,
                       how: str = "inner") -> DataFrame:
    """Join an unbounded stream with a static master relation.

    Each micro-batch is joined with the master as it is when the batch runs.
    With the stream on the left, ``inner``, ``left``, ``left_semi`` and
    ``left_anti`` are allowed (an outer join on the static side would need
    state for ever). The strategy is Catalyst's: a master under the
    broadcast threshold is broadcast to the batch, a larger one is joined by
    shuffle every batch.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} is not supported with the stream on the left")
    return stream.join(master, on, how)


def run_file_sink(df: DataFrame, path: str, checkpoint_location: str, partition_by=(),
                  available_now: bool = True, timeout_s: float | None = None) -> StreamingQuery:
    """Write a stream to Parquet with the exactly-once file sink (the sink's
    own log under ``path/_spark_metadata`` lists the committed files, so a
    re-run batch never duplicates rows for readers), and wait for the drain."""
    w = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        _drain(q, timeout_s)
    return q
