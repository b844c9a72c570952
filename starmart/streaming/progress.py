"""Progress of streaming loads as a table.

A ``StreamingQueryListener`` turns every progress report of a query into one row of the
warehouse's ``stream_progress`` folder: query, run, batch, rows, rates and the durations of
the batch's steps in milliseconds. The rows of a load can be joined with its ``loads``
ledger by ``ledger_batch_id`` (the stream's first id + the micro-batch's number).

Spark reports progress on a thread of its own, after the batch. A row is a line of JSON
in a file of its own, named by run and batch and written by the driver through the
warehouse's file system: no Spark job is started from the listener, and a report that is
made twice rewrites its file. Triggers that found nothing to do write no row.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

FOLDER = "stream_progress"
SCHEMA = ("query_id string, run_id string, batch_id long, ledger_batch_id long, reported_at string, input_rows long, "
          "input_rows_per_second double, processed_rows_per_second double, durations map<string,long>")


def progress_row(progress, first_id: int) -> dict:
    """The row of a ``StreamingQueryProgress``."""
    return {"query_id": str(progress.id), "run_id": str(progress.runId), "batch_id": progress.batchId,
            "ledger_batch_id": first_id + progress.batchId, "reported_at": progress.timestamp,
            "input_rows": progress.numInputRows, "input_rows_per_second": _finite(progress.inputRowsPerSecond),
            "processed_rows_per_second": _finite(progress.processedRowsPerSecond), "durations": dict(progress.durationMs)}


def _finite(x: float) -> float | None:
    return x if x is not None and abs(x) < float("inf") else None


class ProgressTable(StreamingQueryListener):
    """Writes the progress of the queries it is told to ``follow``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/{FOLDER}"
        self.first_ids: dict[str, int] = {}

    def follow(self, name: str, first_id: int) -> None:
        """Report the query of this name; told before its start, so that no batch is missed."""
        self.first_ids[name] = first_id

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        name = event.progress.name
        if name in self.first_ids and event.progress.numInputRows > 0:
            self.write(progress_row(event.progress, self.first_ids[name]))

    def write(self, row: dict) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{row['run_id']}-{row['batch_id']}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode()))
        finally:
            out.close()


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """The progress rows written so far."""
    folder = f"{root.rstrip('/')}/{FOLDER}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(folder)
