"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import starmart
from starmart.session import checkpoint_root

#: Arrow batches handed to Python workers: at most so many rows and bytes.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of one Arrow batch, so that a worker's memory
    does not follow the length of the texts (a text longer than the bound is a
    batch by itself)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # workers find this package where the driver does (a cluster without it there takes --py-files)
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(starmart.__file__)))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark).rstrip('/')}/starmart-llm/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str = "", path: str | None = None) -> DataFrame:
    """Write a result as Parquet in the shared folder and read it back: what is
    built on it neither repeats the work nor loses it with an executor. A caller
    that removes it names the ``path``."""
    path = path or scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
