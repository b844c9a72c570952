"""Raw file sources (master CSVs, transaction files and stream) and exports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import CUSTOMER_RAW, PRODUCT_RAW, TRANSACTION_RAW


#: The line of a master row that does not fit the columns; the file of a transaction.
CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"


def _header_schema(spark: SparkSession, path, raw: T.StructType, glob: str | None = None) -> T.StructType:
    """String columns in the order of the files' header. Columns are found by name:
    any order and extra columns are fine, a missing column is an error."""
    r = spark.read.option("header", True)
    found = (r.option("pathGlobFilter", glob) if glob else r).csv(path).columns
    missing = [c for c in raw.names if c not in found]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {found}")
    return T.StructType([T.StructField(c, T.StringType()) for c in found])


def _read_csv(spark: SparkSession, path, raw: T.StructType, corrupt: bool = False) -> DataFrame:
    """CSV rows by header name; a file whose header differs from the others' fails the read.
    With ``corrupt``, a row that does not fit the columns keeps its line in ``CORRUPT``."""
    schema = _header_schema(spark, path, raw)
    r = spark.read.option("header", True).option("enforceSchema", False)
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return r.schema(schema).csv(path)


def _in_file_order(df: DataFrame, raw: T.StructType) -> DataFrame:
    """The raw columns, the line of a row that does not fit them, and where a row stands: file, block in it."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return df.select(*raw.names, CORRUPT, place.alias("_file"))


def _with_source(df: DataFrame) -> DataFrame:
    """The transaction columns, and the file that a row comes from."""
    m = F.col("_metadata")
    return df.select(*TRANSACTION_RAW.names, F.struct(m["file_path"].alias("path"), m["file_size"].alias("length"),
                                                      m["file_modification_time"].alias("modified")).alias(SOURCE_FILE))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder: path, length, modified. No content is read."""
    m = F.col("_metadata")
    files = spark.read.format("binaryFile").load(path)
    return files.select(m["file_path"].alias("path"), m["file_size"].alias("length"), m["file_modification_time"].alias("modified"))


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customer master CSV with a header row."""
    return _in_file_order(_read_csv(spark, path, CUSTOMER_RAW, corrupt=True), CUSTOMER_RAW)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product master CSV; ``price$`` stays as read and is renamed by cleansing."""
    return _in_file_order(_read_csv(spark, path, PRODUCT_RAW, corrupt=True), PRODUCT_RAW)


def read_transactions(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    """Transactions as a batch (a folder, file or list of files of CSV / Parquet), and the
    file of each (``SOURCE_FILE``)."""
    if fmt == "csv":
        return _with_source(_read_csv(spark, path, TRANSACTION_RAW))
    return _with_source(spark.read.schema(TRANSACTION_RAW).format(fmt).load(path))


def _n_bytes(size: str | int) -> int:
    """Bytes of a size such as 512m or 4g."""
    text = str(size).strip().lower()
    factor = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1:], 1)
    return int(text[:-1] if factor > 1 else text) * factor


def stream_transactions(spark: SparkSession, landing_dir: str, fmt: str = "csv",
                        max_files_per_trigger: int | None = None,
                        max_bytes_per_trigger: str | None = None,
                        glob: str | None = None) -> DataFrame:
    """Unbounded transactions from a landing folder (oldest files first).

    The rate limits bound each micro-batch, which bounds the memory of the
    enrichment join and of the per-batch cache: the back-pressure the
    producer/consumer queue of a hand-written loader lacks.
    """
    schema = TRANSACTION_RAW
    if fmt == "csv":
        try:
            schema = _header_schema(spark, landing_dir, TRANSACTION_RAW, glob)
        except AnalysisException:  # nothing landed yet: files are expected in the documented order
            pass
    r = spark.readStream.schema(schema).option("latestFirst", False)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", _n_bytes(max_bytes_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if fmt == "csv":
        r = r.option("header", True).option("enforceSchema", False)
    return _with_source(r.format(fmt).load(landing_dir))


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a report's result (the batch 'results.txt' of a SQL client)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
