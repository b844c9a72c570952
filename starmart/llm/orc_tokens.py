"""Token-id output as ORC.

``write_tokens`` encodes every text and writes the ids as ORC in ascending
document order: integer run-length encoding of the id lists, row indexes, and
Bloom filters on ``doc_id``; stripes are small enough that one file is read by
several tasks. ``read_tokens`` reads the files back, ``documents`` looks single
documents up (range of the stripe statistics and Bloom filters prune stripes and
row groups), and ``digest`` computes each document's place and checksum.

Rows are ranged by (doc_id, a hash of the text), so repeated ids do not meet in
one task; a null text counts as empty and gives only the end id; a null doc_id
sorts first; repeated doc_ids are kept as rows of their own; an empty table
gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, small_batches, table
from .tokens import default_path, encoder

END_ID = 2
STRIPE_BYTES = 16 << 20
BLOOM_FPP = 0.01

TOKENS = "doc_id long, seq long, n_tokens long, ids array<int>"


def encode_rows(tokenizer_path: str, end_id: int | None):
    """mapInArrow function: (doc_id, text) to TOKENS; ``seq`` counts a task's rows."""

    def run(batches):
        enc = encoder(tokenizer_path)
        seq = 0
        for batch in batches:
            doc = batch.column(0)
            for at, ids, cuts in enc.encode(batch.column(1)):
                n = len(cuts) - 1
                if end_id is not None:
                    ids = np.insert(ids, cuts[1:], end_id)
                    cuts = cuts + np.arange(n + 1)
                values = pa.array(ids.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.slice(at, n),
                        pa.array(np.arange(seq, seq + n)),
                        pa.array(np.diff(cuts).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values),
                    ],
                    names=["doc_id", "seq", "n_tokens", "ids"],
                )
                seq += n

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int | None = END_ID,
                 stripe_bytes: int = STRIPE_BYTES) -> None:
    """Write (doc_id, text) rows as ORC token files in ascending doc_id order."""
    small_batches(docs.sparkSession)
    rows = (docs.select(F.col("doc_id").cast("long"), "text")
            .repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id"))
    (rows.mapInArrow(encode_rows(tokenizer_path or default_path(), end_id), TOKENS)
     .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(BLOOM_FPP))
     .option("orc.create.index", "true").option("orc.stripe.size", str(stripe_bytes)).option("compression", "snappy")
     .orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; ``part`` numbers the files in document order."""
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    return spark.read.schema(TOKENS).orc(path).select("*", part.alias("part"))


def documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; the filter prunes files' stripes and row groups."""
    return spark.read.schema(TOKENS).orc(path).where(F.col("doc_id").isin([int(x) for x in doc_ids]))


def _checksums(batches):
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        cuts = ids.offsets.to_numpy()
        values = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))
        crc = [zlib.crc32(values[a:b]) for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(crc, pa.int64())],
            names=["doc_id", "part", "seq", "n_tokens", "ids_crc32"])


def digest(tokens: DataFrame) -> DataFrame:
    """Per row of the files: doc_id, start, n_tokens, ids_crc32.

    A file's first start is the sum of the files before it (one row per file);
    within a file it is a running sum over the file's own rows."""
    small_batches(tokens.sparkSession)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
             .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    rows = (tokens.select("doc_id", "part", "seq", "n_tokens", "ids")
            .mapInArrow(_checksums, "doc_id long, part long, seq long, n_tokens long, ids_crc32 long"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(bases, "part")
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def op5_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "op5-orc")
    write_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return digest(read_tokens(spark, path))
