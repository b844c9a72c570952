"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and is written as Parquet and read back before the next one. The last stage
returns the packed pieces, the others rows with the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import decontam, jaccard_join, language_id, packing, secrets
from starmart.llm.common import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def row_key(seed: int, *columns: str) -> Column:
    """A hash of the columns that tells nulls apart from values. Two of other seeds tell
    apart rows that share one by chance."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language; the others go. ``lang`` becomes the
    identified one. Rows that repeat a doc_id are judged one by one, by their text."""
    keyed = docs.withColumn("row_key", row_key(1, "doc_id", "text", "lang", "source"))
    rows = language_id.evidence(keyed, "row_key", F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("source"))
    found = language_id.identify(rows).where("accepted").select(F.col("key").alias("row_key"), F.col("lang").alias("found")).dropDuplicates(["row_key"])
    return keyed.join(found, "row_key").withColumn("lang", F.col("found")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (the one with the smallest hash of its
    doc_id and text); of wholly equal rows one. Documents without words stay."""
    keyed = docs.withColumn("row_key", row_key(1, "doc_id", "text")).withColumn("row_key_2", row_key(2, "doc_id", "text"))
    groups = jaccard_join.near_duplicates(keyed.select(F.col("row_key").alias("doc_id"), "text"))
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(kept, "row_key").dropDuplicates(["row_key", "row_key_2"]).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; found secrets are replaced in the text, and n_chars follows it."""
    clean = secrets.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all documents into sequences of 2048 tokens."""
    packed = packing.pack(docs.select("doc_id", "text"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", keep_identified),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: No SQL form: the stages run learned models, exact joins on shingles and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents`` in order."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
