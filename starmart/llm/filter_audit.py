"""Filter interaction audit on a sparse document-term matrix.

Texts become CSR shards of bounded size: a row for each document, with the counts of its
words. The distinct words of all shards are dealt out by word, and numbered there in their
order: the global dictionary. A shard holds the global numbers of its own columns, and its
entries point to these (``global_entries`` spells them out). Filters A and B read the matrix
only: a row's sum is the document's word count, its number of nonzeros the distinct words.
The other flags stand beside the rows: C and D from the text's bytes, E from the smallest
doc_id of equal texts.

Documents are then counted by (part, set of failed filters, labels), at most 32 sets a
part, and every order and step is read off these counts: what a set of filters leaves is
the sum over the sets that avoid it.

Null texts are empty (they fail A and C not; B not: 0 < 0 is false), a null source is the
empty part. Rows that repeat a doc_id are rows of their own; equal texts of one doc_id do not
make each other fail E, nor do null doc_ids, which are never smaller or larger. A doc_id
with several labels counts as good (toxic) if any says so; null doc_ids have no labels.
Other columns are ignored; an empty table gives no rows. A very long text is a shard of
its own.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import delete_path

from .common import scratch, small_batches, staged, table

FILTERS = "ABCDE"
MIN_WORDS = 200
#: Least share of distinct words, and most of capitals, in percent.
DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 2
SYMBOLS = b"#$%&*|"

_CAPITAL, _SYMBOL, _BLANK = (np.zeros(256, bool) for _ in range(3))
_CAPITAL[65:91] = True
_SYMBOL[list(SYMBOLS)] = True
_BLANK[[32, *range(9, 14)]] = True
_TO_BLANK = bytes.maketrans(bytes(range(9, 14)), b" " * 5)

ROW = "struct<doc_id:long,part:string,text_key:binary,chars:long,capitals:long,symbols:boolean>"
#: Row i of a shard has the entries indptr[i] to indptr[i + 1]: places in columns, and counts.
#: Entries are packed (``pack``); columns hold the words' global numbers.
SHARD = f"block long, rows array<{ROW}>, indptr array<long>, indices binary, data binary"
ROW_TYPE = pa.struct([("doc_id", pa.int64()), ("part", pa.string()), ("text_key", pa.binary()), ("chars", pa.int64()), ("capitals", pa.int64()),
                      ("symbols", pa.bool_())])
#: Bits of a word's number that name the task that numbered it.
TASK_BITS = 20
#: Bytes of text in one shard, and of text counted at once in a worker (a longer text is a block by itself).
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20


def pack(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).reshape(-1).view("<i4")


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    places = np.flatnonzero(flags)
    return np.diff(np.searchsorted(places, ends))


def csr_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a block, and its CSR matrix by their numbers."""
    raw = b" ".join(bytes(t.as_buffer()).translate(_TO_BLANK) + b" \t" for t in texts)  # a tab ends a row
    whole = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(raw)], np.int64)), pa.py_buffer(raw)])
    coded = pc.split_pattern(whole, " ").flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    ends = codes == pc.index(words, pa.scalar("\t", words.type)).as_py()
    word = ~ends & (codes != pc.index(words, pa.scalar("", words.type)).as_py())
    row = np.cumsum(ends)[word]
    entries, data = np.unique(row * len(words) + codes[word], return_counts=True)
    used, indices = np.unique(entries % len(words), return_inverse=True)
    indptr = np.searchsorted(entries // len(words), np.arange(len(texts) + 1))
    return words.take(pa.array(used)), indptr, indices.astype(np.int32), data.astype(np.int32)


def _one(values, kind: pa.DataType) -> pa.Array:
    values = values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def row_values(batch: pa.RecordBatch) -> pa.Array:
    texts = batch.column(3).cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    return pa.StructArray.from_arrays(
        [batch.column(0), batch.column(1).cast(pa.string()), batch.column(2).cast(pa.binary()), pa.array(_sums((raw & 0xC0) != 0x80, ends)),
         pa.array(_sums(_CAPITAL[raw], ends)), pa.array(_sums(_SYMBOL[raw], ends) > 0)], fields=list(ROW_TYPE))


def blocks(batch: pa.RecordBatch):
    """Slices of about BLOCK_BYTES of text."""
    ends = np.cumsum(pc.binary_length(batch.column(3)).to_numpy())
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, "right")) - at)
        yield batch.slice(at, n)
        at += n


def local_shards(batches):
    """(doc_id, part, text_key, text) batches to shards of about SHARD_BYTES, and their words."""
    held: list[tuple] = []
    size = number = 0

    def shard():
        words = pa.concat_arrays([w for _, w, _, _, _ in held]).dictionary_encode()
        place, at, indptr, entries = words.indices.to_numpy(), 0, [np.zeros(1, np.int64)], 0
        indices, data = (np.empty(sum(len(d) for *_, d in held), np.int32) for _ in range(2))
        for _, w, ends, columns, counts in held:
            indptr.append(ends[1:] + entries)
            indices[entries : entries + ends[-1]] = place[at : at + len(w)][columns]
            data[entries : entries + ends[-1]] = counts
            at, entries = at + len(w), entries + ends[-1]
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId() << 32 | number], pa.int64()), _one(pa.concat_arrays([r for r, *_ in held]), ROW_TYPE),
             _one(np.concatenate(indptr), pa.int64()), pa.array([pack(indices)], pa.binary()), pa.array([pack(data)], pa.binary()),
             _one(words.dictionary, pa.string())],
            names=["block", "rows", "indptr", "indices", "data", "words"])

    for batch in batches:
        for block in blocks(batch):
            texts = block.column(3).cast(pa.large_binary())
            held.append((row_values(block), *csr_of(texts)))
            size += pc.sum(pc.binary_length(texts)).as_py()
        if size >= SHARD_BYTES:
            yield shard()
            held, size, number = [], 0, number + 1
            pa.default_memory_pool().release_unused()
    if held:
        yield shard()


def numbered(batches):
    """(word, block, place) rows, dealt out by word and sorted by it, with the word's global number:
    its place among the task's words, then the task. ``first``: the word's first row."""
    last, at, task = None, -1, TaskContext.get().partitionId()
    for batch in batches:
        if not batch.num_rows:
            continue
        words = batch.column(0)
        new = np.append(words[0].as_py() != last, pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False))
        places = at + np.cumsum(new)
        last, at = words[-1].as_py(), int(places[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((places << TASK_BITS) | task, pa.int64()), pa.array(new)],
                                         names=["word", "block", "place", "number", "first"])


def in_place(batches):
    """Shards with (place, number) of their words to shards with their columns."""
    for batch in batches:
        names = batch.column(5)
        for i in range(batch.num_rows):
            columns = np.empty(0, np.int64)
            if names[i].is_valid:
                place, number = (names[i].values.field(c).to_numpy() for c in (0, 1))
                columns = np.empty(len(place), np.int64)
                columns[place] = number
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, 1) for c in range(5)], _one(columns, pa.int64())],
                                             names=["block", "rows", "indptr", "indices", "data", "columns"])


def document_term_matrix(docs: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The global dictionary (word, number) of (doc_id, part, text_key, text) rows, and
    their matrix as CSR shards: SHARD and ``columns``. The dictionary is read from shards
    in ``path``, which the caller removes when it is done with it."""
    spark = docs.sparkSession
    small_batches(spark)
    local = staged(docs.select("doc_id", "part", "text_key", "text").mapInArrow(local_shards, SHARD + ", words array<string>"), path=path)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = local.select(F.posexplode("words").alias("place", "word"), "block").select("word", "block", "place").repartition(tasks, "word").sortWithinPartitions("word")
    found = dealt.mapInArrow(numbered, "word string, block long, place int, number long, first boolean")
    # a shard's distinct words: at most its text
    names = found.groupBy("block").agg(F.collect_list(F.struct("place", "number")).alias("names"))
    shards = local.drop("words").join(names, "block", "left").select("block", "rows", "indptr", "indices", "data", "names").mapInArrow(in_place, SHARD + ", columns array<long>")
    matrix = staged(shards, "matrix")
    return found.where("first").select("word", "number"), matrix


def global_entries(shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """indptr, global word numbers and counts of one shard."""
    return np.array(shard["indptr"]), np.array(shard["columns"], np.int64)[unpack(shard["indices"])], unpack(shard["data"])


def row_statistics(batches):
    """Shards to their rows with the row's sum and number of nonzeros."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows, ends, data = batch.column("rows")[i].values, batch.column("indptr")[i].values.to_numpy(), unpack(batch.column("data")[i].as_buffer())
            before = np.zeros(len(data) + 1, np.int64)
            np.cumsum(data, out=before[1:])
            yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.array(np.diff(before[ends])), pa.array(np.diff(ends))],
                                             names=["doc_id", "part", "text_key", "chars", "capitals", "symbols", "words", "distinct_words"])


STATISTICS = "doc_id long, part string, text_key binary, chars long, capitals long, symbols boolean, words long, distinct_words long"


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part and ``failed`` (bit i: fails filter i of FILTERS) of (doc_id, text, source) rows."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"), text.alias("text"))
    path = scratch(docs.sparkSession, "matrix-local")
    _, matrix = document_term_matrix(rows, path)
    delete_path(docs.sparkSession, path)
    found = matrix.select("rows", "indptr", "data").mapInArrow(row_statistics, STATISTICS)
    # by text, so that a group of any size is reduced before the shuffle; its smallest id then meets that document only
    firsts = matrix.select(F.explode("rows").alias("r")).select("r.text_key", "r.doc_id").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.where("doc_id is not null").withColumn("first", F.lit(True))
    flags = [F.col("words") < MIN_WORDS, F.col("distinct_words") * 100 < F.col("words") * DISTINCT_PERCENT,
             F.col("capitals") * 100 > F.col("chars") * CAPITAL_PERCENT, F.col("symbols"), F.col("first").isNull() & F.col("doc_id").isNotNull()]
    failed = sum((F.when(f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(flags)), F.lit(0))
    return found.join(firsts, ["text_key", "doc_id"], "left").select("doc_id", "part", failed.alias("failed"))


def audit(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts for every part, order and step from (doc_id, part, failed) and labels
    (doc_id, quality, toxic)."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("long"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("long"), F.lit(0))).alias("toxic"))
    sets = (failed.join(marks, "doc_id", "left").groupBy("part", "failed")
            .agg(F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))
    subsets = range(1 << len(FILTERS))
    left = lambda c: F.array(*[F.sum(F.when(F.col("failed").bitwiseAND(s) == 0, F.col(c)).otherwise(0)) for s in subsets])
    only = F.array(*[F.sum(F.when(F.col("failed") == 1 << i, F.col("n")).otherwise(0)) for i in range(len(FILTERS))])
    orders = 1
    for i in range(2, len(FILTERS) + 1):
        orders *= i
    # a failing document is removed by each of its failed filters in equally many orders
    share = lambda i: F.sum(F.when(F.col("failed").bitwiseAND(1 << i) != 0, F.col("n") * F.expr(f"{orders} div bit_count(failed)")).otherwise(0))
    parts = sets.groupBy("part").agg(*[left(c).alias(c) for c in ("n", "good", "toxic")], only.alias("only"),
                                     F.array(*[share(i) for i in range(len(FILTERS))]).alias("shapley"))
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for k, i in enumerate(order):
            steps.append(("".join(FILTERS[j] for j in order), k + 1, i, before, before | 1 << i))
            before |= 1 << i
    kind = "array<struct<filter_order:string,step:int,filter:int,before:int,after:int>>"
    text = ",".join('{"filter_order":"%s","step":%d,"filter":%d,"before":%d,"after":%d}' % s for s in steps)
    each = parts.withColumn("s", F.explode(F.from_json(F.lit(f"[{text}]"), kind)))
    at = lambda c, s: F.get(F.col(c), F.col(f"s.{s}"))
    gone = lambda c: at(c, "before") - at(c, "after")
    fails = F.get(F.col("n"), F.lit(0)) - F.get(F.col("n"), F.call_function("shiftleft", F.lit(1), F.col("s.filter")))
    return each.select("part", "s.filter_order", "s.step", at("n", "after").alias("kept"), gone("n").alias("removed"), (fails - gone("n")).alias("redundant"),
                       at("only", "filter").alias("unique_fails"), gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"),
                       at("shapley", "filter").alias("shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failures(table(spark, sf_dir, "documents", "doc_id", "text", "source")), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op11_sql() -> str:
    """The same rows in DuckDB SQL, order by order and step by step."""
    bits = ", ".join(f"('{f}', {1 << i})" for i, f in enumerate(FILTERS))
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations(FILTERS))
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
f AS (SELECT w.doc_id, part,
    (CASE WHEN len(words) < {MIN_WORDS} THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END) AS failed
  FROM w),
m AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN m ON f.doc_id = m.doc_id GROUP BY part, failed),
b(name, bit) AS (VALUES {bits}),
o AS (SELECT filter_order, k AS step, filter_order[k:k] AS name, filter_order[1:k - 1] AS earlier
  FROM (VALUES {orders}) v(filter_order), range(1, {len(FILTERS) + 1}) r(k)),
s AS (SELECT filter_order, step, o.name, b.bit, coalesce((SELECT sum(e.bit) FROM b e WHERE contains(o.earlier, e.name)), 0)::INTEGER AS before
  FROM o JOIN b ON o.name = b.name),
x AS (SELECT part, filter_order, step, name,
    sum(CASE WHEN failed & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failed & before = 0 AND failed & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failed & before <> 0 AND failed & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failed & before = 0 AND failed & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failed & before = 0 AND failed & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, name)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, name))::BIGINT AS shapley FROM x"""
