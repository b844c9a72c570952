"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks (512 bytes every 448) that cover
all of it. Learned filters over 8 bytes, moved 4 bytes at a time, run over each chunk
and are max-pooled to one vector per chunk; the chunk vectors' mean, largest and
smallest values over the document go through a small layer to one probability.

The network (embedding, filters, layers) is fitted by gradient descent on all chunks of
labelled documents outside the held-out fold: the ``train_docs`` first ones in order of a
hash of their doc_id, as far as their texts hold at most ``train_bytes`` together (a text
that does not fit is left out whole and the next ones are tried). Scores use every byte of
every text, however long. Inputs are bytes of the text alone.

Null and empty texts are one chunk of padding and get a score like any other. Labels
that are null are not learned from; labels of unknown documents are ignored; of several
texts of one doc_id the one with the smallest hash, of several labels the smaller one counts. Without
labels of both kinds every score is the labels' rate (0.5 if there are none). Rows
that repeat a doc_id are rows of their own; a null doc_id is not held out; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, staged, table

WIDTH, STRIDE = 8, 4
#: Chunks are 8 blocks of 64 bytes, and share one block with the next.
BLOCK, CHUNK_BLOCKS = 64, 8
CHUNK, STEP = BLOCK * CHUNK_BLOCKS, BLOCK * (CHUNK_BLOCKS - 1)
EMBED, FILTERS, HIDDEN = 8, 32, 24
TRAIN_DOCS, TRAIN_BYTES = 3_000, 24_000_000
STEPS, BATCH = 750, 48
#: Bytes of padded text handled at once in a worker (a longer text is a block by itself).
BLOCK_BYTES = 1_500_000
THRESHOLD = 0.3
FOLDS = 5


def n_chunks(size: np.ndarray) -> np.ndarray:
    return np.maximum(0, -(-(size - CHUNK) // STEP)) + 1


def training_chunks(text: bytes) -> np.ndarray:
    """All chunks of a text, with the bytes that the last filter place reads."""
    n = int(n_chunks(np.array(len(text))))
    data = np.zeros((n - 1) * STEP + CHUNK + WIDTH, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    return np.stack([data[i * STEP : i * STEP + CHUNK + WIDTH - STRIDE] for i in range(n)])


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        f = np.float32
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(f),
            "filters": rng.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)).astype(f), "bias": np.zeros(FILTERS, f),
            "w1": rng.normal(0, (1 / (3 * FILTERS)) ** 0.5, (3 * FILTERS, HIDDEN)).astype(f), "b1": np.zeros(HIDDEN, f),
            "w2": rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN).astype(f), "b2": np.zeros(1, f),
        }
        self.p["embed"][0] = 0

    def head(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(features @ self.p["w1"] + self.p["b1"])
        return 1 / (1 + np.exp(-(hidden.astype(float) @ self.p["w2"] + self.p["b2"]))), hidden

    def fit(self, chunks: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = 5) -> None:
        """Adam on the log loss; a filter's gradient flows to its largest place in a chunk."""
        rng = np.random.default_rng(seed)
        p = self.p
        m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
        places = np.arange(CHUNK // STRIDE) * STRIDE
        step, total = 0, steps
        while step < total:
            order = rng.permutation(len(chunks))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                data = np.concatenate([chunks[i] for i in rows])
                sizes = np.array([len(chunks[i]) for i in rows])
                first = np.cumsum(sizes) - sizes
                doc = np.repeat(np.arange(len(rows)), sizes)
                half = p["embed"][data].reshape(len(data), -1, STRIDE * EMBED)
                cut = STRIDE * EMBED
                out = half[:, :-1] @ p["filters"][:cut] + half[:, 1:] @ p["filters"][cut:] + p["bias"]
                where = out.argmax(1)
                pooled = np.maximum(0, np.take_along_axis(out, where[:, None], 1)[:, 0])
                mean = np.add.reduceat(pooled, first) / sizes[:, None]
                high, low = np.maximum.reduceat(pooled, first), np.minimum.reduceat(pooled, first)
                features = np.concatenate([mean, high, low], 1)
                score, hidden = self.head(features)
                g = ((score - labels[rows]) / len(rows)).astype(np.float32)
                back = g[:, None] * p["w2"] * (1 - hidden * hidden)
                f = back @ p["w1"].T
                d = (f[:, :FILTERS] / sizes[:, None])[doc]
                d = d + f[doc, FILTERS : 2 * FILTERS] * (pooled == high[doc]) + f[doc, 2 * FILTERS :] * (pooled == low[doc])
                d *= pooled > 0
                window = np.stack([data[np.arange(len(data))[:, None], places[where] + i] for i in range(WIDTH)], 2)
                inputs = p["embed"][window].reshape(len(data), FILTERS, WIDTH * EMBED)
                grads = {"filters": np.einsum("cfi,cf->if", inputs, d), "bias": d.sum(0), "w1": features.T @ back, "b1": back.sum(0),
                         "w2": hidden.T @ g, "b2": g.sum(keepdims=True)}
                spread = (d[:, :, None] * p["filters"].T[None]).reshape(-1, EMBED)
                grads["embed"] = np.stack([np.bincount(window.ravel(), spread[:, j], 256) for j in range(EMBED)], 1)
                grads["embed"][0] = 0
                step += 1
                rate = 0.004 * (1 - 0.9 * step / total)
                for k, x in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * x
                    v[k] = 0.999 * v[k] + 0.001 * x * x
                    p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probabilities of whole texts."""
        raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
        size = pc.binary_length(raw).to_numpy()
        padded = (n_chunks(size) - 1) * STEP + CHUNK
        ends = np.cumsum(padded)
        out, at = [], 0
        while at < len(raw):
            done = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, done + BLOCK_BYTES, "right")) - at)
            out.append(self._block(raw.slice(at, n), size[at : at + n], padded[at : at + n]))
            at += n
        return np.concatenate(out) if out else np.zeros(0)

    def _block(self, raw: pa.Array, size: np.ndarray, padded: np.ndarray) -> np.ndarray:
        ends = np.cumsum(padded)
        data = np.zeros(ends[-1], np.uint8)
        cuts = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        source = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
        for a, n, to in zip(cuts.tolist(), size.tolist(), (ends - padded).tolist()):
            data[to : to + n] = source[a : a + n]
        half = self.p["embed"][data].reshape(-1, STRIDE * EMBED)
        out = half @ self.p["filters"][: STRIDE * EMBED]
        after = half @ self.p["filters"][STRIDE * EMBED :]
        after[ends[:-1] // STRIDE] = 0  # what follows a text's last place is no part of it
        out[:-1] += after[1:]
        out += self.p["bias"]
        blocks = np.maximum(0, out.reshape(-1, BLOCK // STRIDE, FILTERS).max(1))
        chunks = n_chunks(size)
        doc = np.repeat(np.arange(len(size)), chunks)
        start = (ends - padded)[doc] // BLOCK + (np.arange(len(doc)) - (np.cumsum(chunks) - chunks)[doc]) * (CHUNK_BLOCKS - 1)
        pooled = blocks[start]
        for i in range(1, CHUNK_BLOCKS):
            np.maximum(pooled, blocks[start + i], out=pooled)
        first = np.cumsum(chunks) - chunks
        features = np.concatenate([np.add.reduceat(pooled, first) / chunks[:, None], np.maximum.reduceat(pooled, first), np.minimum.reduceat(pooled, first)], 1)
        return self.head(features.astype(np.float32))[0]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, known: DataFrame, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """(quality, text) of at most ``train_docs`` documents with at most ``train_bytes``
    together, from known rows (doc_id, quality): whole texts, one for each doc_id."""
    first = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    chosen = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(first, "doc_id").limit(train_docs)
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.octet_length("text"))).alias("text"))
    texts = staged(texts.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0))), "quality-train")
    # at most train_docs rows: a text that does not fit into what is left is passed over
    left, fitting = train_bytes, []
    for r in texts.select("doc_id", "size").orderBy(first, "doc_id").collect():
        if r["size"] <= left:
            left -= r["size"]
            fitting.append(r["doc_id"])
    return texts.where(F.col("doc_id").isin(fitting)).select("quality", "text")


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> tuple[Network | None, float]:
    """The network, or none without labels of both kinds, and the labels' rate."""
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("quality"))
    n, rate = known.agg(F.count("*"), F.avg("quality")).first()
    if not n:
        return None, 0.5
    found = training_rows(docs, known, train_docs, train_bytes).collect()
    rows = sorted(((r["text"] or "").encode(), r["quality"]) for r in found)  # the same network whatever the order of the rows
    target = np.array([q for _, q in rows], float)
    if not rows or target.min() == target.max():
        return None, float(rate)
    network = Network()
    network.fit([training_chunks(text) for text, _ in rows], target)
    return network, float(rate)


def score(docs: DataFrame, network: Network | None, rate: float) -> DataFrame:
    """Per row of (doc_id, text): doc_id, score."""

    def run(batches):
        for batch in batches:
            s = network.scores(batch.column(1)) if network else np.full(batch.num_rows, rate)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    network, rate = fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return score(docs, network, rate).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                             (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
