"""Approximate nearest neighbours by learned partitions.

On a bounded sample of the vectors the graph of nearest neighbours is cut into
balanced parts (recursive median splits, then moves of single vectors to the part
that holds most of their neighbours, within a size limit). A small network learns to
tell a vector's part, trained on the shares of its neighbours in each part. Every
vector is indexed in the part the network finds most probable; a query is routed to
its several most probable parts and ranked there by exact distance in double
precision. How many parts a query visits is chosen on sample queries, as the least
number that reaches ``recall`` of their true neighbours in the sample.

The number of parts grows with the square root of the rows, to ``MAX_PARTS``.

Parts are dealt in blocks of about ``block_rows`` vectors and ``query_rows`` queries, so a
part that holds a large share of all rows (a very common vector) is many tasks; each
block gives a query's best k, and the best k of those are kept: nothing is dropped.

Vectors that are null, all zero, or hold a null, NaN or infinite component take no
part; vectors of another length than the most common one (of equally common ones the
smallest) neither, as no distance to the others is defined. Equal distances go to the
smaller id. Rows that repeat an id stand once, with the smallest of their vectors
(compared component by component). An empty table gives no rows. Columns other than the
two named are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, staged, table

SAMPLE = 6_000
NEIGHBOURS = 10
#: Parts are the square root of the rows over this, MAX_PARTS at most.
PART_ROOT, MAX_PARTS = 4, 64
HIDDEN, EPOCHS = 128, 60
RECALL = 0.94
BLOCK_ROWS, QUERY_ROWS = 4_000, 2_000
#: Queries measured against a block of vectors by one matrix product.
PRODUCT_ROWS = 200
K = 10


def nearest(x: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    """Places in x of the k nearest to each row of q (itself included), in blocks."""
    norm = (x * x).sum(1)
    out = []
    for at in range(0, len(q), 1000):
        d = norm - 2 * q[at : at + 1000] @ x.T
        out.append(np.argpartition(d, min(k, len(x) - 1), axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Cut the neighbour graph into parts of nearly equal size with few cut edges."""
    part = np.zeros(len(x), int)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        if n == 1:
            part[rows] = first
            continue
        centred = x[rows] - x[rows].mean(0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = np.argsort(centred @ axis, kind="stable")
        cut = len(rows) * (n // 2) // n
        todo += [(rows[order[:cut]], first, n // 2), (rows[order[cut:]], first + n // 2, n - n // 2)]
    limit = int(1.15 * len(x) / parts) + 1
    both = [set(g) for g in graph.tolist()]
    for i, g in enumerate(graph.tolist()):
        for j in g:
            both[j].add(i)
    lists = [np.fromiter(g, int) for g in both]
    size = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for i, near in enumerate(lists):
            votes = np.bincount(part[near], minlength=parts)
            votes[size >= limit] = -1
            best = int(votes.argmax())
            here = part[i]
            if best != here and votes[best] > (part[near] == here).sum():
                part[i] = best
                size[here] -= 1
                size[best] += 1
                moved += 1
        if moved < len(x) // 1000 + 1:
            break
    return part


class Router:
    """A network with one hidden layer: vectors to log-probabilities of parts."""

    def __init__(self, x: np.ndarray, target: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std() + 1e-12
        h = (x - self.mean) / self.scale
        w = [rng.normal(0, (2 / h.shape[1]) ** 0.5, (h.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, target.shape[1])), np.zeros(target.shape[1])]
        m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(h))
            for at in range(0, len(h), 256):
                rows = order[at : at + 256]
                a = np.maximum(0, h[rows] @ w[0] + w[1])
                z = a @ w[2] + w[3]
                p = np.exp(z - z.max(1, keepdims=True))
                g = (p / p.sum(1, keepdims=True) - target[rows]) / len(rows)
                back = (g @ w[2].T) * (a > 0)
                step += 1
                for i, d in enumerate((h[rows].T @ back, back.sum(0), a.T @ g, g.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * d
                    v[i] = 0.999 * v[i] + 0.001 * d * d
                    w[i] -= 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.w = w

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(0, (x - self.mean) / self.scale @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]


class Index:
    """Router and number of parts to visit, fitted on a sample."""

    def __init__(self, x: np.ndarray, parts: int, recall: float = RECALL, k: int = K):
        parts = max(1, min(parts, len(x) // (4 * NEIGHBOURS)))
        self.dim, self.parts, self.visits, self.router = x.shape[1], parts, 1, None
        if parts == 1:
            return
        held = np.arange(len(x)) % 5 == 0  # sample queries: not used to fit
        base, queries = x[~held], x[held]
        graph = nearest(base, base, NEIGHBOURS + 1)
        part = balanced_parts(base, graph, parts)
        target = np.zeros((len(base), parts))
        for column in graph.T:
            np.add.at(target, (np.arange(len(base)), part[column]), 1 / graph.shape[1])
        self.router = Router(base, target)
        home = self.router.scores(base).argmax(1)
        truth = home[nearest(base, queries, k)]
        order = np.argsort(-self.router.scores(queries), axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(len(order), 0), 1)
        found = np.take_along_axis(rank, truth, 1)
        self.visits = next((t for t in range(1, parts) if (found < t).mean() >= recall), parts)

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.router.scores(x).argmax(1) if self.router else np.zeros(len(x), int)

    def route(self, x: np.ndarray) -> np.ndarray:
        if not self.router:
            return np.zeros((len(x), 1), int)
        return np.argsort(-self.router.scores(x), axis=1, kind="stable")[:, : self.visits]


def valid_vectors(df: DataFrame) -> DataFrame:
    x = F.col("embedding").cast("array<double>")
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return df.select(F.col("vec_id").cast("long"), x.alias("embedding")).where(F.col("vec_id").isNotNull() & ok)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dim)


def assign_rows(index: Index):
    def run(batches):
        for batch in batches:
            part = index.home(_matrix(batch.column(1), index.dim))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(part.astype(np.int32))], names=["vec_id", "embedding", "part"])

    return run


def route_rows(index: Index):
    def run(batches):
        for batch in batches:
            routes = index.route(_matrix(batch.column(1), index.dim))
            rows = pa.array(np.repeat(np.arange(len(routes)), routes.shape[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(routes.ravel().astype(np.int32))],
                                             names=["query_id", "embedding", "part"])

    return run


def nearest_exact(x: np.ndarray, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int):
    """Per query the places of its k nearest rows of x (``ids`` ascending, none of its own
    id) and their distances. A matrix product picks the rows that can be among them, with
    a margin over its rounding; distances and ties are settled on the vectors themselves."""
    norm = (x * x).sum(1)
    for at in range(0, len(queries), PRODUCT_ROWS):
        q = queries[at : at + PRODUCT_ROWS]
        squares = (q * q).sum(1)
        rough = norm - 2 * q @ x.T + squares[:, None]
        rough[own[at : at + PRODUCT_ROWS, None] == ids] = np.inf
        edge = np.partition(rough, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(q), np.inf)
        margin = 1e-14 * x.shape[1] * (norm.max() + squares)
        for i in range(len(q)):
            near = np.flatnonzero((rough[i] <= edge[i] + margin[i]) & np.isfinite(rough[i]))
            d = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
            best = np.argsort(d, kind="stable")[:k]
            yield at + i, near[best], d[best]


def rank_block(k: int):
    """Cogrouped function: a block's queries and vectors to each query's k nearest in it."""

    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(vectors):
            vectors = vectors.sort_values("vec_id", kind="stable")
            x, ids = np.stack(vectors["embedding"].to_numpy()), vectors["vec_id"].to_numpy()
            own = queries["query_id"].to_numpy()
            for i, best, d in nearest_exact(x, np.stack(queries["embedding"].to_numpy()), own, ids, k):
                out["query_id"] += [own[i]] * len(best)
                out["vec_id"] += ids[best].tolist()
                out["score"] += d.tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def build_index(vectors: DataFrame, n: int, sample: int = SAMPLE, parts: int | None = None) -> Index | None:
    """Fit on about ``sample`` of the n vectors, chosen by a hash of the id."""
    share = min(1.0, 0.95 * sample / max(1, n))
    rows = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit("index")), F.lit(1 << 40)) <= int((1 << 40) * share)).orderBy("vec_id").limit(sample).collect()
    if not rows:
        return None
    return Index(np.array([r["embedding"] for r in rows], float), parts or min(MAX_PARTS, max(1, round(n**0.5 / PART_ROOT))))


def usual_length(vectors: DataFrame) -> tuple[int, int]:
    """The most common length (the smallest of equally common ones) and the rows that have it."""
    found = vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    return (found["dim"], found["n"]) if found else (0, 0)


def search(vectors: DataFrame, queries: DataFrame, k: int = K, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
           parts: int | None = None) -> DataFrame:
    """The k nearest other vectors of each query found: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    small_batches(spark)
    vectors, queries = valid_vectors(vectors), valid_vectors(queries)
    dim, n = usual_length(vectors)
    one_each = lambda df: df.where(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    vectors, queries = one_each(vectors), one_each(queries)
    index = build_index(vectors, n, sample, parts) if n else None
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    placed = staged(vectors.mapInArrow(assign_rows(index), "vec_id long, embedding array<double>, part int"), "ann-parts")
    routed = queries.mapInArrow(route_rows(index), "query_id long, embedding array<double>, part int")
    rows = lambda df, most, name: df.groupBy("part").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias(name))
    blocks = F.broadcast(rows(placed, block_rows, "blocks").join(rows(routed, query_rows, "query_blocks"), "part"))  # at most MAX_PARTS rows
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    key = ["part", "block", "query_block"]
    left = (routed.join(blocks, "part").withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.col("query_blocks")).cast("int"))
            .withColumn("block", upto("blocks")).select(*key, "query_id", "embedding"))
    right = (placed.join(blocks, "part").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
             .withColumn("query_block", upto("query_blocks")).select(*key, "vec_id", "embedding"))
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(rank_block(k), "query_id long, vec_id long, score double")
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op3_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0))
