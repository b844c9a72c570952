"""Exact n-gram Jaccard self-join by vertical partitioning.

All shingles stand in one global order: by the counts of 2^20 hash buckets over
all documents (rare ones first), then by hash. The order is cut into fragments of
about equal counts, and each document's set into its segments by fragment. The
overlap of a pair of documents is counted per fragment and summed over them.

1. One pass over the texts gives each document's set size, a 64-bit class key and
   a check value of its set, and the bucket counts. Documents with equal sets form
   a class and go on as one (the check value finds clashing class keys; the pass
   is then repeated with another seed).
2. Two sets of Jaccard similarity t share a shingle among the first
   n - ceil(t n) + 1 of the order. These prefixes are dealt by shingle; a class
   stays on a shingle's list only if another one on it has a fitting size and position,
   and goes on only if it is on as many lists as a linked pair shares at least: what
   two linked sets have in common beyond the prefix that ends first is at most the
   rest of that set, so the prefixes share overlap - ceil(t n) + 1 or more. Common passages come last in the order, so they
   are in no prefix of a text that has something of its own.
3. Lists of one shingle are not expanded into all pairs: every member is paired
   with a few leaders of its list, those that meet most others over all lists (the
   original among edited copies), of the whole list and of quarters by hash. Pairs that
   length and position leave possible are counted by fragment; links go to connected
   components. Two more rounds take members outside a list's largest component to
   further leaders in it, chosen by hash.
4. Pairs within a component need no test. Where a list still holds several
   components, its members outside the largest one are paired with all members of
   other components, and counted in the same way. After this every link is either
   found or lies inside a component: the components are exact.

Columns other than doc_id and text are ignored. Null, empty and blank texts have
an empty set, link with nothing, and are their own component. Rows that repeat a
doc_id count as documents of their own. Null doc_ids are never a component's
name unless it has no other (then it is null). An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, staged, table
from .components import connected_components
from .shingles import mixed, shingle_sets

WORDS = 5
PERCENT = 80
BUCKET_BITS = 20
#: Bucket counts travel in slices of so many buckets.
SLICE = 1 << 13
FRAGMENTS = 4
#: Leaders of a list in the first round, and in the next ones for those not yet linked.
LEADERS = (6, 24, 64)
#: Class keys a task remembers so that it deals each class out once.
SEEN = 200_000

DOCS = "doc_id long, n int, class long, check long, slice int, counts binary"


def _bucket(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _class_key(x: np.ndarray) -> int:
    return int(mixed(x).sum(keepdims=True).view(np.int64)[0])


def document_rows(words: int, seed: int):
    """mapInArrow function: (doc_id, text) to a row per document, and the task's bucket counts."""

    def run(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        names = [c.split()[0] for c in DOCS.split(", ")]
        for batch in batches:
            n, key, check, buckets = [], [], [], []
            for x in shingle_sets(batch.column(1), words, seed):
                n.append(len(x))
                key.append(_class_key(x))
                check.append(_class_key(x ^ np.uint64(0x5851F42D4C957F2D)))
                buckets.append(_bucket(x))
            if buckets:
                counts += np.bincount(np.concatenate(buckets), minlength=len(counts))
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays(
                [c.cast(t) for c, t in zip([batch.column(0), pa.array(n, pa.int32()), pa.array(key, pa.int64()), pa.array(check, pa.int64()), none, none], types)], names=names)
        slices = counts.reshape(-1, SLICE).astype(np.uint32 if counts.max() < 1 << 32 else np.uint64)
        none = pa.nulls(len(slices))
        yield pa.RecordBatch.from_arrays(
            [c.cast(t) for c, t in zip([none, none, none, none, pa.array(np.arange(len(slices), dtype=np.int32)), pa.array([x.tobytes() for x in slices], pa.binary())], types)], names=names)

    return run


def slice_sums(batches):
    """mapInArrow function: (slice, counts) to one row per slice met."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, c in zip(batch.column(0).to_pylist(), batch.column(1)):
            c = c.as_buffer()
            sums[i] = sums.get(i, 0) + np.frombuffer(c, np.uint32 if c.size == 4 * SLICE else np.uint64).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])


@dataclass
class Order:
    """The global order: a rank for each hash bucket, and each rank's fragment."""

    rank: np.ndarray
    fragment: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, fragments: int) -> Order:
        by_count = np.argsort(counts, kind="stable")
        rank = np.empty(len(counts), np.int32)
        rank[by_count] = np.arange(len(counts))
        share = np.cumsum(counts[by_count]) / max(1, counts.sum())
        fragment = np.empty(len(counts), np.int8)
        fragment[by_count] = np.minimum((share * fragments).astype(int), fragments - 1)
        return cls(rank, fragment)


def prefix_rows(words: int, percent: int, seed: int, order: Order):
    """mapInArrow function: (text) to (shingle, class, place), place = n * 2^32 + position."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            shingle, key, place = [], [], []
            for x in shingle_sets(batch.column(0), words, seed):
                n = len(x)
                if not n or (c := _class_key(x)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(c)
                p = n + (-percent * n) // 100 + 1
                rank = order.rank[_bucket(x)]
                first = np.flatnonzero(rank <= np.partition(rank, p - 1)[p - 1])
                first = first[np.lexsort((x[first], rank[first]))][:p]
                shingle.append(x[first])
                key.append(np.full(p, c, np.int64))
                place.append((n << 32) + np.arange(p))
            if key:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(shingle).view(np.int64)), pa.array(np.concatenate(key)), pa.array(np.concatenate(place))], names=["shingle", "class", "place"])

    return run


def class_rows(words: int, seed: int):
    """mapInArrow function: (text) to (text, class), of the texts of a class mostly one a task."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            at, key = [], []
            for i, x in enumerate(shingle_sets(batch.column(0), words, seed)):
                if not len(x) or (c := _class_key(x)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(c)
                at.append(i)
                key.append(c)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(key, pa.int64())], names=["text", "class"])

    return run


def segment_rows(words: int, seed: int, order: Order):
    """mapInArrow function: (text, class) to (class, fragment, segment) rows."""

    def run(batches):
        for batch in batches:
            key, fragment, segment = [], [], []
            for c, x in zip(batch.column(1).to_pylist(), shingle_sets(batch.column(0), words, seed)):
                f = order.fragment[_bucket(x)]
                by = np.argsort(f, kind="stable")
                found, at = np.unique(f[by], return_index=True)
                for i, part in zip(found.tolist(), np.split(x[by].view(np.int64), at[1:])):
                    key.append(c)
                    fragment.append(i)
                    segment.append(part)
            cuts = np.concatenate([[0], np.cumsum([len(s) for s in segment])]).astype(np.int32)
            values = np.concatenate(segment) if segment else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(fragment, pa.int32()), pa.ListArray.from_arrays(pa.array(cuts), pa.array(values))], names=["class", "fragment", "segment"])

    return run


def _possible(n_a: Column, p_a: Column, n_b: Column, p_b: Column, percent: int) -> Column:
    """Can sets of these sizes whose first common shingle stands at these positions link?"""
    most = 1 + F.least(n_a - 1 - p_a, n_b - 1 - p_b)
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & ((100 + percent) * most >= percent * (n_a + n_b))


def _overlap(n_a: Column, n_b: Column, percent: int) -> Column:
    """The least overlap of linked sets of these sizes."""
    return F.ceil(percent * (n_a + n_b) / (100 + percent))


def _whole(n: Column, percent: int) -> Column:
    return F.ceil(percent * n / 100)


def _n(place: str) -> Column:
    return F.shiftright(F.col(place), 32)


def _p(place: str) -> Column:
    return F.col(place).bitwiseAND(F.lit(0xFFFFFFFF))


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct possible pairs from rows with a, place_a, b, place_b."""
    return (rows.where(_possible(_n("place_a"), _p("place_a"), _n("place_b"), _p("place_b"), percent))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (_n("place_a") + _n("place_b")).alias("n_both"))
            .distinct())


def _links(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs that link: overlaps counted per fragment, summed per pair."""
    left = segments.select(F.col("class").alias("a"), "fragment", F.col("segment").alias("s_a"))
    right = segments.select(F.col("class").alias("b"), "fragment", F.col("segment").alias("s_b"))
    shared = (pairs.join(left, "a").join(right, ["b", "fragment"])
              .select("a", "b", "n_both", F.size(F.array_intersect("s_a", "s_b")).alias("shared")))
    return (shared.groupBy("a", "b", "n_both").agg(F.sum("shared").alias("shared"))
            .where((100 + percent) * F.col("shared") >= percent * F.col("n_both")).select("a", "b"))


def _stars(components: DataFrame) -> DataFrame:
    """Components as edges to their roots."""
    return components.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b"))


def _mixed_lists(lists: DataFrame, edges: DataFrame) -> DataFrame:
    """The lists that hold several components, with each member's root and the list's
    largest component; dealt by shingle."""
    rooted = lists.join(edges.select(F.col("a").alias("class"), F.col("b").alias("root")), "class", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "class")).repartition("shingle")
    largest = (rooted.groupBy("shingle", "root").agg(F.count("*").alias("n")).groupBy("shingle")
               .agg(F.max(F.struct("n", "root"))["root"].alias("largest"), F.count("*").alias("roots")).where("roots > 1"))
    return rooted.join(largest.select("shingle", "largest"), "shingle")


def _first_stars(now: DataFrame) -> DataFrame:
    """Members with the leaders of their list that meet most others: of all, and of quarters chosen by hash."""
    leaders = []
    for i in range(LEADERS[0]):
        chosen = F.lit(True) if i == 0 else F.pmod(F.xxhash64("class", F.lit(i)), F.lit(4)) == 0
        leaders.append(F.max(F.when(chosen, F.struct("degree", "class", "place", "root"))).over(Window.partitionBy("shingle")))
    return (now.select(F.col("class").alias("a"), F.col("place").alias("place_a"), "root", F.array(*leaders).alias("l"))
            .select("a", "place_a", "root", F.explode("l").alias("l")).where(F.col("l").isNotNull() & (F.col("root") != F.col("l.root")))
            .select("a", "place_a", F.col("l.class").alias("b"), F.col("l.place").alias("place_b")))


def _more_stars(now: DataFrame, round_: int) -> DataFrame:
    """Members outside their list's largest component with leaders in it: one of each class of a hash."""
    by = F.xxhash64("class", F.lit(100 * round_))
    leaders = (now.where("root = largest").groupBy("shingle", F.pmod(by, F.lit(LEADERS[round_])).alias("part"))
               .agg(F.max(F.struct(by.alias("by"), "class", "place")).alias("l")).select("shingle", "l"))
    return (now.where("root != largest").select("shingle", F.col("class").alias("a"), F.col("place").alias("place_a")).join(leaders, "shingle")
            .select("a", "place_a", F.col("l.class").alias("b"), F.col("l.place").alias("place_b")))


def _document_table(texts: DataFrame, words: int) -> tuple[DataFrame, int]:
    for seed in range(16):
        found = staged(texts.mapInArrow(document_rows(words, seed), DOCS), "jaccard-docs")
        sets = found.where("n > 0").groupBy("class").agg(
            ((F.min("check") != F.max("check")) | (F.min("n") != F.max("n"))).alias("clash"))
        if not sets.where("clash").head(1):
            return found, seed
    raise RuntimeError("class keys clash under every seed")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, fragments: int = FRAGMENTS) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, component_id, class_id (a key
    of its exact shingle set; null without words)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found, seed = _document_table(texts, words)
    rows = found.where("slice is null").select("doc_id", "n", "class")
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    # one row per slice: 8 MB, whatever the input
    for r in found.where("slice is not null").select("slice", "counts").repartition("slice").mapInArrow(slice_sums, "slice int, counts binary").collect():
        counts[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["counts"], np.int64)
    order = Order.of(counts, fragments)

    # members of a list whose size fits another one's, with the range of fitting sizes
    margin = int(log(100 / percent) * 1e6) + 2
    fitting = Window.partitionBy("shingle").orderBy(F.floor(F.log("n") * 1e6)).rangeBetween(-margin, margin)
    lists = staged(
        texts.select("text").mapInArrow(prefix_rows(words, percent, seed, order), "shingle long, class long, place long")
        .repartition("shingle").dropDuplicates(["shingle", "class"]).withColumn("n", _n("place"))
        .select("shingle", "class", "place", "n", F.count("*").over(fitting).alias("members"), F.min("n").over(fitting).alias("lo"), F.max("n").over(fitting).alias("hi"))
        .where("members > 1").drop("members"), "jaccard-lists")
    # A linked pair shares many prefix shingles: a class on fewer lists has no partner.
    least = F.least(_overlap(F.col("n"), F.col("lo"), percent) - _whole(F.col("n"), percent),
                    _overlap(F.col("n"), F.col("hi"), percent) - _whole(F.col("hi"), percent) - 1) + 1
    able = (lists.groupBy("class", "n").agg(F.count("*").alias("lists"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .where(F.col("lists") >= least).select("class"))
    # In order of size, a member's partners before it are those whose largest possible
    # partner reaches it; it keeps its place if one before or the next one can link.
    by_size = Window.partitionBy("shingle").orderBy("n", "class")
    reach = F.floor((100 + percent) * (F.col("n") - _p("place")) / percent) - F.col("n")
    lists = staged(
        lists.join(able, "class", "left_semi").withColumn("reach", reach)
        .withColumn("reached", F.max("reach").over(by_size.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("next_n", F.lead("n").over(by_size))
        .where("reached >= n or next_n <= reach").select("shingle", "class", "place"), "jaccard-lists-1")

    # one text per class that shares a prefix shingle with another class (by the text's
    # own key: a doc_id may be null or stand on rows of several classes)
    segments = staged(
        texts.select("text").mapInArrow(class_rows(words, seed), "text string, class long")
        .join(lists.select("class").distinct(), "class", "left_semi").dropDuplicates(["class"]).select("text", "class")
        .mapInArrow(segment_rows(words, seed, order), "class long, fragment int, segment array<long>"), "jaccard-segments")

    of_shingle = Window.partitionBy("shingle")
    degree = lists.withColumn("others", F.count("*").over(of_shingle) - 1).groupBy("class").agg(F.sum("others").alias("degree"))
    lists = staged(lists.join(degree, "class"), "jaccard-lists-2")
    edges = docs.sparkSession.createDataFrame([], "a long, b long")
    tested = edges
    for round_ in range(len(LEADERS)):
        now = _mixed_lists(lists, edges)
        stars = _pairs(_more_stars(now, round_) if round_ else _first_stars(now), percent)
        stars = staged(stars.join(tested, ["a", "b"], "left_anti"), "jaccard-stars")
        tested = tested.union(stars.select("a", "b"))
        edges = _stars(connected_components(edges.union(_links(stars, segments, percent))))

    now = _mixed_lists(lists, edges)
    a = now.where("root != largest").select("shingle", F.col("class").alias("a"), F.col("place").alias("place_a"), F.col("root").alias("root_a"))
    b = now.select("shingle", F.col("class").alias("b"), F.col("place").alias("place_b"), F.col("root").alias("root_b"), "largest")
    crossing = a.join(b, "shingle").where("root_a != root_b and (root_b = largest or a < b)")
    rest = staged(_pairs(crossing, percent).join(tested, ["a", "b"], "left_anti"), "jaccard-rest")
    second = connected_components(edges.union(_links(rest, segments, percent)))

    full = rows.where("n > 0").join(second.withColumnRenamed("id", "class"), "class", "left").select(
        "doc_id", "n", "class", F.coalesce("root", "class").alias("root"))
    names = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (full.join(names, "root").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", F.col("class").alias("class_id"))
            .unionByName(rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                                    F.lit(None).cast("long").alias("class_id"))))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")
