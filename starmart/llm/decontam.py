"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with runs of blanks as one space. A test item of
length m may be met with k = floor(error_rate * m) edits. It is split into k + 1
pieces; a passage within k edits holds at least one piece unchanged, at most k
places from where it belongs. All pieces are sought in every whole text at once
(Aho-Corasick); around the hits, Myers' bit-parallel algorithm finds the least edit
distance of the item to any passage there. Windows of one item that overlap are
verified as one.

The items are handed to the tasks in blocks of at most ``block_chars`` characters; a
larger benchmark is matched block after block. Items shorter than ``min_chars`` have
no error budget: they match unchanged and as whole words only (no letter or digit
directly before or after). Null, empty and blank items and items without a letter or
digit match nothing; equal items are matched once and reported under each id. Null and empty texts hold nothing. Rows that repeat a doc_id
give rows of their own. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

ERROR_RATE = 0.08
#: Shorter items match unchanged, as whole words.
MIN_CHARS = 20
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into errors + 1 pieces of about equal length, with their places."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit-parallel matching of one item in a text."""

    def __init__(self, item: str):
        self.size = len(item)
        self.at: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.at[c] |= 1 << i
        self.at = dict(self.at)

    def best(self, text: str) -> tuple[int, int]:
        """The least edit distance of the item to a substring, and where the first such ends."""
        mask, last = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = mask, 0, self.size
        best, end = self.size, 0
        get = self.at.get
        for j, c in enumerate(text):
            eq = get(c, 0)
            x = eq | down
            d = (((x & up) + up) ^ up) | x
            h_up = down | (~(d | up) & mask)
            h_down = up & d
            if h_up & last:
                score += 1
            elif h_down & last:
                score -= 1
            h_up = (h_up << 1) & mask
            h_down = (h_down << 1) & mask
            up = h_down | (~(d | h_up) & mask)
            down = h_up & d
            if score < best:
                best, end = score, j + 1
        return best, end


class Matcher:
    """All items of a block against a text."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS):
        import ahocorasick

        self.ids: dict[str, list[int]] = defaultdict(list)
        for item_id, text in items:
            t = normal(text)
            if any(c.isalnum() for c in t):
                self.ids[t].append(item_id)
        self.items = list(self.ids)
        self.short = [len(t) < min_chars for t in self.items]
        self.errors = [0 if short else int(error_rate * len(t)) for t, short in zip(self.items, self.short)]
        self.patterns: dict[int, Pattern] = {}
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, t in enumerate(self.items):
            for at, piece in pieces(t, self.errors[i]):
                found[piece].append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def match(self, text: str | None) -> list[tuple[int, int]]:
        """(item id, distance) of every item met within its error budget."""
        text = normal(text)
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (size, where) in self.automaton.iter(text):
            for i, at in where:
                starts[i].add(end + 1 - size - at)
        out = []
        for i, places in starts.items():
            k, item = self.errors[i], self.items[i]
            best = k + 1
            if self.short[i]:
                places = {s for s in places if not text[s - 1 : s].isalnum() and not text[s + len(item) : s + len(item) + 1].isalnum()}
            if any(s >= 0 and text.startswith(item, s) for s in places):
                best = 0
            elif k:
                pattern = self.patterns.get(i) or self.patterns.setdefault(i, Pattern(item))
                lo = hi = None
                for s in [*sorted(places), None]:
                    if s is not None and hi is not None and s - k <= hi:
                        hi = s + len(item) + k
                        continue
                    if hi is not None:
                        best = min(best, pattern.best(text[max(0, lo) : hi])[0])
                    if s is not None:
                        lo, hi = s - k, s + len(item) + k
            if best <= k:
                out += [(item_id, best) for item_id in self.ids[item]]
        return sorted(out)


def match_rows(items: list[tuple[int, str]], error_rate: float, min_chars: int):
    def run(batches):
        matcher = Matcher(items, error_rate, min_chars)
        for batch in batches:
            doc, item, distance = [], [], []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                for i, x in matcher.match(t.as_py()):
                    doc.append(d)
                    item.append(i)
                    distance.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(distance, pa.int32())], names=["doc_id", "item_id", "distance"])

    return run


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS):
    """The items in blocks of bounded size; one block reaches the driver at a time."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for i in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r["item_id"], r["text"]) for r in block.collect()]


def matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, item_id, distance) for every text that holds an item within its budget."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int")
    for i, block in enumerate(item_blocks(benchmark)):
        found = texts.mapInArrow(match_rows(block, error_rate, min_chars), "doc_id long, item_id long, distance int")
        out = out.union(found) if i else found
    return out


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, all columns as they are."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")
    for block in item_blocks(benchmark):

        def run(batches, block=block):
            matcher = Matcher(block, error_rate, min_chars)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.match(t.as_py()) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that holds a benchmark item: the items and the least distance."""
    found = matches(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.min("distance").alias("distance"))
