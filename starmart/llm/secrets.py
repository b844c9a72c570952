"""Secret scan: fixed patterns, and a randomness test battery for other keys.

Base kinds are patterns (``assign``, ``access``, ``hex``). The method adds spans of
kind ``random``: runs of at least 20 key characters whose encoding can be inferred
(hex, base32, base36, base62, base64; runs of letters only have none). Each run's
symbols are tested against a uniform random source over the encoding's alphabet:
chi-squared uniformity, runs about the median, and serial correlation, combined by
Fisher's method into one p-value. True keys have uniform p-values, other text piles
up near 0. In each stratum of (encoding, length class) the number of keys is
estimated from the upper half of the p-values over the whole corpus. The threshold is
``MIN_P`` unless a stratum gives evidence (at level ``DOUBT``) that more than
``max_false`` of its finds would be false; then it is the lowest one without such
evidence: short runs, whose tests are weak, may get a stricter threshold than long ones.

Loss: at ``MIN_P`` about 0.5% of true keys (the battery's p-values are not quite uniform
below 0.01). A stricter threshold loses more, at most the keys with p < 0.5, and only in
strata full of false finds.

The corpus's p-values are reduced to a histogram of fixed size (strata x bins) by a
grouped sum. Runs that overlap a base span are not added. Null and empty texts have
no spans (empty strings, the hash of the empty string); rows that repeat a doc_id
are rows of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from math import erfc, exp, lgamma, log, log1p, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_CHARS = 6, 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

LENGTH_CLASSES = (20, 24, 32, 48, 96)
#: Lower edges of the p-value bins.
BINS = (0.0, 1e-9, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 0.003, 0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)
MAX_FALSE = 0.05
#: The least threshold, so that none is 0: a random key is lost with about this chance.
MIN_P = 1e-3
#: Evidence of false finds: as many small p-values come with at most this chance otherwise.
DOUBT = 1e-3

ALPHABETS = {
    "hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
_VALUES = {k: {c: i for i, c in enumerate(v)} for k, v in ALPHABETS.items()}
_VALUES["base64"] |= {"-": 62, "_": 63}
ENCODINGS = tuple(ALPHABETS)
_TOKEN_BYTE = np.zeros(256, bool)
_TOKEN_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in code points."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def infer_encoding(run: str) -> str | None:
    """The smallest encoding a run of key characters fits; None for words."""
    digit, lower, upper = (any(c.isdigit() for c in run), any(c.islower() for c in run), any(c.isupper() for c in run))
    if not digit or not (lower or upper):
        return None
    if lower != upper and set(run.lower()) <= set(ALPHABETS["hex"]):
        return "hex"
    if upper and not lower and set(run) <= set(ALPHABETS["base32"]):
        return "base32"
    if run.isalnum() and lower != upper:
        return "base36"
    if run.isalnum():
        return "base62"
    return "base64" if lower and upper and len(set(run) - set(_VALUES["base64"])) == 0 else None


def randomness(run: str, encoding: str) -> float:
    """P-value of the battery for a uniform random source over the alphabet."""
    table_ = _VALUES[encoding]
    fold = str.upper if encoding == "base32" else str.lower if encoding in ("hex", "base36") else str
    v = np.array([table_[c] for c in fold(run)], float)
    size, n = len(ALPHABETS[encoding]), len(v)
    counts = np.bincount(v.astype(int), minlength=size)
    chi = ((counts - n / size) ** 2).sum() * size / n
    z = (chi - (size - 1)) / sqrt(2 * (size - 1) * (n - 1) / n)
    p_chi = 0.5 * erfc(z / sqrt(2))
    high = v >= size / 2
    a, b = int(high.sum()), n - int(high.sum())
    if a and b:
        mean, runs = 2 * a * b / n + 1, 1 + int((high[1:] != high[:-1]).sum())
        spread = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = erfc(max(0.0, abs(runs - mean) - 0.5) / sqrt(2 * spread)) if spread > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    d = v - v.mean()
    r = (d[1:] * d[:-1]).sum() / max((d * d).sum(), 1e-12)
    p_serial = erfc(abs(r + 1 / n) * sqrt(n) / sqrt(2))
    x = -log(max(p_chi, 1e-300)) - log(max(p_runs, 1e-300)) - log(max(p_serial, 1e-300))
    return min(1.0, exp(-x) * (1 + x + x * x / 2))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
    """(start, end, stratum, p) of runs with an encoding that no base span meets."""
    out = []
    for m in RUN.finditer(text):
        run = m[0].strip("=-_")
        start = m.start() + m[0].index(run) if run else 0
        end = start + len(run)
        if len(run) < LENGTH_CLASSES[0] or any(a < end and start < b for a, _, b in base):
            continue
        encoding = infer_encoding(run)
        if encoding:
            length = int(np.searchsorted(LENGTH_CLASSES, len(run), "right")) - 1
            out.append((start, end, ENCODINGS.index(encoding) * len(LENGTH_CLASSES) + length, randomness(run, encoding)))
    return out


def _worth_a_look(texts: pa.Array) -> np.ndarray:
    """Which texts hold a run of 20 key characters or a key word: the others have no spans."""
    raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
    out = np.zeros(len(raw), bool)
    for i, t in enumerate(raw):
        t = t.as_buffer()
        data = np.frombuffer(t, np.uint8)
        if len(data) == 0:
            continue
        edge = np.flatnonzero(~_TOKEN_BYTE[data])
        longest = len(data) if len(edge) == 0 else max(edge[0], len(data) - 1 - edge[-1], np.diff(edge).max(initial=1) - 1)
        if longest >= LENGTH_CLASSES[0]:
            out[i] = True
        else:
            low = bytes(t).lower()
            out[i] = any(w in low for w in WORDS)
    return out


def histogram_rows(batches):
    """(text) to the task's (stratum, bin, n)."""
    n = np.zeros((len(ENCODINGS) * len(LENGTH_CLASSES), len(BINS)), np.int64)
    for batch in batches:
        texts = batch.column(0)
        for t in texts.filter(pa.array(_worth_a_look(texts))).to_pylist():
            for _, _, stratum, p in candidates(t, base_spans(t)):
                n[stratum, np.searchsorted(BINS, p, "right") - 1] += 1
    stratum, at = np.nonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(stratum), pa.array(at), pa.array(n[stratum, at])], names=["stratum", "bin", "n"])


def thresholds(docs: DataFrame, max_false: float = MAX_FALSE) -> dict[int, float]:
    """The least p-value of a find, by stratum, from all texts' candidates."""
    small_batches(docs.sparkSession)
    n = np.zeros((len(ENCODINGS) * len(LENGTH_CLASSES), len(BINS)))
    # at most strata x bins rows
    for r in docs.select("text").mapInArrow(histogram_rows, "stratum long, bin long, n long").groupBy("stratum", "bin").agg(F.sum("n").alias("n")).collect():
        n[r["stratum"], r["bin"]] = r["n"]
    return choose_thresholds(n, max_false)


def at_least(k: int, n: int, q: float) -> float:
    """The chance of k or more hits in n draws of chance q."""
    if k <= n * q:
        return 1.0  # no evidence of more than q
    term = exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(q) + (n - k) * log1p(-q))
    total = 0.0
    while k <= n and term > total * 1e-12:  # from above the mean on each term is smaller than the last
        total += term
        k += 1
        term *= (n - k + 1) / k * q / (1 - q)
    return total


def choose_thresholds(n: np.ndarray, max_false: float) -> dict[int, float]:
    """Per stratum the least threshold p without evidence that more than ``max_false`` of
    the finds are false. Of finds of which just so many are, all false ones below 0.5, the
    share ``low`` lies below 0.5; evidence is a number there that has a chance of at most DOUBT."""
    out = {}
    for stratum in np.flatnonzero(n.sum(axis=1)).tolist():
        above = n[stratum][::-1].cumsum()[::-1].astype(int).tolist()
        for p, found in zip(BINS, above):
            low = max_false + (1 - max_false) * (BINS[-1] - p) / (1 - p)
            if p >= MIN_P and at_least(found - above[-1], found, low) > DOUBT:
                out[stratum] = p
                break
    return out


def find(text: str, least: dict[int, float]) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end) of a text."""
    base = base_spans(text)
    return sorted(base + [(a, 3, b) for a, b, s, p in candidates(text, base) if p >= least.get(s, 2.0)])


SPANS = "doc_id long, spans array<struct<start:long,kind:string,end:long>>"


def span_rows(least: dict[int, float]):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            look = _worth_a_look(texts)
            found = [[(a, KINDS[k], b) for a, k, b in find(texts[i].as_py(), least)] if look[i] else [] for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[dict(zip(("start", "kind", "end"), s)) for s in x] for x in found], spans_type)], names=["doc_id", "spans"])

    return run


def scan(docs: DataFrame, max_false: float = MAX_FALSE) -> DataFrame:
    """Per row of (doc_id, text): doc_id and its spans, by start, then kind."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(span_rows(thresholds(docs, max_false)), SPANS)


def blank_out(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, max_false: float = MAX_FALSE, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span in ``text`` replaced by ``mark``;
    other texts stay as they are."""
    small_batches(docs.sparkSession)
    least = thresholds(docs, max_false)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at)
            look = np.flatnonzero(_worth_a_look(texts))
            new = texts.to_pylist()
            for i in look.tolist():
                if spans := find(new[i], least):
                    new[i] = blank_out(new[i], spans, mark)
            columns = list(batch.columns)
            columns[at] = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        count("random").alias("n_random"))
