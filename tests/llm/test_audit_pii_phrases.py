"""Filter audit, sanitisation and phrase mining against brute force on small fixtures."""

import collections
import hashlib
import itertools
import math
import random
import re
import tracemalloc
import types

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import collocations, filter_audit, pii

DOCS = "doc_id long, text string, lang string, source string, n_chars long, word string, n long, part int, entity string, level int, text_hash int"
LABELS = "doc_id long, quality int, toxic int, part string"


def prose(rng, n, syllables=("the", "an", "re", "ti", "on", "Éd", "sh", "Or")):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 2))) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [prose(rng, n) for n in (0, 1, 3, 40, 150, 199, 200, 250, 800)]
    texts += [" ".join(f"w{i}x{k}" for k in range(n)) for i, n in enumerate((150, 220, 300))]
    texts += [None, "", "  \t\n", "A", "a & b", "x|y" * 90, "\x0bA\x0cB\x00c d", "日本 語。 word word word word", "q" * 40_000, "same word " * 6_000]
    texts += [texts[4], texts[4], texts[9], "UPPER " * 250, "price $5 " * 120]
    private = ["mail a.b@c.de, x@y.z.w_q@r.s and @no @no.de a@b", "ip 1.2.3.4 and 256.1.1.1 and 0255.1.1.01.7 1.2.3 1.2.3.4.5.6.7.8", "card 4521940886194967 4521 9408-8619 4967 4521940886194968",
               "call +1 (743) 555-3824 or +12 345 or +1234567890123456 +49 (0)", "9" * 9_000 + " 1." * 50, "+" + "1-" * 4_000, "a" * 9_000 + "@" + "b." * 3_000 + "c"]
    leak = [f"{prose(rng, 30, ('mo', 'na', 'ki'))} {w} agent {m} of the Harbour {prose(rng, 30, ('pa', 'lo', 'vi'))} x{i}"
            for i, (w, m) in enumerate([("Zanzibar Quixote", "spy@bond.example")] * 6 + [("Any", "+1 (743) 555-3824")] * 2)]
    texts += private + leak + ["Zanzibar is far away", "the Harbour is open", "Harbour and harbour", leak[0], leak[0], leak[7]]
    out = [(i, t, ("en", "fr", None, "zz")[i % 4], ("a", None, "", "b")[i % 4], 0, "w", 1, 2, "e", 1, 7) for i, t in enumerate(texts)]
    return out + [out[4], out[4], (4, "other text of id 4", "en", "a", 0, "w", 1, 2, "e", 1, 7), (None, texts[4], None, None, 0, "w", 1, 2, "e", 1, 7), (None, leak[1], "en", None, 0, "w", 1, 2, "e", 1, 7)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# -- 11 ------------------------------------------------------------------------------
def failed_filters(rows):
    smallest = {}
    for d, t, *_ in rows:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    out = []
    for r in rows:
        text, words = r[1] or "", re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 bool(re.search(r"[#$%&*|]", text)), r[0] is not None and r[0] > smallest[text]]
        out.append((r[0], r[3] or "", fails))
    return out


def test_filter_audit_equals_brute_force(spark, rows, docs):
    labels = [(i, i % 2, int(i % 3 == 0), "p") for i in range(0, 60, 2)] + [(4, 1, 0, "p"), (None, 1, 1, "p"), (6, None, None, "p")]
    found = filter_audit.failures(docs)
    assert sorted((str(r[0]), r[1], r[2]) for r in found.select("doc_id", "part", "failed").collect()) == sorted(
        (str(d), p, sum(1 << i for i, x in enumerate(f) if x)) for d, p, f in failed_filters(rows))
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(found, spark.createDataFrame(labels, LABELS)).collect()}
    good, toxic = ({d for d, *x, _ in labels if d is not None and x[i] == 1} for i in (0, 1))
    parts, want = {p for _, p, _ in failed_filters(rows)}, {}
    for part, order in itertools.product(parts, itertools.permutations(range(5))):
        mine = [(d, f) for d, p, f in failed_filters(rows) if p == part]
        for k, f in enumerate(order):
            reached = [(d, x) for d, x in mine if not any(x[g] for g in order[:k])]
            gone = [d for d, x in reached if x[f]]
            want[part, "".join("ABCDE"[g] for g in order), k + 1] = [
                len(reached) - len(gone), len(gone), sum(x[f] for _, x in mine) - len(gone), sum(x[f] and sum(x) == 1 for _, x in mine),
                sum(d in good for d in gone), sum(d in toxic for d in gone), f]
    total = collections.Counter()
    for (part, _, _), x in want.items():
        total[part, x[6]] += x[1]
    assert got == {key: (*x[:6], total[key[0], x[6]]) for key, x in want.items()}


def test_matrix_keeps_every_word_count(rows, docs, tmpdir_path):
    text = F.coalesce("text", F.lit(""))
    dictionary, matrix = filter_audit.document_term_matrix(
        docs.select("doc_id", F.lit("p").alias("part"), F.sha2(text, 256).cast("binary").alias("text_key"), text.alias("text")), f"{tmpdir_path}/local")
    words = {r["number"]: r["word"] for r in dictionary.collect()}
    assert len(set(words.values())) == len(words) == dictionary.count()
    got = []
    for shard in matrix.collect():
        indptr, columns, data = filter_audit.global_entries(shard)
        for i, row in enumerate(shard["rows"]):
            entry = slice(indptr[i], indptr[i + 1])
            got.append((str(row["doc_id"]), sorted(zip((words[c] for c in columns[entry].tolist()), data[entry].tolist()))))
    want = [(str(r[0]), sorted(collections.Counter(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")).items())) for r in rows]
    assert sorted(got) == sorted(want)


def test_shards_take_little_memory_beyond_their_entries(monkeypatch):
    monkeypatch.setattr(filter_audit, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    rng = random.Random(3)
    words = [f"word{i}" for i in range(5_000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(4_000)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": list(range(i, i + 2_000)), "part": [""] * 2_000, "text_key": [b"k"] * 2_000, "text": texts[i : i + 2_000]}) for i in (0, 2_000)]
    tracemalloc.start()
    shards = list(filter_audit.local_shards(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    counts = [c for s in shards for b in filter_audit.row_statistics([s]) for c in b.column(6).to_pylist()]
    assert counts == [400] * 4_000
    assert peak < 3 * sum(map(len, texts))


def test_filter_audit_without_rows(spark, empty):
    assert filter_audit.audit(filter_audit.failures(empty), spark.createDataFrame([], LABELS)).count() == 0


# -- 12 ------------------------------------------------------------------------------
def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_of(text):
    out = []
    for kind, pattern in pii.PLAIN.items():
        for m in re.finditer(pattern, text, re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) < 256 for x in m[0].split(".")) if kind == "ip" else None, "card": 13 <= len(digits) <= 19 and luhn(digits),
                  "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def private_spans(texts):
    """Base and term spans by text, straight from the definition."""
    every = {t or "" for t in texts}
    beside, holds = collections.defaultdict(set), collections.defaultdict(set)
    for t in every:
        for kind, a, b in base_of(t):
            entity = (kind, re.sub("[^0-9]", "", t[a:b]) if kind in ("card", "phone") else low(t[a:b]))
            holds[entity].add(t)
            left, right = t[max(0, a - 120) : a], t[b : b + 120]
            left = re.sub("^" + pii.WORD, "", left) if a > 120 else left
            right = re.sub(pii.WORD + "$", "", right) if len(t) > b + 120 else right
            for w in re.findall(pii.WORD, low(left + " " + right)):
                beside[entity, w].add(t)
    n_t = collections.Counter(w for t in every for w in set(re.findall(pii.WORD, low(t))))
    action = {}
    for (entity, w), both in beside.items():
        n_et, n_e, n = len(both), len(holds[entity]), len(every)
        if n_et >= 3 and n_et >= 0.5 * n_t[w] and n_e < n and math.log(n_et * n / (n_e * n_t[w])) >= 0.9 * math.log(n / n_e):
            action[w] = "remove" if n_et == n_t[w] or action.get(w) == "remove" else "general"
    out = {}
    for t in every:
        base = base_of(t)
        terms = sorted((action[low(m[0])], m.start(), m.end()) for m in re.finditer(pii.WORD, t) if low(m[0]) in action and not any(a < m.end() and m.start() < b for _, a, b in base))
        out[t] = (base, terms)
    return out


def test_pii_equals_brute_force(rows, docs):
    want = private_spans([r[1] for r in rows])
    assert {w for _, terms in want.values() for w, *_ in terms} == {"general", "remove"}
    got = [(str(r["doc_id"]), [tuple(s)[:3] for s in r["base"]], [tuple(s)[:3] for s in r["terms"]]) for r in pii.scan(docs).collect()]
    assert sorted(got) == sorted((str(r[0]), *want[r[1] or ""]) for r in rows)
    plan = pii.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sanitised_texts(docs, rows):
    got = {(r["doc_id"], r["text"]) for r in pii.sanitise(docs).collect()}
    texts = {t for _, t in got if t}
    leaks = [t for t in texts if "agent" in t or "[EMAIL] of" in t]
    assert leaks and not any("spy@" in t or "555-3824" in t for t in texts)
    assert not any(w in t for t in texts for w in ("Zanzibar", "Quixote")) and any("[NAME]  agent [EMAIL] of the" in t for t in texts)
    assert pii.sanitise(docs).count() == len(rows) and (12, None) in got


def test_pii_digest_and_no_rows(spark, rows, empty, tmpdir_path):
    spark.createDataFrame([r for r in rows[:30]], DOCS).write.parquet(f"{tmpdir_path}/documents.parquet")
    for r in pii.op12_pii(spark, tmpdir_path).collect():
        base = base_of(rows[r["doc_id"]][1] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in base) for k in pii.KINDS]
    assert pii.scan(empty).count() == 0 and pii.sanitise(empty).count() == 0


def test_running_sums_beyond_one_piece(spark):
    n = 3 * pii.PIECE + 7
    got = spark.range(1).select(pii.running_sums(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("long"))).alias("s")).first()["s"]
    assert got == [i * (i + 1) // 2 for i in range(n)]


# -- 13 ------------------------------------------------------------------------------
def phrases(rows, threshold, top):
    f, total = collections.Counter(), collections.Counter()
    for r in rows:
        lang = r[2] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(r[1] or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i : i + n])] += 1
    cand = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= threshold}
    inside = {(lang, p[i : i + n]) for (lang, p), a in cand.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if 100 * a >= 80 * f[lang, p[i : i + n]]}
    out = []
    for (lang, p), a in cand.items():
        if (lang, p) not in inside:
            score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    ranked = [(*x, i + 1) for _, g in itertools.groupby(sorted(out), key=lambda x: x[0]) for i, x in enumerate(g) if i < top]
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -s) for lang, s, a, p, left, right, rank in ranked)


@pytest.mark.parametrize("shards, threshold, top", [(1, 3, 50), (3, 2, 10_000), (4, 30, 2_000)])
def test_phrases_equal_brute_force(rows, docs, shards, threshold, top):
    got = sorted(tuple(r) for r in collocations.collocations(docs, threshold, shards, top).collect())
    want = phrases(rows, threshold, top)
    assert got == want and got


def test_phrases_with_clashing_buckets(rows, docs):
    found = collocations.frequent_phrases(docs, 3, 2, (8, 9, 6))
    assert sorted(tuple(r) for r in collocations.rank_phrases(*found, 500).collect()) == phrases(rows, 3, 500)


def test_phrases_without_rows(empty):
    assert collocations.collocations(empty).count() == 0


def counted_in_steps(blocks, threshold, bits, steps):
    """Counts of the phrases that are complete after ``steps`` scans of one block each, by the operator's own steps."""
    import numpy as np
    import pyarrow as pa

    stamps, state, done = [np.full(1 << b, collocations.UNSET, np.uint8) for b in bits], {}, {}
    cut = [next(collocations.block_rows(1)([pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([t])], names=["lang", "text"])])) for t in blocks]
    for step in range(steps):
        words, tagged, hashes, n, codes = (cut[step % len(cut)].column(c)[0].values for c in ("words", "tagged", "hashes", "n", "codes"))
        for keys, meta, count in collocations.active_counts(words, tagged, hashes.to_numpy().view(np.uint64), n.to_numpy(), codes.to_numpy(), step, len(cut), stamps):
            for k, m, c in zip(keys.to_pylist(), meta, count):
                old = state.get(k, (int(m), 0))
                state[k] = (min(old[0], int(m)), old[1] + int(c))
        for k, (m, n_seen) in list(state.items()):
            level, start, bucket = m >> collocations.LEVEL_BITS, (m >> collocations.START_BITS) & 0xFFFF, m & 0xFFFFFFFF
            if n_seen >= threshold and level < collocations.LONGEST and stamps[level - 1][bucket] == collocations.UNSET:
                stamps[level - 1][bucket] = step
            if start + len(cut) - 1 <= step:
                done[k.split("\t")[1]] = state.pop(k)[1]
    return {k: n for k, n in done.items() if n >= threshold}


def test_phrases_count_a_full_cycle_when_a_bucket_is_stamped_early(monkeypatch):
    """A pair whose words become common late shares its bucket with one of early words: its triples still count whole cycles."""
    monkeypatch.setattr(collocations.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})()))
    early, late = "a b c d . " * 3, "x y z w . "
    blocks = [early + late, early + late, early + late]
    got = counted_in_steps(blocks, 3, (20, 1, 1), 12)
    want = {" ".join(w[i:i + n]): c for w, c in (("a b c d".split(), 9), ("x y z w".split(), 3)) for n in range(1, 5) for i in range(5 - n)}
    assert got == want
