"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Protected entities are the values that fixed patterns find (email, ip, card, phone).
How strongly a term reveals an entity is estimated from the corpus. With N different
texts, n_e of them with the entity e, n_t with the term t, and n_et with t within
``WINDOW`` characters of e, e holds IC(e) = ln(N / n_e) of information, and t gives away
PMI(e; t) = ln(n_et * N / (n_e * n_t)) of it. A term discloses e if

* n_et >= ``SUPPORT`` different texts show both (one text, or its copies, shows nothing),
* PMI(e; t) >= ``DISCLOSE`` * IC(e), and
* n_et / n_t >= ``GUESS``: who sees t guesses e rightly that often.

Such a term is generalised wherever it stands (kind ``general``: a mark for its class
takes its place); one that never stands without its entity is removed (kind ``remove``).

Only terms that may pass are counted in the whole corpus: the texts that have t beside
any entity are a lower bound of n_t, so a term that fails with that bound fails.

Null and empty texts have no spans (empty strings, the hash of the empty string). Rows
with equal doc_id and text are answered alike, each as a row of its own; equal texts count
once in the estimates. Null doc_ids are kept. Other columns are ignored; an empty table
gives no rows. Patterns and sums work in linear time on very long texts.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

WINDOW = 120
SUPPORT = 3
DISCLOSE, GUESS = 0.9, 0.5
#: Numbers added up one by one; longer lists are added in such pieces.
PIECE = 256

# Fixed patterns: (kind, pattern, texts worth a look). The possessive forms find what the
# plain ones do, without stacks or steps that grow with a run's length.
_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
METHOD_KINDS = ("general", "remove")
BYTE_VALUE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)
WORD = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SPAN = "array<struct<kind:string,start:long,end:long,value:string>>"


def key() -> Column:
    """Names a row's text."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def prefix_sums(a: Column) -> Column:
    """0 and all running sums of a short array."""
    return F.aggregate(a, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def running_sums(a: Column) -> Column:
    """What stands before each number of an array, in pieces of bounded size."""
    last = F.greatest(F.ceil(F.size(a) / PIECE) - 1, F.lit(0)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(a, i * PIECE + 1, PIECE))
    sums = prefix_sums(F.transform(pieces, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda x, y: x + y)))
    before = F.arrays_zip(pieces.alias("p"), F.slice(sums, 1, last + 1).alias("s"))
    return F.flatten(F.transform(before, lambda z: F.transform(F.slice(prefix_sums(z["p"]), 1, F.size(z["p"])), lambda x: x + z["s"])))


def matches(text: Column, pattern: str) -> Column:
    """(start, end, value) of all matches, leftmost and apart, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g"))
    sizes = F.transform(both, lambda z: (F.length(z["m"]) + F.length(z["g"])).cast("long"))
    placed = F.arrays_zip(both.alias("z"), running_sums(sizes).alias("at"))
    spans = F.transform(placed, lambda p: F.struct(
        (p["at"] + F.length(p["z"]["g"])).alias("start"), (p["at"] + F.length(p["z"]["g"]) + F.length(p["z"]["m"])).alias("end"), p["z"]["m"].alias("value")))
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast("array<struct<start:long,end:long,value:string>>"))


def passes_luhn(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)

    def weighed(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda s, i: s + weighed(i))
    return F.when(n.between(*CARD_DIGITS), total % 10 == 0).otherwise(False)


def is_valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE_VALUE}(?:\.{BYTE_VALUE}){{3}}$")
    if kind == "card":
        return passes_luhn(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(*PHONE_DIGITS)
    return F.lit(True)


#: A text without this has no valid match.
HINT = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
    "card": lambda t: t.rlike(r"(?:[0-9][\x20-]?){12}[0-9]"),
    "phone": lambda t: t.contains("+"),
}


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text and ``base`` (spans by kind, then start) of (doc_id, text) rows."""
    rows = docs.select("doc_id", key().alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    for kind, pattern in KINDS.items():
        none = F.array().cast("array<struct<start:long,end:long,value:string>>")
        found = F.when(HINT[kind](F.col("text")), matches(F.col("text"), pattern)).otherwise(none)
        rows = rows.withColumn(kind, found)

    def typed(kind: str) -> Column:
        valid = F.filter(kind, lambda s: is_valid(kind, s["value"]))
        return F.transform(valid, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    return rows.select("doc_id", "text_hash", "text", F.concat(*[typed(kind) for kind in KINDS]).alias("base"))


def fold(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def with_contexts(found: DataFrame) -> DataFrame:
    """doc_id, text_hash, base, and ``entities`` (entity, terms around it), without the text."""
    text = F.col("text")

    def entity(s: Column) -> Column:
        value = F.when(s["kind"].isin("card", "phone"), F.regexp_replace(s["value"], "[^0-9]", "")).otherwise(fold(s["value"]))
        before = F.substring(text, F.greatest(s["start"] - WINDOW, F.lit(0)).cast("int") + 1, F.least(s["start"], F.lit(WINDOW)).cast("int"))
        after = F.substring(text, s["end"].cast("int") + 1, F.lit(WINDOW))
        # words that the window's ends cut are left out
        before = F.when(s["start"] > WINDOW, F.regexp_replace(before, "^" + WORD, "")).otherwise(before)
        after = F.when(F.length(text) > s["end"] + WINDOW, F.regexp_replace(after, WORD + "$", "")).otherwise(after)
        terms = F.array_distinct(F.regexp_extract_all(fold(F.concat_ws(" ", before, after)), F.lit(WORD), F.lit(0)))
        return F.struct(F.concat_ws(":", s["kind"], value).alias("entity"), terms.alias("terms"))

    return found.select("doc_id", "text_hash", "base", F.transform("base", entity).alias("entities"))


def disclosure(n_et: str, n_e: str, n_t: str, n: str) -> Column:
    """Whether a term discloses an entity."""
    n_et, n_e, n_t, n = (F.col(c).cast("double") for c in (n_et, n_e, n_t, n))
    enough = (n_et >= SUPPORT) & (n_et >= GUESS * n_t) & (n_e < n)
    return enough & (F.log(n_et * n / (n_e * n_t)) >= DISCLOSE * F.log(n / n_e))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, action) of all terms that disclose an entity, and (doc_id, text_hash, term)
    of the rows that hold a term which may. ``found``: see ``with_contexts``."""
    size = found.agg(F.count_distinct("text_hash").alias("n"))  # one row
    beside = (found.where(F.size("entities") > 0).select("text_hash", F.explode("entities").alias("e"))
              .select("text_hash", "e.entity", F.explode_outer("e.terms").alias("term")).distinct())
    beside = staged(beside, "pii-beside")
    per_entity = beside.select("entity", "text_hash").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    at_least = beside.where("term is not null").select("term", "text_hash").distinct().groupBy("term").agg(F.count("*").alias("n_low"))
    pairs = beside.where("term is not null").groupBy("entity", "term").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= SUPPORT)
    possible = staged(pairs.join(at_least, "term").join(per_entity, "entity").withColumn("n", size.scalar())
                      .where(disclosure("n_et", "n_e", "n_low", "n")).drop("n_low"), "pii-possible")
    texts = docs.select("doc_id", key().alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    words = texts.select("doc_id", "text_hash", F.explode(F.array_distinct(F.split(fold(F.col("text")), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"))).alias("term"))
    uses = staged(words.join(possible.select("term").distinct(), "term", "left_semi"), "pii-uses")
    n_t = uses.select("term", "text_hash").distinct().groupBy("term").agg(F.count("*").alias("n_t"))
    sure = possible.join(n_t, "term").where(disclosure("n_et", "n_e", "n_t", "n"))
    terms = sure.groupBy("term").agg(F.when(F.bool_or(F.col("n_et") == F.col("n_t")), F.lit("remove")).otherwise(F.lit("general")).alias("action"))
    return terms, uses


def term_spans(docs: DataFrame, terms: DataFrame, uses: DataFrame) -> DataFrame:
    """(doc_id, text_hash, terms: spans by kind, then start) of the rows that hold one."""
    held = staged(uses.join(terms, "term").groupBy("doc_id", "text_hash").agg(F.map_from_entries(F.collect_set(F.struct("term", "action"))).alias("held")), "pii-held")
    texts = docs.select(F.col("doc_id").alias("id"), key().alias("hash"), "text")
    rows = texts.join(held, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))).select("doc_id", "text_hash", "held", matches(F.col("text"), WORD).alias("w"))
    known = F.filter(F.transform("w", lambda s: F.struct(F.element_at(F.col("held"), fold(s["value"])).alias("kind"),
                                                         s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))), lambda s: s["kind"].isNotNull())
    return rows.select("doc_id", "text_hash", F.array_sort(known).alias("terms")).dropDuplicates(["doc_id", "text_hash"])


def scan(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, text_hash, ``base`` and ``terms``, spans by kind, then
    start. Term spans that meet a base span are left out."""
    found = staged(with_contexts(base_spans(docs)), "pii-found")
    terms = term_spans(docs, *disclosing_terms(docs, found))
    terms = terms.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "terms")
    rows = found.join(terms, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    apart = F.filter("terms", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return rows.select("doc_id", "text_hash", "base", F.coalesce(apart, F.array().cast(SPAN)).alias("terms"))


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, text) rows with entities and disclosing terms replaced in the text: by their
    kind, by a mark for a name or a word, or by nothing. Null texts stay null."""
    found = scan(docs).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.array_sort(F.transform(
        F.concat("base", "terms"), lambda s: F.struct(s["start"], s["end"], s["kind"], s["value"]))).alias("spans")).where(F.size("spans") > 0).dropDuplicates(["id", "hash"])
    rows = docs.select("doc_id", "text").join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (key() == F.col("hash")), "left")

    def mark(s: Column) -> Column:
        general = F.when(s["value"].rlike("^[A-Z]"), "[NAME]").otherwise("[WORD]")
        return F.when(s["kind"] == "remove", "").when(s["kind"] == "general", general).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"].cast("int") - acc["at"], F.lit(0)))
        return F.when(s["start"] >= acc["at"], F.struct(F.concat(acc["out"], gap, mark(s)).alias("out"), s["end"].cast("int").alias("at"))).otherwise(
            F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"].cast("int")).alias("at")))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    new = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return rows.select("doc_id", F.coalesce(new, "text").alias("text"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.concat("base", "terms")).alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def op12_sql() -> str:
    """The same rows in DuckDB SQL, from the plain patterns; doc_ids are taken as unique."""
    def spans(pattern: str, where: str) -> str:
        return (f"(SELECT *, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS g FROM d {where})")

    placed = """list_transform(range(1, len(m) + 1), lambda i: {'start': (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1],
      lambda x: length(x))), 0))::BIGINT, 'value': m[i]})"""
    valid = {
        "email": "true",
        "ip": f"regexp_full_match(value, '{BYTE_VALUE}(\\.{BYTE_VALUE}){{3}}')",
        "card": f"""length(digits) BETWEEN {CARD_DIGITS[0]} AND {CARD_DIGITS[1]} AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN digits[length(digits) - i + 1]::INT WHEN digits[length(digits) - i + 1]::INT > 4 THEN 2 * digits[length(digits) - i + 1]::INT - 9
      ELSE 2 * digits[length(digits) - i + 1]::INT END)) % 10 = 0""",
        "phone": f"length(digits) BETWEEN {PHONE_DIGITS[0]} AND {PHONE_DIGITS[1]}",
    }
    each = " UNION ALL ".join(
        f"""SELECT doc_id, text, '{kind}' AS kind, {k} AS nr, start, start + length(value) AS stop, value,
    {"digits" if kind in ("card", "phone") else "translate(value, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"} AS entity_value
  FROM (SELECT doc_id, text, s.start, s.value, regexp_replace(s.value, '[^0-9]', '', 'g') AS digits FROM (SELECT doc_id, text, unnest({placed}) AS s
  FROM {spans(PLAIN[kind], "")})) WHERE {valid[kind]}""" for k, kind in enumerate(KINDS))
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    test = lambda n_t: (f"n_et >= {SUPPORT} AND n_et >= {GUESS} * {n_t} AND n_e < n AND "  # noqa: E731
                        f"ln(n_et::DOUBLE * n / (n_e::DOUBLE * {n_t})) >= {DISCLOSE} * ln(n::DOUBLE / n_e)")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS ({each}),
size AS (SELECT count(DISTINCT text) AS n FROM d),
win AS (SELECT text, kind || ':' || entity_value AS entity,
    CASE WHEN start > {WINDOW} THEN regexp_replace(substring(text, start - {WINDOW} + 1, {WINDOW}), '^{WORD}', '') ELSE substring(text, 1, start) END AS l,
    CASE WHEN length(text) > stop + {WINDOW} THEN regexp_replace(substring(text, stop + 1, {WINDOW}), '{WORD}$', '') ELSE substring(text, stop + 1, {WINDOW}) END AS r
  FROM base),
beside AS (SELECT DISTINCT text, entity, term FROM (SELECT text, entity, unnest(regexp_extract_all({low.format("l || ' ' || r")}, '{WORD}')) AS term FROM win)),
ne AS (SELECT entity, count(DISTINCT text) AS n_e FROM win GROUP BY entity),
pair AS (SELECT entity, term, count(*) AS n_et FROM beside GROUP BY ALL HAVING count(*) >= {SUPPORT}),
word AS (SELECT doc_id, text, unnest(list_distinct(regexp_extract_all({low.format("text")}, '{WORD}'))) AS term FROM d),
nt AS (SELECT term, count(DISTINCT text) AS n_t FROM word WHERE term IN (SELECT term FROM pair) GROUP BY term),
term AS (SELECT term, CASE WHEN bool_or(n_et = n_t) THEN 'remove' ELSE 'general' END AS kind
  FROM pair JOIN ne USING (entity) JOIN nt USING (term), size WHERE {test("n_t")} GROUP BY term),
held AS (SELECT doc_id, m, g FROM {spans(WORD, "WHERE doc_id IN (SELECT doc_id FROM word JOIN term USING (term))")}),
place AS (SELECT doc_id, s.start AS start, s.start + length(s.value) AS stop, term.kind AS kind
  FROM (SELECT doc_id, unnest({placed}) AS s FROM held) JOIN term ON {low.format("s.value")} = term.term),
extra AS (SELECT p.* FROM place p WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = p.doc_id AND b.start < p.stop AND p.start < b.stop)),
every AS (SELECT doc_id, nr, kind, start, stop FROM base UNION ALL SELECT doc_id, CASE kind WHEN 'general' THEN 8 ELSE 9 END, kind, start, stop FROM extra),
s AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY nr, start) AS spans,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY nr, start) FILTER (nr < 8) AS b, count(*) FILTER (nr >= 8) AS n_terms,
    {", ".join(f"count(*) FILTER (nr = {i}) AS n_{k}" for i, k in enumerate(KINDS))} FROM every GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in KINDS)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_terms, 0)::BIGINT AS n_terms FROM d LEFT JOIN s ON d.doc_id = s.doc_id"""
