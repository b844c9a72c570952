"""License scan by diagonal voting, in DataFrame functions only.

All rolling k-word hashes of every whole text are joined to the positions of the
same k words in the template texts (the words are compared too). A hit votes for
its diagonal, text position minus template position. Votes are counted by
(document, template, diagonal); neighbouring diagonals of a template that follow
each other in the text (words put in or left out) are merged into spans. A span is
verified by the share of the template's positions it covers.

A phrase stands in a text exactly where one diagonal has the votes of all its
positions. These places give the base columns; phrases and the longer notices give
the labels of the method.

Null and empty texts have no words and no labels (empty strings, null positions,
score 0). Rows with equal doc_id and text are answered alike, each as a row of its
own; null doc_ids too. Other columns are ignored. A document's hits are grouped by
document, so no group spans documents, whatever its templates.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

K = 3
#: Share of a notice's positions that a span must cover.
COVER = 0.6
#: Words between hits, and between diagonals, of one span.
GAP, DRIFT = 12, 8
MAX_TEMPLATE_WORDS = 100_000

# Phrases and notices as their licenses word them.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the software is provided as is without warranty of any kind express or implied"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, SEPARATORS), "")


def grams(df: DataFrame, *keep: str) -> DataFrame:
    """One row for each k words in a row of column ``w``: keep, pos, w0 .. and their hash."""
    n = F.greatest(F.size("w") - (K - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice("w", i + 1, n).alias(f"w{i}") for i in range(K)])
    rows = df.select(*keep, F.posexplode(zipped).alias("pos", "g"))
    names = [f"w{i}" for i in range(K)]
    return rows.select(*keep, "pos", *[F.col("g")[c].alias(c) for c in names]).withColumn("hash", F.xxhash64(*names))


def template_grams(spark: SparkSession, templates: list[tuple[str, str, bool]]) -> DataFrame:
    """(label, text, whether a phrase) to (template, label, phrase, total, tpos, k words, hash)."""
    if sum(len(t.split()) for _, t, _ in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_WORDS} words")
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(phrase).alias("phrase"), F.lit(text).alias("text"))
                     for i, (label, text, phrase) in enumerate(templates)])
    df = spark.range(1).select(F.explode(rows).alias("t")).select("t.*").withColumn("w", words(F.col("text")))
    df = df.withColumn("total", F.size("w") - (K - 1))
    return grams(df, "template", "label", "phrase", "total").withColumnRenamed("pos", "tpos")


def default_templates() -> list[tuple[str, str, bool]]:
    return [(label, text, True) for label, text in PHRASES] + [(label, text, False) for label, text in NOTICES]


def spans(docs: DataFrame, templates: list[tuple[str, str, bool]] | None = None) -> DataFrame:
    """Spans of (doc_id, text) rows: doc_id, text_hash, template, label, phrase, diagonal,
    first and last word, covered and total template positions. Phrases have one span
    for each place, notices one for each verified passage."""
    bounded = F.broadcast(template_grams(docs.sparkSession, templates or default_templates()))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    key = ["doc_id", "text_hash", "template", "label", "phrase", "total"]
    hits = grams(texts, "doc_id", "text_hash").join(bounded, ["hash", *[f"w{i}" for i in range(K)]])
    votes = (hits.select(*key, "pos", "tpos", (F.col("pos") - F.col("tpos")).alias("diagonal")).groupBy(*key, "diagonal")
             .agg(F.min("pos").alias("first"), (F.max("pos") + K - 1).alias("last"), F.collect_set("tpos").alias("tposes")))
    places = votes.where(F.col("phrase") & (F.size("tposes") == F.col("total")))
    along = Window.partitionBy(*key).orderBy("first", "diagonal")
    new = (F.col("first") > F.lag("last").over(along) + GAP) | (F.abs(F.col("diagonal") - F.lag("diagonal").over(along)) > DRIFT)
    merged = (votes.where(~F.col("phrase")).withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
              .withColumn("span", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*key, "span").agg(F.min("diagonal").alias("diagonal"), F.min("first").alias("first"), F.max("last").alias("last"),
                                         F.array_distinct(F.flatten(F.collect_list("tposes"))).alias("tposes")))
    notices = merged.where(F.size("tposes") >= COVER * F.col("total"))
    out = [*key, "diagonal", "first", "last", F.size("tposes").alias("covered")]
    return places.select(*out).unionByName(notices.select(*out))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    phrase = F.col("phrase")
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans(docs).groupBy(F.col("doc_id").alias("id"), "text_hash").agg(
        F.count_if(phrase).alias("n_base"), F.min(F.when(phrase, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("first"))).cast("long").alias("last_word"), labels(F.when(phrase, F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"), F.max(F.col("covered").cast("double") / F.col("total")).alias("score"))
    sizes = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return sizes.join(found, (F.col("hash") == F.col("text_hash")) & F.col("doc_id").eqNullSafe(F.col("id")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def op4_sql() -> str:
    """The same rows in DuckDB SQL, from the meaning of the columns."""
    templates = ", ".join(f"({i}, '{label}', '{text}', {str(phrase).lower()})" for i, (label, text, phrase) in enumerate(default_templates()))
    low = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH t(template, label, words, phrase) AS (
  SELECT a, b, string_split(c, ' '), d FROM (VALUES {templates}) v(a, b, c, d)),
tg AS (SELECT template, label, phrase, len(words) - 2 AS total, unnest(range(len(words) - 2)) AS tpos, words FROM t),
tk AS (SELECT template, label, phrase, total, tpos, words[tpos + 1] AS a, words[tpos + 2] AS b, words[tpos + 3] AS c FROM tg),
d AS (SELECT doc_id, regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
dg AS (SELECT doc_id, unnest(range(len(w) - 2)) AS pos, w FROM d),
hits AS (SELECT doc_id, template, label, phrase, total, pos, tpos, pos - tpos AS diagonal
  FROM (SELECT doc_id, pos, w[pos + 1] AS a, w[pos + 2] AS b, w[pos + 3] AS c FROM dg) JOIN tk USING (a, b, c)),
votes AS (SELECT doc_id, template, label, phrase, total, diagonal, min(pos) AS first, max(pos) + 2 AS last, list(DISTINCT tpos) AS tposes
  FROM hits GROUP BY ALL),
lagged AS (SELECT *, lag(last) OVER o AS was_last, lag(diagonal) OVER o AS was_diagonal FROM votes WHERE NOT phrase
  WINDOW o AS (PARTITION BY doc_id, template ORDER BY first, diagonal)),
numbered AS (SELECT *, sum(CASE WHEN was_last IS NULL OR first > was_last + {GAP} OR abs(diagonal - was_diagonal) > {DRIFT} THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id, template ORDER BY first, diagonal ROWS UNBOUNDED PRECEDING) AS span FROM lagged),
merged AS (SELECT doc_id, label, total, len(list_distinct(flatten(list(tposes)))) AS covered
  FROM numbered GROUP BY doc_id, template, label, total, span),
spans AS (
  SELECT doc_id, label, true AS phrase, first, 1.0::DOUBLE AS cover FROM votes WHERE phrase AND len(tposes) = total
  UNION ALL
  SELECT doc_id, label, false, NULL, covered::DOUBLE / total FROM merged WHERE covered >= {COVER} * total),
found AS (SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(first) AS first_word, max(first) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(cover) AS score FROM spans GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN found ON d.doc_id = found.doc_id"""
