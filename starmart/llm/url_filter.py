"""URL filter: host and path rules, and gradient-boosted trees for all other URLs.

A rule such as ``example.net/en/`` fits its host and all subdomains of it, if the
URL's path starts with the rule's path; the longest fitting rule decides. URLs that a
rule decides are the labelled ones; boosted trees learn from them on lexical features
(length, depth, digit ratio, entropy, parameter counts, and statistics of the host's
suffixes) and judge the others.

Suffix statistics are block rates of the last label and the last two labels of a
host, by grouped aggregation over all labelled URLs, smoothed toward the overall rate.
The trees are fitted on at most about ``train_rows`` labelled URLs (those with the smallest
hashes, one of each verdict at least, however many there are); everything else covers all rows. If the labelled URLs know one verdict only, or there are none,
the others are judged by the overall rate (allow without any).

A null URL or one without ``://`` has an empty host and path, fits no rule and is
judged by the trees as it is. A URL of any length is read whole. Rows that repeat a page_id are rows of their own; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

# The rules.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
TRAIN_ROWS = 20_000
TREES, DEPTH = 10, 4
#: Rows' worth of overall rate in a suffix's rate.
STRENGTH = 20.0
THRESHOLD = 0.5

FEATURES = ("f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_hyphens", "f_entropy", "f_parameters",
            "f_query_length", "f_fragment", "f_https", "f_rate_1", "f_rate_2", "f_seen_1", "f_seen_2")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    out = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, rule_path = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits, from the runs of the sorted characters."""
    state = lambda c, run, bits: F.struct(c.alias("c"), run.alias("run"), bits.alias("bits"))
    closed = lambda s: s["bits"] + F.when(s["run"] > 0, s["run"] * F.log2(s["run"])).otherwise(0.0)
    chars = F.sort_array(F.filter(F.split(text, ""), lambda c: c != ""))
    n = F.greatest(F.size(chars), F.lit(1)).cast("double")
    return F.aggregate(
        chars, state(F.lit(""), F.lit(0.0), F.lit(0.0)),
        lambda s, c: F.when(s["c"] == c, state(c, s["run"] + 1.0, s["bits"])).otherwise(state(c, F.lit(1.0), closed(s))),
        lambda s: F.log2(n) - closed(s) / n)


def lexical_features(df: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.split("host", r"\."))
    n = F.size(labels)
    return df.withColumns({
        "f_length": F.length(url).cast("double"), "f_host_length": F.length("host").cast("double"), "f_path_length": F.length("path").cast("double"),
        "f_depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"), "f_labels": n.cast("double"),
        "f_digits": _share(url, r"[^0-9]"), "f_hyphens": F.length(F.regexp_replace("host", r"[^-]", "")).cast("double"), "f_entropy": _entropy(F.lower(url)),
        "f_parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")), "f_query_length": F.length(query).cast("double"),
        "f_fragment": F.contains(url, F.lit("#")).cast("double"), "f_https": F.lower(F.substring(url, 1, 6)).eqNullSafe("https:").cast("double"),
        "suffix_1": F.when(n > 0, F.element_at(labels, -1)).otherwise(""),
        "suffix_2": F.when(n > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")),
    })


def judge(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of (page_id, url): page_id, url, host, path, rule, verdict, probability
    (that the trees give a block; null where a rule decided)."""
    host, path = host_and_path(F.col("url"))
    rows = lexical_features(pages.select(F.col("page_id").cast("long"), "url").withColumns({"host": host, "path": path}))
    rows = staged(rows.withColumn("r", rule_for(F.col("host"), F.col("path"), rules))
                  .withColumn("label", F.when(F.col("r").isNotNull(), (F.col("r.verdict") == "block").cast("double")))
                  .withColumn("rule", F.col("r.rule")).drop("r"), "url-features")
    known = rows.where("label is not null")
    h = F.xxhash64("url", "page_id")
    n, blocked, *lowest = known.agg(F.count("*"), F.sum("label"), *[F.min(F.when(F.col("label") == x, h)) for x in (0, 1)]).first()
    rate = (blocked or 0.0) / n if n else 0.0
    full = rows
    for i in (1, 2):
        stats = known.groupBy(F.col(f"suffix_{i}").alias(f"s{i}")).agg(F.sum("label").alias("b"), F.count("*").alias("n"))
        stats = stats.select(f"s{i}", ((F.col("b") + STRENGTH * rate) / (F.col("n") + STRENGTH)).alias(f"r{i}"), F.log1p("n").alias(f"n{i}"))
        full = (full.join(stats, F.col(f"suffix_{i}") == F.col(f"s{i}"), "left")
                .withColumn(f"f_rate_{i}", F.coalesce(f"r{i}", F.lit(rate))).withColumn(f"f_seen_{i}", F.coalesce(f"n{i}", F.lit(0.0))))
    full = full.select("page_id", "url", "host", "path", "rule", "label", *FEATURES)
    decided = F.when(F.col("label") == 1, "block").otherwise("allow")
    if not n or blocked in (0, n):
        return full.select("page_id", "url", "host", "path", "rule", F.when(F.col("label").isNotNull(), decided).otherwise(
            "block" if rate >= threshold and n else "allow").alias("verdict"), F.when(F.col("label").isNull(), F.lit(float(rate))).alias("probability"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(full)
    share = min(1.0, train_rows / n)
    chosen = vectors.where("label is not null").select("features", "label", h.alias("h")).where(((F.col("h") / 2.0**64 + 0.5) < share) | F.col("h").isin(lowest))
    chosen = chosen.repartition(4, "h").sortWithinPartitions("h")
    model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=1).fit(chosen.select("features", "label"))
    scored = model.transform(vectors).withColumn("p", vector_to_array("probability")[1])
    return scored.select("page_id", "url", "host", "path", "rule",
                         F.when(F.col("label").isNotNull(), decided).otherwise(F.when(F.col("p") >= threshold, "block").otherwise("allow")).alias("verdict"),
                         F.when(F.col("label").isNull(), F.col("p")).alias("probability"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "probability")
