"""Language identification by Bayesian evidence fusion.

The posterior of a language L for a row multiplies
* the text's likelihood: hashed byte trigrams, with tables counted over all rows
  under their declared language, tempered because trigrams overlap;
* P(declared language | L), from the table of declared against text-only languages;
* P(address suffix | L), counted in the same way;
* the host's prior P(L | host): the host's language counts, smoothed toward the
  prior of its parent (the address suffix), which is smoothed toward the corpus.
All counts are grouped aggregations over all rows; what reaches the driver has a
fixed size (languages x buckets, and languages x languages; there are at most 26^2 + 26^3 codes). Hosts and suffixes stay distributed and are joined.

A declared value counts by its primary subtag (``pt-BR``: ``pt``, ``zh_Hant``: ``zh``); a
three-letter code with a two-letter one of the same language counts as that (``est``:
``et``), others stand for themselves (``fil``), and values whose primary subtag is
neither, or names no language (``NO_LANGUAGE``), count as null. The languages are the
codes declared on at least ``MIN_SHARE`` of the rows that declare one and have text, and
on ``MIN_ROWS`` rows at least, whatever they are. A
further hypothesis, ``und``, stands for texts of none of them: each of its trigrams is
as likely as FIT above an unseen one, and it has its own counts by declared language,
suffix and host. Rows whose largest posterior is that of ``und`` are rejected, as are
rows without a single trigram; so a language declared on fewer rows, or on none, is
``und`` unless its text fits another one. Without any language (no row declares one,
or too few) nothing can be told apart: rows with trigrams are ``und`` and accepted.

Null declared languages, suffixes and hosts are no evidence; null and empty texts
are ``und``. Rows that repeat a key are rows of their own. An empty table gives no
rows. ``evidence`` names the columns, others are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, staged, table

UNKNOWN = "und"
#: The rows that must declare a language for it to be one: so many, and such a share of all that declare any.
MIN_ROWS, MIN_SHARE = 10, 1e-6
#: Codes that name no language.
NO_LANGUAGE = ("und", "unk", "mul", "mis", "zxx")
#: The three-letter codes of ISO 639-2 (terminological, then bibliographic) and
#: the withdrawn two-letter ones, each with its two-letter code of ISO 639-1.
CODES = """
aar aa abk ab afr af aka ak amh am ara ar arg an asm as ava av ave ae aym ay aze az bak ba bam bm bel be ben bn bis bi bod bo
bos bs bre br bul bg cat ca ces cs cha ch che ce chu cu chv cv cor kw cos co cre cr cym cy dan da deu de div dv dzo dz ell el
eng en epo eo est et eus eu ewe ee fao fo fas fa fij fj fin fi fra fr fry fy ful ff gla gd gle ga glg gl glv gv grn gn guj gu
hat ht hau ha heb he her hz hin hi hmo ho hrv hr hun hu hye hy ibo ig ido io iii ii iku iu ile ie ina ia ind id ipk ik isl is
ita it jav jv jpn ja kal kl kan kn kas ks kat ka kau kr kaz kk khm km kik ki kin rw kir ky kom kv kon kg kor ko kua kj kur ku
lao lo lat la lav lv lim li lin ln lit lt ltz lb lub lu lug lg mah mh mal ml mar mr mkd mk mlg mg mlt mt mon mn mri mi msa ms
mya my nau na nav nv nbl nr nde nd ndo ng nep ne nld nl nno nn nob nb nor no nya ny oci oc oji oj ori or orm om oss os pan pa
pli pi pol pl por pt pus ps que qu roh rm ron ro run rn rus ru sag sg san sa sin si slk sk slv sl sme se smo sm sna sn snd sd
som so sot st spa es sqi sq srd sc srp sr ssw ss sun su swa sw swe sv tah ty tam ta tat tt tel te tgk tg tgl tl tha th tir ti
ton to tsn tn tso ts tuk tk tur tr twi tw uig ug ukr uk urd ur uzb uz ven ve vie vi vol vo wln wa wol wo xho xh yid yi yor yo
zha za zho zh zul zu
alb sq arm hy baq eu bur my chi zh cze cs dut nl fre fr geo ka ger de gre el ice is mac mk mao mi may ms per fa rum ro slo sk
tib bo wel cy
iw he in id ji yi
""".split()
BUCKETS = 1 << 14
BLOCK_BYTES = 2_000_000
TEMPER = 0.25
SMOOTH = 0.5
#: Rows' worth of parent prior in a host's prior, and of corpus prior in a suffix's.
HOST_STRENGTH, SUFFIX_STRENGTH = 20.0, 100.0
#: Probability mass a language's model leaves to unseen trigrams.
UNSEEN = 0.02
#: A trigram of no language is so far above an unseen one, in log-likelihood.
FIT = 2.0


def evidence(df: DataFrame, key: str, text: Column, declared: Column, suffix: Column, host: Column) -> DataFrame:
    code = F.regexp_extract(F.lower(F.trim(declared)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    code = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for x in CODES]), code), code)
    declared = F.when(~code.isin(*NO_LANGUAGE) & (code != ""), code)
    return df.select(F.col(key).cast("long").alias("key"), text.alias("text"), declared.alias("declared"),
                     F.lower(suffix).alias("suffix"), F.lower(host).alias("host"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Web pages: visible text, the html element's lang, the host's last label, the host."""
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    host = F.regexp_extract("url", r"://([^/?#]*)", 1)
    lang = F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([A-Za-z]+)", 1)
    none = lambda c: F.when(c != "", c)
    return evidence(pages, "page_id", body, none(lang), none(F.regexp_extract(host, r"\.([A-Za-z]+)$", 1)), none(host))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents: the declared language, no address, and the source as host."""
    return evidence(docs, "doc_id", F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("source"))


def _trigrams(texts: pa.Array):
    """Blocks of (first text, buckets of all trigrams within texts, borders)."""
    raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(raw).to_numpy())
    at = 0
    while at < len(raw):
        done = ends[at - 1] if at else 0
        n = max(1, int(np.searchsorted(ends, done + BLOCK_BYTES, "right")) - at)
        block = raw.slice(at, n)
        cuts = np.frombuffer(block.buffers()[1], np.int64)[block.offset : block.offset + n + 1]
        data = np.frombuffer(block.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]].astype(np.uint32)
        data[(data >= 65) & (data <= 90)] += 32
        three = (data[:-2] * np.uint32(65536) + data[1:-1] * np.uint32(256) + data[2:]) if len(data) > 2 else np.zeros(0, np.uint32)
        buckets = ((three * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int32)
        yield at, n, buckets, cuts - cuts[0]
        at += n


def declared_languages(rows: DataFrame, least: int = MIN_ROWS, share: float = MIN_SHARE) -> tuple[str, ...]:
    """The codes declared on at least ``least`` rows with a trigram and on at least ``share``
    of all such rows that declare one, the most frequent first."""
    known = rows.where(F.col("declared").rlike("^[a-z]{2,3}$") & (F.octet_length("text") > 2))
    found = known.groupBy("declared").agg(F.count("*").alias("n")).collect()  # at most 26^2 + 26^3 rows
    least = max(least, share * sum(r["n"] for r in found))
    return tuple(r["declared"] for r in sorted(found, key=lambda r: (-r["n"], r["declared"])) if r["n"] >= least)


def count_rows(languages: tuple[str, ...]):
    """mapInArrow function: (text, declared) to the task's (language, bucket, n)."""

    def run(batches):
        n = np.zeros((len(languages), BUCKETS), np.int64)
        place = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            declared = [place.get(x) for x in batch.column(1).to_pylist()]
            for at, rows, buckets, cuts in _trigrams(batch.column(0)):
                for i in range(rows):
                    if declared[at + i] is not None and cuts[i + 1] - cuts[i] > 2:
                        x = buckets[cuts[i] : cuts[i + 1] - 2]
                        np.add.at(n[declared[at + i]], x, 1)
        where, bucket = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(bucket), pa.array(n[where, bucket])], names=["language", "bucket", "n"])

    return run


def text_models(rows: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Log-probability of each bucket under each language, counted over all rows."""
    n = np.zeros((len(languages), BUCKETS))
    counted = rows.select("text", "declared").mapInArrow(count_rows(languages), "language long, bucket long, n long")
    found = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages x buckets at most
    n[found["language"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    share = n / np.maximum(1, n.sum(axis=1, keepdims=True))
    return np.log((1 - UNSEEN) * share + UNSEEN / BUCKETS)


def likelihood_rows(models: np.ndarray):
    """mapInArrow function: evidence rows to the same without text, with the number of
    trigrams and the mean log-likelihood under each language and under none (the last)."""
    width = len(models) + 1

    def run(batches):
        for batch in batches:
            means, sizes = [], []
            for _, _, buckets, cuts in _trigrams(batch.column(batch.schema.get_field_index("text"))):
                size = np.maximum(0, np.diff(cuts) - 2)
                lo = np.minimum(cuts[:-1], len(buckets))
                mean = np.full((len(size), width), float(np.log(UNSEEN / BUCKETS)) + FIT)
                for i, model in enumerate(models):  # memory does not follow the number of languages
                    sums = np.zeros(len(buckets) + 1)
                    np.cumsum(model[buckets], out=sums[1:])
                    mean[:, i] = (sums[lo + size] - sums[lo]) / np.maximum(1, size)
                means.append(mean)
                sizes.append(size)
            mean = np.concatenate(means) if means else np.zeros((0, width))
            size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            keep = [i for i, c in enumerate(batch.schema.names) if c != "text"]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(mean) + 1, dtype=np.int32) * width), pa.array(mean.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(size), lists],
                                             names=[*[batch.schema.names[i] for i in keep], "n", "mean"])

    return run


def _argmax(scores: Column, names: Column) -> Column:
    """The name of the largest score; ties go to the one named first."""
    return F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))


def identify(rows: DataFrame, least: int = MIN_ROWS) -> DataFrame:
    """Per row of ``evidence``: key, lang, posterior, text_lang, declared, accepted."""
    small_batches(rows.sparkSession)
    languages = declared_languages(rows, least)
    if not languages:
        return rows.select("key", F.lit(UNKNOWN).alias("lang"), F.lit(1.0).alias("posterior"), F.lit(UNKNOWN).alias("text_lang"), "declared",
                           F.coalesce(F.octet_length("text") > 2, F.lit(False)).alias("accepted"))
    all_ = (*languages, UNKNOWN)
    place = {x: i for i, x in enumerate(all_)}
    array = lambda x: F.array(*[F.lit(v) for v in x])
    names = array(all_)
    models = text_models(rows, languages)
    scored = staged(rows.mapInArrow(likelihood_rows(models), "key long, declared string, suffix string, host string, n long, mean array<double>")
                    .withColumn("text_lang", F.when(F.col("n") == 0, UNKNOWN).otherwise(_argmax(F.col("mean"), names))), "language-text")
    known = scored.where("n > 0").groupBy("text_lang", "declared", "suffix", "host").agg(F.count("*").alias("n"))

    # P(declared | language), for the values that are languages; others share the rest
    value = F.when(F.col("declared").isin(*languages), F.col("declared")).otherwise("")
    said = np.full((len(all_), len(all_)), SMOOTH)
    for r in known.where("declared is not null").groupBy("text_lang", value.alias("value")).agg(F.sum("n").alias("n")).collect():
        said[place[r["text_lang"]], place.get(r["value"], -1)] += r["n"]
    said = np.log(said / said.sum(axis=1, keepdims=True))
    said = rows.sparkSession.createDataFrame(
        [(x or "", said[:, i].tolist()) for i, x in enumerate((*languages, ""))], "v string, p_declared array<double>")

    corpus = np.full(len(all_), SMOOTH)
    for r in known.groupBy("text_lang").agg(F.sum("n").alias("n")).collect():  # one row a language
        corpus[place[r["text_lang"]]] += r["n"]
    corpus = (corpus / corpus.sum()).tolist()

    def shares(by: list[str], strength: float, parent: Column, name: str) -> DataFrame:
        """P(language | by), from counts and ``strength`` rows' worth of the parent's shares."""
        counts = known.where(F.col(by[0]).isNotNull()).groupBy(*by, "text_lang").agg(F.sum("n").alias("n"))
        counts = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("text_lang", "n"))).alias("n"), F.sum("n").alias("all_n"))
        if "suffix" in by[1:]:
            counts = counts.join(suffixes, F.col("suffix") == F.col("s"), "left")
        return counts.select(*by, F.transform(names, lambda x, i: (
            F.coalesce(F.element_at("n", x), F.lit(0)) + strength * F.get(parent, i)) / (F.col("all_n") + strength)).alias(name))

    # P(language | suffix), smoothed toward the corpus, gives P(suffix | language) by the corpus shares
    suffixes = shares(["suffix"], SUFFIX_STRENGTH, array(corpus), "p_suffix").withColumnRenamed("suffix", "s")
    hosts = shares(["host", "suffix"], HOST_STRENGTH, F.coalesce("p_suffix", array(corpus)), "p_host").withColumnsRenamed({"host": "h", "suffix": "hs"})
    joined = (scored.join(suffixes, F.col("suffix") == F.col("s"), "left")
              .join(hosts, (F.col("host") == F.col("h")) & F.col("suffix").eqNullSafe(F.col("hs")), "left")
              .join(F.broadcast(said), F.when(F.col("declared").isNotNull(), value) == F.col("v"), "left"))

    def log_posterior(mean: Column, i: Column) -> Column:
        whole = F.get(array(corpus), i)
        return (TEMPER * F.col("n") * mean + F.coalesce(F.get("p_declared", i), F.lit(0.0)) + F.coalesce(F.log(F.get("p_suffix", i) / whole), F.lit(0.0))
                + F.log(F.coalesce(F.get("p_host", i), F.get("p_suffix", i), whole)))

    out = joined.withColumn("scores", F.transform("mean", log_posterior)).withColumn("top", F.array_max("scores"))
    weight = F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    lang = F.when(F.col("n") > 0, _argmax(F.col("scores"), names)).otherwise(UNKNOWN)
    return out.select("key", lang.alias("lang"), (1 / weight).alias("posterior"), "text_lang", "declared", (lang != UNKNOWN).alias("accepted"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (by doc_id) and all web pages (by page_id), each table with its own counts."""
    docs = identify(document_evidence(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")))
    pages = identify(page_evidence(table(spark, sf_dir, "pages", "page_id", "url", "html")))
    none = F.lit(None).cast("long")
    return docs.withColumnRenamed("key", "doc_id").withColumn("page_id", none).unionByName(pages.withColumnRenamed("key", "page_id").withColumn("doc_id", none))
