"""Language ID by Bayesian evidence fusion (operator 7).

Four kinds of evidence about a row's language are combined as log-odds:

* its text, by hashed byte trigrams under a naive Bayes model; a text counts as at most
  EFFECTIVE independent trigrams, as neighbouring ones are not independent;
* the declared language (``<html lang>`` or a column), and the address suffix (a language
  folder or a country domain), each by how often rows of a language declare it, which is
  estimated by a grouped aggregation over all rows;
* the host: rows of the same host share a prior, smoothed towards its domain's and that
  towards the corpus's, from grouped sums of the text posteriors; a row's own share is
  taken out again, so that it does not vote twice.

The text model is trained on a bounded sample of labelled rows (about TRAIN_ROWS, kept by
a hash of the id, cut at twice that); all other statistics cover all rows. A row is rejected if
its text has no letters, if training saw less than KNOWN_SHARE of its trigrams in any
language, or if no language reaches CONFIDENT.

Defined cases: null and empty texts have no letters; missing evidence counts as none;
repeated rows are judged alike; an empty table gives an empty result; without labelled rows
every row is rejected.
"""

from __future__ import annotations

import html as html_entities
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import SLICE_BYTES, Scratch, released, table

LANGUAGES = ("de", "en", "es", "fr")
#: Country domains and the language they speak for (fixed values).
DOMAINS = {"de": "de", "at": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "es": "es", "mx": "es", "ar": "es", "fr": "fr"}
BUCKETS = 1 << 16
TRAIN_ROWS = 2000
EFFECTIVE = 60
CONFIDENT = 0.5
HOST_STRENGTH, DOMAIN_STRENGTH = 8.0, 16.0
KNOWN_SHARE = 0.4  # of a text's trigrams, seen in training: below it the text is in none of the languages

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_OPEN = re.compile(r"(?i)<(?:(script|style|noscript)(?![A-Za-z0-9_])|!--)?")
_CLOSE = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "noscript")}
_HTML_LANG = r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})"


def html_text(page: str) -> str:
    """The text of a page without scripts, styles, comments and tags, each of which is a space.

    One walk from opening to closing marks: a kind of mark that is not closed any more is
    looked for once, so the time stays in proportion to the page. An unclosed script, style
    or comment counts as a mere tag, and an unclosed tag as text."""
    out, at, lost = [], 0, set()
    while (m := _OPEN.search(page, at)) is not None:
        end = -1
        kind = "--" if m[0] == "<!--" else (m[1] or "").lower()
        if kind and kind not in lost:
            if kind == "--":
                end = page.find("-->", m.end())
                end = end + 3 if end >= 0 else -1
            else:
                closed = _CLOSE[kind].search(page, m.end())
                end = closed.end() if closed else -1
            if end < 0:
                lost.add(kind)
        if end < 0:
            end = page.find(">", m.start()) + 1
            if not end:
                break
        out += [page[at:m.start()], " "]
        at = end
    return html_entities.unescape("".join([*out, page[at:]]))


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a text's letters; white space and marks are one gap."""
    data = b" ".join(text.encode().translate(_TABLE).split())
    if not data:
        return np.zeros(0, np.uint32)
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    return (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761) >> np.uint32(16)


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray | None:
    """Per trigram bucket the log-probabilities of the languages and whether at least two texts of training have it, from a bounded sample."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isin(*languages) & F.col("text").isNotNull())
    step = max(1, rows.select("lang").count() // TRAIN_ROWS)
    key = F.xxhash64(F.coalesce("id", F.lit("")), F.lit("language"))
    sample = rows.where(F.pmod(key, F.lit(step)) == 0).select(key.alias("k"), "lang", "text").orderBy("k").limit(2 * TRAIN_ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages) + 1, BUCKETS), np.int64)  # the last row counts texts
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                own = np.bincount(trigrams(text), minlength=BUCKETS)
                totals[languages.index(lang)] += own
                totals[-1] += own > 0
        l, k = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(l.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(totals[l, k])], names=["l", "k", "n"])

    found = (sample.repartition(8).select("lang", "text").mapInArrow(released(count), "l int, k int, n long")
             .groupBy("l", "k").agg(F.sum("n").alias("n")).collect())  # at most (languages + 1) x buckets rows
    if not found:
        return None
    counts = np.full((BUCKETS, len(languages) + 1), 0.1)
    for r in found:
        counts[r.k, r.l] += r.n
    seen = (counts[:, -1] >= 2).astype(np.float64)
    return np.column_stack([np.log(counts[:, :-1] / counts[:, :-1].sum(axis=0)), seen])


def _score(model: np.ndarray | None, text_col: str, markup: bool, n_languages: int):
    """Add text log-likelihoods and whether the text is in a known language; texts are read from ``_row``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if not whole.num_rows:
                continue
            texts = whole.column("_row").field(text_col)
            step = max(1, whole.num_rows * SLICE_BYTES // max(1, texts.nbytes))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                out, letters = np.zeros((batch.num_rows, n_languages)), np.zeros(batch.num_rows, bool)
                for i, text in enumerate(texts.slice(at, step).to_pylist()):
                    if not text or model is None:
                        continue
                    buckets = trigrams(html_text(text) if markup else text)
                    if len(buckets):
                        mean = model[buckets].mean(axis=0)
                        letters[i] = mean[-1] >= KNOWN_SHARE
                        out[i] = mean[:-1] * min(len(buckets), EFFECTIVE)
                lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, n_languages, dtype=np.int32), out.ravel())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(letters)], names=[*batch.schema.names, "_text_ll", "_spoken"])
    return run


def _softmax(col: str) -> str:
    top = f"transform({col}, x -> exp(x - array_max({col})))"
    return f"transform({top}, (x, i) -> x / aggregate({top}, CAST(0 AS DOUBLE), (a, y) -> a + y))"


def _evidence_table(rows: DataFrame, column: str, languages: tuple[str, ...]) -> dict[str, list[float]]:
    """log P(value | language) of each value (a language or "other"), from all rows that have one."""
    sums = rows.where(F.col(column).isNotNull() & F.col("_spoken")).groupBy(column).agg(
        *[F.sum(F.col("_r")[i]).alias(f"s{i}") for i in range(len(languages))]).collect()  # a row per language and "other"
    total = [sum(r[f"s{i}"] for r in sums) for i in range(len(languages))]
    values = len(languages) + 1
    return {r[column]: [math.log((r[f"s{i}"] + 1) / (total[i] + values)) for i in range(len(languages))] for r in sums}


def _lookup(column: str, table_: dict[str, list[float]], n: int) -> Column:
    out = F.array(*[F.lit(0.0)] * n)
    for value, logs in table_.items():
        out = F.when(F.col(column) == value, F.array(*[F.lit(x) for x in logs])).otherwise(out)
    return out


def identify(rows: DataFrame, model: np.ndarray | None, text_col: str, declared: Column, suffix: Column, host: Column,
             markup: bool = False, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """``_row`` (a struct of the columns of ``rows``, so that any names may occur among them), lang, confidence, text_lang, kept."""
    spark = rows.sparkSession
    n = len(languages)
    known = lambda c: F.when(c.isNull() | (c == ""), F.lit(None).cast("string")).when(c.isin(*languages), c).otherwise("other")
    evidence = [known(declared).alias("_declared"), known(suffix).alias("_suffix"), F.lower(host).alias("_host")]
    nested = rows.select(F.struct(*rows.columns).alias("_row"), *evidence)
    slim = rows.select(F.struct(text_col).alias("_row"), *evidence)

    def scored(df: DataFrame) -> DataFrame:
        schema = T.StructType([*df.schema.fields, T.StructField("_text_ll", T.ArrayType(T.DoubleType())), T.StructField("_spoken", T.BooleanType())])
        return df.mapInArrow(released(_score(model, text_col, markup, n)), schema)

    scratch = Scratch(spark, "language")
    votes = scratch.write(scored(slim).drop("_row").withColumn("_r", F.expr(_softmax("_text_ll"))).drop("_text_ll"), "votes")
    declared_logs, suffix_logs = (_evidence_table(votes, c, languages) for c in ("_declared", "_suffix"))
    sums = [F.sum(F.col("_r")[i]).alias(f"s{i}") for i in range(n)]
    heard = votes.where("_spoken")
    hosts = heard.where(F.col("_host").isNotNull()).groupBy("_host").agg(F.count(F.lit(1)).alias("n"), *sums)
    hosts = scratch.write(hosts.withColumn("domain", F.substring_index("_host", ".", -2)), "host-sums")
    all_ = heard.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    corpus = [((all_[f"s{i}"] or 0.0) + 1) / (all_["n"] + n) for i in range(n)]
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("dn"), *[F.sum(f"s{i}").alias(f"d{i}") for i in range(n)])
    # a row per host; as a written table it is broadcast only below Spark's own size threshold
    priors = scratch.write(hosts.join(domains, "domain").select(
        "_host", F.col("n").alias("_n"), F.array(*[f"s{i}" for i in range(n)]).alias("_s"),
        F.array(*[(F.col(f"d{i}") + DOMAIN_STRENGTH * corpus[i]) / (F.col("dn") + DOMAIN_STRENGTH) for i in range(n)]).alias("_d")), "priors")

    even = F.array(*[F.lit(math.log(c)) for c in corpus])
    own = (scored(nested).withColumn("_r", F.expr(_softmax("_text_ll")))
           .withColumn("_declared_ll", _lookup("_declared", declared_logs, n)).withColumn("_suffix_ll", _lookup("_suffix", suffix_logs, n))
           .join(priors, "_host", "left").withColumn("_corpus", even))
    prior = (f"transform(_s, (s, i) -> ln((greatest(s - IF(_spoken, _r[i], 0), 0) + {HOST_STRENGTH} * _d[i]) "
             f"/ (_n - IF(_spoken, 1, 0) + {HOST_STRENGTH})))")
    fused = own.withColumn("_ll", F.expr(f"transform(_text_ll, (x, i) -> x + _declared_ll[i] + _suffix_ll[i] + coalesce({prior}, _corpus)[i])"))
    names = F.array(*[F.lit(x) for x in languages])
    pick = lambda c: F.element_at(names, F.expr(f"CAST(array_position({c}, array_max({c})) AS INT)"))
    return (fused.withColumn("_p", F.expr(_softmax("_ll")))
            .select("_row", F.when(F.col("_spoken"), pick("_p")).alias("lang"), F.when(F.col("_spoken"), F.array_max("_p")).otherwise(0.0).alias("confidence"),
                    F.when(F.col("_spoken"), pick("_text_ll")).alias("text_lang"))
            .withColumn("kept", F.col("confidence") >= CONFIDENT))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages``, with a text model from the labelled ``documents``."""
    model = fit(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    host = F.when(host != "", F.lower(host))
    folder = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([A-Za-z]{2})(?:[/?#-]|$)", 1))
    country = F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    spoken = F.lit(None).cast("string")
    for code, lang in DOMAINS.items():
        spoken = F.when(country == code, lang).otherwise(spoken)
    suffix = F.when(folder.isin(*LANGUAGES), folder).otherwise(spoken)
    judged = identify(pages, model, "html", F.lower(F.regexp_extract("html", _HTML_LANG, 1)), suffix, host, markup=True)
    return judged.select("_row.page_id", "lang", "confidence", "text_lang", "kept")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose language is identified: text, the ``lang`` column as the declared language
    and the source as the host. Rejected rows go; the others stay as they are."""
    model = fit(docs, "doc_id", "text", "lang")
    judged = identify(docs, model, "text", F.lower(F.substring("lang", 1, 2)), F.lit(None).cast("string"), F.col("source"))
    return judged.where("kept").select("_row.*")
