"""Language of web pages: text, declared language and address, combined by Bayes' rule.

* Text: a multinomial model of hashed byte trigrams for each language, counted
  over all labelled documents. Neighbouring trigrams are not independent, so the
  log likelihood of a long text is scaled down to that of ``TEXT_WEIGHT``
  trigrams at most.
* Declared language (``<html lang>``): how often each language is declared for
  pages whose text is in a given one, by grouped sums of the text posteriors.
* Address: shares of languages on the page's host, smoothed by those of its
  domain, these by those of its suffix, and these by those of all pages. A
  page's own text posterior is left out of its host's sums.

The posterior is the product of the three, normalised.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.tables import Scratch, bounded_batches
from strata.llm.url_filter import host_of

BUCKETS = 1 << 14
TEXT_WEIGHT = 40.0
#: Pages that a level's own counts must have to weigh as much as the level above.
SMOOTHING = 5.0
#: Prior counts of a declaration that agrees with the text, and of one that does not.
AGREES, DIFFERS = 4.0, 1.0

_HIDDEN = re.compile(rb"(?is)<!--.*?-->|<(script|style|nav|header|footer|noscript)\b.*?</\1\s*>")
_TAG = re.compile(rb"(?s)<[^>]*>|&[a-zA-Z#0-9]+;")
_DECLARED = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})"


def visible_text(html: bytes) -> bytes:
    """Text of a page outside markup, scripts, styles, comments and navigation."""
    return _TAG.sub(b" ", _HIDDEN.sub(b" ", html))


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every three bytes inside a text, A-Z as a-z, digits and signs of ASCII as space."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fold = np.arange(256)
    fold[:128] = 32
    fold[97:123] = fold[65:91] = np.arange(97, 123)
    x = fold[data].astype(np.uint32)
    code = x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)
    bucket = (code * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok = (row[:-2] == row[2:]) & (code != 0x202020)
    return bucket[ok], row[:-2][ok]


class TextModel:
    """Log probabilities of trigram buckets for each language: ``BUCKETS`` numbers a language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.logs = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))

    def likelihoods(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, languages): scaled log likelihoods, 0 for texts without a trigram."""
        bucket, row = _trigrams(data, offsets)
        n = np.bincount(row, minlength=len(offsets) - 1)
        total = np.stack([np.bincount(row, weights=logs[bucket], minlength=len(offsets) - 1) for logs in self.logs], axis=1)
        return total / np.maximum(n, 1)[:, None] * (TEXT_WEIGHT * n / (TEXT_WEIGHT + n))[:, None]


def fit_text(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Model of all rows with a language and a text; the driver gets ``BUCKETS`` sums a language.

    Without any such row the one language is ``und``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offsets = arrays.text_bytes(batch.column(1))
            kinds = {x: i for i, x in enumerate(dict.fromkeys(names))}
            kind = np.array([kinds[x] for x in names], dtype=np.int64)
            for a, b in arrays.row_slices(offsets):
                o = offsets[a:b + 1]
                bucket, row = _trigrams(data[o[0]:o[-1]], o - o[0])
                made = np.bincount(kind[a + row] * BUCKETS + bucket, minlength=len(kinds) * BUCKETS).reshape(-1, BUCKETS)
                for name, i in kinds.items():
                    sums[name] = sums.get(name, 0) + made[i]
        for name, made in sums.items():
            at = np.flatnonzero(made)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(made[at])],
                                             ["lang", "bucket", "n"])

    known = docs.select(F.lower(F.col(lang_col)).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    rows = (known.mapInArrow(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    if not languages:
        return TextModel(["und"], np.zeros((1, BUCKETS)))
    counts = np.zeros((len(languages), BUCKETS))
    counts[np.searchsorted(languages, rows["lang"]), rows["bucket"].to_numpy()] = rows["n"]
    return TextModel(languages, counts)


def _normal(logs: list[Column]) -> list[Column]:
    """Probabilities from log weights."""
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    each = [F.exp(x - top) for x in logs]
    return [x / sum(each) for x in each]


def identify(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a page: id, ``lang``, ``confidence``, ``declared`` and ``text_lang`` (the text's alone).

    Null and empty pages have no text evidence and no declaration; null urls
    and urls without a host share one host. With no evidence at all the result
    is the corpus's most frequent language. Ties go to the first language by
    name. Repeated rows give a row each and count each. Other columns are not
    read. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "language-id")
    k = len(model.languages)
    likely = [f"l{i}" for i in range(k)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(x) if x else b"" for x in batch.column(3).cast(pa.binary()).to_pylist()]
            data, offsets = arrays.text_bytes(pa.array(texts, pa.large_binary()))
            found = np.concatenate([np.zeros((0, k)), *(
                model.likelihoods(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in arrays.row_slices(offsets))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(np.ascontiguousarray(x)) for x in found.T)],
                                             ["id", "host", "declared", *likely])

    declared = F.lower(F.regexp_extract(F.coalesce(F.col(html_col), F.lit("")), _DECLARED, 1))
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), declared.alias("declared"),
                        F.col(html_col).alias("html"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.mapInArrow(read, f"id {kind}, host string, declared string, " + ", ".join(f"{c} double" for c in likely))
    posterior = [p.alias(f"p{i}") for i, p in enumerate(_normal([F.col(c) for c in likely]))]
    rows = scratch.save(rows.select("*", *posterior), "evidence")
    p = [F.col(f"p{i}") for i in range(k)]

    labels = F.split("host", r"\.")
    suffix = F.element_at(labels, -1)
    domain = F.array_join(F.slice(F.reverse(labels), 1, 2), ".")
    known = rows.withColumn("suffix", suffix).withColumn("domain", domain)

    def sums(level: str, name: str) -> DataFrame:
        return known.groupBy(F.col(level).alias(f"{name}_key")).agg(
            F.count("*").alias(f"{name}_n"), *(F.sum(f"p{i}").alias(f"{name}_{i}") for i in range(k)))

    every = rows.agg(F.count("*").alias("n"), *(F.sum(f"p{i}").alias(f"s{i}") for i in range(k))).first()
    total = [((every[f"s{i}"] or 0.0) + 1.0) / ((every["n"] or 0) + k) for i in range(k)]
    said = (known.groupBy(F.col("declared").alias("said_key")).agg(*(F.sum(f"p{i}").alias(f"said_{i}") for i in range(k))))
    names = {lang: i for i, lang in enumerate(model.languages)}

    # shares by suffix, domain and host, each leaning on the level above
    def smoothed(name: str, above: list[Column], own: list[Column] | None = None) -> list[Column]:
        less = F.lit(0.0) if own is None else F.lit(1.0)
        n = F.col(f"{name}_n") - less + SMOOTHING
        return [(F.col(f"{name}_{i}") - (own[i] if own else F.lit(0.0)) + SMOOTHING * above[i]) / n for i in range(k)]

    domains = sums("domain", "domain").withColumn("in_suffix", F.element_at(F.split("domain_key", r"\."), 1))
    domains = domains.join(sums("suffix", "suffix"), F.col("in_suffix") == F.col("suffix_key"))
    shares = smoothed("domain", smoothed("suffix", [F.lit(x) for x in total]))
    domains = domains.select("domain_key", *(s.alias(f"d{i}") for i, s in enumerate(shares)))
    # the levels meet on distinct hosts; pages meet these once
    hosts = sums("host", "host").withColumn("domain", F.array_join(F.slice(F.reverse(F.split("host_key", r"\.")), 1, 2), "."))
    hosts = hosts.join(domains, F.col("domain") == F.col("domain_key")).drop("domain", "domain_key")
    joined = (rows.join(hosts, F.col("host") == F.col("host_key")).join(said, F.col("declared") == F.col("said_key")))
    prior = smoothed("host", [F.col(f"d{i}") for i in range(k)], p)
    # P(declared | language); a page without a declaration says nothing
    spread = AGREES + DIFFERS * k
    of_lang = [F.lit(float(every[f"s{i}"] or 0.0)) for i in range(k)]
    declares = [(F.col(f"said_{i}") - p[i] + F.when(F.col("declared") == lang, AGREES).otherwise(DIFFERS))
                / (of_lang[i] - p[i] + spread) for lang, i in names.items()]
    logs = [F.col(likely[i]) + F.log(F.greatest(prior[i], F.lit(1e-9)))
            + F.when(F.col("declared") == "", 0.0).otherwise(F.log(F.greatest(declares[i], F.lit(1e-9)))) for i in range(k)]
    final = joined.select("id", "declared", *p, F.array(*_normal(logs)).alias("post"))
    lang = F.array(*map(F.lit, model.languages))
    return final.select(F.col("id").alias(id_col), F.element_at(lang, F.array_position("post", F.array_max("post")).cast("int")).alias("lang"),
                        F.array_max("post").alias("confidence"), F.nullif(F.col("declared"), F.lit("")).alias("declared"),
                        F.element_at(lang, F.array_position(F.array(*p), F.array_max(F.array(*p))).cast("int")).alias("text_lang"))
