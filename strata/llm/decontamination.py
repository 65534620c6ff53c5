"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

Seeds are all of a test item's word n-grams, however many documents hold them:
an edited passage that much of the corpus repeats has no others. Seed hits of a
document that lie near each other make a region; a region and an item with a
seed in common are aligned word by word, from an item's length before the first
hit to as much after the last, unless the region holds too few of the item's
words for any alignment to reach the threshold. The score is the local
alignment's, divided by what the whole item would give: 1 for an exact copy,
less by every changed, left out or inserted word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.bloom import HashFilter, hash_filter
from strata.llm.tables import Scratch, bounded_batches

SEED_WORDS = 3
#: Share of an item's full score from which a passage counts as its copy.
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, first word of the passage in it, one past its last)."""
    width = len(passage)
    j = np.arange(width + 1)
    row, begin = np.zeros(width + 1, dtype=np.int64), j.copy()
    best = (0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = row[1:] + GAP
        now, start = np.zeros(width + 1, dtype=np.int64), j.copy()
        now[1:] = np.maximum(np.maximum(diagonal, above), 0)
        start[1:] = np.where(now[1:] == 0, j[1:], np.where(diagonal >= above, begin[:-1], begin[1:]))
        # gaps along the passage: the best start to the left, less the way from there
        reach = np.maximum.accumulate(now - GAP * j)
        source = np.maximum.accumulate(np.where(now - GAP * j == reach, j, 0))
        row, begin = reach + GAP * j, start[source]
        end = int(row.argmax())
        if row[end] > best[0]:
            best = (int(row[end]), int(begin[end]), end)
    return best


def _seed_runs(words: arrays.Words, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of all runs of the given lengths, in order of place."""
    found = [arrays.runs_of(words, n) for n in lengths]
    h, at = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    order = np.argsort(at, kind="stable")
    return h[order], at[order]


def _items(items: DataFrame, n: int) -> DataFrame:
    """(item, words, hashes): each item's word hashes as bytes, and its distinct n-grams."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in arrays.batches_of_words(batch.column(1)):
                h, o = arrays.shingle_sets(words, n)
                each = [words.hashes[s:e].tobytes() for s, e in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(each, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(arrays.signed(h)))],
                    ["item", "words", "hashes"])

    return items.mapInArrow(read, "item long, words binary, hashes array<long>").where("size(hashes) > 0")


def _regions(docs: DataFrame, lengths: list[int], keep: HashFilter, reach: int) -> DataFrame:
    """(id, first, hashes, words): regions of hits, their distinct seeds, and the words around them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in arrays.batches_of_words(batch.column(1)):
                h, at = _seed_runs(words, lengths)
                ok = keep.may_hold(h)
                h, at = h[ok], at[ok]
                if not len(h):
                    continue
                row = np.searchsorted(words.offsets, at, side="right") - 1
                cut = np.flatnonzero((row[1:] != row[:-1]) | (at[1:] - at[:-1] > reach)) + 1
                begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(h)]])
                own = row[begin]
                left = np.maximum(at[begin] - reach, words.offsets[own])
                right = np.minimum(at[end - 1] + reach + max(lengths), words.offsets[own + 1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(own)), pa.array(left - words.offsets[own]),
                     pa.array([np.unique(arrays.signed(h[s:e])) for s, e in zip(begin, end, strict=True)], pa.list_(pa.int64())),
                     pa.array([words.hashes[s:e].tobytes() for s, e in zip(left, right, strict=True)], pa.binary())],
                    ["id", "first", "hashes", "words"])

    return docs.mapInArrow(find, "id long, first long, hashes array<long>, words binary")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", n: int = SEED_WORDS,
                 threshold: float = THRESHOLD) -> DataFrame:
    """Passages of ``docs`` that copy an item: one row for each (document id, item) found.

    Columns: the document id, the item id, ``score`` (0 to 1), and the passage
    ``first_word`` to ``last_word`` (one past it) of the best copy. Null and
    empty texts on either side match nothing; items of fewer than ``n`` words
    are sought as a whole. Rows without an id are left out, as nothing could
    name them; repeated ids count as one document, with its best copy. Other
    columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "decontamination")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    tests = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("item is not null")
    tests = scratch.save(_items(tests, n), "items")
    sizes = tests.select((F.octet_length("words") / 8).cast("int").alias("w"))
    facts = sizes.agg(F.max("w").alias("longest"), F.collect_set(F.least("w", F.lit(n))).alias("lengths")).first()
    lengths, reach = sorted(facts.lengths) or [n], facts.longest or 1  # at most n lengths

    seeds = tests.select("item", F.explode("hashes").alias("h"))
    regions = scratch.save(_regions(texts, lengths, hash_filter(seeds, "h"), reach), "regions")
    shared = (regions.select("id", "first", F.xxhash64("words").alias("key"), F.explode("hashes").alias("h"))
              .join(seeds, "h").select("id", "first", "key", "item").distinct())
    pairs = (shared.join(regions.select("id", "first", "words", F.xxhash64("words").alias("key")), ["id", "first", "key"])
             .join(tests.select("item", F.col("words").alias("item_words")), "item")
             .select("id", "first", "item", "words", "item_words"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows = [], []
            for i, (first, words, item) in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 3, 4)), strict=True)):
                item, words = np.frombuffer(item, np.uint64), np.frombuffer(words, np.uint64)
                if np.isin(item, words).sum() / len(item) < threshold:  # the score if all of these matched
                    continue
                points, start, end = align(item, words)
                found.append((points / (MATCH * len(item)), first + start, first + end))
                rows.append(i)
            score, start, end = (pa.array(x) for x in zip(*found, strict=True)) if found else (pa.array([], t) for t in (
                pa.float64(), pa.int64(), pa.int64()))
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(2).take(rows), score, start, end],
                                             ["id", "item", "score", "first_word", "last_word"])

    kinds = "id long, item long, score double, first_word long, last_word long"
    hits = pairs.mapInArrow(score, kinds).where(F.col("score") >= threshold)
    best = F.max_by(F.struct("score", "first_word", "last_word"),
                    F.struct("score", -F.col("first_word"), -F.col("last_word"))).alias("best")
    return (hits.groupBy("id", "item").agg(best)
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.score", "best.first_word", "best.last_word"))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` that hold no copy of an item; rows without an id stay."""
    found = contaminated(docs, items, id_col, **how).select(id_col).distinct()
    return docs.join(found, id_col, "left_anti").select(*docs.columns)
