"""Removal of lines that many sites share, by HyperLogLog sketches of each line's sites.

A line's identity is the hash of its words (A-Z as a-z, white space aside).
Lines seen on one site only are told apart first, by minimum and maximum of the
sites' hashes. For the others, sketches of the sites merge by aggregation; where
the estimate is near the threshold the sites are counted exactly. The decision
is the exact count's: an estimate is trusted only at a distance from the
threshold of many times its standard error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.bloom import HashFilter, hash_filter
from strata.llm.tables import Scratch, bounded_batches

#: Sites from which a line counts as boilerplate, and words below which a line is never removed (lines without words stay).
LEAST_SITES = 5
LEAST_WORDS = 1
#: log2 of the sketches' registers: a standard error of 3.3 %; estimates within the margin are counted.
REGISTERS_LOG2 = 10
MARGIN = 0.25


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of words, row) of every line of texts; a text's last line may be empty."""
    feeds = np.flatnonzero(data == 10)
    n = len(offsets) - 1
    at = np.concatenate([offsets[:-1], feeds + 1])
    row = np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, side="right") - 1])
    order = np.lexsort((at, row))
    at, row = at[order], row[order]
    words = arrays.words_of(data, np.concatenate([at, [len(data)]]))
    count = np.diff(words.offsets)
    place = np.arange(len(words.hashes)) - np.repeat(words.offsets[:-1], count)
    h = arrays.mix(words.hashes + arrays.mix(place.astype(np.uint64) + np.uint64(1)))
    return arrays.mix(arrays.sums_by_row(h, words.offsets) + count.astype(np.uint64)), count, row


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = arrays.text_bytes(column)
    for a, b in arrays.row_slices(offsets):
        o = offsets[a:b + 1]
        yield a, b, data[o[0]:o[-1]], o - o[0]


def _line_sites(rows: DataFrame, least_words: int, keep: HashFilter | None = None) -> DataFrame:
    """(line, site) of rows (site, text), each once a batch."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            site = batch.column(0).to_numpy()
            for a, _, data, o in _slices(batch.column(1)):
                h, count, row = _lines(data, o)
                ok = count >= least_words
                if keep is not None:
                    ok &= keep.may_hold(h)
                each = np.unique(np.stack([arrays.signed(h[ok]), site[a + row[ok]]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(each[:, 0]), pa.array(each[:, 1])], ["line", "site"])

    return rows.select("site", "text").mapInArrow(read, "line long, site long")


def _site(source: Column) -> Column:
    """A number for each site; rows without one are a site of their own."""
    return F.coalesce(F.when(source.isNotNull(), F.xxhash64(source)), F.lit(0).cast("long"))


def shared_lines(rows: DataFrame, least_sites: int, least_words: int, scratch: Scratch) -> DataFrame:
    """(line): hashes of lines on at least ``least_sites`` sites, from rows (site, text)."""
    ends = _line_sites(rows, least_words).groupBy("line").agg(F.min("site").alias("lo"), F.max("site").alias("hi"))
    several = scratch.save(ends.where("lo <> hi").select("line"), "several")
    if least_sites <= 2:
        return several if least_sites == 2 else scratch.save(ends.select("line"), "lines")
    pairs = (_line_sites(rows, least_words, hash_filter(several, "line"))
             .join(several, "line", "left_semi").distinct())
    pairs = scratch.save(pairs, "pairs")
    spread = pairs.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(REGISTERS_LOG2)).alias("sketch"))
    spread = scratch.save(spread.select("line", F.hll_sketch_estimate("sketch").alias("sites")), "spread")
    sure = spread.where(F.col("sites") > least_sites * (1 + MARGIN)).select("line")
    near = spread.where(F.col("sites").between(least_sites * (1 - MARGIN), least_sites * (1 + MARGIN))).select("line")
    counted = (pairs.join(near, "line", "left_semi").groupBy("line").agg(F.countDistinct("site").alias("sites"))
               .where(F.col("sites") >= least_sites).select("line"))
    return scratch.save(sure.unionByName(counted), "shared")


def without_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                         least_sites: int = LEAST_SITES, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row a document: id, ``n_lines``, ``n_removed`` and the text without lines that many sites share.

    Lines end at line feeds; what is left is joined by line feeds. Lines of
    fewer than ``least_words`` words stay (by default those without any). Every line of a text counts once for
    the text's site, null being a site. A null text stays null with 0 lines, an
    empty one has one empty line. Repeated rows give a row each. Other columns
    are not read. Null ids are ids like others. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "line-dedup")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), _site(F.col(site_col)).alias("site"))
    shared = shared_lines(rows.where("text is not null"), least_sites, least_words, scratch)
    keep = hash_filter(shared, "line")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, o in _slices(batch.column(1)):
                h, count, row = _lines(data, o)
                number = np.arange(len(h)) - np.searchsorted(row, row)
                ok = (count >= least_words) & keep.may_hold(h)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(a + row[ok])), pa.array(arrays.signed(h[ok])), pa.array(number[ok])],
                    ["key", "line", "number"])

    key = F.xxhash64("id", "text").alias("key")
    found = (rows.where("text is not null").select(key, "text").mapInArrow(places, "key long, line long, number long")
             .join(shared, "line", "left_semi").groupBy("key").agg(F.collect_set("number").alias("gone")))
    # numbers of lines that stay, in one pass over both lists
    stay = F.array_except(F.sequence(F.lit(0).cast("long"), F.size("lines") - F.lit(1).cast("long")), F.col("gone"))
    kept = F.transform(stay, lambda i: F.get("lines", i.cast("int")))
    return (rows.withColumn("key", key).join(found, "key", "left").withColumn("lines", F.split("text", "\n"))
            .select(F.col("id").alias(id_col), F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
                    F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
                    F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")))


#: DuckDB SQL of the same rows, with the sites counted exactly.
SQL = r"""
WITH l AS (
  SELECT row, doc_id, site, n, line,
    regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT row, doc_id, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS n
        FROM (SELECT row_number() OVER () AS row, doc_id, coalesce(source, chr(1)) AS site, string_split(text, chr(10)) AS lines
              FROM documents))),
shared AS (SELECT words FROM l WHERE len(words) >= 1 GROUP BY words HAVING count(DISTINCT site) >= 5),
marked AS (SELECT l.*, shared.words IS NOT NULL AS gone FROM l LEFT JOIN shared ON l.words = shared.words)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '') AS text
FROM marked GROUP BY row, doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
