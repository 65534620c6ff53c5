"""Token ids of documents as Parquet list columns.

The file format: Parquet files with one row a document, in ascending id order
within and across files (file names sort as the ids do). Columns: the document
id, ``shard`` (the file's number), ``n_tokens`` and ``ids`` (list of int). Ids
are dictionary encoded where a column chunk's dictionary stays small and else
bit-packed by deltas (format version 2); row groups and pages have a set size,
and page indexes are written, so readers can take the metadata alone, or the
tokens of a range of documents, without the rest.

Each distinct word that a worker meets is encoded once; words are found by a
hash and told apart by their bytes. A tokenizer whose
pre-tokenizer drops white space and parts letters from signs treats words, and
letters and signs within them, apart from each other, so the ids of a text are
those of these units in order. :func:`words_stand_alone` tells whether that
holds by the tokenizer's own definition; whole texts are encoded otherwise.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.tables import Scratch, bounded_batches

END_ID = 2
#: Writer settings: bytes of a row group and of a page, rows of a page, and the size at which a dictionary is given up.
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.page.write-checksum.enabled": "true",
    "compression": "zstd",
}
#: Text bytes of a file, about.
FILE_BYTES = 32 << 20
#: Words whose ids a task keeps.
KEPT_WORDS = 1 << 21


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def words_stand_alone(path: str) -> bool:
    """Whether a tokenizer's ids of a text are those of its words, cut between letters and signs.

    So it is when the normalizer composes, lower-cases and joins white space,
    and the first pre-tokenizer takes runs of letters and runs of signs
    (apostrophes open contractions) and drops what lies between; when nothing
    is put before the text; and when special tokens are without white space
    and within ``<|`` and ``|>``, whose signs are not cut at.
    """
    def steps(x: dict | None, key: str) -> list[dict]:
        return [] if x is None else x[key] if x.get("type") == "Sequence" else [x]

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    normal = steps(made.get("normalizer"), "normalizers")
    before = steps(made.get("pre_tokenizer"), "pretokenizers")
    return ({"type": "Lowercase"} in normal and all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": "\\s+"} and x["content"] == " "
                for x in normal)
            and bool(before) and before[0]["type"] == "Split" and before[0]["behavior"] == "Removed" and before[0]["invert"]
            and before[0]["pattern"].get("Regex") == _WORDS_AND_SIGNS
            and all(x["content"][:2] + x["content"][-2:] == "<||>" and not (x["lstrip"] or x["rstrip"] or any(c.isspace() for c in x["content"]))
                    for x in made["added_tokens"]))


#: Fixed value: the pre-tokenizer's pattern for which units stand alone.
_WORDS_AND_SIGNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# letters of ASCII, and its signs but those of contractions and special tokens
_KINDS = np.zeros(256, dtype=np.int8)
_KINDS[[*range(65, 91), *range(97, 123)]] = 1
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<|>"]] = 2


def _units(data: np.ndarray, offsets: np.ndarray) -> arrays.Words:
    """Units that are encoded apart; those alike but for A-Z and a-z have one hash, save where a special token may be."""
    units = arrays.words_of(data, offsets, lower=True, kinds=_KINDS)
    bars, letters = (np.concatenate([[0], np.cumsum(x)]) for x in (data == ord("|"), _KINDS[data] == 1))
    for i in np.flatnonzero((bars[units.ends] > bars[units.starts]) & (letters[units.ends] > letters[units.starts])).tolist():
        units.hashes[i] = xxhash.xxh64_intdigest(data[units.starts[i]:units.ends[i]].tobytes())
    return units


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _same_bytes(a: np.ndarray, a_starts: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_starts: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """Whether byte range ``i`` of ``a`` is that of ``b``, but for A-Z and a-z."""
    same = a_sizes == b_sizes
    size = np.where(same, a_sizes, 0)
    ends = np.cumsum(size)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    differ = _LOWER[a[np.repeat(a_starts, size) + inside]] != _LOWER[b[np.repeat(b_starts, size) + inside]]
    if differ.any():
        same[np.unique(np.searchsorted(ends, np.flatnonzero(differ), side="right"))] = False
    return same


class Encoder:
    """Ids of batches of texts, with the end id after each.

    Words met before are kept as sorted hashes beside their bytes and ids in one
    table, about ``KEPT_WORDS`` of them; when there are more, the oldest table
    goes. A word of another one's hash is encoded on its own, each time.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokens, self.by_word, self.end_id = tokenizer(path), words_stand_alone(path), end_id
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.begins, self.lengths, self.table = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int32))
        self.spelt, self.at, self.sizes = (np.zeros(0, t) for t in (np.uint8, np.int64, np.int64))

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each) of texts given as byte ranges."""
        raw = data.tobytes()
        said = self.tokens.encode_batch_fast([raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
                                             add_special_tokens=False)
        each = [x.ids for x in said]
        length = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), np.int32, int(length.sum())), length

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        flat, length = self._encode(data, starts, ends)
        at = np.searchsorted(self.hashes, hashes)
        self.begins = np.insert(self.begins, at, len(self.table) + np.cumsum(length) - length)
        self.hashes, self.lengths = np.insert(self.hashes, at, hashes), np.insert(self.lengths, at, length)
        self.table = np.concatenate([self.table, flat])
        size = ends - starts
        places = np.cumsum(size) - size
        self.at, self.sizes = np.insert(self.at, at, len(self.spelt) + places), np.insert(self.sizes, at, size)
        self.spelt = np.concatenate([self.spelt, data[np.repeat(starts - places, size) + np.arange(size.sum())]])

    def _missing(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        return np.flatnonzero((at == len(self.hashes)) | (np.append(self.hashes, np.uint64(0))[at] != hashes))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets of each text's ids) of texts given as bytes."""
        n = len(offsets) - 1
        if not self.by_word:
            flat, count = self._encode(data, offsets[:-1], offsets[1:])
            text_ends = np.cumsum(count)
        else:
            words = _units(data, offsets)
            unique, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
            new = self._missing(unique)
            if len(new) + len(self.hashes) > KEPT_WORDS:
                self._forget()
                new = np.arange(len(unique))
            if len(new):
                self._learn(unique[new], data, words.starts[first[new]], words.ends[first[new]])
            at = np.searchsorted(self.hashes, unique)[which]
            begin, size, table = self.begins[at], self.lengths[at], self.table
            other = np.flatnonzero(~_same_bytes(data, words.starts, words.ends - words.starts, self.spelt, self.at[at], self.sizes[at]))
            if len(other):
                more, count = self._encode(data, words.starts[other], words.ends[other])
                begin[other], size[other] = len(table) + np.cumsum(count) - count, count
                table = np.concatenate([table, more])
            ends = np.cumsum(size)
            flat = table[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
            text_ends = np.concatenate([[0], ends])[words.offsets[1:]]
        out_offsets = np.concatenate([[0], text_ends + np.arange(1, n + 1)])
        out = np.empty(out_offsets[-1], dtype=np.int32)
        is_end = np.zeros(len(out), dtype=bool)
        is_end[out_offsets[1:] - 1] = True
        out[is_end], out[~is_end] = self.end_id, flat
        return out, out_offsets


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this Python worker; tasks that follow each other share what it has met."""
    return Encoder(path, end_id)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID) -> None:
    """Write the token files of ``docs`` to ``folder``.

    Null texts count as empty ones; their ids are the end id alone. Null ids
    come first. Repeated rows are written as often as they come, rows of one id
    in order of their texts. An empty table gives files without rows. Other
    columns are not read. The tokenizer's file must exist at ``tokenizer_path``
    on every machine.
    """
    bounded_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer_path, end_id)
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(2))
            for a, b in arrays.row_slices(offsets):
                o = offsets[a:b + 1]
                ids, at = made.encode(data[o[0]:o[-1]], o - o[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(np.diff(at)),
                     pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))],
                    ["id", "shard", "n_tokens", "ids"])

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-total // FILE_BYTES), min(docs.sparkSession.sparkContext.defaultParallelism * 2, total >> 20))
    (base.repartitionByRange(files, "id").sortWithinPartitions("id", "text")
     .select("id", F.spark_partition_id().alias("shard"), "text")
     .mapInArrow(encode, "id long, shard int, n_tokens long, ids array<int>")
     .write.options(**LAYOUT).parquet(folder))


def read_tokens(spark, folder: str) -> DataFrame:
    """(id, shard, n_tokens, ids) of the files; columns not used are not read."""
    return spark.read.schema("id long, shard int, n_tokens long, ids array<int>").parquet(folder)


def token_index(spark, folder: str, id_col: str = "doc_id") -> DataFrame:
    """For each document of the files: id, ``start`` (ids before it), ``n_tokens`` and ``ids_crc32``.

    ``ids_crc32`` is the unsigned CRC-32 of all its ids as little-endian
    unsigned 32-bit integers, computed from what the files hold.
    """
    bounded_batches(spark)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat, at = ids.flatten().to_numpy().astype("<u4"), np.asarray(ids.offsets) - ids.offsets[0].as_py()
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                                             ["id", "shard", "place", "n_tokens", "ids_crc32"])

    files = read_tokens(spark, folder)
    rows = (files.select("id", "shard", F.col("_metadata.row_index").alias("place"), "ids")
            .mapInArrow(check, "id long, shard int, place long, n_tokens long, ids_crc32 long"))
    # one number a file
    sizes = files.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("skip", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(starts, "shard")
            .select(F.col("id").alias(id_col), (F.col("begin") + F.col("skip")).alias("start"), "n_tokens", "ids_crc32"))


def tokens_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as token files in the shared folder and return the index read back from them."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-files")
    folder = f"{scratch.base}/tokens"
    write_tokens(docs, folder, tokenizer_path, id_col, text_col)
    return token_index(spark, folder, id_col)
