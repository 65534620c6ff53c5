"""SentencePiece ids of whole texts from a table of distinct chunks.

A chunk is a run of whitespace markers and what follows up to the next run.
Where no piece has a marker after another character, no merge crosses the
start of a chunk, so the ids of a text are those of its chunks in order, and
each distinct chunk needs to be segmented once, however often it occurs:

1. each task cuts its texts into chunks, block by block, and lists the distinct
   chunks of a block with their places in that list, in buckets by the chunk's hash;
2. the lists of a bucket meet, and each distinct chunk is segmented once; a frequent
   one stands there once a block, and not once an occurrence;
3. the ids go back to the blocks;
4. the blocks' texts, as compressed lists of places, meet them and are spelled out
   by position.

Chunks are told apart by their bytes. A block holds ``BLOCK_BYTES`` of text or
one text, and there is a bucket for every ``BUCKET_BYTES`` of text, so no step
keeps more than that in a task; lists are compressed. Models that do not fit
(:func:`chunks_stand_alone`) have whole texts as chunks. Nothing but the three
shuffles is written: the texts are read twice instead of being stored between.
A block's key has a digest of its list, so an input that gives other rows when
it is read again (say, a sample without seed) is noticed and not spelled wrong.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.tables import bounded_batches

MARK = "▁"
#: Bytes of text of a block, about.
BLOCK_BYTES = 16 << 20
#: Bytes of text for which there is a bucket of chunks.
BUCKET_BYTES = 64 << 20
#: Chunks that are segmented at once.
AT_ONCE = 1 << 16
#: Bytes of text of a row of places, about; a block has several.
ROW_BYTES = 4 << 20
_SPACE = 0x20


@lru_cache(maxsize=4)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def chunks_stand_alone(path: str) -> bool:
    """Whether the ids of a text are those of its chunks.

    So it is when no piece has a marker after another character, every character
    is left as it is but for the space, which becomes a marker, and one marker
    is put before a text. Pieces are all looked at, and so are all characters.
    """
    made = processor(path)
    pieces = (made.id_to_piece(i) for i in range(made.get_piece_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        return False
    every = "".join(map(chr, chain(range(1, 0xD800), range(0xE000, 0x110000))))
    return all(made.normalize(t) == MARK + t.replace(" ", MARK) for t in (every, "a  b ", "  a"))


def _chunks(text: pa.Array, cut: bool) -> tuple[pa.Array, np.ndarray]:
    """All chunks of texts, each with its first marker as a space, and how many each text has; empty texts have none."""
    text = text.cast(pa.large_string()).fill_null("")
    if cut:
        text = pc.replace_substring(text, MARK, " ")
    none, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    text = pc.if_else(pc.equal(text, none), none, pc.binary_join_element_wise(none, text, space))
    data, offsets = arrays.text_bytes(text)
    full = offsets[:-1] < offsets[1:]
    start = np.zeros(len(data) + 1, dtype=bool)
    if cut:
        space = data == _SPACE
        start[1:-1] = space[1:] & ~space[:-1]
    start[offsets[:-1][full]] = True
    at = np.flatnonzero(start)
    ends = np.append(at, len(data)).astype(np.int64)
    made = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
    return made, np.diff(np.searchsorted(at, offsets))


def encode_pieces(docs: DataFrame, model_path: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every row: the ids that the library gives for the whole text, then ``end_id`` unless None.

    Null texts count as empty ones, which have no ids but the end id. Null ids
    and repeated rows each give a row. Texts of any length are segmented whole.
    An empty table gives an empty result. Other columns are not read. The
    model's file must exist at ``model_path`` on every machine.
    """
    bounded_batches(docs.sparkSession)
    cut = chunks_stand_alone(model_path)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    key = ["block", "digest"]
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, total // BUCKET_BYTES, min(docs.sparkSession.sparkContext.defaultParallelism * 2, total >> 20))
    lists = base.mapInArrow(_lists(cut, buckets), "bucket int, block long, digest long, packed binary")
    found = (lists.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_segment(model_path), "block long, digest long, packed binary")
             .groupBy(key).agg(F.collect_list("packed").alias("found")))
    placed = base.mapInArrow(_places(cut), "block long, digest long, ids array<long>, counts array<int>, at binary")
    # blocks of empty texts alone have no chunks
    return (placed.join(found, key, "left").mapInArrow(_spell(end_id), "id long, ids array<int>")
            .select(F.col("id").alias(id_col), "ids"))


def _blocks(batches: Iterator[pa.RecordBatch], cut: bool) -> Iterator[tuple[int, int, pa.RecordBatch, pa.DictionaryArray, np.ndarray]]:
    """(number, digest of the distinct chunks, rows, chunks, chunks of each text) of blocks of (id, text)."""
    part, made = TaskContext.get().partitionId() << 32, 0
    held: list[pa.RecordBatch] = []
    size = 0

    def block():
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        chunks, counts = _chunks(rows.column(1), cut)
        told = chunks.dictionary_encode()
        mark = xxhash.xxh64()
        for buffer in told.dictionary.buffers()[1:]:
            mark.update(buffer or b"")
        return part + made, mark.intdigest() - (1 << 63), rows, told, counts

    for batch in batches:
        _, offsets = arrays.text_bytes(batch.column(1))
        for a, b in arrays.row_slices(offsets, BLOCK_BYTES):
            if held and size + offsets[b] - offsets[a] > BLOCK_BYTES:
                yield block()
                made, held, size = made + 1, [], 0
            held.append(batch.slice(a, b - a))
            size += int(offsets[b] - offsets[a])
    if sum(x.num_rows for x in held):
        yield block()


def _lists(cut: bool, buckets: int):
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, digest, _, told, _ in _blocks(batches, cut):
            if not len(told.dictionary):
                continue
            chunks = told.dictionary.cast(pa.large_binary())
            bucket = np.fromiter(map(zlib.crc32, chunks.to_pylist()), np.uint32, len(chunks)) % buckets
            place = np.argsort(bucket, kind="stable")
            head = np.flatnonzero(np.diff(bucket[place].astype(np.int64), prepend=-1))
            row = []
            for a, b in zip(head.tolist(), [*head[1:].tolist(), len(place)], strict=True):
                data, offsets = arrays.text_bytes(chunks.take(pa.array(place[a:b])))
                row.append(_packed(data, np.diff(place[a:b], prepend=0), np.diff(offsets)))
            n = len(head)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[place[head]].astype(np.int32)), pa.array(np.full(n, number)), pa.array(np.full(n, digest)),
                                              pa.array(row, pa.binary())], ["bucket", "block", "digest", "packed"])

    return lists


def _places(cut: bool):
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()
        for number, digest, rows, told, counts in _blocks(batches, cut):
            _, offsets = arrays.text_bytes(rows.column(1))
            ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            at = told.indices.to_numpy().astype("<i4")
            for a, b in arrays.row_slices(offsets, ROW_BYTES):
                row = [number], [digest], [rows.column(0).slice(a, b - a).to_pylist()], [counts[a:b].astype(np.int32)], [_packed(_NOTHING, at[ends[a]:ends[b]])]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, row, kinds)), ["block", "digest", "ids", "counts", "at"])

    return places


def _packed(raw: np.ndarray, *numbers: np.ndarray) -> bytes:
    """Bytes and 32-bit numbers, compressed; the numbers' bytes of one rank stand together, as the higher ones are mostly alike."""
    out = [np.int64(len(raw)).tobytes(), raw.tobytes()]
    for x in numbers:
        out += [np.int64(len(x)).tobytes(), x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()]
    return zstandard.compress(b"".join(out), 1)


def _unpacked(packed: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    at = 8 + int(raw[:8].view(np.int64)[0])
    out = [raw[8:at]]
    while at < len(raw):
        n = int(np.frombuffer(raw, np.int64, 1, at)[0])
        out.append(np.ascontiguousarray(raw[at + 8:at + 8 + 4 * n].reshape(4, n).T).view("<i4").ravel())
        at += 8 + 4 * n
    return out


def _segment(model_path: str):
    """Ids of the chunks of each bucket, each distinct one segmented once, by block."""

    def bucket(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        lists = [_unpacked(packed) for _, _, packed in rows]
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *(x[2] for x in lists)]), dtype=np.int64)
        told = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(np.concatenate([x[0] for x in lists]))).dictionary_encode()
        flat, begin, size = _ids(told.dictionary, model_path)
        out, at = [], 0
        for _, place, _ in lists:
            own = told.indices[at:at + len(place)].to_numpy()
            n = size[own]
            first = np.cumsum(n) - n
            out.append(_packed(_NOTHING, place, n, flat[np.repeat(begin[own] - first, n) + np.arange(n.sum())]))
            at += len(place)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(out, pa.binary())],
                                          ["block", "digest", "packed"])

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for number, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and number != now:
                    yield bucket(held)
                    held = []
                now = number
                held.append(row)
        if held:
            yield bucket(held)

    return segment


_NOTHING = np.zeros(0, np.uint8)


def _ids(chunks: pa.Array, model_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat ids, where those of each chunk begin, and how many there are)."""
    made = processor(model_path)
    after = len(made.encode("a"))
    flat, size = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for a in range(0, len(chunks), AT_ONCE):
        # the library puts back the first marker, but not before nothing: a marker alone is had after a letter
        texts = [c[1:] for c in chunks.slice(a, AT_ONCE).to_pylist()]
        ids = [x if t else x[after:] for x, t in zip(made.encode([t or "a " for t in texts], num_threads=1), texts, strict=True)]
        size.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(size[-1].sum())))
    size = np.concatenate(size)
    return np.concatenate(flat), np.cumsum(size) - size, size


def _spell(end_id: int | None):
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, counts, at, found = (batch.column(i)[row] for i in range(2, 6))
                counts, at = counts.values.to_numpy(), _unpacked(at.as_py())[1]
                if len(at) and found.values is None:
                    raise RuntimeError("the texts were other ones when they were read again; write them to a table first")
                begin, size, table = _by_place(found.as_py() or [])
                for a, b, flat, ends in _texts(counts, at, begin, size, table, end_id):
                    yield pa.RecordBatch.from_arrays([ids.values.slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "ids"])

    return spell


def _by_place(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place of a block's list where its ids begin and how many there are, and the ids."""
    parts = [_unpacked(x) for x in found]
    none = np.zeros(0, np.int32)
    place = np.concatenate([none, *(np.cumsum(p[1]) for p in parts)])
    count = np.concatenate([none, *(p[2] for p in parts)]).astype(np.int64)
    begin, size = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    begin[place], size[place] = np.cumsum(count) - count, count
    return begin, size, np.concatenate([none, *(p[3] for p in parts)])


def _texts(counts: np.ndarray, at: np.ndarray, begin: np.ndarray, size: np.ndarray, table: np.ndarray, end_id: int | None):
    """(first, end, flat ids, offsets) of ranges of a block's texts."""
    chunk_ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    for a, b in arrays.row_slices(chunk_ends, 1 << 19):
        here = at[chunk_ends[a]:chunk_ends[b]]
        n = size[here]
        ends = np.concatenate([[0], np.cumsum(n)])
        flat = table[np.repeat(begin[here] - ends[:-1], n) + np.arange(ends[-1])]
        offsets = ends[chunk_ends[a:b + 1] - chunk_ends[a]]
        if end_id is not None:
            flat = np.insert(flat, offsets[1:], end_id)
            offsets = offsets + np.arange(b - a + 1)
        yield a, b, flat.astype(np.int32), offsets.astype(np.int32)


def decode_pieces(rows: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the library's decoding of each list of ids in ``text_col`` in the place of ``ids_col``.

    Null lists give null. Other columns stay as they are.
    """
    bounded_batches(rows.sparkSession)
    kept = [c for c in rows.columns if c != ids_col]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = processor(model_path)
        for batch in batches:
            texts = pa.array([None if x is None else made.decode(x) if x else "" for x in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], texts], [*kept, text_col])

    kinds = rows.select(*kept).schema.add(text_col, "string")
    return rows.select(ids_col, *kept).mapInArrow(decode, kinds)
