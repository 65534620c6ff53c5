"""Periodic runs of words within texts, by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are the same) of at least ``exponent`` periods and ``least`` words, which
no neighbouring word extends. Each of its words occurs ``exponent`` times or
more within it. So a word that occurs more rarely within a segment of a text is
in no run of that segment and splits it; the pieces are looked at again, as
their words occur more rarely in them, until every word of every segment occurs
often enough. What survives is scanned for lags.

Lag scan: for the lags ``q`` of ``(b/2, b]``, ``b`` a power of two, the windows of
``b`` words are numbered (pairs of numbers of half their width, so equal numbers
are equal words), and each window's distance to its next occurrence is taken.
Within a run of period ``q`` that distance is ``q`` for every window whose
next occurrence still fits in: a shorter one would make, as windows are as long
as the period, that distance a period too. So the runs of period ``q`` are the
stretches of windows of distance ``q``, with ``q + b`` words more than windows,
and the scan takes n log n steps for a segment of any length.

All texts of a slice are worked on at once; words are numbered by their bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.tables import bounded_batches

LEAST_WORDS, EXPONENT = 6, 4
#: Rounds of splitting that go over all segments at once; what is not stable by then is split one segment after the other.
ROUNDS = 24
SCHEMA = "id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word's spelling, length of each word, bytes of all words, offsets of each text's words)."""
    letter = ~np.isin(data, (9, 10, 11, 12, 13, 32))
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[offsets[:-1]] = True
    first = letter.copy()
    first[1:] &= ~letter[:-1] | begins[1:-1]
    starts = np.flatnonzero(first)
    packed = data[letter]
    at = np.append(np.cumsum(letter)[starts] - 1, len(packed)).astype(np.int64)
    told = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(packed)]).dictionary_encode()
    return told.indices.to_numpy().astype(np.int64), np.diff(at), packed, np.searchsorted(starts, offsets)


def segments(code: np.ndarray, offsets: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """Ranges of words that hold all runs, no word of which occurs in its range fewer than ``exponent`` times; in no order."""
    out: list[tuple[int, int]] = []
    at = np.arange(len(code))
    seg = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    kinds = int(code.max()) + 1 if len(code) else 1
    for _ in range(ROUNDS):
        if not len(at):
            return out
        _, which, count = np.unique(seg * kinds + code[at], return_inverse=True, return_counts=True)
        keep = count[which] >= exponent
        split = np.zeros(int(seg[-1]) + 1, dtype=bool)
        split[seg[~keep]] = True
        at, seg = at[keep], seg[keep]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(seg) > 0)
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(at)))
        stable = ~split[seg[head]]
        done = stable & (size >= least)
        out += zip(at[head[done]].tolist(), (at[head[done]] + size[done]).tolist(), strict=True)
        go_on = ~stable & (size >= least)
        at, seg = at[np.repeat(go_on, size)], np.repeat(np.arange(int(go_on.sum())), size[go_on])
    if len(at):
        head = np.flatnonzero(np.diff(seg, prepend=-1))
        for a, n in zip(at[head].tolist(), np.diff(np.append(head, len(at))).tolist(), strict=True):
            out += _split_on(code[a:a + n].tolist(), a, least, exponent)
    return out


def _split_on(code: list[int], begin: int, least: int, exponent: int) -> list[tuple[int, int]]:
    """As :func:`segments`, for one segment: counts go over to its largest piece, only the others are counted anew."""
    places: dict[int, list[int]] = {}
    for i, c in enumerate(code):
        places.setdefault(c, []).append(i)
    where = dict.fromkeys(places, 0)  # places of a word before it are left of all that is still to do
    out = []
    counts = Counter(code)
    todo = [(0, len(code), counts, [c for c, n in counts.items() if n < exponent])]
    while todo:
        a, b, counts, rare = todo.pop()  # pieces come from left to right
        if not rare:
            out.append((begin + a, begin + b))
            continue
        cuts = []
        for c in rare:
            own, i = places[c], where[c]
            while i < len(own) and own[i] < a:
                i += 1
            where[c] = i
            while i < len(own) and own[i] < b:
                cuts.append(own[i])
                i += 1
        cuts.sort()
        pieces = [(x + 1, y) for x, y in zip([a - 1, *cuts], [*cuts, b], strict=True) if y > x + 1]
        if not pieces:
            continue
        largest = max(pieces, key=lambda p: p[1] - p[0])
        fresh = []
        fewer: set[int] = set()
        for p in pieces:
            if p == largest:
                continue
            own_counts = Counter(code[p[0]:p[1]])
            for c, n in own_counts.items():
                counts[c] -= n
                fewer.add(c)
            fresh.append((*p, own_counts, [c for c, n in own_counts.items() if n < exponent]))
        fresh.append((*largest, counts, [c for c in fewer if 0 < counts[c] < exponent]))
        todo += sorted((p for p in fresh if p[1] - p[0] >= least), key=lambda p: -p[0])
    return out


def scan(code: np.ndarray, found: list[tuple[int, int]], least: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs within the given segments."""
    none = np.zeros(0, np.int64)
    if not found:
        return none, none, none
    first, end = np.array(sorted(found)).T
    size = end - first
    put = np.concatenate([[0], np.cumsum(size + 1)])  # a word of its own stands after each segment
    place = np.repeat(first - put[:-1], size + 1) + np.arange(put[-1])
    number = np.empty(put[-1], np.int64)
    parted = np.zeros(put[-1], dtype=bool)
    parted[put[1:] - 1] = True
    number[~parted], number[parted] = code[place[~parted]], int(code.max()) + 1 + np.arange(len(size))
    most = np.repeat(size // exponent, size + 1)
    at, rank = np.arange(put[-1]), number
    starts, lengths, periods = [none], [none], [none]
    b, longest = 1, int(size.max()) // exponent
    while len(at):
        order = np.argsort(rank, kind="stable")
        here, gap = at[order], np.diff(at[order])
        again = (np.diff(rank[order]) == 0) & (gap <= most[here[:-1]])
        hit = again & (2 * gap > b) & (gap <= b)
        i, q = here[:-1][hit], gap[hit]
        by = np.argsort(i)
        i, q = i[by], q[by]
        new = np.ones(len(i), dtype=bool)
        new[1:] = (np.diff(i) != 1) | (np.diff(q) != 0)
        head = np.flatnonzero(new)
        length = np.diff(np.append(head, len(i))) - 1 + b + q[head]
        run = (length >= least) & (length >= exponent * q[head])
        starts.append(place[i[head[run]]])
        lengths.append(length[run])
        periods.append(q[head[run]])
        if b >= longest:
            break
        alive = np.zeros(len(order), dtype=bool)
        alive[:-1] |= again
        alive[1:] |= again
        keep = np.sort(order[alive])
        at, rank = at[keep], rank[keep]
        other = np.searchsorted(at, at + b)
        pair = np.append(at, -1)[other] == at + b
        at, wide = at[pair], rank[pair] * (int(rank.max(initial=0)) + 1) + rank[other[pair]]
        rank = np.unique(wide, return_inverse=True)[1]
        b *= 2
    start, length, period = map(np.concatenate, (starts, lengths, periods))
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS,
              exponent: int = EXPONENT) -> DataFrame:
    """(id, runs, collapsed) of every row: the runs of its text, and the text without what repeats in them.

    ``runs`` has ``start`` (number of a word), ``length`` and ``period`` of every
    run, by start, then period. ``collapsed`` is the words joined by one space,
    without those that some run has after its first period; it is never null. Words are ``[^\\x20\\x09-\\x0D]+``
    and differ by case. Null and empty texts have no runs and collapse to an
    empty text. Null ids and repeated rows each give a row; texts of any length
    are worked on whole. An empty table gives an empty result. Other columns
    are not read, whatever their names. ``exponent`` is 3 at least, which the
    lag scan rests on.
    """
    if exponent < 3:
        raise ValueError("a run has three periods at least")
    bounded_batches(docs.sparkSession)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.text_bytes(batch.column(1))
            for a, b in arrays.row_slices(offsets):
                o = offsets[a:b + 1]
                found, texts = _runs_of(data[o[0]:o[-1]], o - o[0], least, exponent)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), found, texts], ["id", "runs", "collapsed"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(runs, SCHEMA)
            .withColumnRenamed("id", id_col))


def _runs_of(data: np.ndarray, offsets: np.ndarray, least: int, exponent: int) -> tuple[pa.ListArray, pa.Array]:
    code, size, packed, words = _words(data, offsets)
    start, length, period = scan(code, segments(code, words, least, exponent), least, exponent)
    row = np.searchsorted(words, start, side="right") - 1
    found = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start - words[row], length, period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(offsets))).astype(np.int32)), found)

    over = np.zeros(len(code) + 1, np.int64)
    np.add.at(over, start + period, 1)
    np.add.at(over, start + length, -1)
    keep = np.cumsum(over)[:-1] == 0
    # every word with a space after it; then what is dropped goes, and the last space of each text
    spelt = np.full(len(packed) + len(code), 0x20, np.uint8)
    spelt[np.arange(len(packed)) + np.repeat(np.arange(len(code)), size)] = packed
    kept = np.repeat(keep, size + 1)
    ends = np.concatenate([[0], np.cumsum((size + 1) * keep)])[words]
    spelt = spelt[kept]
    full = np.diff(ends) > 0
    stays = np.ones(len(spelt), dtype=bool)
    stays[ends[1:][full] - 1] = False
    ends = ends - np.concatenate([[0], np.cumsum(full)])
    texts = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(spelt[stays])))
    return lists, texts.cast(pa.string())
