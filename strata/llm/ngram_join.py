"""Similarity join of texts on word n-gram sets, by PartEnum signatures.

Sets are put in size bands ``[l, r]``, ``r`` about 1.5 times ``l``. Two sets of
Jaccard similarity at least ``num/den`` whose sizes are at most ``r`` differ in
at most ``k = 2 r (den-num) / (den+num)`` elements. A band's domain of hashes is
cut into ``n1`` partitions of ``n2`` parts each; a signature is the projection
of a set on ``n2 - k2`` parts of one partition, for every such subset. With
``n1 (k2+1) > k``, one partition holds at most ``k2`` differences, so one of its
subsets is free of them and the two sets share that signature. Each set signs
for its own band, and for the next one if a partner may lie there.

Projections of fewer than two elements would be shared by unrelated sets. So a
band has ``spare`` partitions more than it needs, and a set leaves out its thin
projections while its thin partitions are no more than ``spare``: one partition
that is not thin still agrees. A set with more of them signs all.

Sets that share a signature are candidates, not yet links. Exact conditions
thin them out before any text is compared: sizes, the number of elements that
no other candidate set has (these all count as differences), and parity sketches
(bit ``i`` is the parity of the number of elements hashed to ``i``; each bit in
which two sketches differ takes a difference of its own). Members carry a sketch
of fixed size, which says nothing of large sets; pairs that it leaves meet fine
sketches, of about as many bits as a set has elements (a longer one folds to the
length of a shorter one by XOR). The rest are compared on their whole sets.

Skew: equal sets collapse into one class by aggregation before anything else;
each Arrow batch signs for a class once; buckets of the same members, as the many
signatures of one group of copies make them, are one bucket. Inside a large bucket, members are
compared with a bounded block of hubs first (the sets with the fewest elements
of their own, such as the original of many edited copies); members whose
component is already the hub's are not compared again. Blocks go on until every
pair of a bucket is either compared, excluded by the conditions above, or in
one component. So no link between different texts is lost, and copies are not
expanded into all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.tables import Scratch, bounded_batches, connected_components

#: Projections with fewer elements are thin.
LEAST_ELEMENTS = 2
#: Longs of a parity sketch.
SKETCH = 8
_SKETCH_COLUMNS = [f"x{i}" for i in range(SKETCH)]
#: Bits of the shortest fine sketch.
LEAST_FINE = 256
#: Hubs of a bucket compared in the first and in each later block.
HUB_BLOCKS = (64, 1024)


@dataclass(frozen=True)
class Band:
    """Sizes ``low..high``, and how its domain is cut."""

    index: int
    low: int
    high: int
    partitions: int
    parts: int
    left_out: int
    spare: int


def bands(num: int, den: int, up_to: int) -> list[Band]:
    """Size bands covering ``1..up_to``, for similarity ``num/den``."""
    out: list[Band] = []
    low = 1
    while not out or out[-2 if len(out) > 1 else -1].high < up_to:
        # partners of a band's sets lie in it or in the next one at most
        high = max(low * den // num, low * 3 // 2 if low > 6 else low)
        k = 2 * high * (den - num) // (den + num)
        if k == 0:
            cut = (1, 1, 0, 0)
        elif k <= 3:  # one partition, every choice of k of its k+4 parts left out
            cut = (1, k + 4, k, 0)
        else:
            need = k // 2 + 1
            spare = need // 3
            cut = (need + spare, 3, 1, spare)
        out.append(Band(len(out), low, high, *cut))
        low = high + 1
    return out


def band_signatures(h: np.ndarray, offsets: np.ndarray, rows: np.ndarray, band: Band) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of the given rows' sets for one band."""
    counts = np.diff(offsets)[rows]
    at = np.repeat(offsets[rows] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    h = arrays.mix(h[at] + np.uint64(band.index * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    cells = band.partitions * band.parts
    own = np.repeat(np.arange(len(rows)), counts) * cells + ((h >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
    mixed = arrays.mix(h)
    size = len(rows) * cells
    low = np.bincount(own, weights=(mixed & np.uint64(0xFFFFFFFF)).astype(float), minlength=size).astype(np.uint64)
    high = np.bincount(own, weights=(mixed >> np.uint64(32)).astype(float), minlength=size).astype(np.uint64)
    sums = (low + (high << np.uint64(32))).reshape(-1, band.parts)
    n = np.bincount(own, minlength=size).reshape(-1, band.parts)
    total, total_n = sums.sum(axis=1, dtype=np.uint64), n.sum(axis=1)
    sig, many = [], []
    partition = np.tile(np.arange(band.partitions), len(rows))
    for j, out in enumerate(combinations(range(band.parts), band.left_out)):
        seed = ((band.index << 40) + (partition << 8) + j).astype(np.uint64)
        out = list(out)
        sig.append(arrays.mix(total - sums[:, out].sum(axis=1, dtype=np.uint64) + arrays.mix(seed + np.uint64(1))))
        many.append(total_n - n[:, out].sum(axis=1))
    sig, many = np.stack(sig, axis=1), np.stack(many, axis=1)
    thin = (many < LEAST_ELEMENTS).any(axis=1).reshape(len(rows), -1).sum(axis=1)
    keep = (many >= LEAST_ELEMENTS) | np.repeat(thin > band.spare, band.partitions)[:, None]
    if cells == 1:
        keep[:] = True
    row = np.repeat(rows, band.partitions * sig.shape[1]).reshape(sig.shape)
    return sig[keep], row[keep]


def signatures(h: np.ndarray, offsets: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures (signature, row) of flat sorted sets."""
    n = np.diff(offsets)
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    if len(n) and n.max():
        cut = bands(num, den, int(n.max()))
        for i, band in enumerate(cut):
            own = (n >= band.low) & (n <= band.high)
            if i:  # sets of the band below with a partner here
                below = cut[i - 1]
                own |= (n >= below.low) & (n <= below.high) & (den * n >= num * band.low)
            rows = np.flatnonzero(own)
            if len(rows):
                found.append(band_signatures(h, offsets, rows, band))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def set_classes(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit digest of each set; equal sets have equal digests."""
    n = np.diff(offsets).astype(np.uint64)
    return arrays.signed(arrays.mix(arrays.sums_by_row(arrays.mix(h), offsets) ^ arrays.mix(n)))


def fine_sketches(h: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Parity sketch of each set, of the least power of two of bits that is not under its size (``LEAST_FINE`` at least)."""
    n = np.diff(offsets)
    bits = LEAST_FINE << np.ceil(np.log2(np.maximum(n, LEAST_FINE) / LEAST_FINE)).astype(np.int64)
    ends = np.cumsum(bits)
    at = np.repeat(ends - bits, n) + (arrays.mix(h + np.uint64(7)) & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=bits.sum()) & 1).astype(np.uint8), bitorder="little")
    starts = np.concatenate([[0], ends // 8])
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(starts), pa.py_buffer(packed)]).cast(pa.binary())


def least_differences(left: pa.Array, right: pa.Array) -> np.ndarray:
    """By how many elements the sets of two columns of fine sketches differ at least, row by row."""
    (x, xo), (y, yo) = arrays.text_bytes(left), arrays.text_bytes(right)
    out = np.zeros(len(left), np.int64)
    for a, b in arrays.row_slices(xo + yo):
        sizes = np.stack([np.diff(xo[a:b + 1]), np.diff(yo[a:b + 1])], axis=1)
        for size in np.unique(sizes, axis=0):
            rows = a + np.flatnonzero((sizes == size).all(axis=1))
            short = size.min()
            folded = [np.bitwise_xor.reduce(d[o[rows][:, None] + np.arange(k)].reshape(len(rows), -1, short), axis=1)
                      for d, o, k in ((x, xo, size[0]), (y, yo, size[1]))]
            out[rows] = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
    return out


def join_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
               num: int = 85, den: int = 100, passes: int = 1, text_passes: int = 1) -> DataFrame:
    """Components of the documents under ``den * |A & B| >= num * |A | B|`` of their ``n``-word sets.

    Returns one row per input row: the id (named ``id_col``), ``n_shingles``
    (set size) and ``component_id`` (smallest id that links reach, the row's
    own included). Texts without words, empty and null ones have size 0 and
    link with nothing; texts of fewer than ``n`` words have their whole
    sequence as the one element. Repeated rows and repeated ids each give a
    row; rows of one text share a component. A row without an id has the
    component of rows of the same text that have one, else a null one, and
    links with nothing. Other columns of ``docs`` are not read, whatever their
    names. An empty table gives an empty result.

    Signatures and elements are shuffled in ``passes`` parts by hash, one part
    after the other, pairs with their texts in ``text_passes`` parts: so much
    less disk is needed, and texts are read so much oftener.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "ngram-join")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in arrays.batches_of_words(batch.column(1)):
                h, o = arrays.shingle_sets(words, n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(o)),
                                                  pa.array(set_classes(h, o))], ["id", "n", "cls"])

    def signed(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = np.zeros(0, np.int64)
            for _, _, words in arrays.batches_of_words(batch.column(0)):
                h, o = arrays.shingle_sets(words, n)
                cls = set_classes(h, o)
                first = np.zeros(len(cls), dtype=bool)
                first[np.unique(cls, return_index=True)[1]] = True
                first &= ~np.isin(cls, done)
                done = np.concatenate([done, cls[first]])
                size = np.where(first, np.diff(o), 0)
                sig, row = signatures(h[np.repeat(first, np.diff(o))], np.concatenate([[0], np.cumsum(size)]), num, den)
                now = sig % np.uint64(passes) == turn
                yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(sig[now])), pa.array(cls[row[now]])], ["sig", "cls"])

    rows = scratch.save(base.mapInArrow(sizes, "id long, n long, cls long"), "rows")
    by_sig = Window.partitionBy("sig")
    parts = [scratch.save(base.select("text").mapInArrow(partial(signed, turn=turn), "sig long, cls long")
                          .withColumn("lo", F.min("cls").over(by_sig)).withColumn("hi", F.max("cls").over(by_sig))
                          .withColumn("all", F.sum(F.xxhash64("cls").bitwiseAND(F.lit((1 << 32) - 1))).over(by_sig))
                          .where("lo < hi").select(F.xxhash64("lo", "hi", "all").alias("sig"), "cls").distinct(), "buckets")
             for turn in range(passes)]
    buckets = reduce(DataFrame.unionByName, parts)
    buckets = buckets if passes == 1 else buckets.distinct()

    classes = rows.where("n > 0").groupBy("cls").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    wanted = buckets.select("cls").distinct().join(classes, "cls")
    again = Window.partitionBy("id", "cls", "_same").orderBy("n")  # equal rows of one id, which the join has brought together
    met = (base.join(wanted, "id").withColumn("_same", F.xxhash64("text"))
           .withColumn("_place", F.row_number().over(again)).where("_place = 1"))
    texts = scratch.save(_sketched(met.select("cls", "n", "text"), n), "texts")
    alone = scratch.save(_own_elements(texts, n, passes, scratch), "alone")
    member = (buckets.join(texts.drop("text", "fine"), "cls").join(alone, "cls", "left")
              .select("sig", "cls", "n", F.coalesce("alone", F.lit(0)).alias("alone"), *_SKETCH_COLUMNS)
              .where(den * F.col("alone") <= (den - num) * F.col("n")))
    member = scratch.save(member, "members")
    scratch.drop(*parts, alone)
    edges = _compare(member, texts, n, num, den, text_passes, scratch)
    scratch.drop(texts)

    labels = connected_components(edges, scratch)
    component = (classes.select("cls", "id").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                 .withColumn("label", F.coalesce("label", "cls")))
    least = component.groupBy("label").agg(F.min("id").alias("component_id"))
    named = component.join(least, "label").select("cls", "component_id")
    full = rows.where("n > 0").join(named, "cls", "left").select("id", "n", "component_id")
    none = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(none).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _sketched(texts: DataFrame, n: int) -> DataFrame:
    """``texts`` (cls, n, text) with both parity sketches of each set, without texts of another class (rows of one id may differ)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = 64 * SKETCH
        for batch in batches:
            for a, b, words in arrays.batches_of_words(batch.column(2)):
                h, o = arrays.shingle_sets(words, n)
                at = (arrays.mix(h + np.uint64(7)) % np.uint64(bits)).astype(np.int64)
                odd = np.bincount(np.repeat(np.arange(b - a), np.diff(o)) * bits + at, minlength=(b - a) * bits) & 1
                longs = np.packbits(odd.astype(np.uint8).reshape(-1, 64), axis=1).view(np.int64).reshape(-1, SKETCH)
                made = pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, fine_sketches(h, o),
                                                   *(pa.array(np.ascontiguousarray(x)) for x in longs.T)],
                                                  ["cls", "n", "text", "fine", *_SKETCH_COLUMNS])
                yield made.filter(pa.array(batch.column(0).to_numpy()[a:b] == set_classes(h, o)))

    return texts.mapInArrow(sketch, "cls long, n long, text string, fine binary, " + ", ".join(f"{x} long" for x in _SKETCH_COLUMNS))


def _own_elements(texts: DataFrame, n: int, passes: int, scratch: Scratch) -> DataFrame:
    """(cls, alone): how many elements of a class no other row of ``texts`` has (fewer than its own where a class has two rows)."""

    def elements(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls = batch.column(0).to_numpy()
            for a, b, words in arrays.batches_of_words(batch.column(1)):
                h, o = arrays.shingle_sets(words, n)
                now = h % np.uint64(passes) == turn
                yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(h[now])), pa.array(np.repeat(cls[a:b], np.diff(o))[now])],
                                                 ["h", "cls"])

    counted = []
    for turn in range(passes):
        each = texts.select("cls", "text").mapInArrow(partial(elements, turn=turn), "h long, cls long")
        single = each.groupBy("h").agg(F.count("*").alias("n"), F.min("cls").alias("cls")).where("n = 1")
        counted.append(scratch.save(single.groupBy("cls").agg(F.count("*").alias("alone")), "own"))
    return reduce(DataFrame.unionByName, counted).groupBy("cls").agg(F.sum("alone").alias("alone"))


def _possible(a: str, b: str, num: int, den: int) -> Column:
    """Whether sizes, own elements and sketches leave room for a link of two members."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = (den - num) * (na + nb)
    odd = sum(F.bit_count(F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}"))) for x in _SKETCH_COLUMNS)
    return ((den * F.least(na, nb) >= num * F.greatest(na, nb))
            & ((den + num) * (F.col(f"{a}.alone") + F.col(f"{b}.alone")) <= most)
            & ((den + num) * odd <= most))


def _compare(members: DataFrame, texts: DataFrame, n: int, num: int, den: int, passes: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) that connect all that is linked, from buckets (sig, cls, n, alone)."""
    by_sig = Window.partitionBy("sig")
    edges = labels = tested = None
    block = 0
    left, before = members.withColumn("label", F.col("cls")), members
    while True:
        hubs = HUB_BLOCKS[min(block, 1)]
        left = (left.withColumn("lo", F.min("label").over(by_sig)).withColumn("hi", F.max("label").over(by_sig))
                .where("lo < hi").drop("lo", "hi")
                .withColumn("place", F.row_number().over(by_sig.orderBy("alone", "cls"))))
        left = scratch.save(left, "left")
        scratch.drop(before)
        before = left
        if left.isEmpty():
            break
        hub, other = left.where(F.col("place") <= (1 if block == 0 else hubs)).alias("hub"), left.alias("other")
        if block == 0:  # the one hub of every bucket first: most components close here
            hubs = 0
        pairs = (hub.join(other, (F.col("hub.sig") == F.col("other.sig")) & (F.col("hub.place") < F.col("other.place"))
                          & (F.col("hub.label") != F.col("other.label")) & _possible("hub", "other", num, den))
                 .select(F.least("hub.cls", "other.cls").alias("a"), F.greatest("hub.cls", "other.cls").alias("b"))
                 .distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.save(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        near = scratch.save(_near(pairs, texts, num, den), "near")
        found = _linked(near, texts, n, num, den, passes, scratch)
        scratch.drop(near)
        edges = found if edges is None else edges.unionByName(found)
        if not found.isEmpty():
            labels = connected_components(edges, scratch)
        left = left.where(F.col("place") > hubs).drop("place", "label")
        left = (left.withColumn("label", F.col("cls")) if labels is None else
                left.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                .withColumn("label", F.coalesce("label", "cls")))
        block += 1
    if edges is None:
        return texts.sparkSession.createDataFrame([], "a long, b long")
    return edges


def _near(pairs: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose fine sketches leave room for a link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            ok = pa.array((den + num) * least_differences(batch.column(4), batch.column(5)) <= (den - num) * both)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(ok) for i in (0, 1)], ["a", "b"])

    one, two = (texts.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("fine").alias(f"fine_{x}")) for x in "ab")
    met = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "fine_a", "fine_b")
    return met.mapInArrow(check, "a long, b long")


def _linked(pairs: DataFrame, texts: DataFrame, n: int, num: int, den: int, passes: int, scratch: Scratch) -> DataFrame:
    """The pairs whose whole sets are similar enough; a pair's first text travels with it, for one part of the first texts after the other."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, o = arrays.text_bytes(batch.column(2))
            data2, o2 = arrays.text_bytes(batch.column(3))
            for a, b in arrays.row_slices(o + o2):
                sets = [arrays.shingle_sets(arrays.words_of(d[f[a]:f[b]], f[a:b + 1] - f[a]), n)
                        for d, f in ((data, o), (data2, o2))]
                both = arrays.shared_counts(*sets)
                union = np.diff(sets[0][1]) + np.diff(sets[1][1]) - both
                ok = pa.array(den * both >= num * union)
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(a, b - a).filter(ok) for i in (0, 1)], ["a", "b"])

    one = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    found = []
    for turn in range(passes):
        now = F.pmod(F.xxhash64("a"), F.lit(passes)) == turn
        wanted = two.join(pairs.where(now).select("b"), "b", "left_semi")  # else all texts are shuffled in each part
        met = pairs.where(now).join(one.where(now), "a").join(wanted, "b").select("a", "b", "text_a", "text_b")
        found.append(scratch.save(met.mapInArrow(check, "a long, b long"), "found"))
    return reduce(DataFrame.unionByName, found)
