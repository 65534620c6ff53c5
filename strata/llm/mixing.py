"""Mixing of sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies each of its
documents should have on average; the whole part is given, the fraction is
rounded at random. The pivotal method takes two documents with fractional
probabilities at a time and moves mass between them, so many words as make one
of the two integral, at random in the proportion that keeps both expectations.
Moved words stay in the source: its taken words differ from the target only by
the last document's rest.

Documents are dealt to groups of about ``GROUP`` by a hash and rounded from the
longest to the shortest, so that what is left over tends to be short. Each
group's one rest goes on to the next level, ``GROUP`` groups to one, until a
source has one rest. That is rounded to the nearer side, and as one long document
may be much of a small source, documents of the last group are then turned round,
those or the two whose turn brings the sum nearest to its target, until none does;
of a few documents every choice is looked at.
A source of a third of all documents is so many more groups. Random numbers come from hashes of the
ids, so reruns agree, however Spark cuts the data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import Scratch

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Documents that one task rounds at once.
GROUP = 4096
#: Documents of a last group up to which every choice of turns is looked at.
EVERY_CHOICE = 14
_STATE = "src string, id long, size long, key long, p double, whole long"


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and 0x09-0x0D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """(src, source_size, target) from (src, source_size), one row a source.

    Sources in order of code points, null last, weigh ``weights`` in turn and
    share ``share`` times the sum of all sizes. No target is above ``most``
    times its source's size; what is above is shared again by weight among the
    rest until no target is above. That is ``min(most * size, level * weight)``
    with the one ``level`` that gives the sum, found in the order in which
    sources reach their limit.
    """
    order = Window.orderBy(F.col("src").isNull(), F.encode("src", "utf-8"))
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    weighed = (sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), at.cast("int")).cast("double"))
               .withColumn("cap", most * F.col("source_size")))
    full = Window.orderBy(F.col("cap") / F.col("w"), F.col("src").isNull(), F.encode("src", "utf-8"))
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onward = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # when every source before this one is at its limit, the rest is shared by those from this one on
    level = ((share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("w").over(onward))
    found = (weighed.withColumn("level", level).withColumn("place", F.row_number().over(full))
             .withColumn("ok", F.col("level") * F.col("w") <= F.col("cap")))
    final = F.min(F.when(F.col("ok"), F.struct("place", "level"))).over(whole)["level"]
    return (found.withColumn("final", final)
            .select("src", "source_size", F.coalesce(F.least("cap", F.col("final") * F.col("w")), F.col("cap")).alias("target")))


def _uniform(key: int, other: int, seed: int) -> float:
    """A number in [0, 1) fixed by two keys and the seed."""
    x = (key * 0x9E3779B97F4A7C15 + other * 0xC2B2AE3D27D4EB4F + seed * 0x165667B19E3779F9 + 1) & (1 << 64) - 1
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ x >> shift) * by) & (1 << 64) - 1
    return ((x ^ x >> 31) >> 11) / (1 << 53)


def pivot(size: np.ndarray, p: np.ndarray, key: np.ndarray, seed: int) -> np.ndarray:
    """Probabilities after pairing in the given order: all integral but at most one.

    ``sum(size * p)`` is kept but for rounding errors of floating point.
    """
    p = p.astype(float).copy()
    held = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = float(size[held]), float(size[i])
        mass_a, mass_b = a * p[held], b * p[i]
        up = min(a - mass_a, mass_b)    # words that can move from i to held
        down = min(mass_a, b - mass_b)  # and back
        if _uniform(int(key[held]), int(key[i]), seed) * (up + down) < down:
            mass_a, mass_b = mass_a + up, mass_b - up
        else:
            mass_a, mass_b = mass_a - down, mass_b + down
        p[held], p[i] = _settled(mass_a, a), _settled(mass_b, b)
        if not 0.0 < p[held] < 1.0:
            held = i if 0.0 < p[i] < 1.0 else -1
    return p


def _settled(mass: float, size: float) -> float:
    """``mass / size``, integral within the rounding error of the transfers."""
    p = mass / size
    return float(round(p)) if abs(p - round(p)) < 1e-9 else p


def settle(size: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """``after`` with its rest rounded, and turned round where that brings ``sum(size * p)`` nearer to that of ``before``."""
    q = np.round(after)
    off = float((size * q).sum() - (size * before).sum())
    free = np.flatnonzero((before > 0) & (before < 1))
    if len(free) <= EVERY_CHOICE:
        turned = np.arange(1 << len(free))[:, None] >> np.arange(len(free)) & 1
        best = turned[np.argmin(np.abs(off + turned @ (size[free] * (1 - 2 * q[free]))))].astype(bool)
        q[free[best]] = 1 - q[free[best]]
        return q
    while True:
        turn = size[free] * (1 - 2 * q[free])
        order = np.argsort(turn, kind="stable")
        # for each one the other whose turn makes up best for what is left; a turn with itself counts as one alone
        near = np.clip(np.searchsorted(turn[order], -off - turn)[:, None] + np.arange(-1, 2), 0, len(free) - 1)
        pair = turn[:, None] + np.where(order[near] == np.arange(len(free))[:, None], 0, turn[order][near])
        i, j = np.unravel_index(np.argmin(np.abs(off + pair)), pair.shape)
        one = int(np.argmin(np.abs(off + turn)))
        chosen = {one} if abs(off + turn[one]) <= abs(off + pair[i, j]) else {int(i), int(order[near[i, j]])}
        step = float(turn[list(chosen)].sum())
        if abs(off + step) >= abs(off) - 1e-6:
            return q
        at = free[list(chosen)]
        q[at], off = 1 - q[at], off + step


def _rounded(seed: int, last: bool):
    def group(rows: pa.Table) -> pa.Table:
        rows = rows.select(["src", "id", "size", "key", "p", "whole"]).sort_by([("size", "descending"), ("key", "ascending"), ("id", "ascending")])
        size, before = rows["size"].to_numpy(), rows["p"].to_numpy()
        p = pivot(size, before, rows["key"].to_numpy(), seed)
        p = settle(size, before, p) if last else p
        return rows.set_column(4, "p", pa.array(p))

    return group


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                share: float = 1.5, most: float = 2.0, weights=WEIGHTS, seed: int = 1) -> DataFrame:
    """One row a document: id, ``size`` (words), ``source_size``, ``target`` of its source, ``taken`` (words).

    A document is taken whole, ``taken / size`` times. Documents of equal id,
    size and source are alike, and repeated rows are rounded each on its own.
    Null and empty texts have size 0 and take 0; null sources are a source of
    their own, the last. Null ids are an id like others. Other columns are not
    read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    rows = scratch.save(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("src"),
                                    word_count(F.col(text_col)).alias("size")), "sizes")
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    target = scratch.save(source_targets(sizes.drop("n"), share, most, weights), "targets")
    largest = sizes.agg(F.max("n")).first()[0] or 0
    # F.when instead of a division by zero for sources without words
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.xxhash64(F.col("id"), F.col("size"), F.lit(seed))
    known = target.withColumnRenamed("src", "of")
    state = (rows.join(known, F.col("src").eqNullSafe(F.col("of")))
             .select("src", "id", "size", key.alias("key"), rate.alias("rate"))
             .select("src", "id", "size", "key",
                     F.when(F.col("size") > 0, F.col("rate") - F.floor("rate")).otherwise(0.0).alias("p"),
                     F.floor("rate").alias("whole")))
    groups = max(1, math.ceil(largest / GROUP))
    done: list[DataFrame] = []
    while True:
        # the number of groups of a source follows the largest source, so a group is about GROUP documents at most
        dealt = state.withColumn("part", F.pmod(F.shiftright("key", 20), F.lit(groups)))
        out = scratch.save(dealt.groupBy("src", "part").applyInArrow(_rounded(seed, groups == 1), _STATE), f"level-{len(done)}")
        rest = (F.col("p") > 0) & (F.col("p") < 1)
        if groups == 1:
            done.append(out)
            break
        done.append(out.where(~rest))
        state, groups = out.where(rest), math.ceil(groups / GROUP)
    given = done[0]
    for more in done[1:]:
        given = given.unionByName(more)
    return (given.join(known, F.col("src").eqNullSafe(F.col("of")))
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    (F.col("size") * (F.col("whole") + F.round("p").cast("long"))).alias("taken"),
                    F.col("src").alias(source_col)))
