"""Roles of transcript turns by a hidden Markov model, and their canonical rendering.

A conversation's rows are cut into segments where a line begins with a speaker
marker (``User:``, ``### Assistant`` and the like); a row without markers is one
segment. Hidden states are the roles. A segment shows its marker, if any, its
length, its number of lines and whether it asks. Start, transition and feature
probabilities are counted on rows whose role is known and not held out, with
prior counts; markers nearly decide a segment's role where they are present.
Viterbi's best path gives the roles of the whole conversation, and each segment
is rendered with its role.

A conversation may be of any length: sorted rows are cut into pieces of at most
``PIECE`` segments, a piece is summed up by the best score from every entering
to every leaving role (a small matrix), the matrices of a conversation are
chained, and then each piece is decoded between its known ends. The path is the
one that a single pass would find.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import Scratch, bounded_batches

ROLES = ("system", "user", "assistant")
#: Speaker names in markers, by role.
SPEAKERS = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "prompter", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "gpt", "model", "answer", "agent", "a"),
}
PIECE = 4096
#: Bytes of text of a task, about.
PART_BYTES = 32 << 20
#: Values of each feature: marker (none or a role), length in powers of two, lines, question mark.
FEATURES = {"marker": len(ROLES) + 1, "size": 20, "lines": 6, "asks": 2}
_ROLE_OF = {name: i for i, names in enumerate(SPEAKERS.values()) for name in names}
_NAMES = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
_MARKER = re.compile(rf"(?im)^[ \t]*(?:<\|(?:im_start\|>)?({_NAMES})(?:\|>)?[ \t]*$|#{{2,4}}[ \t]*({_NAMES})[ \t]*:?[ \t]*$"
                     rf"|[\[(]?\*{{0,2}}({_NAMES})\*{{0,2}}[\])]?\*{{0,2}}[ \t]*[:>]\*{{0,2}}[ \t]*)")
_START = len(ROLES)


def segments(text: str) -> list[tuple[int, str]]:
    """(marker, text) of each segment; marker 0 is none, else the role's place and one."""
    found = list(_MARKER.finditer(text))
    out = []
    if not found or text[:found[0].start()].strip():
        out.append((0, text[:found[0].start()] if found else text))
    ends = [m.start() for m in found[1:]] + [len(text)]
    for m, end in zip(found, ends, strict=False):
        name = next(g for g in m.groups() if g)
        out.append((1 + _ROLE_OF[name.lower()], text[m.end():end]))
    return [(kind, part.strip()) for kind, part in out]


def features(marker: int, text: str) -> tuple[int, ...]:
    """Values of ``FEATURES`` for a segment."""
    return (marker, min(len(text).bit_length(), FEATURES["size"] - 1), min(text.count("\n"), FEATURES["lines"] - 1), int("?" in text))


class Model:
    """Log probabilities: ``step[previous or start, role]`` and one table a feature."""

    def __init__(self, step: np.ndarray, shown: dict[str, np.ndarray]):
        self.step = np.log(step / step.sum(axis=1, keepdims=True))
        self.shown = [np.log(shown[f] / shown[f].sum(axis=1, keepdims=True)) for f in FEATURES]

    def emissions(self, seen: np.ndarray) -> np.ndarray:
        """(segments, roles) from feature values (segments, features)."""
        return sum(table[:, seen[:, i]].T for i, table in enumerate(self.shown))


def fit(rows: DataFrame) -> Model:
    """Counts over rows (conv, number, role, seen) that are known and in the fitting part.

    ``before`` holds the role of the segment before in the same piece, and is
    null at a piece's first segment unless the conversation begins there.
    """
    names = {r: i for i, r in enumerate(ROLES)}
    step = np.ones((len(ROLES) + 1, len(ROLES)))
    shown = {f: np.ones((len(ROLES), n)) for f, n in FEATURES.items()}
    for i in range(len(ROLES)):  # as if seen with a marker so often
        shown["marker"][i, 0] += 50
        shown["marker"][i, i + 1] += 50
    pairs = rows.where("before is not null").groupBy(F.lit("step").alias("kind"), F.col("before").alias("a"), F.col("role").alias("b"))
    parts = [pairs.agg(F.count("*").alias("n"))]
    for i, f in enumerate(FEATURES):
        parts.append(rows.groupBy(F.lit(f).alias("kind"), F.col("role").alias("a"),
                                  F.col("seen")[i].cast("string").alias("b")).agg(F.count("*").alias("n")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    for r in every.collect():  # at most a few values a feature and role
        if r.kind == "step":
            step[names.get(r.a, _START), names[r.b]] += r.n
        else:
            shown[r.kind][names[r.a], int(r.b)] += r.n
    return Model(step, shown)


def transfer(model: Model, seen: np.ndarray) -> np.ndarray:
    """Best score through a piece from each entering state (or the start) to each leaving role."""
    shown = model.emissions(seen)
    total = model.step + shown[0]
    inner = model.step[:len(ROLES)]
    for e in shown[1:]:
        total = (total[:, :, None] + inner[None]).max(axis=1) + e
    return total


def decode(model: Model, seen: np.ndarray, enter: int, leave: int | None) -> list[int]:
    """Best roles of a piece between the entering state and the leaving role (any, if None)."""
    shown = model.emissions(seen)
    inner = model.step[:len(ROLES)]
    score, back = model.step[enter] + shown[0], []
    for e in shown[1:]:
        all_ways = score[:, None] + inner
        back.append(all_ways.argmax(axis=0))
        score = all_ways.max(axis=0) + e
    path = [int(score.argmax()) if leave is None else leave]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _runs(batches: Iterator[pa.RecordBatch], key_columns: int) -> Iterator[tuple[tuple, list[list]]]:
    """Consecutive rows of equal first columns, as lists of the other columns' values."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for key, run in groupby(rows, key=lambda row: row[:key_columns]):
        yield key, [list(c) for c in zip(*(row[key_columns:] for row in run), strict=True)]


def _held_out(conv: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row a segment: conversation, turn, ``part`` (segment of the turn), ``role``, ``rendered``.

    ``role`` is recovered; the given roles of conversations whose crc32 of the
    id is not divisible by 5 are used to fit, and none to decode. ``rendered``
    is ``<|im_start|>role``, a line feed, the trimmed text and ``<|im_end|>``.
    Every row is a turn, repeated rows too; rows of one conversation and turn
    number are ordered by text, then by given role. Null texts are empty segments; rows without a
    conversation id form one conversation, and those without a turn number
    come first. Unknown and null roles do not take part in the fit. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = turns.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "chat-format")
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.lower(F.col(role_col)).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, spark.sparkContext.defaultParallelism, total // PART_BYTES)
    # equal rows may be parted too
    ordered = (rows.withColumn("any", F.monotonically_increasing_id()).repartitionByRange(parts, "conv", "turn", F.xxhash64("text"), "role", "any")
               .sortWithinPartitions("conv", "turn", "text", "role"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, piece, before, in_piece = None, -1, None, 0
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for conv, turn, role, text, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, (marker, said) in enumerate(segments(text)):
                    if (conv,) != at or in_piece == PIECE:
                        piece, in_piece, before, at = piece + 1, 0, None, (conv,)
                    for column, value in zip(out, (part, piece, in_piece, conv, turn, i, role if marker == 0 or i == 0 else None, said,
                                                   features(marker, said)), strict=True):
                        column.append(value)
                    in_piece += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                             ["pid", "piece", "number", "conv", "turn", "part", "role", "said", "seen"])

    cells = (ordered.select("conv", "turn", "role", "text", F.spark_partition_id().alias("pid"))
             .mapInArrow(cut, "pid int, piece long, number long, conv long, turn long, part int, role string, said string, seen array<int>"))
    cells = scratch.save(cells, "segments")

    in_piece = Window.partitionBy("pid", "piece").orderBy("number")
    pieces = cells.groupBy("pid", "piece").agg(F.first("conv").alias("conv"))
    alone = pieces.groupBy("conv").agg(F.min(F.struct("pid", "piece")).alias("first"), F.count("*").alias("n"))
    begins = alone.select(F.col("first.pid").alias("pid"), F.col("first.piece").alias("piece"), F.lit(0).cast("long").alias("number"),
                          F.lit("start").alias("start"))
    known = (cells.where(F.col("role").isin(*ROLES) & ~_held_out(F.col("conv")))
             .withColumn("lag", F.lag("role").over(in_piece)).join(begins, ["pid", "piece", "number"], "left")
             .withColumn("before", F.coalesce("lag", "start")))
    model = fit(known)

    sorted_cells = cells.select("pid", "piece", "conv", "number", "seen").repartition(parts, "pid", "piece").sortWithinPartitions("pid", "piece", "number")
    long_ones = alone.where("n > 1").select(F.col("conv").alias("long_conv"))

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pid, piece, conv), (_, seen) in _runs(batches, 3):
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([piece], pa.int64()), pa.array([conv], pa.int64()),
                                              pa.array([transfer(model, np.array(seen)).ravel().tolist()], pa.list_(pa.float64()))],
                                             ["pid", "piece", "conv", "matrix"])

    in_long = sorted_cells.join(long_ones, F.col("conv").eqNullSafe(F.col("long_conv")), "left_semi")
    matrices = (in_long.repartition(parts, "pid", "piece").sortWithinPartitions("pid", "piece", "number")
                .mapInArrow(sum_up, "pid int, piece long, conv long, matrix array<double>"))

    def chain(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("pid", "ascending"), ("piece", "ascending")])
        steps = [np.array(m).reshape(len(ROLES) + 1, len(ROLES)) for m in rows["matrix"].to_pylist()]
        totals = [steps[0][_START]]
        for m in steps[1:]:
            totals.append((totals[-1][:, None] + m[:len(ROLES)]).max(axis=0))
        leave = [int(totals[-1].argmax())]
        for m, score in zip(reversed(steps[1:]), reversed(totals[:-1]), strict=True):
            leave.append(int((score + m[:len(ROLES), leave[-1]]).argmax()))
        leave.reverse()
        return pa.table({"pid": rows["pid"], "piece": rows["piece"], "enter": pa.array([_START, *leave[:-1]], pa.int32()),
                         "leave": pa.array(leave, pa.int32())})

    ends = matrices.groupBy("conv").applyInArrow(chain, "pid int, piece long, enter int, leave int")

    def recover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pid, piece, enter, leave), (number, seen) in _runs(batches, 4):
            path = decode(model, np.array(seen), _START if enter is None else enter, leave)
            yield pa.RecordBatch.from_arrays([pa.array([pid] * len(path), pa.int32()), pa.array([piece] * len(path), pa.int64()),
                                              pa.array(number, pa.int64()), pa.array([ROLES[i] for i in path])],
                                             ["pid", "piece", "number", "found"])

    roles = (sorted_cells.join(ends, ["pid", "piece"], "left").select("pid", "piece", "enter", "leave", "number", "seen")
             .repartition(parts, "pid", "piece").sortWithinPartitions("pid", "piece", "number")
             .mapInArrow(recover, "pid int, piece long, number long, found string"))
    rendered = F.concat(F.lit("<|im_start|>"), F.col("found"), F.lit("\n"), F.col("said"), F.lit("<|im_end|>"))
    return (cells.join(roles, ["pid", "piece", "number"])
            .select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "part", F.col("found").alias("role"),
                    rendered.alias("rendered")))
