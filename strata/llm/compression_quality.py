"""Quality of texts by compression with two zstandard dictionaries.

One dictionary is made of segments of good labelled texts, one of segments of
bad ones. A text is compressed with either; the difference of the compressed
sizes, divided by the text's size, is large where the text is more like the bad
texts. A logistic curve, fitted to labelled texts that are in neither
dictionary, turns the difference into the probability of label 1.

The fit uses a bounded sample of the labelled rows: ``DICTIONARY_SEGMENTS``
segments of ``SEGMENT`` characters for each label and ``CALIBRATION_ROWS`` rows
for each label, taken in the order of hashes. All texts are scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.tables import Scratch, bounded_batches

#: Bounds of the sample that the fit reads: segments and calibration rows for each label.
SEGMENT = 512
DICTIONARY_SEGMENTS = 1000
CALIBRATION_ROWS = 2000
LEVEL = 9
#: Bytes of a long text compressed at a time: the dictionary works within the window of each.
PIECE = 4096
THRESHOLD = 0.3


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by ``folds``; a null id isn't."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


class Compressors:
    """Size differences of texts under the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        made = [zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for x in (good, bad)]
        for x in made:
            x.precompute_compress(level=LEVEL)
        self.both = [zstandard.ZstdCompressor(dict_data=x, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
                     for x in made]

    def difference(self, text: bytes) -> float:
        """(good size - bad size) / size: below 0 where the text is like the good ones; 0 for an empty text."""
        if not text:
            return 0.0
        good = bad = 0
        for at in range(0, len(text), PIECE):
            piece = text[at:at + PIECE]
            good += len(self.both[0].compress(piece))
            bad += len(self.both[1].compress(piece))
        return (good - bad) / len(text)


def _differences(rows: DataFrame, good: bytes, bad: bytes, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``difference`` of rows with a ``text``."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Compressors(good, bad)
        for batch in batches:
            data, o = arrays.text_bytes(batch.column(0))
            view = memoryview(data)
            found = [by.difference(bytes(view[a:b])) for a, b in zip(o[:-1].tolist(), o[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.float64())], [*keep, "difference"])

    return rows.select("text", *keep).mapInArrow(score, f"{kinds}, difference double")


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve by Newton steps with a little shrinkage."""
    scale = float(np.abs(x).max()) or 1.0
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-6]), z.T @ (y - p) - np.array([1e-2, 0]) * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


class QualityModel:
    """The two dictionaries and the calibration curve; about a MB whatever the input."""

    def __init__(self, good: bytes, bad: bytes, slope: float, intercept: float):
        self.good, self.bad, self.slope, self.intercept = good, bad, slope, intercept

    def score(self, docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """Columns ``keep``, ``score`` and ``difference``; a null text scores as an empty one."""
        named = docs.select(F.col(text).alias("text"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)))
        found = _differences(named, self.good, self.bad, [f"_{i}" for i in range(len(keep))])
        score = 1 / (1 + F.exp(-(F.col("difference") * self.slope + self.intercept)))
        return found.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), score.alias("score"), "difference")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """Fit on labelled rows that are not held out.

    Rows without a label, a text or an id are not used; of labels that
    contradict each other for one id the largest counts, and of repeated ids
    one row. With no rows of a label the model has an empty dictionary for it
    and the curve is flat at the share of the labels (0.5 without any).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "quality")
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = F.xxhash64("id", F.lit("quality"))
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(2))
    chosen = known.where(~held_out(F.col("id"))).withColumn("part", part)
    bounded = Window.partitionBy("y", "part").orderBy(order, "id")
    chosen = (chosen.withColumn("place", F.row_number().over(bounded)).where(F.col("place") <= CALIBRATION_ROWS).drop("place"))
    train = scratch.save(texts.where("text is not null and text <> ''").join(F.broadcast(chosen), "id").dropDuplicates(["id"]), "train")

    pieces = train.where("part = 0").select("id", "y", F.posexplode(F.sequence(
        F.lit(0), F.floor((F.length("text") - 1) / SEGMENT).cast("int"))).alias("at", "i"), "text")
    pieces = pieces.select("id", "y", "at", F.substring("text", F.col("i") * SEGMENT + 1, F.lit(SEGMENT)).alias("segment"))
    by_hash = Window.partitionBy("y").orderBy(F.xxhash64("id", "at"), "id", "at")
    sample = (pieces.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= DICTIONARY_SEGMENTS)
              .orderBy("y", "place").select("y", "segment").collect())
    good, bad = ("\n".join(r.segment for r in sample if r.y == y).encode() for y in (1, 0))

    rest = _differences(train.where("part = 1"), good, bad, ["id", "y"]).select("difference", "y", "id").orderBy("id").collect()
    x, y = np.array([r.difference for r in rest]), np.array([r.y for r in rest], dtype=float)
    share = (y.sum() + 1) / (len(y) + 2)
    if not good or not bad or y.sum() in (0, len(y)):
        return QualityModel(good, bad, 0.0, math.log(share / (1 - share)))
    # the rows are as many for either label as there are, up to the bound: put the true shares back
    counts = {r.y: r["count"] for r in known.where(~held_out(F.col("id"))).groupBy("y").count().collect()}
    slope, intercept = _logistic(x, y)
    shift = math.log(counts[1] / counts[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return QualityModel(good, bad, slope, intercept + shift)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """One row a document: id, ``held_out``, ``score`` (probability of label 1) and ``predicted``.

    Null and empty texts have a size difference of 0 and the curve's score
    there. Repeated rows give a row each, with one score. Other columns of
    ``docs`` are no input. An empty table gives an empty result.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    scored = model.score(docs, text_col, (id_col,))
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "difference")
