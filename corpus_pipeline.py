"""A corpus pipeline of the training-data operators: each stage reads what the one before kept.

All stages but the last return the columns of ``documents``; the last returns
the index of the token files that it writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.compression_quality import THRESHOLD, fit
from strata.llm.decontamination import without_contaminated
from strata.llm.mixing import mix_sources, word_count
from strata.llm.ngram_join import join_links
from strata.llm.queries import table, tokenizer_path
from strata.llm.tables import Scratch
from strata.llm.token_files import tokens_round_trip


def _with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, which rows equal in every column share; so neither null nor repeated ids mix up rows."""
    columns = [F.col(c) for c in docs.columns]
    return docs.withColumn("_row", F.xxhash64(*columns, *(c.isNull() for c in columns)))  # a null alone leaves a hash as it was


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject.

    Each row is judged by its own text: rows without an id too, and rows of
    one id each on its own. Null and empty texts have the curve's score at no
    difference. An empty table gives an empty one.
    """
    scored = fit(docs, table(spark, sf_dir, "labels")).score(docs, "text", tuple(docs.columns))
    return scored.where(F.col("score") >= THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by Jaccard 0.8 of five-word shingles: that of the smallest id.

    Rows without an id take part and come after all others; different texts
    under one id are documents of their own. Rows equal in every column are
    one document, texts without words link with nothing else. Of equal ids in
    a group the row of the smallest hash stays.
    """
    keyed = _with_key(docs)
    linked = join_links(keyed, "_row", n=5, num=80, den=100, passes=2, text_passes=4).select("_row", "component_id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    first = (keyed.select("_row", "doc_id").distinct().join(linked, "_row")
             .groupBy("component_id").agg(F.min(order).alias("first")).select("first._row"))
    again = Window.partitionBy("_row", *docs.columns).orderBy("_row")  # the join has brought equal rows together
    return (keyed.join(first, "_row", "left_semi").withColumn("_place", F.row_number().over(again))
            .where("_place = 1").select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item.

    Each row by its own text: rows without an id are searched too, and rows
    that share an id with a copy stay. Null and empty texts stay.
    """
    return without_contaminated(_with_key(docs), table(spark, sf_dir, "benchmark"), "_row").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; copies carry the document's id.

    Rows without an id or a source take part, the latter as a source of their
    own; texts without words have no size and are left out. Repeated rows
    count each.
    """
    # rows of one id meet their counts in order of source and size, on which alone the counts depend
    taken = mix_sources(docs).select("doc_id", "source", "size", F.when(F.col("size") > 0, F.col("taken") / F.col("size")).cast("int").alias("_copies"))
    placed = Window.partitionBy("doc_id").orderBy("source", "_size", F.desc("_copies"))
    taken = taken.withColumnRenamed("size", "_size").withColumn("_place", F.row_number().over(placed)).select("doc_id", "_place", "_copies")
    placed = Window.partitionBy("doc_id").orderBy("source", "_size", "text", "lang", "n_chars")
    rows = docs.withColumn("_size", word_count(F.col("text"))).withColumn("_place", F.row_number().over(placed))
    met = rows.alias("r").join(taken.alias("t"), F.col("r.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("r._place") == F.col("t._place")))
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return met.where("_copies > 0").select(*(F.col(f"r.{c}").alias(c) for c in docs.columns), copies.alias("_copy")).drop("_copy")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all that is left, and their index as read back; null texts are empty documents."""
    return tokens_round_trip(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: The classifier, the alignment, the rounding and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
