"""Records of CSV files with line breaks inside quoted fields, read by many tasks (SRC1, SRC2).

A file is read as lines, split between tasks as Spark splits text. Whether a line
begins inside quotes depends on the number of quotes before it in the file, of
which only the parity matters:

1. quotes are counted by block (the part of a file that one split read), and the
   parity before each block is the running sum over the blocks of its file;
2. inside a block, a running sum over its lines tells which begin a record; a line
   that begins and ends outside quotes is a record as it is, the lines of any other
   are put together;
3. pieces at the edges of blocks, two a block at most, are put together by file.

The lines are dealt out by block, so no task has more than a split's worth, and the
order of lines never rests on anything but their place. Quotes stand around
fields or are doubled within them (RFC 4180); a lone quote inside an unquoted field
needs the reader of one task, ``read_csv(..., split=False)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLOCK = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("place"), "value")


def csv_records(spark: SparkSession, path: str, encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """(record) of every record of the files, without each file's first one if ``header``; empty lines between records are none."""
    lines = _lines(spark, path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    totals = lines.groupBy(*_BLOCK).agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.select(*_BLOCK, F.coalesce(F.sum("odd").over(before), F.lit(0)).alias("open"))

    inside = Window.partitionBy(*_BLOCK).orderBy("place")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = lines.withColumn("q", quotes).withColumn("after", F.sum("q").over(upto)).join(blocks, _BLOCK)
    counted = counted.withColumns({"open": (F.col("open") + F.col("after") - F.col("q")) % 2 == 1, "ends_open": (F.col("open") + F.col("after")) % 2 == 1})
    blank = F.col("value").isin("", "\r")
    marked = (counted.where(F.col("open") | ~blank).withColumn("n", F.sum((~F.col("open")).cast("int")).over(upto))
              .withColumn("is_first", (F.col("block") == 0) & (F.col("n") == 1)))
    alone = marked.where(~F.col("open") & ~F.col("ends_open")).select("value", "is_first")
    joined = F.array_join(F.array_sort(F.collect_list(F.struct("place", "value")))["value"], "\n")
    parts = (marked.where(F.col("open") | F.col("ends_open")).groupBy(*_BLOCK, "n")
             .agg(joined.alias("value"), F.max_by("ends_open", "place").alias("ends_open"), F.first("is_first").alias("is_first")))
    whole = parts.where((F.col("n") > 0) & ~F.col("ends_open")).select("value", "is_first")
    # a record that goes on beyond its block is followed by the first pieces of the next blocks, up to the one that ends it
    edge = parts.where((F.col("n") == 0) | F.col("ends_open"))
    owner = F.sum((F.col("n") > 0).cast("int")).over(Window.partitionBy("file").orderBy("block", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pieces = F.array_join(F.array_sort(F.collect_list(F.struct("block", "n", "value")))["value"], "\n")
    across = edge.withColumn("owner", owner).groupBy("file", "owner").agg(pieces.alias("value"), F.bool_or("is_first").alias("is_first"))
    found = alone.unionByName(whole).unionByName(across.select("value", "is_first"))
    if header:
        found = found.where(~F.col("is_first"))
    text = F.make_valid_utf8("value") if encoding.upper().replace("-", "") == "UTF8" else F.decode(F.col("value").cast("binary"), encoding)
    return found.select(F.regexp_replace(text, "\r$", "").alias("record"))
