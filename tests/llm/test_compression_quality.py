import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm.compression_quality import fit, held_out, quality_scores
from tests.llm.fixtures import HAVE_DATA, as_dicts, awkward_docs, no_docs

SF01 = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_fold(spark):
    rows = spark.range(-5, 300).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_scores(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "quality").collect()
    good, bad = ([r.score for r in rows if r.quality == y] for y in (1, 0))
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert sum(g >= 0.3 for g in good) / len(good) > 0.97


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
def test_scores_do_not_depend_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(quality_scores(docs, labels).collect()) == sorted(quality_scores(docs.repartition(7), turned).collect())


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (7, 0, 0), (7, 1, None), (None, 1, 0), (8, None, 0), (9, 0, 1), (99, 1, 0)], LABELS)
    got = as_dicts(quality_scores(docs, labels))
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[4]["score"] == by[5]["score"]  # null and empty
    assert quality_scores(no_docs(spark), labels).collect() == []
    assert {r["score"] for r in as_dicts(quality_scores(docs, labels.limit(0)))} == {0.5}
    assert fit(docs, labels.where("quality = 1")).slope == 0
