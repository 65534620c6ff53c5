import hashlib
import os
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.llm.merkle_manifest import as_hex, build, fold, leaf_digest, proofs
from strata.llm.queries import op13_merkle_manifest
from tests.llm.fixtures import HAVE_DATA, SF, awkward_docs, no_docs

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def climb(nodes):
    """(top, for each node the others of its run level by level, folds of another leaf) of a tree."""
    paths = [[] for _ in nodes]
    level = [(d, [i]) for i, d in enumerate(nodes)]
    while len(level) > 1:
        up = []
        for at in range(0, len(level), 3):
            run = level[at:at + 3]
            for j, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(([d for d, _ in run[:j]], [d for d, _ in run[j + 1:]]))
            up.append((sha(*(d for d, _ in run)), [i for _, below in run for i in below]))
        level = up
    return level[0][0], paths


def plain(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops, paths = [], []
    for s in names:
        by[s].sort(key=lambda x: x[:3])
        top, own = climb([x[2] for x in by[s]])
        tops.append(top)
        paths.append(own)
    root, above = climb(tops)
    out = []
    for s, top, own, rest in zip(names, tops, paths, above, strict=True):
        for (_, _, d, r), path in zip(by[s], own, strict=True):
            path = path + rest
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            up = leaf({**r, "text": text})
            for left, right in path:
                up = sha(*left, up, *right)
            out.append((r["doc_id"], d, top, root, sha(*(x for left, right in path for x in left + right)), up, up == root))
    return sorted(out, key=repr)


def checked(df):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect()), key=repr)


def query_on(spark, docs, tmp_path):
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    return op13_merkle_manifest(spark, f"file://{tmp_path}")


def test_awkward_rows(spark, tmp_path):
    docs = awkward_docs(spark).unionByName(spark.createDataFrame([(None, "a\n", None, "a", None), (None, None, None, None, None)],
                                                                "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    docs = docs.unionByName(docs.where("source = 'b'").withColumn("source", F.lit("")))
    rows = [r.asDict() for r in docs.collect()]
    assert checked(query_on(spark, docs, tmp_path)) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 4, 28])
def test_trees_of_all_shapes(spark, tmp_path, n):
    rows = [dict(zip(FIELDS, (i * 7 % 101, f"s{i % 5 * (i % 3)}", "en", i, f"t{i}\n"), strict=True)) for i in range(n)]
    docs = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], "doc_id long, source string, lang string, n_chars long, text string") if n else no_docs(spark)
    assert checked(query_on(spark, docs, tmp_path)) == (plain(rows) if n else [])


def test_requests_for_some_leaves_open_only_their_nodes(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "concat('s', id % 2) as source", "cast(id as string) as text")
    made = build(docs, leaf_digest(F.col("doc_id"), F.col("text")))
    wanted = spark.createDataFrame([("=s0", 0), ("=s1", 99), ("=s1", 100), ("=none", 0)], "key string, rank long")
    rows = proofs(made, wanted).withColumn("up", fold(as_hex(F.col("digest")), F.col("path"))).collect()
    assert sorted(r.id for r in rows) == [0, 199] and {r.up for r in rows} == {made.root.hex()}


def test_equal_subtrees_are_one_record(spark):
    docs = spark.range(27).selectExpr("1 as doc_id", "'s' as source")
    made = build(docs, leaf_digest(F.col("doc_id")))
    assert [r.select("digest").distinct().count() for r in made.records] == [1, 1, 1]
    assert proofs(made).count() == 27


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
def test_query_is_exact(spark):
    rows = [r.asDict() for r in spark.read.parquet(os.path.join(SF, "documents.parquet")).collect()]
    assert checked(entry.queries()["op13_merkle_manifest"](spark, SF)) == plain(rows)
