from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import mixing
from strata.llm.mixing import mix_sources, pivot, settle, source_targets
from tests.llm.fixtures import HAVE_DATA, as_dicts, awkward_docs, no_docs, words

SFS = [f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1")]


def plain_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        left = total - sum(fixed.values())
        goal = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if goal[s] > most * sizes[s]]
        if not above:
            return fixed | goal
        fixed |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 1, "b": 100, "c": 1000, None: 7}, {"b": 0, "a": 5, "é": 50, "z": 3, "Z": 900, "zz": 2},
                                   {f"s{i}": i * i for i in range(30)}, {"a": 4, "b": 4, "c": 4, "d": 4}])
def test_targets_match_repeated_sharing(spark, sizes):
    got = source_targets(spark.createDataFrame(list(sizes.items()), "src string, source_size long"))
    assert {r.src: r.target for r in got.collect()} == pytest.approx(plain_targets(sizes))


def test_settling_of_few_documents_is_the_best_choice():
    rng = np.random.default_rng(3)
    for n in (1, 2, 9, 14, 15, 60, 300):
        for _ in range(20):
            size, p = rng.integers(1, 2000, n), rng.random(n)
            off = abs((size * settle(size, p, np.round(p))).sum() - (size * p).sum())
            if n <= 9:
                assert off == pytest.approx(min(abs(sum(s for i, s in enumerate(size) if c >> i & 1) - (size * p).sum()) for c in range(1 << n)))
            assert off <= (2000 if n < 9 else 60 if n < 60 else 5)


def test_pivot_keeps_mass_and_expectation():
    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 50, 40), rng.random(40)
    sums = np.zeros(40)
    for seed in range(400):
        key = rng.integers(-(1 << 62), 1 << 62, 40)
        q = pivot(size, p, key, seed)
        assert ((q > 0) & (q < 1)).sum() <= 1 and (size * q).sum() == pytest.approx((size * p).sum())
        assert abs((size * settle(size, p, q)).sum() - (size * p).sum()) <= size.max()
        sums += q
    assert np.abs(sums / 400 - p).max() < 0.13


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
@pytest.mark.parametrize("sf", SFS)
def test_mix_is_near_its_targets_and_repeatable(spark, monkeypatch, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = as_dicts(mix_sources(docs))
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len(words(text[r["doc_id"]])) and r["taken"] in (0, r["size"], 2 * r["size"])
        by[r["source"]].append(r)
    want = plain_targets({s: sum(r["size"] for r in rs) for s, rs in by.items()})
    for s, rs in by.items():
        assert [r["target"] for r in rs] == pytest.approx([want[s]] * len(rs)) and {r["source_size"] for r in rs} == {sum(r["size"] for r in rs)}
        assert abs(sum(r["taken"] for r in rs) - want[s]) <= max(0.005 * want[s], 0.5 * min(r["size"] for r in rs if r["size"]))
    again = as_dicts(mix_sources(docs.repartition(13)))
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    monkeypatch.setattr(mixing, "GROUP", 4)  # several levels
    rows = as_dicts(mix_sources(docs))
    taken = defaultdict(int)
    for r in rows:
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 * max(r["size"] for r in rs) + 1 for s, rs in by.items()) and len(rows) == len(text)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    got = as_dicts(mix_sources(docs))
    assert sorted(r["doc_id"] for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    want = plain_targets({s: r for s, r in docs.withColumn("c", mixing.word_count(F.col("text"))).groupBy("source").agg(F.sum("c")).collect()})
    assert {r["source"]: r["target"] for r in got} == pytest.approx(want)
    assert all(r["taken"] <= 2 * r["size"] for r in got) and {r["taken"] for r in got if r["doc_id"] in (4, 5, 6)} == {0}
    assert mix_sources(no_docs(spark)).collect() == []
