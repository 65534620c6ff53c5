import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from strata.llm import periodic_runs
from strata.llm.periodic_runs import find_runs, scan, segments
from tests.llm.fixtures import HAVE_DATA, SF, WORD, awkward_docs, no_docs


def plain_runs(w, least=6, exponent=4):
    """Every maximal stretch of every period, smallest period first; those that a smaller period explains go."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if (n := j - i + q) >= max(least, exponent * q) and j > i:
                if not any(all(w[x] == w[x + p] for x in range(i, i + n - p)) for p in range(1, q)):
                    out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def found(words, least=6, exponent=4):
    code = np.unique(np.array(words), return_inverse=True)[1].astype(np.int64) if words else np.zeros(0, np.int64)
    return list(zip(*(x.tolist() for x in scan(code, segments(code, np.array([0, len(code)]), least, exponent), least, exponent)), strict=True))


pieces = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=7)


@settings(max_examples=600, deadline=None)
@given(pieces, st.sampled_from([(6, 4), (1, 3), (10, 5)]))
def test_runs_are_those_of_brute_force(made, limits):
    w = [x for block, n in made for x in block * n]
    assert found(w, *limits) == plain_runs(w, *limits)


@settings(max_examples=200, deadline=None)
@given(pieces)
def test_splitting_one_by_one_gives_the_same(made):
    w = [x for block, n in made for x in block * n]
    rounds = periodic_runs.ROUNDS
    try:
        want = sorted(segments(np.array(w, np.int64), np.array([0, len(w)]), 6, 4))
        periodic_runs.ROUNDS = 1
        assert sorted(segments(np.array(w, np.int64), np.array([0, len(w)]), 6, 4)) == want
    finally:
        periodic_runs.ROUNDS = rounds


def test_a_chain_of_ever_rarer_words_is_split_in_time():
    # each cut takes the fourth occurrence of the next word
    w = [x for i in range(30000) for x in (i, i, i, i + 1)]
    assert found(w) == []
    long = random.Random(5).choices(range(12), k=300000)
    assert (50000, 90000, 900) in found(long[:50000] + long[50000:50900] * 100 + [99] + long)


def test_awkward_rows(spark):
    docs = awkward_docs(spark).select("doc_id", "text", "id", "key", "size")
    rows = docs.unionByName(spark.createDataFrame([
        (None, "x " * 9), (20, " a b\na b\ta b\x0ba b "), (21, "A a A a A a A a"), (22, "c " * 5), (23, "é é é é é é"),
        (24, "a a a a a a a a a a a a")],
        "doc_id long, text string").selectExpr("doc_id", "text", "doc_id as id", "doc_id as key", "doc_id as size"))
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(rows).collect()), key=repr)
    want = []
    for r in rows.collect():
        w = WORD.findall(r.text or "")
        runs = plain_runs(w) if len(w) < 3000 else []
        want.append((r.doc_id, runs, collapsed(w, runs)))
    assert got == sorted(want, key=repr)
    assert find_runs(no_docs(spark)).collect() == []


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
def test_query_is_exact(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(os.path.join(SF, "documents.parquet")).collect()}
    rows = entry.queries()["op12_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(docs)
    planted = 0
    for r in rows:
        w = WORD.findall(docs[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = w[:a] + [w[a + i % p] for i in range(n - a)]
        if n > 2500:  # too slow for the plain way
            continue
        runs = plain_runs(w)
        planted += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(runs) and (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted
