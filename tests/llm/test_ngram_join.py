import random

import numpy as np
import pytest

from strata.llm import ngram_join
from strata.llm.ngram_join import bands, fine_sketches, join_links, least_differences, signatures
from tests.llm.fixtures import as_dicts, awkward_docs, no_docs, sentence, shingles


def plain_components(rows, n, num, den):
    sets = {i: shingles(t, n) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("num,den", [(85, 100), (80, 100), (1, 2)])
def test_similar_sets_share_a_signature(num, den):
    rng = np.random.default_rng(5)
    for size in [1, 2, 5, 7, 9, 13, 20, 27, 40, 90, 300, 1000]:
        for _ in range(6):
            a = np.unique(rng.integers(1, 1 << 63, size, dtype=np.uint64))
            most = max(0, int((den - num) * len(a) / den))
            for dropped in {0, most // 2, most}:
                b = np.sort(rng.permutation(a)[dropped:])
                for added in {0, int(len(b) * den / num) - len(a)}:
                    c = np.unique(np.concatenate([b, rng.integers(1, 1 << 63, max(0, added), dtype=np.uint64)]))
                    both = len(np.intersect1d(a, c))
                    if den * both < num * (len(a) + len(c) - both):
                        continue
                    sig, row = signatures(np.concatenate([a, c]), np.array([0, len(a), len(a) + len(c)]), num, den)
                    assert set(sig[row == 0]) & set(sig[row == 1]), (size, dropped, added)


def test_bands_cover_all_sizes():
    cut = bands(85, 100, 5000)
    assert cut[0].low == 1 and cut[-1].high >= 5000
    assert all(a.high + 1 == b.low for a, b in zip(cut, cut[1:], strict=False))
    for b in cut:
        assert (b.partitions - b.spare) * (b.left_out + 1) > 2 * b.high * 15 // 185


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    want = plain_components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 4, 85, 100)
    got = as_dicts(join_links(docs))
    assert sorted(r["doc_id"] for r in got) == sorted([*range(1, 13), 9])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert join_links(no_docs(spark)).collect() == []


def test_rows_of_one_id_with_other_texts_and_rows_without_id(spark):
    rng = random.Random(3)
    a, b = sentence(rng, 80).split(), sentence(rng, 80).split()
    a2, b2 = [*a[:-1], "x"], [*b[:-1], "y"]
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a2)), (3, " ".join(b2)), (None, " ".join(a2)), (None, "all by itself")]
    got = join_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (None, 1), (None, None)], key=str)


@pytest.mark.parametrize("n,num", [(4, 85), (5, 80)])
def test_large_group_of_edited_copies(spark, n, num):
    rng = random.Random(11)
    base = sentence(rng, 90, 5000).split()
    rows = []
    for i in range(150):  # most are similar to the base, some to other copies only, some to none
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = rng.choice(["x", "y", f"z{rng.randrange(9)}"])
        rows.append((i * 3 % 151, " ".join(copy)))
    rows += [(1000 + i, sentence(rng, rng.randrange(1, 40), 12)) for i in range(100)]
    got = as_dicts(join_links(spark.createDataFrame(rows, "doc_id long, text string"), n=n, num=num))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_components(rows, n, num, 100)


def test_passes_find_the_same(spark):
    rng = random.Random(5)
    rows = []
    for group in range(6):
        text = sentence(rng, 80, 400).split()
        for copy in range(5):
            text[rng.randrange(80)] = f"edit{copy}"
            rows.append((1000 + 10 * group + copy, " ".join(text)))
    docs = awkward_docs(spark).select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    found = [sorted((tuple(r) for r in join_links(docs, passes=p, text_passes=q).collect()), key=str) for p, q in ((1, 1), (3, 1), (1, 2), (2, 4))]
    assert found[0] == found[1] == found[2] == found[3]
    assert len({c for i, _, c in found[0] if i is not None and i >= 1000}) < len(rows)


def test_fine_sketches_never_say_more_than_the_difference():
    rng = np.random.default_rng(6)
    for size in [0, 1, 255, 256, 257, 700, 5000]:
        for kept in [0, size // 2, size - size // 10, size]:
            for added in [0, 1, size // 8, 2 * size]:
                a = np.unique(rng.integers(1, 1 << 63, size, dtype=np.uint64))
                b = np.unique(np.concatenate([rng.permutation(a)[:kept], rng.integers(1, 1 << 63, added, dtype=np.uint64)]))
                fine = fine_sketches(np.concatenate([a, b, a]), np.cumsum([0, len(a), len(b), len(a)]))
                differ = len(np.setxor1d(a, b))
                got = least_differences(fine.slice(0, 2), fine.slice(1, 2)).tolist()
                assert got[0] == got[1] <= differ and (differ - got[0]) % 2 == 0


def test_texts_of_dissimilar_long_sets_are_not_compared(spark, monkeypatch):
    rng = random.Random(9)
    blocks = [" ".join(rng.choice("abcdefgh") * 2 + str(rng.randrange(10 ** 6)) for _ in range(40)) for _ in range(60)]
    texts = [" ".join(rng.sample(blocks, 30)) for _ in range(16)]
    texts += [t + " more words at the end" for t in texts[:4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compared = []
    linked = ngram_join._linked
    monkeypatch.setattr(ngram_join, "_linked", lambda pairs, *rest: compared.append(pairs.count()) or linked(pairs, *rest))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in as_dicts(join_links(docs, n=5, num=80, den=100))}
    assert got == plain_components(list(enumerate(texts)), 5, 80, 100)
    assert sum(compared) == 4
