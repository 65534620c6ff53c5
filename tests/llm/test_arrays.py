import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import arrays
from tests.llm.fixtures import shingles, words

TEXTS = ["a b c", None, "", "  ", "x", "A B C d e f g", "a b c d e", "é É\tÉ\x0bz\x1f y", "a" * 5000 + " b", "q\n" * 7]


@pytest.mark.parametrize("limit", [1, 20, 1 << 20])
def test_words_and_shingles_match_plain_python(limit, monkeypatch):
    monkeypatch.setattr(arrays, "SLICE_BYTES", limit)
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("ab") for _ in range(rng.randrange(12))) for _ in range(200)]
    data, offsets = arrays.text_bytes(pa.array(texts))
    seen = {}
    for a, b in arrays.row_slices(offsets, limit):
        o = offsets[a:b + 1]
        found = arrays.words_of(data[o[0]:o[-1]], o - o[0])
        for n in (1, 3, 4):
            h, at = arrays.shingle_sets(found, n)
            assert np.diff(at).tolist() == [len(shingles(t, n)) for t in texts[a:b]]
            for i, t in enumerate(texts[a:b]):
                key = (n, frozenset(shingles(t, n)))
                assert seen.setdefault(key, tuple(h[at[i]:at[i + 1]])) == tuple(h[at[i]:at[i + 1]])
        assert np.diff(found.offsets).tolist() == [len(words(t)) for t in texts[a:b]]


def test_runs_stay_inside_texts():
    found = arrays.words_of(*arrays.text_bytes(pa.array(["a b c", "", "d e", "f g h i"])))
    assert arrays.runs_of(found, 3)[1].tolist() == [0, 5, 6]
    assert len(arrays.runs_of(found, 9)[0]) == 0


def test_shared_counts():
    left = arrays.shingle_sets(arrays.words_of(*arrays.text_bytes(pa.array(["a b c", "", "x"]))), 1)
    right = arrays.shingle_sets(arrays.words_of(*arrays.text_bytes(pa.array(["c b z", "a", None]))), 1)
    assert arrays.shared_counts(left, right).tolist() == [2, 0, 0]
