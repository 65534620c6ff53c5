import random

import numpy as np
import pytest

from strata.llm.decontamination import GAP, MATCH, MISMATCH, align, contaminated, without_contaminated
from tests.llm.fixtures import as_dicts, awkward_docs, no_docs, sentence

ITEMS = "item_id long, text string, score double"


def plain_score(item, passage):
    row, best = [0] * (len(passage) + 1), 0
    for word in item:
        now = [0]
        for j, other in enumerate(passage):
            now.append(max(0, row[j] + (MATCH if word == other else MISMATCH), row[j + 1] + GAP, now[j] + GAP))
        row, best = now, max(best, *now)
    return best


def test_alignment_matches_plain_dynamic_programming():
    rng = np.random.default_rng(2)
    for _ in range(300):
        item, passage = rng.integers(0, 5, rng.integers(1, 15)), rng.integers(0, 5, rng.integers(0, 25))
        score, start, end = align(item, passage)
        assert score == plain_score(item.tolist(), passage.tolist())
        assert plain_score(item.tolist(), passage[start:end].tolist()) == score


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(4)
    items = [(i, sentence(rng, 30, 300)) for i in range(12)] + [(50, None), (51, ""), (52, "rare pair"), (None, "w1 w2 w3 w4")]
    docs, held = [], set()
    for d in range(60):
        text = sentence(rng, 200, 300).split()
        if d % 3 == 0:
            i = d // 3 % 12
            copy = items[i][1].split()
            for k in range(2, len(copy), 7):  # changed words, one left out, one put in
                copy[k] = f"changed{k}"
            del copy[11]
            copy.insert(20, "inserted")
            text[100:100] = copy
            held.add((d, i))
        docs.append((d, " ".join(text)))
    docs += [(90, "so a Rare  PAIR here"), (91, items[0][1]), (92, items[0][1] + "\n" + items[3][1]), (None, items[0][1])]
    docs += [(200 + i, items[5][1] + " " + sentence(rng, 20)) for i in range(100)]  # one item in much of the corpus
    held |= {(90, 52), (91, 0), (92, 0), (92, 3)} | {(200 + i, 5) for i in range(100)}
    return docs, items, held


def test_finds_edited_copies_and_nothing_else(spark, planted):
    docs, items, held = planted
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(*i, 0.0) for i in items], ITEMS)
    got = as_dicts(contaminated(frame, tests))
    assert {(r["doc_id"], r["item_id"]) for r in got} == held and len(got) == len(held)
    by = {(r["doc_id"], r["item_id"]): r for r in got}
    assert by[91, 0]["score"] == 1.0 and (by[91, 0]["first_word"], by[91, 0]["last_word"]) == (0, 30)
    assert 0.5 < by[0, 0]["score"] < 0.9 and abs(by[0, 0]["first_word"] - 100) <= 3
    left = without_contaminated(frame, tests)
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((d for d, _ in docs if d is None or d not in {h[0] for h in held}), key=str)


def test_finds_an_edited_passage_of_many_documents_beside_one_exact_copy(spark):
    rng = random.Random(6)
    item = sentence(rng, 30, 300)
    edited = item.split()
    for k in range(2, len(edited), 7):
        edited[k] = f"changed{k}"
    passages = [item] + [" ".join(edited)] * 30
    docs = [(i, f"{sentence(rng, 60, 300)} {p} {sentence(rng, 60, 300)}") for i, p in enumerate(passages)]
    docs += [(100 + i, sentence(rng, 150, 300)) for i in range(20)]
    got = as_dicts(contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item, 0.0)], ITEMS)))
    assert {r["doc_id"]: round(r["score"], 1) for r in got} == {0: 1.0} | {i: 0.8 for i in range(1, 31)}


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    tests = spark.createDataFrame([(1, "one", 0.0), (2, None, 0.0), (2, "Üb Éa ONE", 0.0)], ITEMS)
    assert {(r["doc_id"], r["item_id"]) for r in as_dicts(contaminated(docs, tests))} == {(7, 1), (8, 1), (9, 1), (9, 2), (11, 1)}
    assert contaminated(no_docs(spark), tests).collect() == [] == contaminated(docs, tests.limit(0)).collect()
    assert without_contaminated(docs, tests.limit(0)).count() == docs.count()
    assert without_contaminated(docs, tests).columns == docs.columns
