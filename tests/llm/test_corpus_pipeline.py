import random
from collections import Counter

import pytest

import corpus_pipeline
from strata.llm.compression_quality import fit
from strata.llm.queries import ORACLE_SQL, QUERIES, table
from tests.llm.fixtures import DOCS, HAVE_DATA, SF, as_dicts, awkward_docs
from tests.llm.test_ngram_join import plain_components
from tools.check_oracle import _digest

pytestmark = pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert _digest(got.columns, [tuple(r) for r in got.collect()])[0] == _digest(names, want.fetchall())[0]


def test_stages_do_what_their_operators_say(spark):
    docs = table(spark, SF, "documents").cache()
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        docs = docs.cache()
        ids[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if name == "quality":
            before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if name == "near_duplicates":
            first = plain_components(before.items(), 5, 80, 100)
            assert ids[name] == sorted(i for i, (_, c) in first.items() if i == c)
    assert set(ids["mix"]) <= set(ids["decontaminate"]) <= set(ids["near_duplicates"]) <= set(ids["quality"])
    assert len(ids["mix"]) > len(set(ids["mix"]))
    rows = sorted(as_dicts(corpus_pipeline.STAGES[-1][1](spark, docs, SF)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == ids["mix"]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))


def test_stages_on_awkward_rows(spark):
    docs = awkward_docs(spark).select(*[c.split()[0] for c in DOCS.split(", ")])
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()
        stage(spark, docs.limit(0), SF).collect()


def test_mix_of_repeated_rows(spark):
    docs = spark.createDataFrame([(i // 3, "w " * (1 + i % 7), "en", "a" if i % 2 else "b", i) for i in range(60)], DOCS)
    docs = docs.unionByName(docs.limit(10))
    mixed = corpus_pipeline.mix(spark, docs, SF)
    words = sum(len(r.text.split()) for r in docs.collect())
    assert abs(sum(len(r.text.split()) for r in mixed.collect()) - 1.5 * words) <= 7
    assert mixed.columns == docs.columns


def test_rows_of_one_id_and_without_an_id_are_documents(spark):
    words = ["".join(random.Random(i).choices("abcdefgh", k=5)) for i in range(200)]
    texts = [" ".join(words[i * 40:(i + 1) * 40]) for i in range(5)]
    rows = [(1, texts[0], "en", "a", 1), (1, texts[1], "en", "a", 1), (None, texts[2], "en", "a", 1), (None, texts[3], "en", None, 1),
            (2, texts[0], "en", "a", 1), (None, texts[1], "en", "a", 1), (3, texts[4], "en", "a", 1), (3, texts[4], "en", "a", 1),
            (None, texts[4] + " more", "en", "a", 1), (4, None, "en", "a", 1), (4, "", "en", "a", 1), (None, " ", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    left = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert left.columns == docs.columns
    assert Counter(tuple(r) for r in left.collect()) == Counter(rows[i] for i in (0, 1, 2, 3, 6, 9, 10, 11))

    model = fit(docs, table(spark, SF, "labels"))
    kept = corpus_pipeline.quality(spark, docs, SF)
    want = [tuple(r)[:5] for r in model.score(docs, "text", tuple(docs.columns)).where("score >= 0.3").collect()]
    assert Counter(tuple(r) for r in kept.collect()) == Counter(want)

    item = table(spark, SF, "benchmark").where("length(text) > 100").first().text
    docs = spark.createDataFrame([*rows, (1, f"{texts[3]} {item} {texts[2]}", "en", "a", 1), (None, item, "en", "a", 1)], DOCS)
    assert Counter(tuple(r) for r in corpus_pipeline.decontaminate(spark, docs, SF).collect()) == Counter(rows)
