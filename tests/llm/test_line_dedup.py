import duckdb

from strata.llm.line_dedup import SQL, without_shared_lines
from tests.llm.fixtures import as_dicts, awkward_docs, no_docs


def test_matches_sql_near_the_threshold(spark):
    rows = []
    for i in range(40):
        lines = [f"own line number {i} here", "All Rights   reserved by us"]
        lines += [f"shared by just {n} of sites" for n in range(1, 12) if i % 20 < n]
        rows.append((1000 + i, "\n".join(lines) + ("\n" if i % 2 else ""), "en", f"s{i % 20}", 0))
    rows += [(2100 + i, "few words", "en", f"s{i}", 0) for i in range(9)] + [(300, "\n\n", "en", None, 0), (None, "few words\nno id", "en", "s1", 0), (None, None, "en", "s1", 0), (301, "", None, None, None)]
    docs = awkward_docs(spark).select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    got = without_shared_lines(docs)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(SQL)
    names = [d[0] for d in want.description]
    assert sorted(map(repr, as_dicts(got.select(*names)))) == sorted(repr(dict(zip(names, r, strict=True))) for r in want.fetchall())
    by = {r["doc_id"]: r for r in as_dicts(got)}
    assert "reserved" not in by[1000]["text"] and "own line number 0" in by[1000]["text"]
    assert "just 4 of" in by[1000]["text"] and "just 5 of" not in by[1000]["text"]
    assert by[2100]["text"] == "" and by[2100]["n_removed"] == 1 and by[4]["text"] is None


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    got = as_dicts(without_shared_lines(docs))
    assert len(got) == docs.count()
    assert {r["doc_id"]: r["text"] for r in got} == {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert without_shared_lines(no_docs(spark)).collect() == []
