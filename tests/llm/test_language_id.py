import numpy as np
import pytest

from strata.llm.language_id import fit_text, identify, visible_text
from tests.llm.fixtures import HAVE_DATA, as_dicts

PAGES = "page_id long, url string, html string, host string, declared string, l0 double"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog went with them to that house", "EN"), (2, "der hund und die katze sind nicht im haus", "de"),
                                  (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string")
    return fit_text(docs)


def test_visible_text():
    assert visible_text(b"<p>a&amp;b</p><script>no</script><!-- no --><STYLE>no</style >c<nav>no</nav>").split() == [b"a", b"b", b"c"]


def test_likelihoods_are_finite_for_any_text(model):
    assert model.languages == ["de", "en"]
    got = model.likelihoods(np.frombuffer(b"the dog", np.uint8), np.array([0, 7, 7]))
    assert got[0, 1] > got[0, 0] and got[1].tolist() == [0, 0]


def test_awkward_rows(spark, model):
    rows = [(1, "http://a.org/x", "<html lang='en'>the dog and that house"), (1, "http://a.org/x", "<html lang='en'>the dog and that house"),
            (2, None, None), (3, "", ""), (4, "http://b.de/", "<html LANG=de-AT><p>und die katze nicht"), (None, "http://b.de/y", "<html lang=de>"),
            (5, "http://b.de/z", "<p>" + "katze " * 40000)]
    pages = spark.createDataFrame([(*r, "h", "d", 0.0) for r in rows], PAGES)
    got = as_dicts(identify(pages, model))
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["lang"] == "en" and by[4]["lang"] == by[5]["lang"] == by[None]["lang"] == "de"
    assert by[4]["declared"] == "de" and by[2]["declared"] is None and by[2]["lang"] in ("de", "en")
    assert all(0.5 <= r["confidence"] <= 1 for r in got)
    assert identify(pages.limit(0), model).collect() == []


def test_no_labelled_text(spark):
    none = fit_text(spark.createDataFrame([(1, None, "en"), (2, "x", None)], "doc_id long, text string, lang string"))
    pages = spark.createDataFrame([(1, "http://a.org/x", "<html lang='en'>the dog", "h", "d", 0.0)], PAGES)
    assert [(r["lang"], r["confidence"]) for r in as_dicts(identify(pages, none))] == [("und", 1.0)]


def test_host_prior_decides_without_text(spark, model):
    rows = [(i, "http://x.example/", "<p>und der hund im haus", "h", "d", 0.0) for i in range(20)] + [(99, "http://x.example/q", "<p>?", "h", "d", 0.0)]
    rows += [(200 + i, f"http://y{i}.com/", "<p>the cat and that dog went", "h", "d", 0.0) for i in range(60)] + [(98, "http://z.com", "", "h", "d", 0.0)]
    by = {r["page_id"]: r for r in as_dicts(identify(spark.createDataFrame(rows, PAGES), model))}
    assert by[99]["lang"] == "de" and by[98]["lang"] == "en"


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
def test_accuracy_against_the_address_path(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    got = identify(pages, fit_text(spark.read.parquet(f"{SF01}/documents.parquet")))
    told = pages.selectExpr("page_id", "regexp_extract(url, '://[^/]*/([a-z]+)/', 1) as path")
    right = got.join(told, "page_id").selectExpr("avg(int(lang = path))", "avg(int(text_lang = path))").first()
    assert right[0] > 0.97 and right[1] > 0.95
