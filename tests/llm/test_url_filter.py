import duckdb
from pyspark.sql import functions as F

from strata.llm.tables import Scratch
from strata.llm.url_filter import SQL, build_cascade, filter_pages, is_listed

URLS = ["http://Blog.Example.org/es/1", "https://example.org/en/15?x", "http://example.org", "http://a.com/fr/", "http://com/de/x",
        "http://xcom/de/x", "http://m.adult-x.example.net/en/1", "ftp://ÀB.net#frag", "no scheme", "", None, "a://b://c/d", "http://?q",
        "http://host.com/de/?a#b", "http://org/", "http://org//x/fr/"]


def test_rules_hosts_and_paths(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(1, URLS[1], "y"), (None, URLS[0], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").withColumn("shard", F.lit(1)).withColumn("key", F.lit("k"))
    got = sorted(map(tuple, filter_pages(pages).collect()), key=repr)
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toPandas().astype({"page_id": "Int64"}))
    assert got == sorted(con.execute(SQL).fetchall(), key=repr)
    by_id = {r[0]: r for r in got}
    assert by_id[0][1:] == ("blog.example.org", "/es/1", "example.org/es/", "block")
    assert by_id[2][2:] == ("", None, "allow") and by_id[6][4] == "block" and by_id[10][1:3] == ("", "")
    assert filter_pages(pages.limit(0)).collect() == []


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20000).select(F.concat(F.lit("host"), "id").alias("key"), (F.xxhash64("id") % 3 == 0).alias("listed"))
    table, sizes, shards = build_cascade(universe, Scratch(spark, "test"))
    assert len(sizes) > 2 and shards > 1
    keyed = universe.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")).join(table, "shard", "left")
    assert keyed.where(is_listed(F.col("key"), sizes) != F.col("listed")).count() == 0


def test_no_python_on_the_main_path(spark):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    plan = filter_pages(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
