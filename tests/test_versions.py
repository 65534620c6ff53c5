"""Tables of versions: commits, conflicts, pruning by statistics and Bloom filters, and what refreshes from them."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from strata.operators.clustering import clustered, z_value
from strata.operators.lookup import append_unseen, known_keys
from strata.session import list_names, publish, scratch_path, write_text
from strata.sinks.upsert import upsert_table
from strata.sinks.versions import Conflict, VersionedTable
from tests.conftest import rows

SCHEMA = "zone string, k bigint, v bigint"


def made(spark, data, cols=("zone",), **kw):
    table = VersionedTable(spark, scratch_path(spark, "test-versions"))
    df = spark.createDataFrame(data, SCHEMA)
    assert table.create(df.schema, cols, **kw) and not table.create(df.schema)
    table.append(df)
    return table


def files_of(df):
    return {f.rpartition("/")[2] for f in df.inputFiles()}


def test_a_file_is_published_once(spark):
    base = scratch_path(spark, "test-publish")
    write_text(spark, f"{base}/a", "first")
    write_text(spark, f"{base}/b", "second")
    assert publish(spark, f"{base}/a", f"{base}/name") and not publish(spark, f"{base}/b", f"{base}/name")
    assert sorted(list_names(spark, base)) == ["b", "name"]


def test_versions_can_be_read_and_untouched_partitions_keep_their_files(spark):
    table = made(spark, [("a", 1, 1), ("a b/é", 2, 2), (None, 3, 3)])
    first = table.snapshot()
    got = upsert_table(table, spark.createDataFrame([("a b/é", 2, 20), (None, 3, 30), ("0007", 4, 4), ("a b/é", 5, 5)], SCHEMA), ["k", "zone"])
    # a NULL zone never matches, so that row is added
    assert (got.rows_loaded, got.rows_updated, got.rows_inserted) == (4, 1, 3)
    assert rows(table.read(), "zone", "k", "v") == sorted([("a", 1, 1), ("a b/é", 2, 20), (None, 3, 3), (None, 3, 30), ("0007", 4, 4), ("a b/é", 5, 5)], key=repr)
    assert rows(table.read(first), "zone", "k", "v") == sorted([("a", 1, 1), ("a b/é", 2, 2), (None, 3, 3)], key=repr)
    assert table.snapshot().parts["zone=a"] == first.parts["zone=a"] and set(table.snapshot().changed) == set(table.snapshot().parts) - {"zone=a"}
    assert upsert_table(table, table.read().limit(0), ["k", "zone"]).rows_loaded == 0 and table.versions() == [0, 1, 2]


def test_a_write_that_dies_leaves_the_table_as_it_was(spark):
    table = made(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)])
    before = rows(table.read())
    fails = F.when(F.col("zone") == "c", F.raise_error(F.lit("killed")).cast("long")).otherwise(F.lit(9))
    with pytest.raises(Exception, match="killed"):
        table.replace(table.read().withColumn("v", fails).repartition(3, "zone"), table.snapshot())
    assert rows(table.read()) == before and table.versions() == [0, 1]
    # written, but the record is never published
    table.write_folder(table.read().withColumn("v", F.lit(9)), table.snapshot())
    assert rows(table.read()) == before
    assert len(table.vacuum(older_than_s=-5)) >= 1 and rows(table.read()) == before


def test_two_writers(spark):
    table = made(spark, [("a", 1, 1), ("b", 2, 2)])
    base = table.snapshot()
    row = lambda *r: spark.createDataFrame([r], SCHEMA)
    table.replace(row("a", 1, 10), base)
    table.replace(row("b", 2, 20), base)  # other partitions: both stay
    assert rows(table.read(), "v") == [(10,), (20,)]
    with pytest.raises(Conflict):
        table.replace(row("a", 1, 100), base)
    table.append(row("a", 7, 7))
    assert table.append_after(row("a", 8, 8), base) is None
    assert rows(table.read(), "v") == [(10,), (20,), (7,)]
    # upserts of one partition at once: the second merges into what the first left
    threads = [threading.Thread(target=upsert_table, args=(VersionedTable(spark, table.root), row("a", 100 + i, i), ["k", "zone"])) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert {r.k for r in table.read().collect()} == {1, 2, 7, 100, 101, 102}


def test_unpartitioned_and_empty_tables(spark):
    table = VersionedTable(spark, scratch_path(spark, "test-versions"))
    assert table.snapshot() is None
    table.create(spark.createDataFrame([], SCHEMA).schema)
    assert table.read().collect() == []
    upsert_table(table, spark.createDataFrame([("a", 1, 1), (None, None, 2)], SCHEMA), ["k"])
    upsert_table(table, spark.createDataFrame([("b", 1, 3), (None, None, 4)], SCHEMA), ["k"])
    assert rows(table.read(), "zone", "k", "v") == sorted([("b", 1, 3), (None, None, 2), (None, None, 4)], key=repr)
    with pytest.raises(ValueError, match="lacks"):
        upsert_table(table, spark.createDataFrame([(1,)], "k long"), ["k"])


def test_clustered_files_hardly_overlap_in_either_column(spark):
    df = spark.range(0, 40000).selectExpr("pmod(hash(id), 5000) as k", "cast(pmod(hash(id, 7), 5000) as string) as zone", "date_add(date'2024-01-01', cast(pmod(hash(id, 9), 300) as int)) as day")
    table = VersionedTable(spark, scratch_path(spark, "test-cluster"))
    table.create(df.schema, cluster_by=["k", "day"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        table.append(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    every = files_of(table.read())
    assert len(every) >= 24
    for ranges, where in (({"day": ("2024-03-01", "2024-03-05")}, "day between '2024-03-01' and '2024-03-05'"), ({"k": (100, 160)}, "k between 100 and 160")):
        some = table.read(ranges=ranges)
        assert len(files_of(some)) < len(every) // 2
        assert rows(some) == rows(df.where(where).select(*some.columns))
    assert rows(table.read(ranges={"k": (1, 5), "zone": ("1", "2")})) == rows(df.where("k between 1 and 5 and zone between '1' and '2'").select("k", "zone", "day"))


def test_z_values_of_nulls_ties_and_texts(spark):
    df = spark.createDataFrame([(None, None), (1, "a"), (1, "é"), (2, ""), (None, "zzzzzzzzzz")] * 3, "a int, b string")
    got = df.select("a", z_value(df, ["a", "b"]).alias("z")).collect()
    assert all(r.z is not None for r in got)
    assert rows(clustered(df, ["a", "b"], files=2)) == rows(df) and clustered(df.limit(0), ["a", "b"]).collect() == []
    with pytest.raises(ValueError):
        z_value(spark.createDataFrame([([1], 1)], "a array<int>, b int"), ["a", "b"])


def _rows_scanned(spark, action):
    """Rows that scans gave in the executions that ``action`` starts, from the final plans' metrics."""
    store = spark._jsparkSession.sharedState().statusStore()
    done = store.executionsCount()
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    total, found = 0, store.executionsList(int(done), 1000)
    for i in range(found.size()):
        x = found.apply(i)
        nodes, values = store.planGraph(x.executionId()).allNodes(), store.executionMetrics(x.executionId())
        for j in range(nodes.size()):
            node = nodes.apply(j)
            if node.name().startswith("Scan parquet"):
                for m in range(node.metrics().size()):
                    metric = node.metrics().apply(m)
                    if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                        total += int(values.get(metric.accumulatorId()).get().replace(",", ""))
    return total


@pytest.mark.parametrize("bloom", [True, False])
def test_few_keys_pass_over_row_groups(spark, bloom):
    ids = spark.range(0, 200000, numPartitions=8).selectExpr("cast(hash(id) as bigint) * 1000003 + id as k", "id as v", "'x' as zone").select("zone", "k", "v")
    table = VersionedTable(spark, scratch_path(spark, "test-bloom"))
    table.create(ids.schema, bloom=["k"] if bloom else [])
    options = {"parquet.block.size": str(64 << 10), "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": "100"}
    conf = spark._jsc.hadoopConfiguration()
    for k, v in options.items():
        conf.set(k, v)
    try:
        table.append(ids)
    finally:
        for k in options:
            conf.unset(k)
    batch = ids.where("v in (5, 77777, 123456)").unionByName(spark.range(60).selectExpr("'x' as zone", "id * 977 + 3 as k", "id as v"))
    want = rows(ids.select("k").join(batch.select("k").distinct(), "k"))
    scanned = _rows_scanned(spark, lambda: known_keys(table.read(), batch, "k", scratch_path(spark, "known")))
    assert rows(known_keys(table.read(), batch, "k", scratch_path(spark, "known"))) == want
    assert rows(known_keys(table.read(), batch, "k", scratch_path(spark, "known"), at_most=3)) == want
    assert known_keys(table.read(), batch.limit(0), "k", scratch_path(spark, "known")).collect() == []
    # the batch itself is read too
    assert (scanned < 50000) if bloom else (scanned >= 200000)


def test_unseen_rows_are_appended_once(spark):
    table = made(spark, [("a", 1, 1), ("b", 2, 2)], bloom=["k"])
    batch = spark.createDataFrame([("a", 2, 9), ("c", 3, 3), (None, None, 4)], SCHEMA)
    made_, n = append_unseen(table, batch, "k", scratch_path(spark, "unseen"))
    assert n == 2 and made_.number == 2
    assert append_unseen(table, batch.where("k is not null"), "k", scratch_path(spark, "unseen"))[1] == 0
    assert rows(table.read(), "k") == sorted([(1,), (2,), (3,), (None,)], key=repr)


def test_unseen_rows_when_another_writer_is_first(spark):
    table = made(spark, [("a", 1, 1)])
    other, plain = VersionedTable(spark, table.root), table.append_after
    calls = []

    def late(df, base):
        if not calls:
            calls.append(1)
            other.append(spark.createDataFrame([("b", 3, 30)], SCHEMA))
        return plain(df, base)

    table.append_after = late
    made_, n = append_unseen(table, spark.createDataFrame([("a", 3, 3), ("a", 4, 4)], SCHEMA), "k", scratch_path(spark, "unseen"))
    assert n == 1 and rows(table.read(), "k", "v") == [(1, 1), (3, 30), (4, 4)]


def _orders(spark, data):
    raw = spark.createDataFrame(data, "order_id string, order_date date, order_amount_inr double, order_status string, _generated_at timestamp")
    from strata.schemas import RAW_ORDERS, conform

    return conform(raw.withColumn("order_datetime", F.col("order_date").cast("timestamp")), RAW_ORDERS)


def test_silver_is_refreshed_for_changed_keys_alone(spark):
    from strata.plans import silver
    from strata.plans.silver_refresh import refresh, refresh_silver

    day, at = (lambda n: dt.date(2023, 1, n)), (lambda n: dt.datetime(2023, 2, n))
    root = scratch_path(spark, "test-silver")
    bronze = VersionedTable(spark, f"{root}/bronze")
    feed = [(f"o{i}", day(1 + i % 9), 100.0 + i, "delivered", at(1)) for i in range(90)]
    bronze.create(_orders(spark, feed).schema)
    bronze.append(_orders(spark, feed))
    out = VersionedTable(spark, f"{root}/out/stg_orders")
    full = lambda: rows(silver.stg_orders(bronze.read()).select(*out.read().columns))
    assert refresh_silver(spark, {"raw_orders": bronze}, f"{root}/out")["stg_orders"]["built"] == "all"
    assert rows(out.read()) == full()
    first = out.snapshot()
    # a new day, an order sent again, one that moves to another day and one that is out of range now
    bronze.append(_orders(spark, [("n1", day(20), 5.0, "x", at(2)), ("o3", day(4), 7.0, "cancelled", at(2)), ("o5", day(25), 8.0, "x", at(2)),
                                  ("o8", day(9), 1e9, "x", at(2)), ("n2", day(2), 9.0, "x", at(2)), (None, day(1), 9.0, "x", at(2))]))
    got = refresh_silver(spark, {"raw_orders": bronze}, f"{root}/out")["stg_orders"]
    assert got["built"] == "changes" and got["keys"] == 5 and rows(out.read()) == full()
    second = out.snapshot()
    same = {p for p in first.parts if second.parts.get(p) == first.parts[p]}
    assert len(same) == 9 - 4 and second.parts["order_date=2023-01-02"][0] == first.parts["order_date=2023-01-02"][0]
    assert refresh(bronze, out, silver.stg_orders, ["order_id"]) == {"built": "nothing", "keys": 0, "partitions": 0}
    # the same rows loaded anew change nothing, whatever their files
    bronze.replace(bronze.read().repartition(3), bronze.snapshot(), whole=True)
    assert refresh(bronze, out, silver.stg_orders, ["order_id"]) == {"built": "changes", "keys": 0, "partitions": 0}
    bronze.replace(bronze.read().where("order_date < '2023-01-05'"), bronze.snapshot(), whole=True)
    refresh(bronze, out, silver.stg_orders, ["order_id"])
    assert rows(out.read()) == full() and "order_date=2023-01-20" not in out.snapshot().parts


def test_coverage_is_kept_up_from_both_sides(spark):
    from strata.plans.silver import weather_coverage
    from strata.plans.silver_refresh import refresh_coverage

    root, day = scratch_path(spark, "test-coverage"), (lambda n: dt.date(2023, 1, n))
    orders, weather, out = (VersionedTable(spark, f"{root}/{n}") for n in ("orders", "weather", "out"))
    o = lambda *r: spark.createDataFrame(list(r), "order_id string, city string, order_date date")
    w = lambda *r: spark.createDataFrame(list(r), "city string, weather_date date")
    orders.create(o().schema, ["order_date"])
    weather.create(w().schema)
    orders.append(o(*((f"o{i}", "ab"[i % 2], day(1 + i % 6)) for i in range(30)), ("n", None, day(1)), ("m", "a", None)))
    weather.append(w(("a", day(1)), ("b", day(2)), ("a", day(2))))
    full = lambda: rows(weather_coverage(orders.read(), weather.read()).where("order_date is not null").select(*out.read().columns))
    kept = lambda: rows(out.read().where("order_date is not null"))
    assert refresh_coverage(orders, weather, out)["built"] == "all" and kept() == full()
    weather.append(w(("a", day(3)), ("b", day(4))))   # late weather closes gaps
    got = refresh_coverage(orders, weather, out)
    assert (got["built"], got["keys"]) == ("changes", 2) and kept() == full()
    orders.append(o(("x", "a", day(9)), ("y", "b", day(2))))  # a new day and one that is covered
    assert refresh_coverage(orders, weather, out)["keys"] == 2 and kept() == full()
    weather.replace(weather.read().where("weather_date > '2023-01-02'"), weather.snapshot(), whole=True)  # weather that is taken back
    assert refresh_coverage(orders, weather, out)["keys"] == 2 and kept() == full()
    assert refresh_coverage(orders, weather, out)["built"] == "nothing"
