"""DuckDB SQL equivalents of ``strata.plans.workloads`` (the correctness oracle).

Written independently of the Spark code, in plain SQL over the driver's
tables. DuckDB specifics: ``isodow(x) - 1`` is Monday = 0; ``QUALIFY`` filters
on window results; NULL ordering is always spelled out.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["md3_orders_clean"] = """
WITH src AS (
  SELECT * FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderkey IS NOT NULL
), latest AS (
  SELECT * FROM src
  QUALIFY row_number() OVER (
    PARTITION BY o_orderkey
    ORDER BY o_orderdate DESC NULLS LAST, o_custkey DESC NULLS LAST,
             o_orderstatus DESC NULLS LAST, o_totalprice DESC NULLS LAST,
             o_orderpriority DESC NULLS LAST) = 1
)
SELECT o_orderkey AS order_id,
       o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date,
       o_orderdate AS order_datetime,
       CAST(hour(o_orderdate) AS INTEGER) AS order_hour,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS order_day_of_week,
       CASE WHEN isodow(o_orderdate) - 1 >= 5 THEN true ELSE false END AS is_weekend,
       o_totalprice AS order_amount,
       upper(o_orderstatus) AS order_status,
       CASE WHEN upper(o_orderstatus) = 'F' THEN true ELSE false END AS is_finished,
       CASE WHEN upper(o_orderstatus) = 'O' THEN true ELSE false END AS is_open,
       CASE WHEN upper(o_orderstatus) = 'P' THEN true ELSE false END AS is_partial,
       o_orderpriority AS order_priority
FROM latest
WHERE o_totalprice > 0 AND o_totalprice <= 400000
"""


def _std_city(e: str) -> str:
    """City standardisation in DuckDB; '||' keeps SQL NULL propagation."""
    t = f"trim({e})"
    return (f"CASE WHEN upper({t}) IN ('BANGALORE', 'BENGALURU') THEN 'Bangalore' "
            f"WHEN upper({t}) IN ('NEW DELHI', 'DELHI') THEN 'Delhi' "
            f"WHEN upper({t}) = 'BOMBAY' THEN 'Mumbai' "
            f"ELSE upper(substr({t}, 1, 1)) || lower(substr({t}, 2)) END")


def _desc(*cols: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


ORACLE_SQL["win_dedup_latest_lineitem"] = f"""
SELECT * FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY {_desc('l_shipdate', 'l_partkey', 'l_suppkey', 'l_quantity', 'l_extendedprice',
                  'l_discount', 'l_tax', 'l_returnflag', 'l_linestatus')}) = 1
"""

ORACLE_SQL["win_dedup_authoritative_documents"] = f"""
WITH d AS (SELECT md5(text) AS text_hash, doc_id, lang, source, n_chars FROM documents)
SELECT * FROM d
QUALIFY row_number() OVER (
  PARTITION BY text_hash
  ORDER BY n_chars DESC NULLS LAST, doc_id ASC NULLS LAST, {_desc('lang', 'source')}) = 1
"""

ORACLE_SQL["md1_part_attributes"] = f"""
WITH best AS (
  SELECT * FROM part WHERE p_partkey IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY p_partkey
    ORDER BY {_desc('p_retailprice', 'p_size', 'p_name', 'p_brand', 'p_type')}) = 1
)
SELECT p_partkey AS part_id,
       trim(p_name) AS part_name,
       {_std_city('p_type')} AS part_type,
       trim(string_split(p_name, ' ')[1]) AS name_primary,
       (upper(coalesce(p_name, '')) LIKE '%BOLT%' OR upper(coalesce(p_name, '')) LIKE '%RING%'
        OR upper(coalesce(p_name, '')) LIKE '%ROD%') AS is_fastener,
       CASE WHEN CAST(p_size AS DOUBLE) = 0 OR p_size IS NULL THEN NULL
            ELSE p_retailprice / CAST(p_size AS DOUBLE) END AS price_per_size,
       CAST(ceil(p_size / 13) AS INTEGER) AS size_band,
       CASE CAST(ceil(p_size / 13) AS INTEGER) WHEN 1 THEN 'BUDGET' WHEN 2 THEN 'AFFORDABLE'
            WHEN 3 THEN 'PREMIUM' WHEN 4 THEN 'LUXURY' ELSE NULL END AS size_tier,
       CASE WHEN p_retailprice / 200.0 BETWEEN 0 AND 5 THEN CAST(p_retailprice / 200.0 AS DOUBLE) END
         AS price_score
FROM best
"""

ORACLE_SQL["md2_tiering_scd1"] = f"""
WITH best AS (
  SELECT * FROM supplier WHERE s_suppkey IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY s_suppkey ORDER BY {_desc('s_acctbal', 's_nationkey', 's_name')}) = 1
), scored AS (
  SELECT s_suppkey AS supplier_id,
         CASE WHEN s_acctbal / 2000.0 BETWEEN 0 AND 5 THEN CAST(s_acctbal / 2000.0 AS DOUBLE) END AS score,
         s_name AS supplier_name
  FROM best
)
SELECT supplier_id, score, supplier_name,
       CASE WHEN score >= 4.5 THEN 'EXCELLENT' WHEN score >= 4.0 THEN 'GOOD'
            WHEN score >= 3.5 THEN 'AVERAGE' WHEN score >= 3.0 THEN 'BELOW_AVERAGE'
            WHEN score IS NOT NULL THEN 'POOR' ELSE NULL END AS score_tier,
       DATE '2020-01-01' AS valid_from,
       CAST(NULL AS DATE) AS valid_to,
       true AS is_current
FROM scored
"""

ORACLE_SQL["md4_weather_classify"] = f"""
WITH r AS (
  SELECT l_returnflag AS city, CAST(l_shipdate AS DATE) AS weather_date,
         l_quantity AS temperature_max, l_tax * 100.0 AS temperature_min,
         l_discount * 200.0 AS precipitation_sum, l_orderkey AS fetch_seq, l_linenumber AS reading_no
  FROM lineitem
), latest AS (
  SELECT * FROM r WHERE city IS NOT NULL AND weather_date IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY city, weather_date
    ORDER BY {_desc('fetch_seq', 'temperature_max', 'temperature_min', 'precipitation_sum', 'reading_no')}) = 1
), c AS (
  SELECT *, CASE WHEN precipitation_sum > 15 THEN 'heavy_rain'
                 WHEN precipitation_sum > 2.5 THEN 'light_rain'
                 WHEN temperature_max > 40 THEN 'extreme_heat'
                 WHEN temperature_max > 35 THEN 'hot'
                 ELSE 'normal' END AS weather_category
  FROM latest
)
SELECT {_std_city('city')} AS city, weather_date, temperature_max, temperature_min, precipitation_sum,
       coalesce(precipitation_sum > 2.5, false) AS is_rainy,
       weather_category,
       temperature_max - temperature_min AS temperature_range,
       coalesce(month(weather_date) IN (6, 7, 8, 9, 10), false) AS monsoon_month,
       coalesce(weather_category IN ('heavy_rain', 'extreme_heat'), false) AS is_extreme_weather,
       CASE WHEN month(weather_date) IN (12, 1, 2) THEN 'WINTER'
            WHEN month(weather_date) IN (3, 4, 5) THEN 'SPRING'
            WHEN month(weather_date) IN (6, 7, 8, 9) THEN 'MONSOON'
            WHEN month(weather_date) IN (10, 11) THEN 'POST_MONSOON' END AS season,
       fetch_seq
FROM c
"""

ORACLE_SQL["md5_label_knockout"] = f"""
WITH o AS (
  SELECT CAST(o_orderdate AS DATE) AS match_date, o_custkey, o_orderstatus, o_orderpriority, o_orderkey
  FROM orders
), latest AS (
  SELECT * FROM o WHERE match_date IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY match_date, o_custkey, o_orderstatus, o_orderpriority
    ORDER BY o_orderkey DESC NULLS LAST) = 1
)
SELECT l.match_date, l.o_orderkey,
       {_std_city('c.c_mktsegment')} AS venue,
       c.c_name || ' vs ' || c.c_mktsegment AS match_label,
       lower(trim(l.o_orderpriority)) AS match_type,
       coalesce(lower(trim(l.o_orderpriority)) IN ('1-urgent', '2-high', '3-medium'), false) AS is_knockout
FROM latest l LEFT JOIN customer c ON l.o_custkey = c.c_custkey
"""

ORACLE_SQL["md6_calendar_parts"] = """
WITH o AS (
  SELECT CAST(o_orderdate AS DATE) AS festival_date, o_orderpriority AS festival_name,
         o_orderstatus AS festival_type, o_orderkey AS ingest_seq
  FROM orders
), latest AS (
  SELECT * FROM o WHERE festival_date IS NOT NULL AND festival_name IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY festival_date, festival_name
    ORDER BY ingest_seq DESC NULLS LAST, festival_type DESC NULLS LAST) = 1
)
SELECT festival_date, festival_name,
       upper(trim(festival_type)) AS festival_type,
       upper(trim(festival_type)) = 'F' AS is_major,
       CAST(year(festival_date) AS INTEGER) AS festival_year,
       CAST(month(festival_date) AS INTEGER) AS festival_month,
       ingest_seq
FROM latest
"""

ORACLE_SQL["jn_coverage_gap"] = """
SELECT CAST(o.o_orderdate AS DATE) AS order_date, COUNT(*) AS orders_without_lines
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_orderkey IS NULL
GROUP BY 1
HAVING COUNT(*) > 0
ORDER BY 2 DESC
"""

ORACLE_SQL["jn_coverage_gap_two_key"] = """
WITH ev AS (SELECT user_id, CAST(ts AS DATE) AS event_date, event_type FROM events)
SELECT p.user_id, p.event_date, COUNT(*) AS purchases_without_view
FROM ev p
LEFT JOIN (SELECT * FROM ev WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.event_date = v.event_date
WHERE p.event_type = 'purchase' AND v.user_id IS NULL
GROUP BY 1, 2
HAVING COUNT(*) > 0
ORDER BY 3 DESC
"""

ORACLE_SQL["jn_exists_flag"] = """
SELECT o.o_orderkey, o.o_orderstatus,
       EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS has_lines
FROM orders o
"""

ORACLE_SQL["jn_exists_flag_filtered"] = """
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_date,
       EXISTS (SELECT 1 FROM lineitem l
               WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R') AS has_returned_line,
       EXISTS (SELECT 1 FROM lineitem l
               WHERE l.l_orderkey = o.o_orderkey
                 AND CAST(l.l_shipdate AS DATE) = CAST(o.o_orderdate AS DATE)) AS shipped_same_day
FROM orders o
"""

_BATCHES = """
WITH li AS (SELECT *, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem),
batch AS (SELECT * FROM li WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
existing AS (
  SELECT * FROM li
  WHERE l_shipdate < TIMESTAMP '1999-01-01' AND ship_date IN (SELECT ship_date FROM batch)
),
new_rows AS (
  SELECT * FROM batch b
  WHERE NOT EXISTS (SELECT 1 FROM existing e
                    WHERE e.l_orderkey = b.l_orderkey AND e.l_linenumber = b.l_linenumber)
)
"""

ORACLE_SQL["jn_append_new_only"] = _BATCHES + "SELECT * FROM new_rows"

ORACLE_SQL["agg_append_counts"] = _BATCHES + """
SELECT (SELECT COUNT(*) FROM batch) AS rows_in_batch,
       (SELECT COUNT(*) FROM new_rows) AS rows_processed,
       (SELECT COUNT(*) FROM batch) - (SELECT COUNT(*) FROM new_rows) AS rows_rejected
"""

ORACLE_SQL["jn_lookup_default"] = """
SELECT c.c_custkey,
       CAST(coalesce(CASE lower(c.c_mktsegment)
                       WHEN 'building' THEN 2.2 WHEN 'automobile' THEN 2.0 WHEN 'machinery' THEN 1.8
                       WHEN 'furniture' THEN 1.4 WHEN 'others' THEN 1.0 END, 1.0) AS DOUBLE)
         AS segment_multiplier,
       CASE c.c_nationkey WHEN 0 THEN 'Nation zero' WHEN 1 THEN 'Nation one'
            WHEN 2 THEN 'Nation two' WHEN 3 THEN 'Nation three' END AS nation_label,
       CASE WHEN n.n_name = 'NATION_1' THEN 'NATION_ONE' WHEN n.n_name = 'NATION_2' THEN 'NATION_TWO'
            ELSE n.n_name END AS nation_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

_DEMAND = """
WITH ents AS (
  SELECT c.c_custkey, n.n_name AS city, c.c_mktsegment AS segment
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
), days AS (
  SELECT CAST(d AS DATE) AS order_date
  FROM unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) t(d)
), rain AS (
  SELECT CAST(ts AS DATE) AS weather_date, avg(value) > 50.0 AS is_rainy
  FROM events GROUP BY 1
), wet AS (
  SELECT weather_date AS order_date, bool_or(coalesce(is_rainy, false)) AS r FROM rain GROUP BY 1
), demand AS (
  SELECT e.c_custkey, e.city, e.segment, d.order_date,
         round(CAST(3.5 AS DOUBLE)
           * CAST(coalesce(CASE e.city WHEN 'NATION_0' THEN 1.8 WHEN 'NATION_1' THEN 2.0
                      WHEN 'NATION_2' THEN 2.2 WHEN 'NATION_3' THEN 1.4 WHEN 'NATION_4' THEN 1.6
                      WHEN 'NATION_5' THEN 1.5 END, 1.0) AS DOUBLE)
           * CAST(coalesce(CASE lower(e.segment) WHEN 'building' THEN 2.2 WHEN 'automobile' THEN 2.0
                      WHEN 'machinery' THEN 1.8 WHEN 'furniture' THEN 1.4 WHEN 'others' THEN 1.0 END,
                      1.0) AS DOUBLE)
           * CAST(CASE WHEN isodow(d.order_date) - 1 >= 5 THEN 1.35 ELSE 1.0 END AS DOUBLE)
           * CAST(CASE WHEN coalesce(w.r, false) THEN 1.25 ELSE 1.0 END AS DOUBLE), 6) AS expected_orders
  FROM ents e CROSS JOIN days d LEFT JOIN wet w ON w.order_date = d.order_date
)
"""

ORACLE_SQL["jn_spine_expected_demand"] = _DEMAND + "SELECT * FROM demand"

ORACLE_SQL["fn_hour_profile"] = _DEMAND + """
, daily AS (SELECT city, order_date, sum(expected_orders) AS expected_orders FROM demand GROUP BY 1, 2),
hw AS (
  SELECT CAST(h AS INTEGER) AS order_hour,
         CAST(CASE WHEN h IN (12, 13) THEN 3.0 WHEN h IN (19, 20, 21) THEN 4.0 ELSE 1.0 END AS DOUBLE)
           / 37.0 AS share
  FROM range(24) t(h)
)
SELECT city, order_date, order_hour, round(expected_orders * share, 4) AS expected_orders_hour
FROM daily CROSS JOIN hw
"""

_LI_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
_LI_NONKEY = [c for c in _LI_COLS if c not in ("l_orderkey", "l_linenumber")]
_UPSERT = f"""
WITH t AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'),
s0 AS (
  SELECT * REPLACE (l_quantity + 1.0 AS l_quantity) FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1998-06-01'
),
s AS (
  SELECT * FROM s0
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_desc(*_LI_NONKEY)}) = 1
),
updated AS (
  SELECT {", ".join(f"CASE WHEN s.l_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _LI_COLS)},
         s.l_orderkey IS NOT NULL AS matched
  FROM t LEFT JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
),
inserted AS (
  SELECT * FROM s
  WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
)
"""

ORACLE_SQL["snk_upsert_result"] = _UPSERT + f"""
SELECT {", ".join(_LI_COLS)} FROM updated
UNION ALL
SELECT {", ".join(_LI_COLS)} FROM inserted
"""

ORACLE_SQL["snk_upsert_counts"] = _UPSERT + """
SELECT (SELECT COUNT(*) FROM s0) AS rows_loaded,
       (SELECT COUNT(*) FROM updated WHERE matched) AS rows_updated,
       (SELECT COUNT(*) FROM inserted) AS rows_inserted,
       (SELECT COUNT(*) FROM updated WHERE matched) + (SELECT COUNT(*) FROM inserted) AS rows_affected
"""

ORACLE_SQL["src_json_flatten"] = """
SELECT event_id, event_type,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL AS is_valid
FROM events
"""

ORACLE_SQL["src_array_zip"] = """
SELECT vec_id, label,
       CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
       unnest(embedding) AS value
FROM embeddings
"""

ORACLE_SQL["src_partition_prune_scan"] = """
SELECT *, CAST(ts AS DATE) AS event_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'
"""

_WS = "[ \\t\\n\\x0B\\f\\r]"


def _clean(e: str) -> str:
    return f"nullif(regexp_replace({e}, '^{_WS}+|{_WS}+$', '', 'g'), '')"


ORACLE_SQL["src_csv_contract_scan"] = f"""
SELECT c_custkey AS customer_key,
       {_clean('c_name')} AS customer_name,
       c_nationkey AS country_code,
       c_acctbal AS account_balance,
       {_clean('c_mktsegment')} AS market_segment,
       TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at,
       'customer.csv' AS _source_file
FROM customer WHERE c_nationkey = 1
"""

ORACLE_SQL["stream_dedup_events"] = "SELECT * FROM events"

ORACLE_SQL["agg_duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY 1, 2 HAVING COUNT(*) > 1
"""

ORACLE_SQL["agg_frequency_share"] = """
SELECT o_orderpriority, COUNT(*) AS n_rows,
       round(CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 9) AS share
FROM orders GROUP BY 1 ORDER BY 2 DESC, 1
"""

ORACLE_SQL["agg_order_profile"] = """
WITH f AS (SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1),
top AS (SELECT o_orderpriority FROM f ORDER BY n DESC, o_orderpriority DESC LIMIT 1)
SELECT min(CAST(o_orderdate AS DATE)) AS min_order_date,
       max(CAST(o_orderdate AS DATE)) AS max_order_date,
       COUNT(*) AS n_rows,
       COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS n_distinct_dates,
       CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS n_finished,
       CAST(count_if(o_totalprice > 300000) AS BIGINT) AS n_large,
       round(CAST(COUNT(DISTINCT o_orderstatus) AS DOUBLE) / CAST(COUNT(o_orderstatus) AS DOUBLE), 9)
         AS status_unique_proportion,
       (SELECT o_orderpriority FROM top) AS top_priority
FROM orders
"""

ORACLE_SQL["agg_ingest_summary"] = """
WITH parts AS (
  SELECT 'customers' AS source, COUNT(*) AS n_rows, CAST(COUNT(DISTINCT c_nationkey) AS BIGINT) AS n_cities
  FROM customer
  UNION ALL
  SELECT 'suppliers', COUNT(*), CAST(COUNT(DISTINCT s_nationkey) AS BIGINT) FROM supplier
  UNION ALL
  SELECT 'events', COUNT(*), CAST(COUNT(DISTINCT event_type) AS BIGINT) FROM events
  UNION ALL
  SELECT 'orders', COUNT(*), CAST(0 AS BIGINT) FROM orders
)
SELECT source, n_rows, n_cities,
       CAST(CASE WHEN n_cities > 0 THEN floor(n_rows / n_cities) ELSE 0 END AS BIGINT) AS n_days
FROM parts
"""

ORACLE_SQL["agg_conditional_counts"] = """
SELECT l_returnflag,
       CAST(count_if(l_discount > 0.05) AS BIGINT) AS n_discounted,
       CAST(count_if(l_quantity >= 40) AS BIGINT) AS n_bulk,
       CAST(count_if(l_linestatus = 'O') AS BIGINT) AS n_open
FROM lineitem GROUP BY 1
"""


def _dq(table: str, check: str, count_sql: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, "
            f"CAST(({count_sql}) AS BIGINT) AS failing_rows")


def _nn(t, c):
    return _dq(t, f"not_null_{c}", f"SELECT COUNT(*) FROM {t} WHERE {c} IS NULL")


def _uniq(t, cols):
    k = ", ".join(cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return _dq(t, f"unique_{'_'.join(cols)}",
               f"SELECT COUNT(*) FROM (SELECT {k} FROM {t} WHERE {nn} GROUP BY {k} HAVING COUNT(*) > 1)")


def _acc(t, c, values):
    vals = ", ".join(f"'{v}'" for v in values)
    return _dq(t, f"accepted_values_{c}", f"SELECT COUNT(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN ({vals})")


def _btw(t, c, lo, hi, cond="true"):
    return _dq(t, f"between_{c}",
               f"SELECT COUNT(*) FROM {t} WHERE coalesce({c} IS NOT NULL AND ({cond}) "
               f"AND NOT ({c} >= {lo} AND {c} <= {hi}), false)")


def _rel(t, c, parent, pc):
    return _dq(t, f"relationships_{c}",
               f"SELECT COUNT(*) FROM {t} x WHERE x.{c} IS NOT NULL "
               f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pc} = x.{c})")


def _expr(t, name, pred):
    return _dq(t, name, f"SELECT COUNT(*) FROM {t} WHERE coalesce({pred}, false)")


_DQ_PARTS = [
    _nn("orders", "o_orderkey"), _uniq("orders", ["o_orderkey"]),
    _acc("orders", "o_orderstatus", ("F", "O", "P")),
    _acc("orders", "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")),
    _btw("orders", "o_totalprice", 0, 400000, "o_totalprice IS NOT NULL"),
    _rel("orders", "o_custkey", "customer", "c_custkey"),
    _expr("orders", "finished_orders_positive_price", "o_orderstatus = 'F' AND NOT (o_totalprice > 0)"),
    _dq("orders", "row_count_between", "SELECT CASE WHEN COUNT(*) < 0 THEN 1 ELSE 0 END FROM orders"),
    _dq("orders", "proportion_unique_o_orderpriority",
        "SELECT CASE WHEN coalesce(CAST(COUNT(DISTINCT o_orderpriority) AS DOUBLE) / "
        "nullif(CAST(COUNT(o_orderpriority) AS DOUBLE), 0) NOT BETWEEN 0.0 AND 0.5, false) "
        "THEN 1 ELSE 0 END FROM orders"),
    _nn("lineitem", "l_orderkey"), _uniq("lineitem", ["l_orderkey", "l_linenumber"]),
    _btw("lineitem", "l_discount", 0, 0.1),
    _acc("lineitem", "l_returnflag", ("A", "N", "R")),
    _expr("lineitem", "returned_lines_positive_quantity",
          "l_returnflag = 'R' AND (l_quantity IS NULL OR l_quantity <= 0)"),
    _rel("lineitem", "l_orderkey", "orders", "o_orderkey"),
    _nn("customer", "c_custkey"), _uniq("customer", ["c_custkey"]),
    _acc("customer", "c_mktsegment", ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")),
    _btw("customer", "c_acctbal", -999.99, 9999.99),
    _rel("customer", "c_nationkey", "nation", "n_nationkey"),
]

ORACLE_SQL["dq_report"] = (
    "SELECT table_name, check_name, failing_rows, "
    "CASE WHEN failing_rows > 0 THEN 'error' ELSE 'pass' END AS status FROM (\n"
    + "\nUNION ALL\n".join(_DQ_PARTS) + "\n)")

ORACLE_SQL["dq_freshness"] = """
WITH m AS (SELECT event_type AS source, max(ts) AS max_loaded_at FROM events GROUP BY 1),
a AS (
  SELECT *, (epoch_us(TIMESTAMP '2024-01-31 23:30:00') - epoch_us(max_loaded_at)) / 3.6e9 AS age
  FROM m
)
SELECT source, max_loaded_at, round(age, 6) AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age > 48.0 THEN 'error'
            WHEN age > 24.0 THEN 'warn' ELSE 'pass' END AS status
FROM a
"""

ORACLE_SQL["inc_next_range"] = """
WITH ev AS (SELECT event_type AS source_name, CAST(ts AS DATE) AS event_date FROM events),
state AS (
  SELECT source_name, max(event_date) AS watermark_date FROM ev
  WHERE event_date <= DATE '2024-01-20' AND source_name IN ('click', 'view') GROUP BY 1
),
sources AS (SELECT DISTINCT source_name FROM ev),
runs AS (SELECT * FROM (VALUES (DATE '2024-01-15'), (DATE '2024-01-30')) r(run_date)),
ranges AS (
  SELECT s.source_name, r.run_date, st.watermark_date AS last_date,
         coalesce(st.watermark_date + 1, r.run_date - 6) AS start_date, r.run_date AS end_date
  FROM sources s CROSS JOIN runs r LEFT JOIN state st ON st.source_name = s.source_name
)
SELECT source_name, run_date, last_date, start_date, end_date,
       start_date > end_date AS is_empty,
       CAST(greatest(date_diff('day', start_date, end_date) + 1, 0) AS INTEGER) AS n_days,
       (SELECT COUNT(*) FROM ev WHERE ev.source_name = ranges.source_name
          AND ev.event_date BETWEEN ranges.start_date AND ranges.end_date) AS n_rows
FROM ranges
"""

_SK_NULL = "'_dbt_utils_surrogate_key_null_'"
ORACLE_SQL["fn_surrogate_key"] = f"""
SELECT l_orderkey, l_linenumber,
       md5(concat_ws('-', coalesce(CAST(l_orderkey AS VARCHAR), {_SK_NULL}),
                          coalesce(CAST(l_linenumber AS VARCHAR), {_SK_NULL}),
                          coalesce(CAST(l_returnflag AS VARCHAR), {_SK_NULL}),
                          coalesce(CAST(l_shipdate AS VARCHAR), {_SK_NULL}))) AS line_sk
FROM lineitem
"""

ORACLE_SQL["fn_round_clamp"] = """
WITH b AS (
  SELECT l_orderkey, l_linenumber,
         l_extendedprice / 100.0 - 50.0 AS base, 1.0 + l_discount * 10.0 AS factor
  FROM lineitem
)
SELECT l_orderkey, l_linenumber,
       greatest(least(round_even((CASE WHEN coalesce(base, 0.0) <= 0 THEN 300.0 ELSE base END) * factor
                                 / 10.0, 0) * 10.0, 3500.0), 80.0) AS order_amount
FROM b
"""

ORACLE_SQL["fn_safe_divide"] = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity = 0 OR l_quantity IS NULL THEN NULL ELSE l_extendedprice / l_quantity END
         AS unit_price,
       CASE WHEN l_discount = 0 OR l_discount IS NULL THEN NULL ELSE l_tax / l_discount END
         AS tax_per_discount
FROM lineitem
"""

ORACLE_SQL["set_union_all"] = """
SELECT o_orderkey, o_orderdate, o_totalprice,
       CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'early' ELSE 'late' END AS slice
FROM orders
"""

ORACLE_SQL["prj_clean_text"] = f"""
WITH c AS (
  SELECT page_id, {_clean('url')} AS page_url, {_clean('html')} AS raw_html FROM pages
)
SELECT page_id,
       CAST(length(page_url) AS INTEGER) AS url_length,
       CAST(length(raw_html) AS INTEGER) AS html_length,
       raw_html IS NULL AS html_is_blank,
       upper(trim(regexp_extract(page_url, '^(\\w+)://', 1))) AS scheme
FROM c
"""

ORACLE_SQL["jn_left_enrich_two_keys"] = f"""
WITH md4 AS ({ORACLE_SQL["md4_weather_classify"]})
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag AS city, CAST(l.l_shipdate AS DATE) AS ship_date,
       m.weather_category, m.season
FROM lineitem l
LEFT JOIN md4 m ON l.l_returnflag = m.city AND CAST(l.l_shipdate AS DATE) = m.weather_date
"""
