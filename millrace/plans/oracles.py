"""The queries in ANSI SQL, written against the shared tables alone."""

from __future__ import annotations

from textwrap import dedent

# Line items as sales rows, money in cents; a row is good when it ships no earlier than
# it was ordered, and good rows are numbered per topic partition.
_BASE = """
WITH raw AS (
  SELECT l_orderkey AS order_id, r_name AS region, n_name AS country, p_type AS item_type,
         CASE WHEN l_linestatus = 'O' THEN 'Online' ELSE 'Offline' END AS sales_channel,
         CASE substr(o_orderpriority, 1, 1)
           WHEN '1' THEN 'C' WHEN '2' THEN 'H' WHEN '3' THEN 'M' ELSE 'L' END AS priority,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
         CAST(l_quantity AS INTEGER) AS units_sold,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS rev,
         CAST(round(l_extendedprice * 100) AS BIGINT)
           * CAST(105 - round(l_discount * 100) - round(l_tax * 100) * 5 AS BIGINT) // 100 AS cost,
         l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
),
sales AS (
  SELECT *, rev - cost AS profit,
         (2 * rev + units_sold) // (2 * units_sold) AS price_c,
         (2 * cost + units_sold) // (2 * units_sold) AS cost_c
  FROM raw WHERE ship_date >= order_date
),
topic AS (
  SELECT *, CAST(order_id % 3 AS INTEGER) AS part_no,
         row_number() OVER (
           PARTITION BY order_id % 3
           ORDER BY order_id, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice
         ) - 1 AS pos
  FROM sales
),
silver AS (
  SELECT *, 'sales-events-' || part_no || '-' || pos AS source_kafka_offset,
         CAST(year(order_date) AS INTEGER) AS order_year,
         CAST(month(order_date) AS INTEGER) AS order_month,
         CASE WHEN rev = 0 THEN 0
              ELSE sign(profit) * ((2 * CAST(abs(profit) AS HUGEINT) * 10000 + rev) // (2 * rev))
         END AS margin
  FROM topic
)
"""


def _money(cents: str, name: str) -> str:
    return f"CAST(CAST({cents} / 100.0 AS DECIMAL(18,4)) AS VARCHAR) AS {name}"


_MARGIN = "CAST(CAST(margin / 100.0 AS DECIMAL(6,2)) AS VARCHAR) AS margin_pct"

_SALES = """
  order_id, region, country, item_type, sales_channel, priority,
  CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date,
  units_sold, price_c / 100.0 AS unit_price, cost_c / 100.0 AS unit_cost,
  rev / 100.0 AS total_revenue, cost / 100.0 AS total_cost, profit / 100.0 AS total_profit
"""

_BRONZE = f"""
  {_SALES}, 'sales-events' AS kafka_topic, part_no AS kafka_partition, pos AS kafka_offset,
  CAST(1609459200000 AS BIGINT) AS kafka_timestamp_ms,
  CAST(1609459200000 AS BIGINT) AS ingested_at, 'lineitem' AS source_file
"""

_SILVER_BODY = f"""
  order_id, region, country, item_type, sales_channel, priority,
  CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date,
  order_year, order_month, CAST(ship_date - order_date AS INTEGER) AS lead_time_days,
  units_sold,
  {_money("price_c", "unit_price")}, {_money("cost_c", "unit_cost")},
  {_money("rev", "total_revenue")}, {_money("cost", "total_cost")},
  {_money("profit", "total_profit")}, {_MARGIN},
  CAST(1609459200000 AS BIGINT) AS bronze_ingested_at
"""

_SILVER = f"""
  {_SILVER_BODY}, CAST(1609545600000 AS BIGINT) AS silver_transformed_at, source_kafka_offset
"""


def _revenue(year: int, month: int) -> str:
    return f"""{_BASE}
    SELECT country,
           CAST(SUM(CAST(rev / 100.0 AS DECIMAL(18,4))) AS VARCHAR) AS total_revenue,
           CAST(SUM(CAST(profit / 100.0 AS DECIMAL(18,4))) AS VARCHAR) AS total_profit,
           CAST(CAST(sign(SUM(margin)) * ((2 * abs(SUM(margin)) + COUNT(*)) // (2 * COUNT(*)))
                / 100.0 AS DECIMAL(18,2)) AS VARCHAR) AS avg_margin_pct,
           CAST(SUM(units_sold) AS BIGINT) AS total_units
    FROM silver WHERE order_year = {year} AND order_month = {month}
    GROUP BY country ORDER BY SUM(rev) DESC, country
    """


_US = "strftime({0}, '%-m/%-d/%Y')"

# Rejects of the damaged rows, in the order the rules apply.
_QUARANTINED = f"""{_BASE},
damaged AS (
  SELECT order_id, l_linenumber AS line, order_date, ship_date, units_sold,
         order_id % 7 = 0 AS bad_order, order_id % 11 = 0 AS bad_ship,
         order_id % 5 = 0 AS bad_units, order_id % 13 = 0 AS bad_price
  FROM raw
),
judged AS (
  SELECT *,
         CASE WHEN bad_order THEN 'INVALID_DATE' WHEN bad_ship THEN 'INVALID_DATE'
              WHEN ship_date < order_date THEN 'SCHEMA_RULE'
              WHEN bad_units OR bad_price THEN 'BAD_TYPE' END AS reject_class,
         CASE WHEN bad_order THEN 'order_date' WHEN bad_ship THEN 'ship_date'
              WHEN ship_date < order_date THEN 'ship_date'
              WHEN bad_units THEN 'units_sold' ELSE 'unit_price' END AS reject_field
  FROM damaged
)
SELECT order_id AS order_key, line, reject_class, reject_field,
       CASE WHEN bad_order THEN 'not-a-date' WHEN bad_ship THEN ''
            WHEN reject_class = 'SCHEMA_RULE' THEN CAST(ship_date AS VARCHAR)
            WHEN bad_units THEN units_sold || 'x' ELSE '1e999' END AS reject_value,
       CASE WHEN bad_order
              THEN 'expected format MM/DD/YYYY or YYYY-MM-DD, got ''not-a-date'''
            WHEN bad_ship THEN 'expected format MM/DD/YYYY or YYYY-MM-DD, got '''''
            WHEN reject_class = 'SCHEMA_RULE'
              THEN 'ship_date ' || ship_date || ' is before order_date ' || order_date
            WHEN bad_units THEN 'not a valid int' ELSE 'not a valid double' END AS reject_reason
FROM judged WHERE reject_class IS NOT NULL
"""

_POISON = """
poison AS (
  SELECT part_no, pos,
         CASE WHEN pos % 11 = 0 THEN 'MALFORMED_JSON'
              WHEN pos % 13 = 0 THEN 'MISSING_FIELD'
              WHEN pos % 17 = 0 THEN 'INVALID_DATE'
              WHEN pos % 19 = 0 THEN 'BAD_TYPE'
              WHEN pos % 23 = 0 THEN 'BAD_TYPE'
              WHEN pos % 29 = 0 THEN 'BAD_TYPE'
              WHEN pos % 31 = 0 THEN 'SCHEMA_RULE' END AS reject_class
  FROM topic
)
"""

_PRIOR = """
WITH facts AS (
  SELECT page_id, url, md5(html) AS etag, CAST(octet_length(encode(html)) AS BIGINT) AS len,
         page_id % 8 AS k
  FROM pages
),
prior AS (
  SELECT url, CASE k WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'old' ELSE etag END AS etag,
         CASE k WHEN 3 THEN len + 1 WHEN 5 THEN NULL ELSE len END AS len,
         CASE WHEN k = 1 THEN 'extracted' ELSE 'produced' END AS status,
         row_number() OVER (PARTITION BY url ORDER BY k = 1) AS rk
  FROM facts WHERE k <> 0
)
"""


def _is_new(current_etag: str) -> str:
    return f"""
    CASE WHEN p.url IS NULL THEN true
         WHEN p.status <> 'produced' THEN true
         WHEN COALESCE({current_etag}, '') <> '' AND COALESCE(p.etag, '') <> ''
           THEN {current_etag} <> p.etag
         WHEN f.len IS NOT NULL AND p.len IS NOT NULL THEN f.len <> p.len
         ELSE true END
    """


_KEYS = f"SELECT source_kafka_offset, order_id, {_MARGIN} FROM silver"

_ORACLES = {
    "landing_valid": f"{_BASE} SELECT {_SALES} FROM sales",
    "landing_csv": f"{_BASE} SELECT {_SALES} FROM sales",
    "landing_missing_column": f"""{_BASE}
      SELECT CASE WHEN order_id % 2 = 1 THEN 'MISSING_COLUMN'
                  WHEN ship_date < order_date THEN 'SCHEMA_RULE' ELSE 'VALID' END AS outcome,
             CASE WHEN order_id % 2 = 1 THEN 'Country'
                  WHEN ship_date < order_date THEN 'ship_date' END AS reject_field,
             COUNT(*) AS row_count
      FROM raw GROUP BY 1, 2""",
    "row_cap": f"""{_BASE}
      SELECT order_id, l_linenumber AS line, ship_date >= order_date AS is_valid FROM raw
      ORDER BY order_id, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice
      LIMIT 10""",
    "rejects_by_class": f"""{_BASE}
      SELECT 'SCHEMA_RULE' AS reject_class, COUNT(*) AS row_count
      FROM raw WHERE ship_date < order_date""",
    "landing_run_counters": f"""{_BASE}
      SELECT COUNT(*) FILTER (WHERE ship_date >= order_date) AS sent,
             COUNT(*) FILTER (WHERE ship_date < order_date) AS skipped FROM raw""",
    "quarantined_rows": _QUARANTINED,
    "date_parse_formats": f"""
      WITH d AS (SELECT CAST(l_orderkey % 9 AS INTEGER) AS form, CAST(l_shipdate AS DATE) AS day
                 FROM lineitem),
      t AS (SELECT form, day, CASE form
              WHEN 0 THEN {_US.format("day")}
              WHEN 1 THEN strftime(day, '%m/%d/%Y')
              WHEN 2 THEN strftime(day, '%Y-%m-%d')
              WHEN 3 THEN strftime(day, '%Y-%-m-%-d')
              WHEN 4 THEN strftime(day, '%-m/%-d/%y')
              WHEN 5 THEN strftime(day, '%Y-%m-%d') || 'T00:00'
              WHEN 6 THEN '2/30/' || strftime(day, '%Y')
              WHEN 7 THEN '13/1/' || strftime(day, '%Y')
              ELSE ' ' || {_US.format("day")} END AS date_text FROM d)
      SELECT form, date_text, COUNT(*) AS row_count,
             CASE WHEN form < 4 THEN CAST(any_value(day) AS VARCHAR) END AS parsed
      FROM t GROUP BY form, date_text""",
    "number_coercion": """
      WITH d AS (SELECT CAST(l_orderkey % 10 AS INTEGER) AS form,
                        CAST(l_quantity AS INTEGER) AS n FROM lineitem),
      t AS (SELECT form, n, CASE form WHEN 0 THEN n || '' WHEN 1 THEN n || '.0'
              WHEN 2 THEN ' ' || n || ' ' WHEN 3 THEN '+' || n WHEN 4 THEN '1_0' || n
              WHEN 5 THEN n || 'e2' WHEN 6 THEN n || 'd' WHEN 7 THEN n || '.5'
              WHEN 8 THEN n || '__0' ELSE 'nan' END AS number_text FROM d)
      SELECT form, number_text, COUNT(*) AS row_count,
             CAST(CASE WHEN form < 4 THEN any_value(n)
                       WHEN form = 4 THEN CAST('10' || any_value(n) AS INTEGER) END AS INTEGER)
               AS as_integer,
             CAST(CASE WHEN form < 4 THEN any_value(n)
                       WHEN form = 4 THEN CAST('10' || any_value(n) AS INTEGER)
                       WHEN form = 5 THEN any_value(n) * 100
                       WHEN form = 7 THEN any_value(n) + 0.5 END AS DOUBLE) AS as_double
      FROM t GROUP BY form, number_text""",
    "topic_positions": f"""{_BASE}
      SELECT 'sales-events' AS topic, part_no AS partition, pos AS "offset",
             CAST(order_id AS VARCHAR) AS key, l_linenumber AS line, l_partkey AS part
      FROM topic""",
    "key_routing": f"""{_BASE}
      SELECT CAST(order_id AS VARCHAR) AS key, COUNT(*) AS messages,
             CAST(order_id % 3 AS INTEGER) AS first_partition,
             CAST(order_id % 3 AS INTEGER) AS last_partition
      FROM sales GROUP BY order_id""",
    "topic_roundtrip": f"""{_BASE}
      SELECT part_no AS partition, pos AS "offset", {_SALES} FROM topic""",
    "poison_messages": f"""{_BASE}, {_POISON}
      SELECT part_no AS kafka_partition, pos AS kafka_offset, reject_class,
             'kafka_message' AS reject_field FROM poison WHERE reject_class IS NOT NULL""",
    "bronze_enriched": f"{_BASE} SELECT {_BRONZE} FROM topic",
    "bronze_nested_roundtrip": f"{_BASE} SELECT {_BRONZE} FROM topic",
    "bronze_ndjson": f"{_BASE} SELECT {_BRONZE} FROM topic",
    "bronze_preview": f"""{_BASE}
      SELECT {_BRONZE} FROM topic ORDER BY part_no, pos LIMIT 100""",
    "silver_transform": f"{_BASE} SELECT {_SILVER} FROM silver",
    "margin_overflow": f"""{_BASE}
      SELECT source_kafka_offset, 'MARGIN_OVERFLOW' AS reject_class FROM silver
      WHERE (2 * CAST(abs(profit) AS HUGEINT) * 10000000 + rev) // (2 * rev) > 999999""",
    "silver_table": f"{_BASE} SELECT {_SILVER} FROM silver",
    "silver_month": f"""{_BASE}
      SELECT {_SILVER} FROM silver WHERE order_year = 1998 AND order_month = 5""",
    "silver_partitions": f"""{_BASE}
      SELECT order_year, order_month, COUNT(*) AS row_count FROM silver
      GROUP BY order_year, order_month""",
    "merge_replay": f"{_BASE} {_KEYS}",
    "merge_three_runs": f"{_BASE} {_KEYS}",
    "compacted_silver": f"""{_BASE}
      SELECT order_year, order_month, CAST(1 AS BIGINT) AS files, COUNT(*) AS row_count, COUNT(*) AS keys,
             CAST(SUM(CAST(rev / 100.0 AS DECIMAL(18,4))) AS VARCHAR) AS revenue
      FROM silver GROUP BY order_year, order_month""",
    "merge_scattered": f"{_BASE} {_KEYS}",
    "missing_ranges": f"""{_BASE},
      lost AS (SELECT part_no, pos FROM topic
               WHERE pos % 17 = 4 OR pos % 300 BETWEEN 10 AND 25 OR pos % 2000 < 1000),
      island AS (SELECT *, pos - row_number() OVER (PARTITION BY part_no ORDER BY pos) AS k FROM lost)
      SELECT 'sales-events' AS topic, part_no AS partition, MIN(pos) AS first_missing, MAX(pos) AS last_missing
      FROM island GROUP BY part_no, k""",
    "range_completeness": f"""{_BASE},
      held AS (SELECT part_no, pos FROM topic
               WHERE pos % 17 <> 4 AND NOT pos % 300 BETWEEN 10 AND 25 AND pos % 2000 >= 1000),
      layers AS (
        SELECT 'topic' AS layer, part_no, pos FROM topic
        UNION ALL SELECT 'bronze', part_no, pos FROM held
        UNION ALL SELECT 'bronze', part_no, pos FROM held WHERE pos % 3 = 0
        UNION ALL SELECT 'silver', part_no, pos FROM topic)
      SELECT layer, 'sales-events' AS topic, part_no AS partition, COUNT(*) AS row_count,
             COUNT(DISTINCT pos) AS offsets, COUNT(*) - COUNT(DISTINCT pos) AS copies, MIN(pos) AS first,
             MAX(pos) AS last, MAX(pos) - MIN(pos) + 1 = COUNT(DISTINCT pos) AS complete
      FROM layers GROUP BY layer, part_no""",
    "replay_ranges": f"""{_BASE},
      asked(run, part_no, low, high, from_bronze) AS (
        VALUES (1, 0, 0, 99, false), (2, 0, 50, 149, false), (2, 1, 0, 9, false), (3, 0, 0, 149, true),
               (3, 2, 5, 20, true), (4, 0, 0, 99, false), (5, 0, 0, 149, false), (5, 1, 0, 9, false)),
      sent AS (SELECT run, part_no, pos, from_bronze FROM asked JOIN topic USING (part_no) WHERE pos BETWEEN low AND high),
      copies AS (
        SELECT run, part_no, pos,
               CASE WHEN NOT from_bronze THEN 1
                    ELSE (SELECT COUNT(*) FROM sent e WHERE e.run < s.run AND e.part_no = s.part_no AND e.pos = s.pos)
                         + CASE WHEN pos % 3 <> 0 THEN 1 ELSE 0 END END AS n,
               pos % 3 = 0 AND NOT from_bronze
               AND NOT EXISTS (SELECT 1 FROM sent e WHERE e.run < s.run AND e.part_no = s.part_no AND e.pos = s.pos) AS new
        FROM sent s)
      SELECT CAST(run AS INTEGER) AS run, CAST(SUM(n) AS BIGINT) AS received, COUNT(*) FILTER (WHERE new) AS written
      FROM copies GROUP BY run""",
    "redrive_rejects": f"""{_BASE}, {_POISON},
      n AS (SELECT COUNT(*) AS total, COUNT(reject_class) AS bad,
                   COUNT(reject_class) FILTER (WHERE pos % 2 = 0) AS even FROM poison)
      SELECT CAST(1 AS INTEGER) AS run, bad AS opened, even AS stored, total - bad + even AS bronze,
             total - bad + even AS silver, bad - even AS quarantine FROM n
      UNION ALL SELECT 2, bad - even, 0, total - bad + even, total - bad + even, bad - even FROM n
      UNION ALL SELECT 3, bad - even, bad - even, total, total, 0 FROM n""",
    "merge_incremental": f"{_BASE} SELECT {_SILVER} FROM silver WHERE pos % 4 = 3",
    "strict_merge": f"""{_BASE}
      SELECT COUNT(*) AS stored, COUNT(*) AS clashes, MIN(source_kafka_offset) AS sample
      FROM silver WHERE pos % 5 = 0""",
    "offset_read_order": f"""{_BASE}
      SELECT part_no AS kafka_partition, pos AS kafka_offset,
             row_number() OVER (ORDER BY part_no, pos) - 1 AS read_rank FROM topic""",
    "created_tables": f"""{_BASE}
      SELECT 'bronze' AS layer, country, COUNT(*) AS row_count FROM topic GROUP BY country
      UNION ALL SELECT 'silver', country, COUNT(*) FROM silver GROUP BY country""",
    "margin_zero_revenue": f"""{_BASE},
      priced AS (SELECT source_kafka_offset, CASE WHEN pos % 3 = 0 THEN 0 ELSE margin END AS margin
               FROM silver)
      SELECT source_kafka_offset, {_MARGIN} FROM priced""",
    "silver_rejects": f"""{_BASE},
      judged AS (
        SELECT CASE WHEN (2 * CAST(abs(profit) AS HUGEINT) * 10000000 + rev) // (2 * rev) > 999999
                    THEN 'MARGIN_OVERFLOW' ELSE 'SILVER' END AS outcome FROM silver)
      SELECT outcome, COUNT(*) AS row_count, (SELECT COUNT(*) FROM silver) AS received
      FROM judged GROUP BY outcome""",
    "silver_file_order": f"""{_BASE}
      SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS out_of_order FROM silver""",
    "archive_rejects": f"""{_BASE}
      SELECT 'VALID' AS outcome, COUNT(*) + 1 AS row_count, CAST(200000 AS INTEGER) AS longest_country
      FROM sales
      UNION ALL SELECT 'SCHEMA_RULE', COUNT(*), CAST(MAX(length(country)) AS INTEGER)
      FROM raw WHERE ship_date < order_date
      UNION ALL SELECT 'UNREADABLE_ARCHIVE', 3, NULL
      UNION ALL SELECT 'SKIPPED_MEMBER', 1, NULL""",
    "ingest_cycle_twice": f"""{_BASE}
      SELECT 'topic' AS layer, COUNT(*) AS row_count FROM sales
      UNION ALL SELECT 'bronze', COUNT(*) FROM sales
      UNION ALL SELECT 'silver', COUNT(*) FROM sales""",
    "stream_old_file": f"""{_BASE}
      SELECT 'bronze' AS layer, COUNT(*) AS row_count FROM sales""",
    "stream_repeated_batch": f"""{_BASE}
      SELECT 'bronze' AS layer, COUNT(*) AS row_count FROM sales
      UNION ALL SELECT 'silver', COUNT(*) FROM sales""",
    "strict_stream": "SELECT CAST(0 AS BIGINT) AS stored, true AS stopped",
    "merge_counters": f"""{_BASE},
      n AS (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE pos % 2 = 0) AS even FROM topic)
      SELECT CAST(1 AS INTEGER) AS run, even AS received, even AS written,
             CAST(0 AS BIGINT) AS skipped FROM n
      UNION ALL SELECT 2, total, total - even, even FROM n
      UNION ALL SELECT 3, total, 0, total FROM n""",
    "merge_first_copy": f"""{_BASE}
      SELECT source_kafka_offset, {_MARGIN},
             CAST(1609459200000 AS BIGINT) AS bronze_ingested_at FROM silver""",
    "strict_duplicates": f"""{_BASE}
      SELECT source_kafka_offset, CAST(CASE WHEN pos % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS copies,
             pos % 5 = 0 AS stored
      FROM silver WHERE pos % 3 = 0 OR pos % 5 = 0""",
    "dedup_check": f"""{_BASE}, rows_twice AS (
        SELECT source_kafka_offset FROM silver
        UNION ALL SELECT source_kafka_offset FROM silver WHERE pos % 3 = 0)
      SELECT source_kafka_offset, COUNT(*) AS cnt FROM rows_twice
      GROUP BY source_kafka_offset HAVING COUNT(*) > 1""",
    "distinct_keys": f"{_BASE} SELECT source_kafka_offset FROM silver",
    "missing_in_silver": f"""{_BASE}
      SELECT source_kafka_offset FROM silver WHERE order_month = 2""",
    "completeness": f"""{_BASE}
      SELECT COUNT(*) AS sent, COUNT(*) AS bronze, COUNT(DISTINCT source_kafka_offset) AS silver,
             CAST(0 AS BIGINT) AS lost, true AS complete FROM silver""",
    "layer_counts": f"""{_BASE}
      SELECT 'landing' AS layer, COUNT(*) AS row_count FROM raw
      UNION ALL SELECT 'topic', COUNT(*) FROM sales
      UNION ALL SELECT 'bronze', COUNT(*) FROM sales
      UNION ALL SELECT 'silver', COUNT(*) FROM sales""",
    "revenue_by_country": _revenue(1998, 5),
    "revenue_by_country_prev_month": _revenue(1998, 12),
    "revenue_by_country_reference_mode": _revenue(1998, 5).replace(
        "SELECT country,\n", "SELECT country, '1998-06-15' AS as_of,\n", 1
    ),
    "revenue_from_sums": _revenue(1998, 5),
    "revenue_by_month": f"""{_BASE}
      SELECT order_year, order_month, country,
             CAST(SUM(CAST(rev / 100.0 AS DECIMAL(18,4))) AS VARCHAR) AS total_revenue,
             CAST(SUM(CAST(profit / 100.0 AS DECIMAL(18,4))) AS VARCHAR) AS total_profit,
             CAST(CAST(sign(SUM(margin)) * ((2 * abs(SUM(margin)) + COUNT(*)) // (2 * COUNT(*)))
                  / 100.0 AS DECIMAL(18,2)) AS VARCHAR) AS avg_margin_pct,
             CAST(SUM(units_sold) AS BIGINT) AS total_units
      FROM silver GROUP BY order_year, order_month, country""",
    "catalog_months": f"""{_BASE}
      SELECT order_year, order_month, country, COUNT(*) AS row_count,
             CAST(SUM(units_sold) AS BIGINT) AS total_units
      FROM silver GROUP BY order_year, order_month, country""",
    "adhoc_sql": f"""{_BASE}
      SELECT country, order_year,
             CAST(SUM(CAST(rev / 100.0 AS DECIMAL(18,4))) AS VARCHAR) AS total_revenue,
             CAST(SUM(units_sold) AS BIGINT) AS total_units, COUNT(*) AS raw_rows
      FROM silver GROUP BY country, order_year""",
    "manifest_changes": f"""{_PRIOR}
      SELECT f.page_id, f.url,
             {_is_new("(CASE WHEN f.k <> 6 THEN f.etag END)")} AS is_new
      FROM facts f LEFT JOIN (SELECT * FROM prior WHERE rk = 1) p ON f.url = p.url""",
    "manifest_states": f"""{_PRIOR},
      changed AS (
        SELECT f.url FROM facts f LEFT JOIN (SELECT * FROM prior WHERE rk = 1) p ON f.url = p.url
        WHERE {_is_new("f.etag")})
      SELECT url, CAST(CASE WHEN url IN (SELECT url FROM changed) THEN 1609545600000
                            ELSE 1609459200000 END AS BIGINT) AS downloaded_at,
             'produced' AS status
      FROM (SELECT url FROM prior UNION SELECT url FROM changed)""",
    "file_manifest": """
      SELECT page_id // 100 AS file_no,
             CAST(SUM(octet_length(encode(html)) + 1) AS BIGINT) AS length,
             md5(string_agg(html || chr(10), '' ORDER BY page_id)) AS checksum_md5
      FROM pages GROUP BY page_id // 100""",
    "changed_files": """
      SELECT page_id // 10 AS file_no, (page_id // 10) % 4 <> 3 AS opened, (page_id // 10) % 4 IN (0, 1) AS is_new
      FROM pages GROUP BY page_id // 10""",
    "archive_records": f"{_BASE} SELECT {_SALES} FROM sales",
    "stream_to_silver": f"{_BASE} SELECT {_SILVER} FROM silver",
    "stream_replay": f"""{_BASE}
      SELECT 'bronze' AS layer, 2 * COUNT(*) AS row_count FROM sales
      UNION ALL SELECT 'silver', COUNT(*) FROM sales""",
    "stream_resume": f"""{_BASE},
      n AS (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE pos % 4 = 0) AS early FROM topic)
      SELECT CAST(1 AS INTEGER) AS run, early AS received, early AS written FROM n
      UNION ALL SELECT 2, total - early, total - early FROM n""",
    "stream_poison": f"""{_BASE}, {_POISON}
      SELECT COALESCE(reject_class, 'SILVER') AS outcome, COUNT(*) AS row_count
      FROM poison GROUP BY 1""",
    "stream_run_log": f"""{_BASE}, {_POISON}
      SELECT 'bronze' AS entry, COUNT(*) AS received, COUNT(*) - COUNT(reject_class) AS written,
             CAST(0 AS BIGINT) AS skipped, COUNT(reject_class) AS rejected FROM poison
      UNION ALL
      SELECT 'silver', COUNT(*), COUNT(*), 0, 0 FROM poison WHERE reject_class IS NULL""",
    "ingest_end_to_end": f"{_BASE} SELECT {_SILVER_BODY} FROM silver",
}

ORACLES = {name: dedent(sql).strip() for name, sql in _ORACLES.items()}
