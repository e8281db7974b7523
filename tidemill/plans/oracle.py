"""DuckDB SQL computing each registered query from the base tables.

The oracle does not go through JSON: it derives orders, resolves addresses
with its own range join, and aggregates directly. Equal results therefore
also check the JSON round trips, casts and filters of the Spark side.
"""

from __future__ import annotations

# Fixture derivations (FIXTURES.md section 3), as common table expressions.
_RAW = """
raw AS (
  SELECT o_orderkey, o_custkey, o_orderdate, c_nationkey,
         cast(o_orderkey AS varchar) AS orderId,
         lpad(cast(o_custkey AS varchar), 9, '0') AS userId,
         strftime(cast(o_orderdate AS timestamp) + to_milliseconds((o_orderkey % 3) * 28799877), '%Y-%m-%d %H:%M:%S.%g') AS orderTime,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL
              WHEN o_orderkey % 49 = 0 THEN 'bad-ip'
              WHEN o_orderkey % 47 = 0 THEN '192.168.1.1'
              WHEN o_orderkey % 43 = 0 THEN concat_ws('.', wide >> 24, (wide >> 16) & 255, (wide >> 8) & 255, wide & 255)
              ELSE concat('10.', c_nationkey, '.', o_orderkey % 256, '.', o_custkey % 256) END AS ip,
         cast(cast(cast(o_totalprice AS decimal(10,2)) AS double) AS varchar) AS orderMoney,
         cast(o_totalprice AS decimal(10,2)) AS money,
         CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END AS orderStatus
  FROM (SELECT *, CAST(CASE (o_orderkey // 43) % 4 WHEN 0 THEN 184549376 WHEN 1 THEN 184849376 WHEN 2 THEN 184849377
                       ELSE 184549376 + (o_orderkey * 31) % 300001 END AS BIGINT) AS wide FROM orders)
  JOIN customer ON o_custkey = c_custkey
)"""

_JUNK = """
junk AS (
  SELECT o_orderkey,
         CASE (o_orderkey // 101) % 6 WHEN 0 THEN NULL WHEN 1 THEN ',' WHEN 2 THEN ' ,, '
              WHEN 3 THEN concat(chr(9), ',', chr(10)) WHEN 4 THEN ', ,' ELSE '' END AS txt
  FROM raw WHERE o_orderkey % 101 = 0
),
kept_junk AS (SELECT txt FROM junk WHERE (o_orderkey // 101) % 6 IN (4, 5))"""

_OCTET = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

_LOCATED = f"""
ipdim AS (
  SELECT CAST(10 AS BIGINT) * 16777216 + n_nationkey * 65536 AS ip_lo,
         CAST(10 AS BIGINT) * 16777216 + n_nationkey * 65536 + 65535 AS ip_hi,
         concat('X|0|', r_name, '|', n_name, '|isp') AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT CAST(184549376 AS BIGINT), CAST(184849376 AS BIGINT), 'X|0|WIDE|WIDE_CITY|isp'
),
open_orders AS (
  SELECT *, CASE WHEN regexp_full_match(ip, '{_OCTET}\\.{_OCTET}\\.{_OCTET}\\.{_OCTET}') THEN
              CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
              + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) END AS ip_num
  FROM raw WHERE orderStatus = 0
),
located AS (
  SELECT o.*, coalesce(split_part(d.region, '|', 3), 'Unknown') AS province,
         coalesce(split_part(d.region, '|', 4), 'Unknown') AS city
  FROM open_orders o LEFT JOIN ipdim d ON o.ip_num BETWEEN d.ip_lo AND d.ip_hi
)"""

_BASE = f"WITH {_RAW},{_LOCATED}"

# The nested dictionary; the narrowest range that holds an address owns it.
_NESTED = """
nested AS (
  SELECT DISTINCT * FROM (
    SELECT * FROM ipdim
    UNION ALL
    SELECT 167772160 + s_nationkey * 65536 + (s_suppkey * 37) % 256 * 256 + 100,
           167772160 + s_nationkey * 65536 + (s_suppkey * 37) % 256 * 256 + 400 + s_suppkey % 200,
           concat('X|0|', r_name, '|', s_name, '|isp')
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 167772160, 184549375, 'X|0|NET10|NET10_CITY|isp'))"""
_BASE_JUNK = f"WITH {_RAW},{_JUNK}"

_CITIES = "('NATION_0','NATION_1','NATION_2','NATION_3','NATION_4','NATION_5','NATION_6','NATION_7','NATION_8')"

# Daily cells: total / province / city, and the three as grouping-set rows.
_TOTAL = """SELECT 'orders:money:total:' || cast(cast(o_orderdate AS date) AS varchar) AS key, 'global' AS field,
       cast(sum(money) AS varchar) AS value FROM located GROUP BY cast(o_orderdate AS date)"""
_PROVINCE = """SELECT 'orders:money:province:' || cast(cast(o_orderdate AS date) AS varchar) AS key, province AS field,
       cast(sum(money) AS varchar) AS value FROM located GROUP BY cast(o_orderdate AS date), province"""
_CITY = f"""SELECT 'orders:money:city:' || cast(cast(o_orderdate AS date) AS varchar) AS key, city AS field,
       cast(sum(money) AS varchar) AS value FROM located WHERE city IN {_CITIES}
       GROUP BY cast(o_orderdate AS date), city"""

_SETS = f"""
sets AS (
  SELECT 'total' AS grain, cast(o_orderdate AS date) AS d, 'global' AS category, cast(sum(money) AS decimal(20,2)) AS amt
  FROM located GROUP BY 2
  UNION ALL
  SELECT 'province', cast(o_orderdate AS date), province, cast(sum(money) AS decimal(20,2)) FROM located GROUP BY 2, 3
  UNION ALL
  SELECT 'city', cast(o_orderdate AS date), city, cast(sum(money) AS decimal(20,2))
  FROM located WHERE city IN {_CITIES} GROUP BY 2, 3
)"""

_KV = f"""
kv AS (
  {_TOTAL}
  UNION ALL
  {_PROVINCE}
  UNION ALL
  {_CITY}
)"""

_WIDE = """
wide AS (
  SELECT reverse(userId) || '_' || orderTime AS row_key, o_orderkey,
         orderId, userId, orderTime, coalesce(ip, '') AS ip, orderMoney, cast(orderStatus AS varchar) AS orderStatus,
         province, city
  FROM located
)"""

_DOC_FIELDS = "orderId, userId, orderTime, ip, orderMoney, cast(orderStatus AS varchar) AS orderStatus, province, city"

# Three versions an order, written one after the other; a field's last non-NULL value wins.
_MERGED_DOCS = """
versions AS (
  SELECT o_orderkey * 3 + v AS seq, orderId, userId, orderTime,
         CASE WHEN v <> 1 THEN ip END AS ip,
         CASE WHEN v = 0 THEN orderMoney WHEN v = 2 AND o_orderkey % 5 = 0 THEN '1.5' END AS orderMoney,
         cast(v AS varchar) AS orderStatus,
         CASE WHEN v = 0 THEN province WHEN v = 2 AND o_orderkey % 7 = 0 THEN 'MOVED' END AS province,
         CASE WHEN v = 0 THEN city WHEN v = 1 AND o_orderkey % 11 = 0 THEN 'MOVED' END AS city
  FROM located, (VALUES (0), (1), (2)) t(v))
SELECT orderId,
       arg_max(userId, seq) FILTER (WHERE userId IS NOT NULL) AS userId,
       arg_max(orderTime, seq) FILTER (WHERE orderTime IS NOT NULL) AS orderTime,
       arg_max(ip, seq) FILTER (WHERE ip IS NOT NULL) AS ip,
       arg_max(orderMoney, seq) FILTER (WHERE orderMoney IS NOT NULL) AS orderMoney,
       arg_max(orderStatus, seq) FILTER (WHERE orderStatus IS NOT NULL) AS orderStatus,
       arg_max(province, seq) FILTER (WHERE province IS NOT NULL) AS province,
       arg_max(city, seq) FILTER (WHERE city IS NOT NULL) AS city
FROM versions GROUP BY orderId"""

_ETL_FIELDS = f"""{_BASE}
SELECT orderId AS key, {_DOC_FIELDS} FROM located"""

# A put overwrites the puts before it, in write order.
_WIDE_LATEST = f"""{_BASE},{_WIDE}
SELECT row_key, orderId, userId, orderTime, ip, orderMoney, orderStatus, province, city
FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY o_orderkey DESC) AS rn FROM wide) WHERE rn = 1"""

_LOG = """
log AS (
  SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS partition, event_id, ts,
         row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS "offset"
  FROM events
),
ledger AS (
  SELECT topic, partition, max("offset") + 1 AS from_offset FROM log
  WHERE ts < TIMESTAMP '2024-01-08 00:00:00' AND partition <> 2 GROUP BY topic, partition
),
pending AS (
  SELECT l.topic, l.partition, l."offset", l.event_id FROM log l LEFT JOIN ledger g USING (topic, partition)
  WHERE l."offset" >= coalesce(g.from_offset, 0)
)"""

_LOCATED_COLS = f"""{_BASE}
SELECT orderId, ip, province, city FROM located"""

# Purchases in three arrivals, some told late; the watermark each arrival is judged by, and the one it leaves.
_EVENTS = """
WITH e AS (
  SELECT event_id, value, CASE WHEN event_id % 89 = 0 THEN ts - INTERVAL 5 DAY ELSE ts END AS ts,
         (event_id - min(event_id) OVER ()) //
           CAST(ceil((max(event_id) OVER () - min(event_id) OVER () + 1) / 3.0) AS BIGINT) AS slot
  FROM events WHERE event_type = 'purchase'),
w AS (
  SELECT s.slot, (SELECT max(date_trunc('millisecond', e.ts)) - INTERVAL 10 MINUTE FROM e WHERE e.slot < s.slot) AS wm,
         (SELECT max(date_trunc('millisecond', e.ts)) - INTERVAL 10 MINUTE FROM e WHERE e.slot = s.slot) AS own
  FROM (SELECT DISTINCT slot FROM e) s)"""

_FIELDS = "(VALUES ('orderId'), ('userId'), ('orderTime'), ('ip'), ('orderMoney'), ('orderStatus'), ('province'), ('city'))"
_OF_FIELD = """CASE f WHEN 'orderId' THEN orderId WHEN 'userId' THEN userId WHEN 'orderTime' THEN orderTime WHEN 'ip' THEN ip
  WHEN 'orderMoney' THEN orderMoney WHEN 'orderStatus' THEN orderStatus WHEN 'province' THEN province ELSE city END"""

ORACLE: dict[str, str] = {
    "etl_clean": f"""{_BASE_JUNK}
SELECT orderId, CAST(NULL AS varchar) AS junk FROM raw
UNION ALL SELECT CAST(NULL AS varchar), txt FROM kept_junk""",
    "etl_parse": f"""{_BASE_JUNK}
SELECT orderId, userId, orderTime, ip, orderMoney, orderStatus FROM raw
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, CAST(NULL AS INTEGER) FROM kept_junk""",
    "etl_open_orders": f"""WITH {_RAW}
SELECT orderId, userId, orderTime, ip, orderMoney, orderStatus FROM raw WHERE orderStatus = 0""",
    "etl_ip_range_join": _LOCATED_COLS,
    "etl_ip_prefix_join": _LOCATED_COLS,
    "etl_ip_salted_join": _LOCATED_COLS,
    "etl_ip_stored_join": _LOCATED_COLS,
    "dictionary_normalised": f"""{_BASE},{_NESTED},
edges AS (SELECT ip_lo AS p FROM nested UNION SELECT ip_hi + 1 FROM nested),
parts AS (SELECT p, lead(p) OVER (ORDER BY p) - 1 AS q FROM edges),
owned AS (
  SELECT p, q, region FROM parts JOIN nested ON p BETWEEN ip_lo AND ip_hi
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY ip_hi - ip_lo, ip_lo, region) = 1),
flagged AS (
  SELECT *, CASE WHEN lag(region) OVER (ORDER BY p) = region AND lag(q) OVER (ORDER BY p) + 1 = p THEN 0 ELSE 1 END AS fresh FROM owned),
runs AS (SELECT *, sum(fresh) OVER (ORDER BY p) AS run FROM flagged)
SELECT CAST(min(p) AS BIGINT) AS ip_lo, CAST(max(q) AS BIGINT) AS ip_hi, any_value(region) AS region FROM runs GROUP BY run""",
    "etl_ip_nested": f"""{_BASE},{_NESTED},
owner AS (
  SELECT o_orderkey, region FROM open_orders JOIN nested ON ip_num BETWEEN ip_lo AND ip_hi
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY ip_hi - ip_lo, ip_lo, region) = 1)
SELECT orderId, ip, coalesce(split_part(region, '|', 3), 'Unknown') AS province, coalesce(split_part(region, '|', 4), 'Unknown') AS city
FROM open_orders LEFT JOIN owner USING (o_orderkey)""",
    "etl_output_fields": _ETL_FIELDS,
    "report_total": f"{_BASE}\n{_TOTAL}",
    "report_province": f"{_BASE}\n{_PROVINCE}",
    "report_city": f"{_BASE}\n{_CITY}",
    "report_city_semi": f"{_BASE}\n{_CITY}",
    "report_sets": f"""{_BASE},{_SETS}
SELECT grain, 'orders:money:' || grain || ':' || cast(d AS varchar) AS key, category AS field,
       cast(amt AS varchar) AS value FROM sets""",
    "report_long": f"""{_BASE},{_SETS}
SELECT d AS date,
       CASE grain WHEN 'total' THEN '总销售额' WHEN 'province' THEN '省份销售额' ELSE '城市销售额' END AS dimension,
       category, amt AS sales FROM sets""",
    "report_document": f"""{_BASE},{_SETS}
SELECT d AS date,
       coalesce(max(amt) FILTER (WHERE grain = 'total'), CAST(0 AS DECIMAL(20,2))) AS total_sales,
       CAST(count(*) FILTER (WHERE grain = 'province') AS INTEGER) AS n_provinces,
       coalesce(string_agg(category || '=' || cast(amt AS varchar), ';' ORDER BY category, amt)
                FILTER (WHERE grain = 'province'), '') AS province_sales,
       CAST(count(*) FILTER (WHERE grain = 'city') AS INTEGER) AS n_cities,
       coalesce(string_agg(category || '=' || cast(amt AS varchar), ';' ORDER BY category, amt)
                FILTER (WHERE grain = 'city'), '') AS city_sales
FROM sets GROUP BY d""",
    "report_series": f"""{_BASE},{_SETS}
SELECT d AS date, 0 AS ordinal, 'Total' AS label, amt AS value FROM sets WHERE grain = 'total'
UNION ALL
SELECT d, CAST(row_number() OVER (PARTITION BY d ORDER BY category, amt) AS INTEGER), category, amt
FROM sets WHERE grain = 'province'""",
    "report_day_default": f"""{_BASE},{_SETS},
days AS (
  SELECT cast(t.d AS date) AS d FROM range((SELECT min(d) FROM sets) - INTERVAL 2 DAY, (SELECT max(d) FROM sets) + INTERVAL 3 DAY,
                                    INTERVAL 1 DAY) t(d))
SELECT days.d AS date,
       coalesce(max(amt) FILTER (WHERE grain = 'total'), CAST(0 AS DECIMAL(20,2))) AS total_sales,
       CAST(count(*) FILTER (WHERE grain = 'province') AS INTEGER) AS n_provinces,
       coalesce(string_agg(category || '=' || cast(amt AS varchar), ';' ORDER BY category, amt)
                FILTER (WHERE grain = 'province'), '') AS province_sales,
       CAST(count(*) FILTER (WHERE grain = 'city') AS INTEGER) AS n_cities,
       coalesce(string_agg(category || '=' || cast(amt AS varchar), ';' ORDER BY category, amt)
                FILTER (WHERE grain = 'city'), '') AS city_sales
FROM days LEFT JOIN sets ON sets.d = days.d GROUP BY days.d""",
    "report_json_file": None,
    "report_csv_file": None,
    "store_kv_latest": f"""{_BASE},{_KV}
SELECT key, field, value FROM kv""",
    "store_kv_get": f"""{_BASE},{_KV},
days AS (
  SELECT cast(d AS date) AS d FROM range(
    (SELECT min(cast(o_orderdate AS date)) FROM located),
    (SELECT max(cast(o_orderdate AS date)) FROM located) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)
)
SELECT 'orders:money:total:' || cast(days.d AS varchar) AS key, 'global' AS field, coalesce(kv.value, '0') AS value
FROM days LEFT JOIN kv ON kv.key = 'orders:money:total:' || cast(days.d AS varchar) AND kv.field = 'global'""",
    "store_kv_getall": f"""{_BASE},{_KV}
SELECT key, CAST(count(*) AS INTEGER) AS n_fields, string_agg(field || '=' || value, ';' ORDER BY field) AS entries
FROM kv GROUP BY key""",
    "store_wide_rows": f"""{_BASE},{_WIDE}
SELECT row_key, orderId, userId, orderTime, ip, orderMoney, orderStatus, province, city FROM wide""",
    "store_wide_latest": _WIDE_LATEST,
    "store_wide_custom": f"SELECT row_key, ip, city FROM ({_WIDE_LATEST})",
    "store_documents": f"""{_BASE}
SELECT {_DOC_FIELDS} FROM located""",
    "store_documents_merged": f"{_BASE},{_MERGED_DOCS}",
    "stream_etl": _ETL_FIELDS,
    "stream_total": f"{_BASE}\n{_TOTAL}",
    "stream_province": f"{_BASE}\n{_PROVINCE}",
    "stream_city": f"{_BASE}\n{_CITY}",
    "stream_two_hop": f"{_BASE}\n{_PROVINCE}",
    "stream_restart": f"{_BASE}\n{_PROVINCE}",
    "stream_wide": _WIDE_LATEST,
    "stream_documents": f"{_BASE},{_MERGED_DOCS}",
    "stream_wide_state": _WIDE_LATEST,
    # Arrival a makes batch 2a, under the watermark of the arrivals before it, and 2a + 1, under its own too.
    "stream_state_rows": f"""{_EVENTS},
batches AS (SELECT 2 * slot + b AS batch, slot, CASE WHEN b = 0 THEN wm ELSE greatest(wm, own) END AS wm FROM w, (VALUES (0), (1)) t(b)),
days AS (SELECT b.batch, b.wm, cast(e.ts AS date) AS d FROM batches b JOIN e ON e.slot <= b.slot GROUP BY ALL)
SELECT 'parity' AS form, CAST(batch AS INTEGER) AS batch, count(*) AS state_rows, min(d) AS first_day, max(d) AS last_day
FROM days GROUP BY batch
UNION ALL
SELECT 'bounded', CAST(batch AS INTEGER), count(d) FILTER (WHERE wm IS NULL OR d + INTERVAL 1 DAY > wm),
       min(d) FILTER (WHERE wm IS NULL OR d + INTERVAL 1 DAY > wm), max(d) FILTER (WHERE wm IS NULL OR d + INTERVAL 1 DAY > wm)
FROM days GROUP BY batch""",
    "stream_late_rows": f"""{_EVENTS}
SELECT CAST(2 * slot AS INTEGER) AS batch, count(*) FILTER (WHERE wm IS NULL OR cast(ts AS date) + INTERVAL 1 DAY > wm) AS kept,
       count(*) FILTER (WHERE NOT (wm IS NULL OR cast(ts AS date) + INTERVAL 1 DAY > wm)) AS dropped, CAST(0 AS BIGINT) AS untimed
FROM e JOIN w USING (slot) GROUP BY slot""",
    "stream_stores": f"""{_BASE},{_KV},
docs AS (SELECT {_DOC_FIELDS} FROM located),
puts AS ({_WIDE_LATEST})
SELECT 'cells' AS store, key, field, value FROM kv
UNION ALL SELECT 'documents', orderId, f, {_OF_FIELD} FROM docs, {_FIELDS} t(f)
UNION ALL SELECT 'wide', row_key, f, {_OF_FIELD} FROM puts, {_FIELDS} t(f)""",
    "stream_quarantine": f"""{_BASE_JUNK},
told AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 THEN 'undecodable'
                               WHEN o_orderkey % 83 = 0 THEN 'no order id' ELSE 'kept' END AS outcome FROM raw
  UNION ALL
  SELECT o_orderkey, CASE WHEN txt IS NULL THEN 'no value' WHEN txt = '' THEN 'empty' ELSE 'undecodable' END FROM junk),
batched AS (SELECT CAST(k % 3 AS INTEGER) AS batch, outcome FROM told)
SELECT batch, outcome, count(*) AS messages FROM batched GROUP BY batch, outcome
UNION ALL SELECT batch, 'read', count(*) FROM batched GROUP BY batch""",
    "stream_intake": f"""{_BASE}
SELECT CAST((o_orderkey % 8) // 3 AS INTEGER) AS batch, count(*) AS messages FROM located GROUP BY 1""",
    # A row is dropped when its day had ended before the watermark that the arrivals before its own had reached.
    "stream_daily_bounded": """
WITH e AS (
  SELECT event_id, value, CASE WHEN event_id % 89 = 0 THEN ts - INTERVAL 5 DAY ELSE ts END AS ts,
         (event_id - min(event_id) OVER ()) //
           CAST(ceil((max(event_id) OVER () - min(event_id) OVER () + 1) / 3.0) AS BIGINT) AS slot
  FROM events WHERE event_type = 'purchase'),
w AS (
  SELECT s.slot, (SELECT max(date_trunc('millisecond', e.ts)) - INTERVAL 10 MINUTE FROM e WHERE e.slot < s.slot) AS wm
  FROM (SELECT DISTINCT slot FROM e) s)
SELECT cast(ts AS date) AS order_date, cast(sum(cast(value AS decimal(10,2))) AS decimal(20,2)) AS total_amt
FROM e JOIN w USING (slot) WHERE wm IS NULL OR cast(ts AS date) + INTERVAL 1 DAY > wm GROUP BY 1""",
    "scalar_ip_text": """
WITH t AS (SELECT o_orderkey, ((o_orderkey * 65537 + o_custkey) % 4294967296) - 2147483648 AS ip_signed FROM orders)
SELECT o_orderkey, ip_signed,
       concat_ws('.', (ip_signed >> 24) & 255, (ip_signed >> 16) & 255, (ip_signed >> 8) & 255, ip_signed & 255) AS ip_text,
       ip_signed + CASE WHEN ip_signed < 0 THEN 4294967296 ELSE 0 END AS ip_number
FROM t""",
    "scalar_date_text": """
SELECT event_id, epoch_us(ts) // 1000 AS millis,
       strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y%m%d%H%M%S%g') AS compact,
       strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S.%g') AS record
FROM events""",
    "scalar_ids": """
SELECT event_id,
       strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y%m%d%H%M%S%g') || lpad(cast(event_id % 1000000 AS varchar), 6, '0')
         AS order_id,
       cast(1 + user_id % 5 AS varchar) || lpad(cast(user_id AS varchar), 8, '0') AS user_id
FROM events""",
    "scalar_json_props": """
SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(value AS DECIMAL(10,2)) AS money
FROM events""",
    "offsets_resume": f"""WITH {_LOG}
SELECT topic, partition, "offset", event_id FROM pending""",
    "offsets_commit": f"""WITH {_LOG},
merged AS (
  SELECT topic, partition, from_offset FROM ledger
  UNION ALL SELECT topic, partition, max("offset") + 1 FROM pending GROUP BY topic, partition
)
SELECT topic, partition, max(from_offset) AS from_offset FROM merged GROUP BY topic, partition""",
}

ORACLE["report_json_file"] = ORACLE["report_document"]
ORACLE["report_csv_file"] = ORACLE["report_long"]
ORACLE["stream_sets"] = ORACLE["report_sets"]
ORACLE["report_export_changes"] = ORACLE["report_document"]
ORACLE["report_from_store"] = ORACLE["report_document"]
