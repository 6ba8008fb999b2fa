"""The registered queries in plain SQL, for an independent engine to check."""

from __future__ import annotations

from streammart.workload.queries import AGE_AS_OF, ORDER_DAY, VISIT_DAY
from streammart.workload.roles import BIRTHDAY_BASE

_DAY_US = 86_400_000_000
_HOUR_US = 3_600_000_000
_BOUNCE_US = 6 * _HOUR_US


def _bucket(ts: str, width_us: int, shift: int = 0) -> str:
    start = f"make_timestamp((epoch_us({ts}) // {width_us} + {shift}) * {width_us})"
    return f"strftime({start}, '%Y-%m-%d %H:%M:%S')"


def _day(number: int) -> str:
    text = str(number)
    return f"{text[:4]}-{text[4:6]}-{text[6:]}"


_TIME = "'%Y-%m-%d %H:%M:%S'"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

_CHANGES = """
changes AS (
  SELECT 'order_info' AS "table",
         CASE o_orderstatus WHEN 'F' THEN 'insert' WHEN 'O' THEN 'insert' ELSE 'update' END AS "type",
         o_orderkey AS id, o_totalprice AS total_amount, o_orderstatus AS detail
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
  UNION ALL
  SELECT 'user_info', CASE c_mktsegment WHEN 'BUILDING' THEN 'delete' ELSE 'insert' END,
         c_custkey, NULL, c_name
  FROM customer)
"""

_PAGES = f"""
pages_ AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN value >= 20 THEN 'v2' ELSE 'v1' END AS vc, event_type AS ch,
         CASE WHEN {_K} < 30 THEN 'north' WHEN {_K} < 60 THEN 'east' ELSE 'south' END AS ar,
         CASE WHEN {_K} < 50 THEN '1' ELSE '0' END AS is_new,
         event_type IN ('signup', 'view') AS entry,
         CAST(round(value * 1000) AS BIGINT) AS during_time, ts
  FROM events)
"""

_UNIQUES = """
uniques AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
    FROM pages_ WHERE entry) WHERE rn = 1)
"""

_BOUNCES = f"""
bounces AS (
  SELECT * FROM (
    SELECT *, min(CASE WHEN NOT entry THEN epoch_us(ts) END) OVER (
      PARTITION BY mid ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING
    ) AS follow FROM pages_)
  WHERE entry AND (follow IS NULL OR follow - epoch_us(ts) >= {_BOUNCE_US}))
"""

_RAW_LOG = f"""
raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, event_type AS ch, value, props, ts,
         json_extract_string(props, '$.k') AS k,
         CASE WHEN {_K} < 50 THEN '1' ELSE '0' END AS is_new,
         event_type = 'signup' AND value < 5 AS broken
  FROM events),
good AS (SELECT * FROM raw WHERE NOT broken)
"""

_WIDE = f"""
wide AS (
  SELECT l_orderkey AS order_id, l_orderkey * 10 + l_linenumber AS detail_id,
         l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num, o_custkey AS user_id,
         CAST(c_nationkey AS BIGINT) AS province_id, o_orderstatus AS order_status,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date,
         strftime(o_orderdate, '%H:%M:%S') AS create_hour,
         CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount,
         o_orderdate, l_shipdate, o_orderpriority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""

_PROVINCES = """
provinces AS (
  SELECT n_nationkey, n_name AS province_name, CAST(n_regionkey AS VARCHAR) AS province_area_code,
         'N-' || n_nationkey AS province_iso_code,
         r_name || '-' || n_nationkey AS province_3166_2_code
  FROM nation JOIN region ON n_regionkey = r_regionkey)
"""

_SKUS = """
cats AS (SELECT length(p_type) AS len, min(p_type) AS category3_name FROM part GROUP BY 1),
skus AS (
  SELECT p_partkey, p_name AS sku_name, p_retailprice AS sku_price,
         CAST(p_size AS BIGINT) AS spu_id, 'size ' || p_size AS spu_name,
         CAST(split_part(p_brand, '#', 2) AS BIGINT) AS tm_id, p_brand AS tm_name,
         CAST(length(p_type) AS BIGINT) AS category3_id, category3_name
  FROM part JOIN cats ON length(p_type) = len)
"""

_USERS = f"""
users AS (
  SELECT c_custkey,
         CAST((epoch_ms(TIMESTAMP '{AGE_AS_OF}') -
           epoch_ms(CAST(DATE '{BIRTHDAY_BASE}' - CAST(floor(abs(c_acctbal)) AS INTEGER)
                    AS TIMESTAMP))) // 31536000000 AS INTEGER) AS user_age,
         substr(c_mktsegment, 1, 1) AS user_gender
  FROM customer)
"""

_VISITOR_MEASURES = f"""
WITH {_PAGES}, {_UNIQUES}, {_BOUNCES},
measures AS (
  SELECT ts, vc, ch, ar, is_new, 0 AS uv, 1 AS pv, CAST(entry AS INTEGER) AS sv, 0 AS uj,
         during_time AS dur FROM pages_
  UNION ALL SELECT ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM uniques
  UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 0, 1, 0 FROM bounces)
"""
_VISITOR_SUMS = """
  CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
  CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct,
  CAST(sum(dur) AS BIGINT) AS dur_sum
"""
_VISITOR_DAY = f"CAST(ts AS DATE) = DATE '{_day(VISIT_DAY)}'"


def _visitors(width_us: int) -> str:
    return f"""{_VISITOR_MEASURES}
SELECT {_bucket('ts', width_us)} AS stt, {_bucket('ts', width_us, 1)} AS edt,
       vc, ch, ar, is_new, {_VISITOR_SUMS}
FROM measures GROUP BY ALL"""


def _products(single_row_zero: bool) -> str:
    def distinct(column: str, name: str) -> str:
        count = f"count(DISTINCT {column})"
        if single_row_zero:
            count = f"CASE WHEN count(*) = 1 THEN 0 ELSE {count} END"
        return f"CAST({count} AS BIGINT) AS {name}"

    def row(source: str, ts: str, sku: str, **own: str) -> str:
        names = ("display", "click", "favor", "cart", "num", "amount", "oid", "paid", "pid",
                 "refund", "rid", "comment", "good")
        empty = {"oid": "NULL", "pid": "NULL", "rid": "NULL"}
        values = ", ".join(f"{own.get(n, empty.get(n, '0'))} AS {n}" for n in names)
        return f"SELECT {ts} AS ts, {sku} AS sku_id, {values} FROM {source}"

    k = f"CAST({_K} AS BIGINT)"
    rows = " UNION ALL ".join(
        [
            row("events WHERE event_type = 'click'", "ts", k, click="1"),
            row("events WHERE event_type = 'view'", "ts", k, display="1"),
            row("events WHERE event_type = 'signup'", "ts", k, favor="1"),
            row("events WHERE event_type = 'view'", "ts", k, cart="1"),
            row("wide", "o_orderdate", "sku_id", amount="total_amount", num="sku_num",
                oid="order_id"),
            row("wide WHERE order_status = 'F'", "o_orderdate + INTERVAL 1 DAY", "sku_id",
                paid="split_total_amount", pid="order_id"),
            row("lineitem WHERE l_returnflag = 'R'", "l_shipdate", "l_partkey",
                refund="CAST(l_extendedprice AS DECIMAL(16,2))", rid="l_orderkey"),
            row("events WHERE event_type = 'error'", "ts", k, comment="1",
                good=f"CASE WHEN {_K} < 50 THEN 1 ELSE 0 END"),
        ]
    )

    def total(column: str, name: str) -> str:
        return f"CAST(sum({column}) AS BIGINT) AS {name}"

    def amount(column: str, name: str) -> str:
        return f"CAST(CAST(sum({column}) AS DECIMAL(26,2)) AS DOUBLE) AS {name}"

    return f"""WITH {_WIDE}, {_SKUS}, rows_ AS ({rows}),
stats AS (
  SELECT {_bucket('ts', _DAY_US)} AS stt, {_bucket('ts', _DAY_US, 1)} AS edt, sku_id,
    {total('display', 'display_ct')}, {total('click', 'click_ct')},
    {total('favor', 'favor_ct')}, {total('cart', 'cart_ct')}, {total('num', 'order_sku_num')},
    {amount('amount', 'order_amount')}, {distinct('oid', 'order_ct')},
    {amount('paid', 'payment_amount')}, {distinct('pid', 'paid_order_ct')},
    {distinct('rid', 'refund_order_ct')}, {amount('refund', 'refund_amount')},
    {total('comment', 'comment_ct')}, {total('good', 'good_comment_ct')}
  FROM rows_ GROUP BY ALL)
"""


_SALES = f"""WITH {_WIDE}, {_SKUS}, sales AS (
  SELECT wide.*, skus.* EXCLUDE (sku_name) FROM wide JOIN skus ON sku_id = p_partkey
  WHERE CAST(o_orderdate AS DATE) = DATE '{_day(ORDER_DAY)}')
"""
_SALES_AMOUNT = "CAST(CAST(sum(total_amount) AS DECIMAL(26,2)) AS DOUBLE) AS order_amount"


def _top(keys: str, more: str = "") -> str:
    return f"""{_SALES}
SELECT {keys}, {_SALES_AMOUNT}{more} FROM sales GROUP BY {keys}
HAVING sum(total_amount) > 0 ORDER BY sum(total_amount) DESC, {keys} LIMIT 10"""


_FLAGS = f"""{_VISITOR_MEASURES},
flags AS (SELECT is_new, {_VISITOR_SUMS} FROM measures WHERE {_VISITOR_DAY} GROUP BY is_new)
"""
_RATED = f"""{_FLAGS},
rated AS (
  SELECT *,
    CASE WHEN uv_ct <> 0 AND sv_ct <> 0
         THEN ((uj_ct * 100 * 100 * 2 + sv_ct) // (2 * sv_ct)) / 100.0 ELSE 0 END AS uj_rate,
    CASE WHEN uv_ct <> 0 AND sv_ct <> 0
         THEN (((dur_sum * 2 + sv_ct) // (2 * sv_ct) + 50) // 100) / 10.0 ELSE 0 END AS dur_per_sv,
    CASE WHEN uv_ct <> 0 AND sv_ct <> 0
         THEN ((pv_ct * 100 * 2 + sv_ct) // (2 * sv_ct)) / 100.0 ELSE 0 END AS pv_per_sv
  FROM flags)
"""
_PIVOT_LINES = [
    (0, "users", "uv_ct"), (1, "pages", "pv_ct"), (2, "bounce_rate", "uj_rate"),
    (3, "seconds_per_visit", "dur_per_sv"), (4, "pages_per_visit", "pv_per_sv"),
]
_HOURS = f"""{_VISITOR_MEASURES},
hours AS (
  SELECT CAST(hour(ts) AS INTEGER) AS hr, CAST(sum(uv) AS BIGINT) AS uv_ct,
         CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct,
         CAST(sum(CASE WHEN is_new = '1' THEN uv ELSE 0 END) AS BIGINT) AS new_uv
  FROM measures WHERE {_VISITOR_DAY} GROUP BY 1)
"""

_ENRICHED = ("spu_id, spu_name, tm_id, tm_name, category3_id, category3_name")

_PAYMENT = f"""
SELECT order_id AS payment_id, order_id, detail_id, sku_id, user_id, o_orderpriority AS subject,
       strftime(o_orderdate + INTERVAL 1 DAY, {_TIME}) AS payment_create_time,
       strftime(o_orderdate, {_TIME}) AS order_create_time,
       CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(split_total_amount AS DOUBLE) AS split_total_amount
FROM wide WHERE order_status = 'F'
"""

ORACLES: dict[str, str] = {
    "cdc_filter_normalise": f"""WITH {_CHANGES}
SELECT "table", "type", count(*) AS n FROM changes GROUP BY ALL""",
    "cdc_route": f"""WITH {_CHANGES}
SELECT "table", "type",
  CASE WHEN "table" = 'order_info' AND "type" = 'insert' THEN 'dwd_order_info'
       WHEN "table" = 'order_info' AND "type" = 'update' THEN 'dim_order_info'
       WHEN "table" = 'user_info' AND "type" = 'insert' THEN 'dim_user_info'
       ELSE 'none' END AS sink_table, count(*) AS n
FROM changes GROUP BY ALL""",
    "cdc_prune_columns": """
SELECT o_orderkey AS src_offset, 'id,total_amount,user_id' AS kept, o_orderkey AS id,
       o_totalprice AS total_amount
FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "cdc_to_dimension": f"""WITH {_CHANGES}
SELECT CASE "table" WHEN 'order_info' THEN 'dim_order_info' ELSE 'dim_user_info' END AS sink_table,
       'id' AS sink_pk, id, detail
FROM changes
WHERE ("table" = 'order_info' AND "type" = 'update')
   OR ("table" = 'user_info' AND "type" = 'insert')""",
    "rules_flatten": """
SELECT 'conf' AS "database", 'table_process' AS "table",
       CASE o_orderpriority WHEN '5-LOW' THEN 'delete' ELSE 'create' END AS "type",
       o_orderpriority = '5-LOW' AS empty, count(*) AS n
FROM orders GROUP BY ALL""",
    "rules_latest": """
SELECT 't' || o_custkey AS source_table, o_orderstatus AS operate_type,
       'dwd_' || o_orderkey AS sink_table
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
                                   ORDER BY o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1 AND o_orderpriority <> '5-LOW'""",
    "dim_upsert_batches": """
WITH gone AS (SELECT user_id, max(event_id) AS at FROM events WHERE event_type = 'error' GROUP BY user_id),
kept AS (
  SELECT e.* FROM events e LEFT JOIN gone g ON e.user_id = g.user_id
  WHERE e.user_id IS NOT NULL AND event_type <> 'error' AND (g.at IS NULL OR event_id > g.at))
SELECT user_id, arg_max(event_type, event_id) AS last_type,
       arg_max(value, event_id) FILTER (event_type IN ('signup', 'purchase')) AS amount,
       arg_max(props, event_id) FILTER (event_type = 'signup') AS props
FROM kept GROUP BY user_id""",
    "asof_enrich": """
WITH versions AS (
  SELECT user_id, ts, props, event_type = 'error' AS removed FROM events WHERE event_type IN ('signup', 'error')
  QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
SELECT f.event_id, f.user_id, CASE WHEN NOT v.removed THEN v.ts END AS since, CASE WHEN NOT v.removed THEN v.props END AS profile
FROM events f ASOF LEFT JOIN versions v ON f.user_id = v.user_id AND f.ts >= v.ts
WHERE f.event_type IN ('view', 'click', 'purchase')""",
    "dim_upsert_latest": """
SELECT user_id, event_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""",
    "code_labels": f"""
SELECT CASE WHEN {_K} < 50 THEN '1203' ELSE '1201' END AS appraise,
       CASE WHEN {_K} < 50 THEN 'good' ELSE 'bad' END AS label, count(*) AS n
FROM events WHERE event_type = 'error' GROUP BY ALL""",
    "dirty_quarantine": f"""WITH {_RAW_LOG}
SELECT event_id AS src_offset, 'not json ' || props AS value FROM raw WHERE broken""",
    "log_split_page": f"""WITH {_RAW_LOG}
SELECT event_id AS src_offset, mid, ch, is_new,
       CASE ch WHEN 'click' THEN 'good_detail' ELSE 'home' END AS page_id,
       CASE WHEN ch IN ('click', 'purchase') THEN 'home' END AS last_page_id,
       k AS item, CAST(round(value * 1000) AS BIGINT) AS during_time
FROM good WHERE ch <> 'error'""",
    "log_split_start": f"""WITH {_RAW_LOG}
SELECT event_id AS src_offset, mid, ch, is_new, '{{"entry":"icon"}}' AS start
FROM good WHERE ch = 'error'""",
    "log_explode_display": f"""WITH {_RAW_LOG}
SELECT event_id AS src_offset, 'home' AS page_id, CAST(n - 1 AS INTEGER) AS display_no, k AS item,
       CASE n WHEN 1 THEN 'sku_id' ELSE 'activity_id' END AS item_type,
       'home' AS own_page_id, CAST(n AS BIGINT) AS pos
FROM (SELECT *, unnest([1, 2]) AS n FROM good WHERE ch = 'view')""",
    "log_repaired_value": f"""WITH {_RAW_LOG}
SELECT mid, CASE WHEN is_new = '1' AND rn > 1 THEN '0' ELSE is_new END AS is_new,
       count(*) AS n, count(*) FILTER (ch = 'error') AS starts
FROM (SELECT *, row_number() OVER (PARTITION BY mid, is_new ORDER BY epoch_ms(ts), event_id) AS rn
      FROM good)
GROUP BY ALL""",
    "repair_is_new": f"""WITH {_PAGES}
SELECT event_id, mid, CASE WHEN is_new = '1' AND rn > 1 THEN '0' ELSE is_new END AS is_new
FROM (SELECT *, row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, event_id) AS rn
      FROM pages_)""",
    "daily_unique_visit": f"""WITH {_PAGES}, {_UNIQUES}
SELECT event_id, mid, strftime(ts, '%Y-%m-%d') AS visit_date FROM uniques""",
    "bounce_detect": f"WITH {_PAGES}, {_BOUNCES} SELECT event_id, mid FROM bounces",
    "order_wide_interval": f"""WITH {_WIDE}
SELECT order_id, detail_id, sku_id, sku_num, user_id, province_id, order_status, create_date,
       create_hour, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(split_total_amount AS DOUBLE) AS split_total_amount
FROM wide
WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 5 DAY""",
    "payment_wide_interval": f"""WITH {_WIDE} {_PAYMENT}
  AND l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 5 DAY""",
    "payment_wide_all": f"WITH {_WIDE} {_PAYMENT}",
    "order_wide_full": f"""WITH {_WIDE}, {_PROVINCES}, {_SKUS}, {_USERS}
SELECT order_id, detail_id, sku_id, sku_name, province_name, province_area_code,
       province_iso_code, province_3166_2_code, user_age, user_gender, {_ENRICHED},
       CAST(split_total_amount AS DOUBLE) AS split_total_amount
FROM wide JOIN provinces ON province_id = n_nationkey JOIN skus ON sku_id = p_partkey
JOIN users ON user_id = c_custkey""",
    "enrich_user_age": f"""WITH {_USERS}
SELECT o_orderkey, user_age, user_gender FROM orders JOIN users ON o_custkey = c_custkey""",
    "enrich_province": f"""WITH {_PROVINCES}
SELECT c_custkey, c_nationkey, province_name, province_area_code, province_iso_code,
       province_3166_2_code
FROM customer LEFT JOIN provinces ON c_nationkey = n_nationkey""",
    "enrich_sku_chain": f"""WITH {_SKUS}
SELECT l_orderkey, l_linenumber, l_partkey, sku_name, {_ENRICHED}
FROM lineitem LEFT JOIN skus ON l_partkey = p_partkey""",
    "enrich_dim_miss": """
SELECT l_orderkey, l_linenumber, l_partkey, p_name AS sku_name
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size >= 10) ON l_partkey = p_partkey""",
    "enrich_large_dim": """
SELECT l_orderkey, l_linenumber, l_partkey, p_name AS sku_name
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "coalesce_wide_merge": """
SELECT o_orderkey AS detail_id,
       COALESCE(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, o_orderpriority)
         AS order_status,
       o_custkey AS user_id
FROM orders""",
    "visitor_stats": _visitors(_HOUR_US),
    "visitor_stats_2s": _visitors(2_000_000),
    "visitor_running_totals": f"""{_VISITOR_MEASURES}
SELECT vc, ch, ar, is_new, {_VISITOR_SUMS} FROM measures GROUP BY ALL""",
    "product_stats": f"""{_products(False)}
SELECT stt, edt, sku_id, sku_name, sku_price, {_ENRICHED}, display_ct, click_ct, favor_ct,
       cart_ct, order_sku_num, order_amount, order_ct, payment_amount, paid_order_ct,
       refund_order_ct, refund_amount, comment_ct, good_comment_ct
FROM stats LEFT JOIN skus ON sku_id = p_partkey""",
    "product_stats_single_row_quirk": f"""{_products(True)}
SELECT stt, sku_id, order_ct, paid_order_ct, refund_order_ct FROM stats""",
    "province_stats": f"""WITH {_WIDE}, {_PROVINCES}
SELECT {_bucket('o_orderdate', _DAY_US)} AS stt, {_bucket('o_orderdate', _DAY_US, 1)} AS edt,
       province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
       CAST(CAST(sum(split_total_amount) AS DECIMAL(26,2)) AS DOUBLE) AS order_amount,
       count(*) AS order_count
FROM wide JOIN provinces ON province_id = n_nationkey GROUP BY ALL""",
    "province_distinct_orders": f"""WITH {_WIDE}
SELECT {_bucket('o_orderdate', _DAY_US)} AS stt, province_id,
       count(DISTINCT order_id) AS order_count
FROM wide GROUP BY ALL""",
    "keyword_stats": f"""
SELECT keyword, count(*) AS ct, 'SEARCH' AS source, {_bucket('ts', _DAY_US)} AS stt,
       {_bucket('ts', _DAY_US, 1)} AS edt
FROM (SELECT unnest(string_split(p_name, ' ')) AS keyword, l_shipdate AS ts
      FROM lineitem JOIN part ON l_partkey = p_partkey)
GROUP BY ALL""",
    # Whatever is no letter, digit or mark becomes a space, and the rest is cut at spaces.
    "keyword_table_function": r"""
SELECT lang, keyword, count(*) AS ct
FROM (SELECT lang, unnest(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}\p{M}]', ' ', 'g'), ' ')) AS keyword FROM documents)
WHERE keyword <> '' GROUP BY ALL""",
    "keyword_dictionary": r"""
SELECT lang, keyword, count(*) AS ct
FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '\b(cc by-nc 4\.0|apache license|mit license|version 3)\b')) AS keyword FROM documents)
GROUP BY ALL""",
    # Each entry the best path takes becomes a word of its own ("the mit" and "license" cover more than "mit license").
    "keyword_smart": r"""
WITH marked AS (
  SELECT lang, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text),
    '\bapache license, version 2\.0\b', ' qqentryone ', 'g'),
    '\bthe apache\b', ' qqentrytwo ', 'g'),
    '\bthe mit\b', ' qqentryfive ', 'g'),
    '\bmit license\b', ' qqentrythree ', 'g'),
    '\blicense, version\b', ' qqentryfour ', 'g') AS text FROM documents)
SELECT lang, CASE keyword WHEN 'qqentryone' THEN 'apache license, version 2.0' WHEN 'qqentrytwo' THEN 'the apache'
  WHEN 'qqentrythree' THEN 'mit license' WHEN 'qqentryfour' THEN 'license, version' WHEN 'qqentryfive' THEN 'the mit' ELSE keyword END AS keyword,
  count(*) AS ct
FROM (SELECT lang, unnest(string_split(regexp_replace(text, '[^\p{L}\p{N}\p{M}]', ' ', 'g'), ' ')) AS keyword FROM marked)
WHERE keyword <> '' GROUP BY ALL""",
    "tumble_sql": f"""
SELECT {_bucket('ts', 2 * _HOUR_US)} AS stt, {_bucket('ts', 2 * _HOUR_US, 1)} AS edt, event_type,
       count(*) AS n
FROM events GROUP BY ALL""",
    "report_gmv": f"""{_SALES}
SELECT CAST(COALESCE(CAST(sum(total_amount) AS DECIMAL(26,2)), 0) AS DOUBLE) AS gmv FROM sales""",
    "report_gmv_empty_day": """
SELECT CAST(COALESCE(sum(o_totalprice), 0) AS DOUBLE) AS gmv
FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1900-01-01'""",
    "report_trademark": _top("tm_id, tm_name"),
    "report_category3": _top("category3_id, category3_name"),
    "report_spu": f"""{_SALES},
per_sku AS (
  SELECT spu_id, spu_name, sku_id, sum(total_amount) AS amount, count(DISTINCT order_id) AS cnt
  FROM sales GROUP BY ALL)
SELECT spu_id, spu_name, CAST(CAST(sum(amount) AS DECIMAL(26,2)) AS DOUBLE) AS order_amount,
       CAST(sum(cnt) AS BIGINT) AS order_ct
FROM per_sku GROUP BY spu_id, spu_name
HAVING sum(amount) > 0 ORDER BY sum(amount) DESC, spu_id, spu_name LIMIT 10""",
    "report_visitor_flag": f"{_FLAGS} SELECT * FROM flags",
    "report_visitor_ratios": f"""{_RATED}
SELECT is_new, uv_ct, pv_ct, sv_ct, uj_ct, dur_sum, CAST(uj_rate AS DOUBLE) AS uj_rate,
       CAST(dur_per_sv AS DOUBLE) AS dur_per_sv, CAST(pv_per_sv AS DOUBLE) AS pv_per_sv
FROM rated""",
    "report_visitor_pivot": f"{_RATED} "
    + " UNION ALL ".join(
        f"SELECT CAST({line} AS INTEGER) AS line, '{label}' AS type, "
        f"CAST(COALESCE(max(CASE WHEN is_new = '1' THEN {col} END), 0) AS DOUBLE) AS \"new\", "
        f"CAST(COALESCE(max(CASE WHEN is_new <> '1' THEN {col} END), 0) AS DOUBLE) AS \"old\" "
        f"FROM rated"
        for line, label, col in _PIVOT_LINES
    ),
    "report_hour": f"{_HOURS} SELECT * FROM hours",
    "report_hour_dense": f"""{_HOURS}
SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hr, COALESCE(uv_ct, 0) AS uv_ct,
       COALESCE(pv_ct, 0) AS pv_ct, COALESCE(new_uv, 0) AS new_uv
FROM range(24) AS r(h) LEFT JOIN hours ON h = hr""",
    "report_province": f"""WITH {_WIDE}, {_PROVINCES}
SELECT province_name,
       CAST(CAST(sum(split_total_amount) AS DECIMAL(26,2)) AS DOUBLE) AS order_amount
FROM wide JOIN provinces ON province_id = n_nationkey
WHERE CAST(o_orderdate AS DATE) = DATE '{_day(ORDER_DAY)}'
GROUP BY province_id, province_name""",
    "report_keyword_weighted": f"""
SELECT keyword, ct FROM (
  SELECT keyword, CAST(sum(weight) AS BIGINT) AS ct, count(*) AS plain
  FROM (SELECT unnest(string_split(p_name, ' ')) AS keyword,
               CASE l_returnflag WHEN 'A' THEN 10 WHEN 'N' THEN 2 ELSE 1 END AS weight
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE CAST(l_shipdate AS DATE) = DATE '{_day(ORDER_DAY)}')
  GROUP BY keyword ORDER BY plain DESC, keyword LIMIT 20)""",
    "report_chart_json": f"""{_HOURS},
dense AS (
  SELECT h, lpad(CAST(h AS VARCHAR), 2, '0') AS hr, COALESCE(uv_ct, 0) AS uv_ct,
         COALESCE(pv_ct, 0) AS pv_ct, COALESCE(new_uv, 0) AS new_uv
  FROM range(24) AS r(h) LEFT JOIN hours ON h = hr)
SELECT '{{"status":0,"data":{{"categories":["' || string_agg(hr, '","' ORDER BY h) ||
  '"],"series":[{{"name":"uv_ct","data":[' || string_agg(uv_ct, ',' ORDER BY h) ||
  ']}},{{"name":"pv_ct","data":[' || string_agg(pv_ct, ',' ORDER BY h) ||
  ']}},{{"name":"new_uv","data":[' || string_agg(new_uv, ',' ORDER BY h) || ']}}]}}}}' AS chart
FROM dense""",
}



def _top_chart(keys: str, name: str, document: str, more: str = "") -> str:
    return f"""{_SALES},
top AS (
  SELECT {keys}, {name} AS n, CAST(sum(total_amount) AS DECIMAL(26,2)) AS v{more} FROM sales GROUP BY {keys}
  HAVING sum(total_amount) > 0 ORDER BY sum(total_amount) DESC, {keys} LIMIT 10)
SELECT '{{"status":0,"data":' || {document} || '}}' AS chart FROM top"""


ORACLES["report_chart_trademark"] = _top_chart(
    "tm_id, tm_name",
    "tm_name",
    """'{"categories":[' || coalesce(string_agg('"' || n || '"', ',' ORDER BY v DESC, n), '') ||
  '],"series":[{"name":"order_amount","data":[' || coalesce(string_agg(v, ',' ORDER BY v DESC, n), '') || ']}]}'""",
)
ORACLES["report_chart_category3"] = _top_chart(
    "category3_id, category3_name",
    "category3_name",
    """'[' || coalesce(string_agg('{"name":"' || n || '","value":' || v || '}', ',' ORDER BY v DESC, n), '') || ']'""",
)
ORACLES["report_chart_spu"] = _top_chart(
    "spu_id, spu_name",
    "spu_name",
    """'{"columns":[{"name":"SPU","id":"spu_name"},{"name":"amount","id":"order_amount"},{"name":"orders","id":"order_ct"}],"rows":[' ||
  coalesce(string_agg('{"spu_name":"' || n || '","order_amount":' || v || ',"order_ct":' || ct || '}', ',' ORDER BY v DESC, n), '') || ']}'""",
    ", count(DISTINCT order_id || '/' || sku_id) AS ct",
)
ORACLES["report_chart_gmv"] = f"""{_SALES}
SELECT '{{"status":0,"data":' || COALESCE(CAST(sum(total_amount) AS DECIMAL(26,2)), 0) || '}}' AS chart FROM sales"""

# The streaming forms give what the batch forms give.
ORACLES.update(
    {
        "stream_repair_is_new": ORACLES["repair_is_new"],
        "stream_daily_unique_visit": f"""WITH {_PAGES}, {_UNIQUES}
SELECT mid, strftime(ts, '%Y-%m-%d') AS visit_date FROM uniques""",
        "stream_bounce_detect": ORACLES["bounce_detect"],
        "stream_visitor_stats": ORACLES["visitor_stats"],
        "stream_order_wide": ORACLES["order_wide_interval"],
        "stream_province_stats": f"""WITH {_WIDE}
SELECT {_bucket('o_orderdate', _DAY_US)} AS stt, {_bucket('o_orderdate', _DAY_US, 1)} AS edt,
       province_id, CAST(CAST(sum(split_total_amount) AS DECIMAL(26,2)) AS DOUBLE) AS order_amount,
       count(*) AS order_count
FROM wide
WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 5 DAY
GROUP BY ALL""",
        "stream_keyword_stats": ORACLES["keyword_stats"],
        "stream_payment_wide": ORACLES["payment_wide_interval"],
        "stream_product_stats": ORACLES["product_stats"],
    }
)
ORACLES.update(
    {
        f"stored_report_{name}": ORACLES[f"report_{same}"]
        for name, same in [
            ("gmv", "gmv"), ("trademark", "trademark"), ("category3", "category3"), ("spu", "spu"),
            ("visitor", "visitor_pivot"), ("hr", "hour_dense"), ("province", "province"),
        ]
    }
)
ORACLES["stored_report_keyword"] = ORACLES["report_keyword_weighted"].replace(
    "WHEN 'N' THEN 2 ELSE 1 END", "WHEN 'N' THEN 2 ELSE CASE l_linenumber WHEN 1 THEN 3 ELSE 1 END END"
)
ORACLES["stream_running_totals"] = ORACLES["visitor_running_totals"]
ORACLES["stream_asof_enrich"] = ORACLES["asof_enrich"]
ORACLES["job_log_base"] = f"""WITH {_RAW_LOG},
fixed AS (
  SELECT mid, ch, CASE WHEN is_new = '1' AND rn > 1 THEN '0' ELSE is_new END AS is_new
  FROM (SELECT *, row_number() OVER (PARTITION BY mid, is_new ORDER BY epoch_ms(ts), event_id) AS rn FROM good))
SELECT CASE ch WHEN 'error' THEN 'dwd_start_log' ELSE 'dwd_page_log' END AS topic, mid, is_new, count(*) AS n FROM fixed GROUP BY ALL
UNION ALL SELECT 'dwd_display_log', NULL, NULL, 2 * count(*) FROM fixed WHERE ch = 'view' HAVING count(*) > 0
UNION ALL SELECT 'ods_base_log_dirty', NULL, NULL, count(*) FROM raw WHERE broken HAVING count(*) > 0"""
# The rules change before the second and the third part: new order rule; no more user rule, but one for deletes.
ORACLES["job_db_base"] = """
WITH changes AS (
  SELECT 'order_info' AS t, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'insert' ELSE 'update' END AS op, o_orderkey AS id,
         o_orderkey * 3 // (SELECT max(o_orderkey) + 1 FROM orders) AS part
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
  UNION ALL
  SELECT 'user_info', CASE c_mktsegment WHEN 'BUILDING' THEN 'delete' ELSE 'insert' END, c_custkey,
         c_custkey * 3 // (SELECT max(c_custkey) + 1 FROM customer)
  FROM customer),
placed AS (
  SELECT id, CASE
    WHEN t = 'order_info' AND op = 'insert' THEN CASE part WHEN 0 THEN 'dwd_order_info' ELSE 'dwd_order_new' END
    WHEN t = 'order_info' THEN 'dim_order_info'
    WHEN op = 'insert' AND part < 2 THEN 'dim_user_info'
    WHEN op = 'delete' AND part = 2 THEN 'dwd_user_gone' ELSE 'ods_base_db_unrouted' END AS place
  FROM changes)
SELECT place, CASE place WHEN 'dwd_order_info' THEN 'id,total_amount,user_id' WHEN 'dwd_order_new' THEN 'id,note'
    WHEN 'dwd_user_gone' THEN 'id' WHEN 'dim_order_info' THEN 'id,status' WHEN 'dim_user_info' THEN 'id,name' END AS fields,
  count(*) AS n, CAST(sum(id) AS BIGINT) AS ids
FROM placed GROUP BY ALL"""


def _document(rows: str, head: str, tail: str, order: str, source: str) -> str:
    return f"""SELECT '{{"status":0,"data":{head}' || coalesce(string_agg({rows}, ',' ORDER BY {order}), '') || '{tail}}}' AS chart FROM ({source})"""


_CENTS = "CAST(CAST({} AS DECIMAL(20,2)) AS VARCHAR)"
ORACLES["report_chart_province"] = _document(
    """'{"name":"' || province_name || '","value":' || """ + _CENTS.format("order_amount") + " || '}'",
    '{"mapData":[', "]}", "province_name", ORACLES["report_province"],
)
ORACLES["report_chart_visitor"] = _document(
    """'{"type":"' || type || '","new":' || """ + _CENTS.format("new") + """ || ',"old":' || """ + _CENTS.format("old") + " || '}'",
    '{"columns":[{"name":"type","id":"type"},{"name":"new","id":"new"},{"name":"old","id":"old"}],"rows":[', "]}", "line",
    ORACLES["report_visitor_pivot"],
)
ORACLES["report_chart_keyword"] = _document(
    """'{"name":"' || keyword || '","value":' || ct || '}'""", "[", "]", "plain DESC, keyword",
    ORACLES["stored_report_keyword"].replace("SELECT keyword, ct", "SELECT keyword, ct, plain", 1),
)
