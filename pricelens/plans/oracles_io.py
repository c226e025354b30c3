"""DuckDB oracles for source / sink / join / stream queries."""

from __future__ import annotations

from .fixtures import RAW_LISTING_CTE
from .html_fixtures import pages_cte
from .oracles import CLEAN_SELECT, ROWS_CTE, oracle
from .oracles_html import STORE_B_CARDS, rx

RAW_COLS = "date, category, sub_category, prd_name, prd_brand, prd_price, prd_per_price, prd_discount, prd_link, prd_img"
STORES3 = "CASE {x} % 3 WHEN 0 THEN 'Loblaws' WHEN 1 THEN 'HMart' ELSE 'Metro' END"
CLEAN_ORACLE = f"WITH {ROWS_CTE} SELECT {CLEAN_SELECT} FROM firsts WHERE reject_reason IS NULL"

# an empty cell is a missing value in a CSV file
CELLS = ", ".join(f"NULLIF({c}, '') AS {c}" for c in RAW_COLS.split(", "))
oracle("csv_scan", f"WITH {RAW_LISTING_CTE} SELECT {CELLS} FROM raw_listing")
oracle("file_stream", f"WITH {RAW_LISTING_CTE} SELECT {CELLS} FROM raw_listing")
oracle(
    "csv_wide",
    """WITH p AS (SELECT *, p_partkey % 3 = 0 AS short, p_partkey % 3 <> 0 AND p_partkey % 5 = 0 AS long FROM part)
SELECT '/p/' || p_partkey AS prd_link, CASE WHEN NOT short THEN p_name || ', "x"' END AS prd_name,
  CASE WHEN NOT short THEN '00' || p_partkey % 7 END AS w2, CASE WHEN NOT short THEN '00' || p_partkey % 7 END AS w35, CASE WHEN NOT short THEN '00' || p_partkey % 7 END AS w38,
  CAST(CASE WHEN long THEN 41 ELSE 40 END AS INTEGER) AS n_cells, long AS malformed, CASE WHEN long THEN 'columns' ELSE 'date' END AS reject_reason,
  CASE WHEN long THEN 'beyond' END AS beyond
FROM p""",
)
oracle(
    "named_files",
    f"""WITH {RAW_LISTING_CTE}
SELECT 'Loblaws/Loblaws_2023-11-16_' || CAST(shard AS VARCHAR) || '.csv' AS object_key, 'Loblaws' AS name_store, DATE '2023-11-16' AS name_day,
  CAST(shard AS INTEGER) AS shard, {CELLS} FROM raw_listing""",
)
oracle(
    "page_bytes",
    f"""WITH c AS (SELECT * FROM (VALUES ('utf8', 'utf-8'), ('bom', 'utf-8'), ('latin1', 'cp1252'), ('utf16', 'utf-16-be')) t(copy, charset))
SELECT page_id, copy, charset, {rx('<title>(.*?)</title>')} AS title, {rx('<h1>(.*?)</h1>')} AS h1,
  CAST(len(regexp_extract_all(html, '<a ')) AS BIGINT) AS n_links, {rx('<footer>(.*?)</footer>')} AS footer FROM pages, c""",
)
STORE_OF = STORES3.format(x="shard")
oracle(
    "path_columns",
    f"""WITH {RAW_LISTING_CTE}, f AS (
  SELECT {STORE_OF} AS store, replace(split_part(file, '/', 2), 'Loblaws', {STORE_OF}) AS file_name, shard, count(*) AS n_rows FROM raw_listing GROUP BY ALL
)
SELECT store, file_name, store || '/' || file_name AS object_key, store AS name_store,
  CAST(split_part(file_name, '_', 2) AS DATE) AS name_day, CAST(shard AS INTEGER) AS shard, n_rows FROM f""",
)
oracle("csv_roundtrip", CLEAN_ORACLE)
oracle("partitioned_write", CLEAN_ORACLE)


def _json_field(name: str, expr: str, quote: bool) -> str:
    val = f"to_json({expr})" if quote else f"CAST({expr} AS VARCHAR)"
    return f"'\"{name}\":' || coalesce({val}, 'null')"


oracle(
    "json_records",
    f"""WITH {ROWS_CTE}
SELECT prd_id_in_store, '{{' || {_json_field('store', 'store', True)} || ',' || {_json_field('prd_id_in_store', 'prd_id_in_store', True)}
  || ',' || {_json_field('scrap_date', 'CAST(scrap_date AS VARCHAR)', True)} || ',' || {_json_field('prd_price', 'prd_price', False)}
  || ',' || {_json_field('prd_brand', 'prd_brand', True)} || ',' || {_json_field('on_sale_cat', 'on_sale_cat', True)}
  || ',' || {_json_field('average_unit', 'average_unit', True)} || '}}' AS record
FROM firsts WHERE reject_reason IS NULL""",
)
oracle(
    "upsert_by_key",
    """SELECT p_partkey AS k, p_name, CAST(p_retailprice AS DECIMAL(12,2)) AS price, 1 AS version
FROM part WHERE p_partkey % 3 <> 0
UNION ALL
SELECT p_partkey AS k, p_name, CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 2 AS DECIMAL(12,2)) AS price, 3 AS version
FROM part WHERE p_partkey % 3 = 0""",
)
STORE5 = "CASE p_partkey % 5 WHEN 0 THEN 'Loblaws' WHEN 1 THEN 'HMart' WHEN 2 THEN 'Metro' WHEN 3 THEN 'NoFrills' ELSE 'Costco' END"
oracle(
    "store_lookup",
    f"""WITH s AS (SELECT p_partkey AS k, {STORE5} AS store FROM part),
d AS (SELECT * FROM (VALUES
  ('Loblaws', 'https://www.loblaws.ca/', 14), ('HMart', 'https://www.hmart.com/', 12),
  ('Metro', 'https://www.metro.ca/en/online-grocery/aisles', 16), ('NoFrills', 'https://www.nofrills.ca/', NULL)) t(store, site, n_shards))
SELECT k, s.store, site, CAST(n_shards AS INTEGER) AS n_shards FROM s LEFT JOIN d ON s.store = d.store""",
)
oracle(
    "store_config",
    """SELECT s_suppkey, n_name, CASE n_nationkey % 3 WHEN 0 THEN 'https://' || lower(n_name) || '.example/a#b' WHEN 1 THEN 'https://' || lower(n_name) || '.example/' END AS site
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
oracle("unknown_store", f"SELECT p_partkey AS k, {STORE5} AS store FROM part WHERE p_partkey % 5 = 4")
SHARD = "(CAST(FLOOR(k / 2) AS BIGINT) % 7 + 2)"
oracle(
    "clean_dispatch",
    f"""WITH {ROWS_CTE}, m AS (SELECT *, {STORES3.format(x=SHARD)} AS st FROM firsts), r AS (SELECT *, {STORES3.format(x=SHARD)} AS st FROM rows),
n AS (SELECT k AS nk, prd_name AS raw_name FROM raw_listing),
x AS (SELECT *, CASE WHEN reject_reason IS NOT NULL THEN true ELSE false END AS bad FROM m JOIN n ON k = nk)
SELECT file, pos, st AS store, prd_id_in_store, prd_price, reject_reason, CASE WHEN bad THEN raw_date END AS raw_date,
  CASE WHEN bad THEN raw_price END AS raw_price, CASE WHEN bad THEN prd_link END AS raw_link, CASE WHEN bad THEN raw_name END AS raw_name
FROM x WHERE st = 'Loblaws'
UNION ALL
SELECT replace(file, 'Loblaws', st), pos, st, NULL, NULL, 'unknown_store', raw_date, raw_price, prd_link, raw_name
FROM r JOIN n ON k = nk WHERE st <> 'Loblaws'""",
)
oracle(
    "union_stores",
    f"""WITH {ROWS_CTE}, {pages_cte('store_b_listing')}, cards AS ({STORE_B_CARDS}),
b AS (SELECT *, TRY_CAST(substr(price, 2) AS DECIMAL(12,2)) AS p, TRY_CAST(substr(org, 2) AS DECIMAL(12,2)) AS o FROM cards
  WHERE has_page AND has_price AND pid IS NOT NULL)
SELECT store, prd_id_in_store, scrap_date, prd_name, prd_price, CAST(NULL AS DECIMAL(12,2)) AS org_price, prd_discount,
  CAST(NULL AS BOOLEAN) AS is_discounted, on_sale_cat, category, NULL AS prd_url, prd_link, NULL AS reject_reason, NULL AS raw_price
FROM firsts WHERE reject_reason IS NULL
UNION ALL
SELECT 'HMart', pid, day, p_name, p, o, NULL, on_sale, CASE WHEN on_sale THEN 'SAVING' END, category, prd_url, NULL,
  CASE WHEN p IS NULL THEN 'price' END, CASE WHEN p IS NULL THEN price END
FROM b""",
)
oracle(
    "worklist",
    """WITH s AS (SELECT * FROM (VALUES ('HMart'), ('Loblaws'), ('Metro')) t(store)),
sh AS (
  SELECT 'HMart' AS store, unnest([1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 12, 13]) AS shard
  UNION ALL SELECT 'Loblaws', unnest(generate_series(2, 15))
  UNION ALL SELECT 'Metro', unnest(generate_series(0, 15))
)
SELECT store, CAST(shard AS INTEGER) AS shard, 'daily_scrapping_' || store || '_' || CAST(shard AS VARCHAR) AS job_name FROM sh""",
)
oracle(
    "union_open_schema",
    f"""WITH {ROWS_CTE}, b AS (SELECT p_partkey AS k, p_name FROM part)
SELECT store, prd_id_in_store, prd_name, prd_price, CAST(NULL AS DECIMAL(12,2)) AS org_price, NULL AS origin, CAST(NULL AS BOOLEAN) AS organic,
  CAST(NULL AS INTEGER) AS weight, CAST(NULL AS BIGINT) AS kcal, on_sale_cat, NULL AS org_price_text, on_sale_cat IS NULL AS nothing_extra
FROM firsts WHERE reject_reason IS NULL
UNION ALL
SELECT 'HMart', CAST(k AS VARCHAR), p_name, CAST(2.50 AS DECIMAL(12,2)), CASE WHEN k % 3 = 2 AND k % 2 = 1 THEN CAST(1.50 AS DECIMAL(12,2)) END,
  CASE WHEN k % 3 = 0 THEN 'Origin ' || CAST(k % 7 AS VARCHAR) END, CASE WHEN k % 3 = 1 THEN k % 2 = 0 END, CAST(CASE WHEN k % 3 = 1 THEN k % 900 END AS INTEGER),
  CASE WHEN k % 3 = 2 THEN CAST(k % 500 AS BIGINT) END, NULL, CASE WHEN k % 3 = 2 AND k % 2 = 0 THEN 'ask' END, false FROM b""",
)
# by store A's rules for the batch; of the three stores' files only store A's rows are cleaned
QUALITY = ["product_id", "date", "price", "parts", "unit_prices", "unit", "columns", "unknown_store"]


def _figures(run: str, rows: str, firsts: str, reason: str) -> str:
    out = [f"SELECT '{run}' AS run, 'rows_in' AS figure, count(*) AS n FROM {rows}", f"SELECT '{run}', 'duplicates', (SELECT count(*) FROM {rows}) - (SELECT count(*) FROM {firsts})"]
    out.append(f"SELECT '{run}', 'kept', count(*) FROM {firsts} WHERE {reason} IS NULL")
    out += [f"SELECT '{run}', 'reject:{r}', count(*) FROM {firsts} WHERE {reason} = '{r}'" for r in QUALITY]
    return " UNION ALL ".join([*out, f"SELECT '{run}', 'reject:other', 0"])


oracle(
    "quality_figures",
    f"""WITH {ROWS_CTE}, s AS (
  SELECT reject_reason AS reason FROM firsts WHERE {STORES3.format(x=SHARD)} = 'Loblaws'
  UNION ALL SELECT 'unknown_store' FROM rows WHERE {STORES3.format(x=SHARD)} <> 'Loblaws')
{_figures('batch', 'rows', 'firsts', 'reject_reason')} UNION ALL {_figures('stream', 'rows', 's', 'reason')}""",
)
CLEAN_NAMES = CLEAN_SELECT.split(", ")
IDS = ", ".join(c if c in ("store", "prd_id_in_store", "scrap_date") else f"NULL AS {c}" for c in CLEAN_NAMES)
UNKNOWN = ", ".join("st AS store" if c == "store" else f"NULL AS {c}" for c in CLEAN_NAMES)
oracle(
    "stream_clean_upsert",
    f"""WITH {ROWS_CTE}, m AS (SELECT *, {STORES3.format(x=SHARD)} AS st FROM firsts), r AS (SELECT *, {STORES3.format(x=SHARD)} AS st FROM rows)
SELECT {CLEAN_SELECT}, NULL AS reject_reason, NULL AS raw_price, NULL AS raw_link FROM m WHERE st = 'Loblaws' AND reject_reason IS NULL
UNION ALL SELECT {IDS}, reject_reason, raw_price, prd_link FROM m WHERE st = 'Loblaws' AND reject_reason IS NOT NULL
UNION ALL SELECT {UNKNOWN}, 'unknown_store', raw_price, prd_link FROM r WHERE st <> 'Loblaws'""",
)
oracle("replay_idempotent", CLEAN_ORACLE)
FAILURES = f"""SELECT event_id, ts, 'FAILED' AS status,
  'daily_scrapping_' || {STORES3.format(x='user_id')} || '_' || CAST(user_id % 16 AS VARCHAR) AS job_name
FROM events WHERE event_type = 'error' AND user_id % 10 <> 0"""
oracle("failure_alerts", FAILURES)
oracle("alerts_once", FAILURES)  # however often an event was delivered
oracle("json_roundtrip", CLEAN_ORACLE)
