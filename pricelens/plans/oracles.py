"""DuckDB oracle SQL per registered query.

The oracles start from the same raw text (``RAW_LISTING_CTE``) and either
parse it with DuckDB's own functions or go straight to the known answer
from the integers the text was built from (exact HALF_UP arithmetic on
integers where Spark rounds decimals).
"""

from __future__ import annotations

from ..schemas import NA_WORDS
from .fixtures import BAD_DATE, RAW_LISTING_CTE, THIRD_PRICE, money, raw_listing_cte

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


NA_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in NA_WORDS)


def na(x: str) -> str:
    return f"CASE WHEN {x} IN ({NA_LIST}) THEN NULL ELSE {x} END"


def dbl_text(x: str) -> str:
    """Integer hundredths -> the text of the double (``'997.5'``)."""
    return f"CAST(CAST({x} AS DOUBLE) / 100 AS VARCHAR)"


WS = "[\\s\\x{a0}]"  # the blanks that occur in the text
FIRST_LINE = f"split_part({na('prd_discount')}, chr(10), 1)"
PID = "CASE WHEN k % 53 = 52 OR k % 59 = 58 THEN NULL ELSE CAST(CAST(FLOOR(k / 2) AS BIGINT) AS VARCHAR) || '_EA' END"
PRICE_OK = "NOT (k % 41 = 40 OR k % 43 = 42)"

def rows_cte(source: str = "part") -> str:
    """Expected cleaned value of every raw row (``rows``) and the rows kept
    by keep-first (``firsts``)."""
    return raw_listing_cte(source) + _ROWS_BODY


_ROWS_BODY = (
    f""",
rows AS (
  SELECT k, file, pos,
    CASE WHEN NOT ({BAD_DATE}) THEN CAST(date AS DATE) END AS scrap_date, category, sub_category,
    regexp_replace(prd_name, '\\({WS}*ID required at pick-up{WS}*\\)', '', 'g') AS prd_name,
    {na('prd_brand')} AS prd_brand,
    CASE WHEN {PRICE_OK} THEN CAST(CAST(cents AS DOUBLE) / 100 AS DECIMAL(12,2)) END AS prd_price,
    {FIRST_LINE} AS prd_discount,
    prd_link, prd_img, prd_price AS raw_price, prd_per_price AS raw_per_price, date AS raw_date,
    {PID} AS prd_id_in_store,
    'Loblaws' AS store,
    CASE WHEN contains({FIRST_LINE}, 'SAVE') THEN 'SAVING' WHEN contains({FIRST_LINE}, 'MIN') THEN 'MULTI'
         WHEN contains({FIRST_LINE}, 'Member') THEN 'MEMBER' WHEN contains({FIRST_LINE}, 'Points') THEN 'POINT' END AS on_sale_cat,
    CASE k % 6
      WHEN 0 THEN CAST(amt * 100 AS VARCHAR) || ' g'
      WHEN 1 THEN CASE WHEN {PRICE_OK} THEN {dbl_text('(2 * cents * 100 + u) // (2 * u)')} || ' kg' END
      WHEN 2 THEN '1 ea'
      WHEN 3 THEN CAST(amt * 50 AS VARCHAR) || ' ml'
      WHEN 4 THEN CASE WHEN {PRICE_OK} THEN {dbl_text('(2 * cents * 10000 + u) // (2 * u)')} || ' g' END
    END AS average_unit,
    CASE k % 6
      WHEN 0 THEN '$' || {money('u')} || '/100g'
      WHEN 1 THEN '$' || {money('u')} || '/1kg'
      WHEN 2 THEN '$1.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || '/1ea'
      WHEN 3 THEN CASE WHEN {PRICE_OK} THEN '$ ' || {dbl_text('cents')} || ' / ' || CAST(amt * 50 AS VARCHAR) || ' ml' END
      WHEN 4 THEN '$' || {money('u')} || '/100g'
    END AS price_per_unit_1,
    CASE WHEN k % 6 = 1 THEN '$' || {money('u2')} || '/1lb' END AS price_per_unit_2,
    CASE WHEN {PID} IS NULL THEN 'product_id'
         WHEN {BAD_DATE} THEN 'date'
         WHEN NOT ({PRICE_OK}) THEN 'price'
         WHEN k % 6 = 5 AND k % 4 = 1 THEN 'parts'
         WHEN {THIRD_PRICE} THEN 'unit_prices'
         WHEN k % 6 = 5 AND k % 4 IN (2, 3) THEN 'unit' END AS reject_reason
  FROM raw_listing
),
firsts AS (
  SELECT * FROM rows WHERE prd_id_in_store IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY file, prd_id_in_store ORDER BY pos) = 1
  UNION ALL SELECT * FROM rows WHERE prd_id_in_store IS NULL
)"""
)
ROWS_CTE = rows_cte("part")

CLEAN_SELECT = (
    "scrap_date, category, sub_category, prd_name, prd_brand, prd_price, prd_discount, prd_link, prd_img, "
    "prd_id_in_store, store, on_sale_cat, average_unit, price_per_unit_1, price_per_unit_2"
)

oracle("clean_listings", f"WITH {ROWS_CTE} SELECT {CLEAN_SELECT} FROM firsts WHERE reject_reason IS NULL")
oracle("clean_listings_lines", f"WITH {rows_cte('lineitem')} SELECT {CLEAN_SELECT} FROM firsts WHERE reject_reason IS NULL")
oracle(
    "product_id",
    f"WITH {RAW_LISTING_CTE} SELECT k, prd_link, NULLIF(regexp_extract(prd_link, '/(\\w+)$', 1), '') AS prd_id_in_store FROM raw_listing",
)
oracle("promo_category", f"WITH {ROWS_CTE} SELECT k, prd_discount, on_sale_cat FROM rows")
oracle(
    "parse_price",
    f"WITH {RAW_LISTING_CTE} SELECT k, prd_price AS prd_price_text, "
    f"TRY_CAST(NULLIF(regexp_extract(prd_price, '\\$(.*)', 1), '') AS DECIMAL(12,2)) AS prd_price FROM raw_listing",
)
oracle(
    "unit_price",
    f"""WITH {RAW_LISTING_CTE}, s AS (
  SELECT k, string_split(prd_per_price, ',') AS a FROM raw_listing WHERE prd_per_price IS NOT NULL
), t AS (
  SELECT k, CAST(len(a) AS INTEGER) AS n_parts, CASE WHEN NOT contains(a[1], '$') THEN a[1] END AS unit_part,
    trim(coalesce(CASE WHEN len(a) = 3 THEN a[2] || '.' || replace(a[3], '.', '') WHEN len(a) = 2 THEN a[2] END, a[1])) AS pt
  FROM s
), v AS (
  SELECT k, n_parts, unit_part, CASE WHEN contains(pt, '$') THEN pt END AS price_part FROM t
), w AS (
  SELECT *, regexp_split_to_array(price_part, '{WS}+') AS toks FROM v
), x AS (
  SELECT k, n_parts, unit_part, price_part, toks[1] AS price_per_unit_1,
    CASE WHEN len(toks) >= 2 THEN toks[2] END AS price_per_unit_2 FROM w
)
SELECT *,
  TRY_CAST(NULLIF(regexp_extract(price_per_unit_1, '\\$(.*?)/(\\d+)(\\w+)', 1), '') AS DECIMAL(12,4)) AS unit_price,
  TRY_CAST(NULLIF(regexp_extract(price_per_unit_1, '\\$(.*?)/(\\d+)(\\w+)', 2), '') AS DECIMAL(8,0)) AS unit_base,
  NULLIF(regexp_extract(price_per_unit_1, '\\$(.*?)/(\\d+)(\\w+)', 3), '') AS unit_word
FROM x""",
)
oracle("average_unit", f"WITH {ROWS_CTE} SELECT k, prd_price, average_unit FROM firsts WHERE reject_reason IS NULL")
oracle(
    "unit_price_text",
    f"WITH {ROWS_CTE} SELECT k, price_per_unit_1, price_per_unit_2 FROM firsts WHERE reject_reason IS NULL",
)
oracle("na_words", f"WITH {ROWS_CTE} SELECT k, prd_brand, prd_discount FROM rows")
oracle(
    "clean_name",
    f"WITH {RAW_LISTING_CTE} SELECT k, regexp_replace(prd_name, '\\({WS}*ID required at pick-up{WS}*\\)', '', 'g') AS prd_name FROM raw_listing",
)
oracle(
    "rejects",
    f"WITH {ROWS_CTE} SELECT file, pos, prd_id_in_store, reject_reason, raw_date, raw_price, raw_per_price, prd_link AS raw_link FROM firsts WHERE reject_reason IS NOT NULL",
)
oracle(
    "record_id",
    f"WITH {ROWS_CTE} SELECT store, prd_id_in_store, scrap_date, "
    "sha256(concat_ws('|', store, prd_id_in_store, CAST(scrap_date AS VARCHAR))) AS record_id "
    "FROM firsts WHERE reject_reason IS NULL",
)
LOCAL_TS = "timezone('America/Toronto', timezone('UTC', ts))"
oracle(
    "processing_time",
    f"""WITH e AS (SELECT event_id, ts, {LOCAL_TS} AS lt FROM events),
f AS (SELECT event_id, lt, date_diff('minute', ts, lt) AS om FROM e)
SELECT event_id,
  strftime(lt, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN strftime(lt, '%f') <> '000000' THEN '.' || strftime(lt, '%f') ELSE '' END
  || CASE WHEN om < 0 THEN '-' ELSE '+' END
  || lpad(CAST(abs(om) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs(om) % 60 AS VARCHAR), 2, '0') AS processing_time
FROM f""",
)
oracle(
    "scrape_day",
    f"SELECT event_id, CAST({LOCAL_TS} AS DATE) AS scrap_date, CAST(ts - INTERVAL 5 HOUR AS DATE) AS file_day FROM events",
)
oracle(
    "dedup_first",
    f"""WITH {RAW_LISTING_CTE}, r AS (
  SELECT file, pos, NULLIF(regexp_extract(prd_link, '/(\\w+)$', 1), '') AS prd_id_in_store FROM raw_listing
)
SELECT file, prd_id_in_store, min(pos) AS pos FROM r WHERE prd_id_in_store IS NOT NULL GROUP BY ALL""",
)
oracle(
    "part_width",
    f"""WITH {RAW_LISTING_CTE}, s AS (
  SELECT file, string_split({na('prd_per_price')}, ',') AS a FROM raw_listing
), t AS (
  SELECT file, a, trim(coalesce(CASE WHEN len(a) = 3 THEN a[2] || '.' || replace(a[3], '.', '') WHEN len(a) = 2 THEN a[2] END, a[1])) AS pt FROM s
)
SELECT file, CAST(max(len(a)) AS INTEGER) AS max_comma_parts,
  CAST(max(CASE WHEN contains(pt, '$') THEN len(regexp_split_to_array(pt, '{WS}+')) END) AS INTEGER) AS max_price_tokens,
  count(*) AS n_rows
FROM t GROUP BY file""",
)


def all_oracles() -> dict[str, str]:
    from . import oracles_html, oracles_io  # noqa: F401

    return dict(ORACLES)
