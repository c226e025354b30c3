"""DuckDB oracles for the HTML queries.

Pages from ``part``: the answer follows from the integers the page was
built from. Driver ``pages``: regex extraction plus entity decoding of the
entities that occur there.
"""

from __future__ import annotations

from .fixtures import money
from .html_fixtures import DAMAGED_CARDS, DAMAGED_PAGE, PER_PRICE, pages_cte
from .oracle_clean_sql import clean_sql
from .oracles import CLEAN_SELECT, oracle


def decode(x: str) -> str:
    """Decode the entities that occur in ``pages``; like HTML, these legacy
    names are also decoded without the closing semicolon."""
    out = x
    for ent, ch in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        out = f"regexp_replace({out}, '&{ent};?', '{ch}', 'g')"
    return out


def rx(pattern: str) -> str:
    return decode(f"regexp_extract(html, '(?s){pattern}', 1)")


oracle("page_scan", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages")
oracle(
    "html_first_text",
    f"""SELECT page_id, {rx('<title>(.*?)</title>')} AS title, {rx('<h1>(.*?)</h1>')} AS h1,
  {rx('<div class="ad">(.*?)</div>')} AS ad, {rx('<footer>(.*?)</footer>')} AS footer,
  CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS VARCHAR) AS reject_reason FROM pages""",
)
oracle(
    "html_attr",
    f"""WITH l AS (
  SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hs,
         regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS ts FROM pages
), u AS (
  SELECT page_id, url, unnest(generate_series(0, len(hs) - 1)) AS ord, unnest(hs) AS href, unnest(ts) AS t FROM l
)
SELECT page_id, CAST(ord AS INTEGER) AS ord, {decode('href')} AS href, {decode('t')} AS text,
  regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1) || {decode('href')} AS link FROM u""",
)
oracle("cards_per_page", "SELECT page_id, CAST(len(regexp_extract_all(html, '<li>')) AS BIGINT) AS n_cards FROM pages")

J2 = "(SELECT 0 AS j UNION ALL SELECT 1)"
CARD_ROWS = f"""SELECT page_id, url, k, shard, CAST(j AS INTEGER) AS card, p_brand AS category, p_type AS sub_category,
  CASE WHEN k % 97 = 96 AND j = 1 THEN NULL ELSE (CASE WHEN k % 11 = 0 THEN p_name || ' & co' ELSE p_name END) || ' ' || CAST(j AS VARCHAR) END AS prd_name,
  CASE WHEN k % 3 = 0 THEN NULL ELSE p_brand END AS prd_brand,
  CASE WHEN (k + j) % 2 = 0 THEN '$' || {money('cents')} ELSE '$' || {money('cents - 50')} END AS prd_price,
  CASE WHEN k % 29 = 28 AND j = 0 THEN NULL ELSE coalesce({PER_PRICE}, '') END AS prd_per_price,
  CASE WHEN k % 5 = 1 THEN 'SAVE $1.00' || chr(10) || 'limit 2' END AS prd_discount,
  'https://www.loblaws.ca/a/p/' || CAST(CASE WHEN j = 1 AND k % 10 = 5 THEN k - 1 ELSE k END AS VARCHAR) || CAST(j AS VARCHAR) || '_EA' AS prd_link,
  CASE WHEN (k + j) % 4 = 0 THEN NULL ELSE 'https://img.example/' || CAST(k AS VARCHAR) || '_' || CAST(j AS VARCHAR) || '.png' END AS prd_img,
  CASE WHEN k % 97 = 96 AND j = 1 THEN 'missing:prd_name' WHEN k % 29 = 28 AND j = 0 THEN 'missing:prd_per_price' END AS reject_reason
FROM fpages, {J2} c WHERE k % 9 <> 0"""

oracle(
    "html_cards",
    f"""WITH {pages_cte('store_a')}, cards AS ({CARD_ROWS})
SELECT page_id, card, category, sub_category, prd_name, prd_brand, prd_price, prd_per_price, prd_discount,
  prd_link, prd_img, reject_reason FROM cards""",
)
CAPTURED = "timezone('America/Toronto', timezone('UTC', TIMESTAMP '2023-11-01 12:00:00' + to_minutes(CAST(k * 7 AS BIGINT))))"
oracle(
    "cards_to_clean",
    f"""WITH {pages_cte('store_a')}, cards AS ({CARD_ROWS}),
raw AS (
  SELECT strftime(CAST({CAPTURED} AS DATE), '%Y-%m-%d') || '/' || CAST(shard AS VARCHAR) AS file, k * 10 + card AS pos,
    strftime(CAST({CAPTURED} AS DATE), '%Y-%m-%d') AS date,
    category, sub_category, prd_name, prd_brand, prd_price, prd_per_price, prd_discount, prd_link, prd_img
  FROM cards WHERE reject_reason IS NULL
), {clean_sql('raw')}
SELECT {CLEAN_SELECT} FROM cleaned WHERE reject_reason IS NULL""",
)
oracle(
    "html_fallback",
    f"""WITH {pages_cte('store_a')}
SELECT page_id, CAST(j AS INTEGER) AS card,
  CASE WHEN (k + j) % 2 = 0 THEN '$' || {money('cents')} END AS price_regular,
  CASE WHEN (k + j) % 2 = 1 THEN '$' || {money('cents - 50')} END AS price_sale,
  CASE WHEN (k + j) % 2 = 0 THEN '$' || {money('cents')} ELSE '$' || {money('cents - 50')} END AS prd_price
FROM fpages, {J2} c""",
)
oracle(
    "html_empty_filter",
    f"WITH {pages_cte('store_a')} SELECT page_id, '2 items' AS notice FROM fpages WHERE k % 9 <> 0",
)
oracle(
    "html_page_count",
    f"""WITH {pages_cte('store_a', 'pa')}, {pages_cte('store_b_listing', 'pb')}
SELECT 'Loblaws' AS store, page_id, CAST(CASE WHEN k % 4 = 0 THEN 1 ELSE k % 5 END AS INTEGER) AS n_pages FROM pa
UNION ALL
SELECT 'HMart' AS store, page_id, CAST(CASE WHEN k % 3 = 0 THEN 1 ELSE k % 4 + 1 END AS INTEGER) AS n_pages FROM pb""",
)
oracle(
    "page_urls",
    f"""WITH {pages_cte('store_a', 'pa')}, {pages_cte('store_b_listing', 'pb')},
a AS (SELECT page_id, k, url, unnest(generate_series(1, CASE WHEN k % 4 = 0 THEN 1 ELSE k % 5 END)) AS page_no FROM pa
  UNION ALL SELECT page_id, k, url, NULL FROM pa WHERE k % 4 <> 0 AND k % 5 = 0),
b AS (SELECT page_id, url, unnest(generate_series(1, CASE WHEN k % 3 = 0 THEN 1 ELSE k % 4 + 1 END)) AS page_no FROM pb)
SELECT 'Loblaws' AS store, page_id, CAST(page_no AS INTEGER) AS page_no,
  CASE WHEN page_no IS NULL THEN NULL WHEN k % 4 = 0 THEN url ELSE url || '?page=' || CAST(page_no AS VARCHAR) END AS page_url,
  CASE WHEN page_no IS NULL THEN 'pager:no_pages' END AS reject_reason FROM a
UNION ALL
SELECT 'HMart' AS store, page_id, CAST(page_no AS INTEGER) AS page_no,
  CASE WHEN page_no = 1 THEN url ELSE url || '?p=' || CAST(page_no AS VARCHAR) END AS page_url, NULL AS reject_reason FROM b""",
)
oracle(
    "html_link_filter",
    f"""WITH {pages_cte('nav')}
SELECT page_id, 'https://www.loblaws.ca/c/' || CAST(k AS VARCHAR) || '/all' AS link FROM fpages
UNION ALL SELECT page_id, 'https://www.loblaws.ca/c/' || CAST(k AS VARCHAR) || '/more' AS link FROM fpages WHERE k % 5 = 0""",
)
oracle(
    "html_spec_table",
    f"""WITH {pages_cte('store_b_product')}
SELECT page_id, p_brand AS prd_brand, p_name AS prd_name, CAST(p_size AS VARCHAR) || ' ea' AS average_unit,
  CASE WHEN k % 19 = 18 THEN NULL ELSE CAST(k AS VARCHAR) END AS prd_id_in_store FROM fpages""",
)
oracle(
    "price_pair",
    f"""WITH {pages_cte('store_b_product')}
SELECT page_id,
  CASE WHEN k % 17 = 16 THEN NULL WHEN k % 3 = 1 THEN '$' || {money('cents - 100')} ELSE '$' || {money('cents')} END AS prd_price,
  CASE WHEN k % 17 = 16 THEN NULL ELSE '$' || {money('cents')} END AS org_price,
  CASE WHEN k % 17 = 16 THEN NULL ELSE k % 3 = 1 END AS prd_discount,
  CASE WHEN k % 17 <> 16 AND k % 3 = 1 THEN 'SAVING' END AS on_sale_cat,
  CASE WHEN k % 17 = 16 THEN 'missing:prd_price' WHEN k % 19 = 18 THEN 'missing:prd_id_in_store' END AS reject_reason
FROM fpages""",
)
oracle(
    "links_by_category",
    f"""WITH {pages_cte('store_b_listing')}
SELECT p_type AS category, page_id, CAST(j AS INTEGER) AS card,
  'https://mart.example/p/' || CAST(k AS VARCHAR) || '-' || CAST(j AS VARCHAR) || '.html' AS prd_url,
  'https://mart.example/img/' || CAST(k AS VARCHAR) || '-' || CAST(j AS VARCHAR) || '.jpg' AS prd_img
FROM fpages, (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2) c WHERE j < 2 OR k % 2 = 0""",
)
# every card with its newest product page; prices by the rules the pages were written from
STORE_B_CARDS = f"""SELECT k, page_id, CAST(j AS INTEGER) AS card, p_type AS category, p_brand, p_name, p_size,
  'https://mart.example/p/' || CAST(k AS VARCHAR) || '-' || CAST(j AS VARCHAR) || '.html' AS prd_url,
  'https://mart.example/img/' || CAST(k AS VARCHAR) || '-' || CAST(j AS VARCHAR) || '.jpg' AS prd_img,
  NOT (j = 2 AND k % 23 = 22) AS has_page, NOT (k % 17 = 16 AND j = 0) AS has_price, k % 3 = 1 AS on_sale,
  CASE WHEN k % 3 = 1 THEN '$' || {money('cents - 100')} WHEN k % 29 = 28 THEN 'ask' ELSE '$' || {money('cents')} END AS price,
  CASE WHEN k % 3 <> 1 AND k % 29 = 28 THEN 'ask' ELSE '$' || {money('cents')} END AS org,
  CASE WHEN k % 19 = 18 AND j = 1 THEN NULL ELSE CAST(k AS VARCHAR) || CAST(j AS VARCHAR) END AS pid,
  CAST({CAPTURED} AS DATE) AS day
FROM fpages, (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2) c WHERE j < 2 OR k % 2 = 0"""
oracle(
    "store_b_rows",
    f"""WITH {pages_cte('store_b_listing')}, cards AS ({STORE_B_CARDS})
SELECT page_id AS listing_page, card, category, prd_url, prd_img,
  CASE WHEN has_page AND has_price THEN price END AS prd_price,
  CASE WHEN has_page AND has_price THEN org END AS org_price,
  CASE WHEN has_page AND has_price THEN on_sale END AS prd_discount,
  CASE WHEN has_page AND has_price AND on_sale THEN 'SAVING' END AS on_sale_cat,
  CASE WHEN has_page THEN p_brand END AS prd_brand,
  CASE WHEN has_page THEN p_name END AS prd_name,
  CASE WHEN has_page THEN CAST(p_size AS VARCHAR) || ' ea' END AS average_unit,
  CASE WHEN has_page THEN pid END AS prd_id_in_store,
  'HMart' AS store, CASE WHEN has_page THEN day END AS scrap_date,
  CASE WHEN NOT has_page THEN 'missing:product_page' WHEN NOT has_price THEN 'missing:prd_price'
       WHEN pid IS NULL THEN 'missing:prd_id_in_store' END AS reject_reason
FROM cards""",
)
oracle(
    "page_rejects",
    f"""WITH p AS (SELECT page_id, {DAMAGED_PAGE} AS page,
  CAST(len(regexp_extract_all(html, '<a href="')) AS BIGINT) AS n FROM pages),
r AS (SELECT *, CASE page_id % 12 WHEN 3 THEN 'page:missing' WHEN 4 THEN 'page:empty' WHEN 5 THEN 'page:empty' WHEN 6 THEN 'page:no_markup'
  WHEN 7 THEN 'page:no_records' WHEN 9 THEN 'page:unreadable:ValueError' WHEN 10 THEN 'page:no_records'
  ELSE CASE WHEN n = 0 THEN 'page:no_records' END END AS reason FROM p)
SELECT page_id, CASE WHEN reason IS NULL THEN n END AS n_links, reason, CASE WHEN reason IS NOT NULL THEN sha256(page) END AS page_sha256 FROM r""",
)
oracle(
    "card_rejects",
    f"""WITH {pages_cte('store_a')}, cards AS ({CARD_ROWS}),
d AS (SELECT *, {DAMAGED_CARDS} AS page FROM fpages WHERE k % 13 = 12)
SELECT page_id, url, card, reject_reason, prd_name AS raw_name, prd_link AS raw_link, CAST(NULL AS INTEGER) AS page_chars
FROM cards WHERE k % 13 <> 12 AND reject_reason IS NOT NULL
UNION ALL
SELECT page_id, url, NULL, CASE k % 4 WHEN 0 THEN 'page:unreadable:ValueError' WHEN 1 THEN 'page:missing' WHEN 2 THEN 'page:no_markup' ELSE 'page:no_records' END,
  NULL, NULL, CAST(length(page) AS INTEGER) FROM d""",
)
_A = "'https://www.loblaws.ca"
oracle(
    "page_closure",
    f"""WITH RECURSIVE {pages_cte('store_a')},
p AS (SELECT k, CAST(k AS VARCHAR) AS n, CASE WHEN k % 4 = 0 THEN 0 ELSE k % 5 END AS last FROM fpages),
pg AS (SELECT k, n, unnest(generate_series(1, last)) AS i FROM p WHERE last >= 1),
captured AS (SELECT {_A}/h/' || n AS url FROM p UNION SELECT {_A}/c/' || n || '/all' FROM p
  UNION SELECT {_A}/c/' || n || '/all?page=' || CAST(i AS VARCHAR) FROM pg WHERE i % 2 = 1),
link AS (
  SELECT {_A}/h/' || n AS a, {_A}/h/' || CAST(k + 1 AS VARCHAR) AS b FROM p WHERE k % 4 <> 3
  UNION SELECT {_A}/h/' || n, {_A}/h/' || CAST(k - 2 AS VARCHAR) FROM p WHERE k % 4 = 2
  UNION SELECT {_A}/h/' || n, {_A}/c/' || n || '/all' FROM p
  UNION SELECT {_A}/h/' || n, {_A}/c/' || n || '/more' FROM p WHERE k % 5 = 0
  UNION SELECT {_A}/c/' || n || '/all', {_A}/c/' || n || '/all?page=' || CAST(i AS VARCHAR) FROM pg
  UNION SELECT x.url, {_A}/c/' || n || '/all?page=' || CAST(i AS VARCHAR) FROM pg JOIN captured x ON x.url LIKE '%?page=%' AND split_part(x.url, '?', 1) = {_A}/c/' || n || '/all'
), reach AS (
  SELECT {_A}/h/' || n AS url, 0 AS depth FROM p WHERE k % 4 = 1
  UNION SELECT b, depth + 1 FROM reach JOIN link ON a = url WHERE depth < 12
)
SELECT url, CAST(min(depth) AS INTEGER) AS depth, url IN (SELECT url FROM captured) AS captured FROM reach GROUP BY url""",
)
