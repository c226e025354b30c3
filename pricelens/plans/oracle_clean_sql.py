"""The cleaning rules written once in DuckDB SQL, over any relation shaped
like the raw listing file (``file, pos`` + the ten raw text columns).

An independent statement of the rules for oracles whose raw rows do not come
from the ``part`` text generator (e.g. rows extracted from HTML). Exact
integer HALF_UP arithmetic replaces DuckDB's double division.
"""

from __future__ import annotations

from .oracles import WS, na

RAW = ["date", "category", "sub_category", "prd_name", "prd_brand", "prd_price", "prd_per_price", "prd_discount", "prd_link", "prd_img"]
UNIT_RE = "\\$(.*?)/(\\d+)(\\w+)"


def clean_sql(source: str) -> str:
    """CTE text ending in ``cleaned`` (all rows, with ``reject_reason``,
    duplicates removed per (file, product id), first by ``pos``)."""
    nulls = ", ".join(f"{na(c)} AS {c}" for c in RAW)
    return f"""
c_n AS (SELECT file, pos, {nulls} FROM {source}),
c_p AS (
  SELECT *, NULLIF(regexp_extract(prd_link, '/(\\w+)$', 1), '') AS pid,
    TRY_CAST(NULLIF(regexp_extract(prd_price, '\\$(.*)', 1), '') AS DECIMAL(12,2)) AS price,
    split_part(prd_discount, chr(10), 1) AS disc,
    string_split(prd_per_price, ',') AS a
  FROM c_n),
c_u AS (
  SELECT *, CASE WHEN NOT contains(a[1], '$') THEN a[1] END AS unit_part,
    trim(coalesce(CASE WHEN len(a) = 3 THEN a[2] || '.' || replace(a[3], '.', '') WHEN len(a) = 2 THEN a[2] END, a[1])) AS pt
  FROM c_p),
c_t AS (SELECT *, regexp_split_to_array(CASE WHEN contains(pt, '$') THEN pt END, '{WS}+') AS toks FROM c_u),
c_v AS (
  SELECT *, toks[1] AS ppu1, CASE WHEN len(toks) >= 2 THEN toks[2] END AS ppu2 FROM c_t),
c_r AS (
  SELECT *,
    TRY_CAST(NULLIF(regexp_extract(ppu1, '{UNIT_RE}', 1), '') AS DECIMAL(12,4)) AS up,
    TRY_CAST(NULLIF(regexp_extract(ppu1, '{UNIT_RE}', 2), '') AS DECIMAL(8,0)) AS base,
    NULLIF(regexp_extract(ppu1, '{UNIT_RE}', 3), '') AS word
  FROM c_v),
c_a AS (
  SELECT *, coalesce(unit_part, CASE WHEN up IS NOT NULL AND base IS NOT NULL AND word IS NOT NULL AND price IS NOT NULL AND up <> 0 THEN
      CAST(CAST((2 * CAST(price * 100 AS HUGEINT) * CAST(base AS HUGEINT) * 10000 + CAST(up * 10000 AS HUGEINT))
                // (2 * CAST(up * 10000 AS HUGEINT)) AS DOUBLE) / 100 AS VARCHAR) || ' ' || word END) AS avg_unit
  FROM c_r),
c_all AS (
  SELECT file, pos, pid, price, disc, ppu1, ppu2, avg_unit, a, toks, up, base, word, prd_per_price,
    CAST(date AS DATE) AS scrap_date, category, sub_category, prd_name, prd_brand, prd_link, prd_img,
    CASE WHEN pid IS NULL THEN 'product_id'
         WHEN price IS NULL THEN 'price'
         WHEN len(a) > 3 OR (len(a) = 3 AND NOT contains(a[2], '$')) THEN 'parts'
         WHEN len(toks) > 2 THEN 'unit_prices'
         WHEN prd_per_price IS NOT NULL AND ((ppu1 IS NOT NULL AND (up IS NULL OR base IS NULL OR word IS NULL)) OR avg_unit IS NULL) THEN 'unit'
    END AS reject_reason
  FROM c_a),
c_first AS (
  SELECT * FROM c_all WHERE pid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY file, pid ORDER BY pos) = 1
  UNION ALL SELECT * FROM c_all WHERE pid IS NULL),
cleaned AS (
  SELECT file, pos, scrap_date, category, sub_category,
    {na(f"regexp_replace(prd_name, '\\({WS}*ID required at pick-up{WS}*\\)', '', 'g')")} AS prd_name,
    prd_brand, price AS prd_price, {na('disc')} AS prd_discount, prd_link, prd_img, pid AS prd_id_in_store,
    'Loblaws' AS store,
    CASE WHEN contains(disc, 'SAVE') THEN 'SAVING' WHEN contains(disc, 'MIN') THEN 'MULTI'
         WHEN contains(disc, 'Member') THEN 'MEMBER' WHEN contains(disc, 'Points') THEN 'POINT' END AS on_sale_cat,
    {na('avg_unit')} AS average_unit,
    {na("coalesce(ppu1, CASE WHEN price IS NOT NULL AND avg_unit IS NOT NULL THEN '$ ' || CAST(CAST(price AS DOUBLE) AS VARCHAR) || ' / ' || avg_unit END)")} AS price_per_unit_1,
    {na('ppu2')} AS price_per_unit_2,
    reject_reason
  FROM c_first)"""
