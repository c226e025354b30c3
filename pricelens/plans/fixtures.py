"""Raw listing text derived from the driver tables.

No driver table holds grocery listings, so the raw rows are built from
``part`` inside the query: every part row becomes one listing row whose
text covers the shapes the cleaner must handle (unit text with one, two or
three comma parts, two unit prices, thousands commas, bad links, NA words,
promotion labels). Work grows with ``part``.

The expressions are plain SQL that Spark and DuckDB both accept, so the
oracle can start from the very same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import NA_WORDS

# integer building blocks per part row
BASE_EXPRS = [
    ("k", "p_partkey"),
    ("pos", "p_partkey"),
    ("shard", "CAST(FLOOR(p_partkey / 2) AS BIGINT) % 7 + 2"),
    ("cents", "CAST(ROUND(p_retailprice * 100) AS BIGINT)"),
    ("u", "p_partkey % 487 + 13"),
    ("u2", "p_partkey % 199 + 7"),
    ("amt", "p_partkey % 9 + 1"),
    ("p_name", "p_name"),
    ("p_brand", "p_brand"),
    ("p_type", "p_type"),
    ("p_size", "p_size"),
]

# The same building blocks per lineitem row (30x the rows of part). ``k``
# drives the text, so lines sharing (order, line number) become duplicates
# within one file; ``pos`` is unique and keeps "first" well defined.
LINE_BASE_EXPRS = [
    ("k", "l_orderkey * 8 + l_linenumber"),
    ("pos", "(((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 1000 + l_suppkey) * 64 + CAST(l_quantity AS INT)"),
    ("shard", "CAST(FLOOR((l_orderkey * 8 + l_linenumber) / 2) AS BIGINT) % 7 + 2"),
    ("cents", "CAST(ROUND(l_extendedprice / l_quantity * 100) AS BIGINT)"),
    ("u", "(l_orderkey * 8 + l_linenumber) % 487 + 13"),
    ("u2", "(l_orderkey * 8 + l_linenumber) % 199 + 7"),
    ("amt", "(l_orderkey * 8 + l_linenumber) % 9 + 1"),
    ("p_name", "'item ' || CAST(l_partkey AS STRING)"),
    ("p_brand", "'Brand#' || CAST(l_suppkey % 50 AS STRING)"),
    ("p_type", "l_returnflag || l_linestatus"),
    ("p_size", "CAST(l_quantity AS INT)"),
]
SOURCES = {"part": BASE_EXPRS, "lineitem": LINE_BASE_EXPRS}


def money(x: str) -> str:
    """Integer cents -> '12.34' text."""
    return (
        f"CAST(CAST(FLOOR(({x}) / 100) AS BIGINT) AS STRING) || '.' || "
        f"lpad(CAST(({x}) % 100 AS STRING), 2, '0')"
    )


# seven shards a day, and another day every 4,000 rows: the number of files grows with the table
DAY = "CAST(DATE '2023-11-01' + CAST(shard + 9 + FLOOR(k / 4000) AS INT) AS STRING)"
BAD_DATE = "k % 61 = 60"
THIRD_PRICE = "k % 66 = 7"
NBSP = "chr(160)"
NA_CASE = "CASE CAST(FLOOR(k / 10) AS BIGINT) % " + str(len(NA_WORDS)) + " " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(NA_WORDS)) + " END"
LINK_ID = "CAST(CAST(FLOOR(k / 2) AS BIGINT) AS STRING)"

RAW_EXPRS = [
    ("k", "k"),
    ("file", f"'Loblaws/Loblaws_' || {DAY} || '_' || CAST(shard AS STRING) || '.csv'"),
    ("pos", "pos"),
    ("date", f"CASE WHEN {BAD_DATE} THEN '12/11/2023' ELSE {DAY} END"),
    ("category", "p_type"),
    ("sub_category", "p_brand"),
    (
        "prd_name",
        "CASE WHEN k % 7 = 3 THEN p_name || ' ( ID required at pick-up )' "
        "WHEN k % 7 = 5 THEN p_name || ' (ID required at pick-up)' "
        f"WHEN k % 7 = 6 THEN p_name || ' (' || {NBSP} || 'ID required at pick-up' || {NBSP} || ')' ELSE p_name END",
    ),
    ("prd_brand", f"CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN {NA_CASE} WHEN 2 THEN 'nan' ELSE p_brand END"),
    (
        "prd_price",
        "CASE WHEN k % 41 = 40 THEN '$1,' || lpad(CAST(k % 1000 AS STRING), 3, '0') || '.00' "
        f"WHEN k % 43 = 42 THEN 'sold out' ELSE '$' || {money('cents')} END",
    ),
    (
        "prd_per_price",
        "CASE k % 6 "
        f"WHEN 0 THEN CAST(amt * 100 AS STRING) || ' g, $' || {money('u')} || '/100g' "
        f"WHEN 1 THEN '$' || {money('u')} || '/1kg' || CASE WHEN k % 4 = 1 THEN {NBSP} ELSE ' ' END || '$' || {money('u2')} || '/1lb' "
        f"|| CASE WHEN {THIRD_PRICE} THEN ' $9.99/1oz' ELSE '' END "
        "WHEN 2 THEN '1 ea, $1,' || lpad(CAST(k % 1000 AS STRING), 3, '0') || '/1ea' "
        "WHEN 3 THEN CAST(amt * 50 AS STRING) || ' ml' "
        f"WHEN 4 THEN '$' || {money('u')} || '/100g' "
        "ELSE CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '1,000 g, $0.80/100g' "
        f"WHEN 2 THEN '$1,200/1ea' ELSE '$' || {money('u')} || '/1' END END",
    ),
    (
        "prd_discount",
        "CASE k % 9 WHEN 0 THEN 'SAVE $1.00' || chr(10) || 'limit 4' WHEN 1 THEN '$3.00 MIN 2' "
        "WHEN 2 THEN 'Member price' WHEN 3 THEN '1000 Points' WHEN 4 THEN 'SAVE with MIN 2' "
        "WHEN 5 THEN 'limit 4' || chr(10) || 'SAVE $1' WHEN 6 THEN 'save $1' WHEN 7 THEN 'NaN' ELSE NULL END",
    ),
    (
        "prd_link",
        f"CASE WHEN k % 53 = 52 THEN 'https://shop.example/p/' || {LINK_ID} || '-EA' "
        f"WHEN k % 59 = 58 THEN 'https://shop.example/p/' || {LINK_ID} || '_EA?s=x' "
        f"ELSE 'https://shop.example/a/p/' || {LINK_ID} || '_EA' END",
    ),
    ("prd_img", "CASE WHEN k % 5 = 0 THEN NULL ELSE 'https://img.example/' || CAST(k AS STRING) || '.png' END"),
]


def _select_sql(exprs) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in exprs)


def raw_listing_cte(source: str = "part") -> str:
    """DuckDB / ANSI text of the same rows, for oracles: ``raw_listing`` CTE."""
    return (
        f"base AS (SELECT {_select_sql(SOURCES[source])} FROM {source}), "
        f"raw_listing AS (SELECT {_select_sql(RAW_EXPRS)}, u, u2, amt, cents, shard FROM base)"
    )


RAW_LISTING_CTE = raw_listing_cte("part")


def dealt(table: DataFrame) -> DataFrame:
    """The narrow source rows over as many partitions as the job's shuffles have:
    the given tables are single files, and building (and then parsing) texts and
    pages should not be left to one task. AQE would merge rows this narrow into
    one partition again, so the number is given."""
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartition(n, *table.columns)


def raw_listings(table: DataFrame, with_helpers: bool = False, source: str = "part") -> DataFrame:
    """Raw store-A listing rows (all text) plus ``file`` and ``pos``."""
    base = dealt(table).selectExpr(*[f"{e} AS {n}" for n, e in SOURCES[source]])
    cols = [f"{e} AS {n}" for n, e in RAW_EXPRS]
    if with_helpers:
        cols += ["u", "u2", "amt", "cents", "shard"]
    return base.selectExpr(*cols)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
