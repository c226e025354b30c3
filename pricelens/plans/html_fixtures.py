"""HTML pages built from ``part`` (one or more pages per part row).

The driver's ``pages`` table has none of the store markup (classes, pagers,
spec tables), so pages in the stores' shapes are written with ``concat``
from ``part`` inside the query; oracles know the answer from the same
integers. Plain SQL accepted by both Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import STORE_A_CARD_CLASSES, STORE_B_CARD_CLASS, STORE_B_IMG_CLASS, STORE_B_PRICE_CLASS
from ..schemas import STORE_A_EMPTY_NOTICE as EMPTY
from ..schemas import STORE_A_FIELDS as A
from ..schemas import STORE_A_HEADING_CLASS as HEADING
from ..schemas import STORE_A_NOTICE_CLASS as NOTICE
from .fixtures import BASE_EXPRS, RAW_EXPRS, dealt, money

PER_PRICE = dict(RAW_EXPRS)["prd_per_price"]
K = "CAST(k AS STRING)"
# the price's classes in the other order, on an element that must not match
SWAPPED = " ".join(A["prd_price_regular"].split()[::-1])


def _p(cls: str, body: str, tag: str = "p") -> str:
    return f"'<{tag} class=\"{cls}\">' || {body} || '</{tag}>'"


def product(j: int) -> str:
    """Product id of card j of page k; some second cards show the previous page's."""
    if j == 0:
        return f"{K} || '0'"
    return "CASE WHEN k % 10 = 5 THEN CAST(k - 1 AS STRING) ELSE CAST(k AS STRING) END || '1'"


def card(j: int) -> str:
    """One store-A product card (j = 0 or 1) of page k."""
    return " || ".join(
        [
            f"'<div class=\"{' '.join(STORE_A_CARD_CLASSES)}\">'",
            f"'<a class=\"{A['prd_link']}\" href=\"/a/p/' || {product(j)} || '_EA\">view</a>'",
            f"CASE WHEN (k + {j}) % 4 = 0 THEN '' ELSE '<img class=\"{A['prd_img']}\" src=\"https://img.example/' || {K} || '_{j}.png\">' END",
            f"CASE WHEN k % 97 = 96 AND {j} = 1 THEN '' ELSE "
            + _p(A["prd_name"], f"CASE WHEN k % 11 = 0 THEN p_name || ' &amp; co' ELSE p_name END || ' {j}'", "h3")
            + " END",
            f"CASE WHEN k % 3 = 0 THEN '' ELSE " + _p(A["prd_brand"], "p_brand") + " END",
            f"CASE WHEN k % 7 = 0 AND {j} = 1 THEN '<span class=\"{SWAPPED}\">$0.01</span>' ELSE '' END",
            f"CASE WHEN (k + {j}) % 2 = 0 THEN " + _p(A["prd_price_regular"], f"'$' || {money('cents')}")
            + " ELSE " + _p(A["prd_price_sale"], f"'$' || {money('cents - 50')}") + " END",
            f"CASE WHEN k % 29 = 28 AND {j} = 0 THEN '' ELSE " + _p(A["prd_per_price"], f"coalesce({PER_PRICE}, '')") + " END",
            f"CASE WHEN k % 5 = 1 THEN " + _p(A["prd_discount"], "'SAVE $1.00' || chr(10) || 'limit 2'") + " ELSE '' END",
            "'</div>'",
        ]
    )


STORE_A_PAGE = " || ".join(
    [
        # a header menu with a nav of its own, before the content
        "'<html><body><header><nav><button>menu</button></nav></header><div id=\"site-content\">'",
        f"CASE WHEN k % 2 = 0 THEN '<h2 class=\"{HEADING} big\"> ' || p_type || ' </h2>' ELSE '<h2 class=\"{HEADING}\">' || p_type || '</h2>' END",
        f"CASE WHEN k % 18 = 0 THEN '<p class=\"big {NOTICE}\"> {EMPTY}' || chr(10) || '</p>' WHEN k % 9 = 0 THEN '<p class=\"{NOTICE}\">{EMPTY}</p>' "
        f"ELSE '<p class=\"{NOTICE}\">2 items</p>' END",
        "'<div class=\"css-c33bww\">'",
        card(0),
        card(1),
        "'</div>'",
        "CASE WHEN k % 4 = 0 THEN '' ELSE '<nav aria-label=\"pagination\">' || repeat('<button>.</button>', CAST(k % 5 + 2 AS INT)) || '</nav>' END",
        "'</div></body></html>'",
    ]
)


def _li(j: int) -> str:
    return (
        f"'<li class=\"{STORE_B_CARD_CLASS}\"><div class=\"product-item-info\">"
        f"<a href=\"https://mart.example/p/' || {K} || '-{j}.html\"><img class=\"{STORE_B_IMG_CLASS}\" "
        f"src=\"https://mart.example/img/' || {K} || '-{j}.jpg\"></a><a href=\"#reviews\">reviews</a></div></li>'"
    )


STORE_B_LISTING = " || ".join(
    [
        "'<html><body><span class=\"base\">' || p_type || '</span>'",
        "'<ol class=\"products list items product-items\">'",
        _li(0),
        _li(1),
        f"CASE WHEN k % 2 = 0 THEN {_li(2)} ELSE '' END",
        "'</ol>'",
        "CASE WHEN k % 3 = 0 THEN '' ELSE '<ul class=\"items pages-items\">' || repeat('<li class=\"item\">.</li>', CAST(k % 4 + 2 AS INT)) || '</ul>' END",
        "'</body></html>'",
    ]
)


def _price_span(x: str) -> str:
    return f"'<span class=\"{STORE_B_PRICE_CLASS}\">$' || {money(x)} || '</span>'"


def _row(label: str, value: str) -> str:
    return f"'<tr><th class=\"col label\">{label}</th><td class=\"col data\">' || {value} || '</td></tr>'"


STORE_B_PRODUCT = " || ".join(
    [
        "'<html><body><div class=\"product-info-price\">'",
        f"CASE WHEN k % 17 = 16 THEN '' WHEN k % 3 = 1 THEN {_price_span('cents - 100')} || {_price_span('cents')} ELSE {_price_span('cents')} END",
        "'</div><table class=\"data table additional-attributes\"><tbody>'",
        _row("Brand", "p_brand"),
        _row("Name", "p_name"),
        _row("Unit", "CAST(p_size AS STRING) || ' ea'"),
        f"CASE WHEN k % 19 = 18 THEN '' ELSE {_row('SKU', K)} END",
        "'</tbody></table></body></html>'",
    ]
)

# product pages of all cards (p): some older captures with another price (old), some cards without a page
STORE_B_PRODUCTS = " || ".join(
    [
        "'<html><body><div class=\"product-info-price\">'",
        f"CASE WHEN k % 17 = 16 AND p = 0 THEN '' WHEN old THEN {_price_span('1')} WHEN k % 3 = 1 THEN {_price_span('cents - 100')} || {_price_span('cents')} "
        f"WHEN k % 29 = 28 THEN '<span class=\"{STORE_B_PRICE_CLASS}\">ask</span>' ELSE {_price_span('cents')} END",
        "'</div><table class=\"data table additional-attributes\"><tbody>'",
        _row("Brand", "p_brand"),
        _row("Name", "p_name"),
        _row("Unit", "CAST(p_size AS STRING) || ' ea'"),
        f"CASE WHEN k % 19 = 18 AND p = 1 THEN '' ELSE {_row('SKU', K + ' || CAST(p AS STRING)')} END",
        "'</tbody></table></body></html>'",
    ]
)
HAS_PAGE = "NOT (p = 2 AND k % 23 = 22) AND (NOT old OR k % 13 = 0)"

NAV_PAGE = " || ".join(
    [
        f"'<div id=\"site-content\"><h2 class=\"{HEADING}\"> ' || p_brand || ' </h2><div>'",
        f"'<a data-testid=\"nav-list-link\" href=\"/c/' || {K} || '/all\">See All</a>'",
        f"'<a data-testid=\"nav-list-link\" href=\"/c/' || {K} || '/sub\">' || p_name || '</a>'",
        f"'<a data-testid=\"other\" href=\"/c/' || {K} || '/x\">See All</a>'",
        f"CASE WHEN k % 5 = 0 THEN '<a data-testid=\"nav-list-link\" href=\"/c/' || {K} || '/more\">See All</a>' ELSE '' END",
        f"CASE WHEN k % 7 = 0 THEN '<a data-testid=\"nav-list-link\" href=\"/c/' || {K} || '/sp\"> See All</a>' ELSE '' END",
        "'</div></div>'",
    ]
)

# Hubs that lead on: every page's See-All link goes to a listing, to a page that
# was never captured and, three times out of four, to the next hub. Listings have pagers.
HUB_PAGE = " || ".join(
    [
        f"'<div id=\"site-content\"><h2 class=\"{HEADING}\">' || p_brand || '</h2>'",
        f"CASE WHEN k % 4 <> 3 THEN '<a data-testid=\"nav-list-link\" href=\"/h/' || CAST(k + 1 AS STRING) || '\">See All</a>' ELSE '' END",
        f"'<a data-testid=\"nav-list-link\" href=\"/c/' || {K} || '/all\">See All</a>'",
        f"CASE WHEN k % 5 = 0 THEN '<a data-testid=\"nav-list-link\" href=\"/c/' || {K} || '/more\">See All</a>' ELSE '' END",
        f"CASE WHEN k % 4 = 2 THEN '<a data-testid=\"nav-list-link\" href=\"/h/' || CAST(k - 2 AS STRING) || '\">See All</a>' ELSE '' END",
        f"'<a data-testid=\"other\" href=\"/x/' || {K} || '\">See All</a></div>'",
    ]
)

# pages of ``pages`` as a crawl may deliver them; SQL of both engines
DAMAGED_PAGE = """CASE page_id % 12
  WHEN 1 THEN replace(html, '<nav>', '<![foo[x]]><nav>') WHEN 2 THEN html || '<![' WHEN 3 THEN NULL WHEN 4 THEN ''
  WHEN 5 THEN '  ' || chr(10) WHEN 6 THEN '{"error": 503}' WHEN 7 THEN replace(html, '<a ', '<b ') WHEN 8 THEN replace(html, '</a>', '')
  WHEN 9 THEN html || '&#' || repeat('9', 5000) || ';' WHEN 10 THEN '<html><body><p>cut off <a hre' WHEN 11 THEN html || '<!-- open'
  ELSE html END"""
# store-A pages of which every 13th is damaged in one of four ways
DAMAGED_CARDS = """CASE WHEN page_id % 13 <> 12 THEN html WHEN page_id % 4 = 0 THEN html || '&#' || repeat('9', 5000) || ';'
  WHEN page_id % 4 = 1 THEN NULL WHEN page_id % 4 = 2 THEN 'Bad Gateway' ELSE '<html><body><h1>Maintenance</h1></body></html>' END"""

PAGE_KINDS = {
    "store_a": STORE_A_PAGE,
    "store_b_listing": STORE_B_LISTING,
    "store_b_product": STORE_B_PRODUCT,
    "nav": NAV_PAGE,
    "hub": HUB_PAGE,
}
PAGE_URLS = {
    "store_a": f"'https://www.loblaws.ca/c/' || {K} || '/all'",
    "store_b_listing": f"'https://mart.example/c/' || {K}",
    "store_b_product": f"'https://mart.example/p/' || {K} || '-0.html'",
    "nav": f"'https://www.loblaws.ca/n/' || {K}",
    "hub": f"'https://www.loblaws.ca/h/' || {K}",
}

_BASE_SQL = ", ".join(f"{e} AS {n}" for n, e in BASE_EXPRS)


def pages_cte(kind: str, name: str = "fpages") -> str:
    """DuckDB text: ``name(page_id, url, html, k, cents, p_size, ...)``."""
    return (
        f"{name}_base AS (SELECT {_BASE_SQL} FROM part), "
        f"{name} AS (SELECT k AS page_id, {PAGE_URLS[kind]} AS url, {PAGE_KINDS[kind]} AS html, * FROM {name}_base)"
    )


def _captured(df: DataFrame, page_id: str, back: str = "0") -> DataFrame:
    """``captured_at``: a UTC wall clock seven minutes later for every page."""
    start = F.lit("2023-11-01 12:00:00").cast("timestamp_ntz")
    return df.withColumn("captured_at", F.timestamp_add("MINUTE", F.expr(f"{page_id} * 7 - {back}"), start))


def part_pages(part: DataFrame, kind: str) -> DataFrame:
    """Pages of one kind, one per part row: ``(page_id, url, html, shard, captured_at)``."""
    base = dealt(part).selectExpr(*[f"{e} AS {n}" for n, e in BASE_EXPRS])
    pages = base.selectExpr("k AS page_id", f"{PAGE_URLS[kind]} AS url", f"{PAGE_KINDS[kind]} AS html", "shard")
    return _captured(pages, "page_id")


def product_pages(part: DataFrame) -> DataFrame:
    """Store-B product pages of the cards of all listing pages: ``(url, html, captured_at)``."""
    base = dealt(part).selectExpr(*[f"{e} AS {n}" for n, e in BASE_EXPRS])
    base = base.withColumn("p", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn("old", F.explode(F.array(F.lit(False), F.lit(True))))
    base = base.where(HAS_PAGE).selectExpr("k", "old", f"'https://mart.example/p/' || {K} || '-' || CAST(p AS STRING) || '.html' AS url", f"{STORE_B_PRODUCTS} AS html")
    return _captured(base, "k", "CASE WHEN old THEN 1440 ELSE 0 END").select("url", "html", "captured_at")
