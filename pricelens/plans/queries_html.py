"""Registered HTML queries: the driver's ``pages`` table and store-shaped
pages built from ``part`` (see ``html_fixtures``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import paths, timefmt
from ..operators import clean as C
from ..operators import extract as X
from ..operators import worklist as W
from ..operators.closure import page_closure, page_links
from ..schemas import CLEAN_COLUMNS, STORE_A_CARD_CLASSES, STORE_A_FIELDS, STORE_A_NOTICE_CLASS
from ..session import not_broadcast, scratch_path, written_once
from ..sources.pages import read_pages
from .fixtures import read_table
from .html_fixtures import DAMAGED_CARDS, DAMAGED_PAGE, part_pages, product_pages
from .queries import query


def _pages(spark, sf_dir):
    return read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet")


def _part_pages(spark, sf_dir, kind):
    return part_pages(read_table(spark, sf_dir, "part"), kind)


@query("page_scan")
def q_page_scan(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", "url", F.length("html").alias("n_chars"))


@query("html_first_text")
def q_html_first_text(spark, sf_dir):
    fields = {
        "title": {"tag": "title"},
        "h1": {"tag": "h1"},
        "ad": {"class": "ad"},
        "footer": {"tag": "footer"},
        "brand": {"class": "brand"},
    }
    recs = H.records(_pages(spark, sf_dir), fields, keep=["page_id"])
    return recs.select("page_id", *fields, X.missing_reason(["title", "ad"]).alias("reject_reason"))


@query("html_attr")
def q_html_attr(spark, sf_dir):
    fields = {"href": {"self": True, "get": "@href"}, "text": {"self": True}}
    recs = H.records(_pages(spark, sf_dir), fields, container={"tag": "a", "has_attrs": ["href"]}, keep=["page_id", "url"])
    return recs.select(
        "page_id", "ord", "href", "text", H.join_root(H.site_root("url"), "href").alias("link")
    )


@query("cards_per_page")
def q_cards_per_page(spark, sf_dir):
    recs = H.records(_pages(spark, sf_dir), {"n": {"tag": "li", "get": "count"}}, keep=["page_id"])
    return recs.select("page_id", F.col("n").cast("bigint").alias("n_cards"))


@query("html_cards")
def q_html_cards(spark, sf_dir):
    return X.store_a_cards(_part_pages(spark, sf_dir, "store_a"), _part_pages(spark, sf_dir, "nav"))


@query("html_fallback")
def q_html_fallback(spark, sf_dir):
    f = STORE_A_FIELDS
    recs = H.records(
        _part_pages(spark, sf_dir, "store_a"),
        {"price_regular": {"class": f["prd_price_regular"]}, "price_sale": {"class": f["prd_price_sale"]}},
        container={"all_classes": STORE_A_CARD_CLASSES},
        keep=["page_id"],
    )
    return recs.select(
        "page_id", F.col("ord").alias("card"), "price_regular", "price_sale",
        F.coalesce("price_regular", "price_sale").alias("prd_price"),
    )


@query("html_empty_filter")
def q_html_empty_filter(spark, sf_dir):
    recs = H.records(
        _part_pages(spark, sf_dir, "store_a"), {"notice": {"all_classes": STORE_A_NOTICE_CLASS.split()}}, keep=["page_id"]
    )
    return recs.filter(X.not_empty("notice")).select("page_id", "notice")


@query("html_page_count")
def q_html_page_count(spark, sf_dir):
    a = X.store_a_page_info(_part_pages(spark, sf_dir, "store_a")).select(F.lit("Loblaws").alias("store"), "page_id", "n_pages")
    b = X.store_b_page_info(_part_pages(spark, sf_dir, "store_b_listing")).select(F.lit("HMart").alias("store"), "page_id", "n_pages")
    return a.unionByName(b)


@query("page_urls")
def q_page_urls(spark, sf_dir):
    a = W.store_a_page_urls(X.store_a_page_info(_part_pages(spark, sf_dir, "store_a")))
    b = W.store_b_page_urls(X.store_b_page_info(_part_pages(spark, sf_dir, "store_b_listing")))
    cols = ["page_id", "page_no", "page_url", "reject_reason"]
    return a.select(F.lit("Loblaws").alias("store"), *cols).unionByName(b.select(F.lit("HMart").alias("store"), *cols))


@query("html_link_filter")
def q_html_link_filter(spark, sf_dir):
    return X.store_a_see_all_links(_part_pages(spark, sf_dir, "nav")).select("page_id", "link")


@query("html_spec_table")
def q_html_spec_table(spark, sf_dir):
    return X.store_b_products(_part_pages(spark, sf_dir, "store_b_product"), keep=["page_id"]).select(
        "page_id", "prd_brand", "prd_name", "average_unit", "prd_id_in_store"
    )


@query("price_pair")
def q_price_pair(spark, sf_dir):
    return X.store_b_products(_part_pages(spark, sf_dir, "store_b_product"), keep=["page_id"]).select(
        "page_id", "prd_price", "org_price", "prd_discount", "on_sale_cat", "reject_reason"
    )


@query("page_closure")
def q_page_closure(spark, sf_dir):
    """All pages that every fourth hub leads to, and which were not captured.

    Captured are all hubs, all listings and the odd ones of the listings'
    further pages.
    """
    hubs, listings = _part_pages(spark, sf_dir, "hub"), _part_pages(spark, sf_dir, "store_a")
    urls = W.store_a_page_urls(X.store_a_page_info(listings)).where("page_no % 2 = 1 AND page_url <> url")
    with written_once(urls.select("page_id", "page_url"), "further-urls") as urls:
        further = listings.join(not_broadcast(urls), "page_id").select(F.col("page_url").alias("url"), "html")
        pages = hubs.select("url", "html").unionByName(listings.select("url", "html")).unionByName(further)
        with written_once(page_links(pages), "page-links") as links, written_once(pages.select("url"), "page-urls") as captured:
            out = page_closure(hubs.where("page_id % 4 = 1").select("url"), links, captured)
            path = scratch_path(spark, "page-closure")
            out.write.parquet(path)
    return spark.read.parquet(path)


@query("links_by_category")
def q_links_by_category(spark, sf_dir):
    """A-2/A-3: links grouped by category in page and card order, one row
    per link. The grouping is kept as rows with the order key (category,
    page_id, card); no per-category list is ever collected, so a category
    holding a third of all links is still spread over many tasks. Sort on
    the key where an ordered listing is needed."""
    cards = X.store_b_listing_cards(_part_pages(spark, sf_dir, "store_b_listing"))
    return cards.select("category", "page_id", "card", "prd_url", "prd_img")


@query("cards_to_clean")
def q_cards_to_clean(spark, sf_dir):
    """Store pages -> card rows -> cleaning chain: the whole weekly flow.

    The rows of all pages of a (store, day, shard) are one listing file, in
    page and card order, so a product on two of its pages is kept once.
    """
    pages, heads = _part_pages(spark, sf_dir, "store_a"), _part_pages(spark, sf_dir, "nav")
    cards = X.EXTRACTORS["Loblaws"](pages, heads, keep=["page_id", "url", "shard", "captured_at"])
    cards, _ = X.split_cards(cards)  # ``card_rejects`` has the others
    cards = cards.withColumn("day", timefmt.scrape_day("captured_at"))
    raw = cards.select(
        paths.object_key(F.lit("Loblaws"), "day", "shard").alias("file"),
        F.struct("page_id", "card").alias("pos"),
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        "category", "sub_category", "prd_name", "prd_brand", "prd_price", "prd_per_price", "prd_discount", "prd_link", "prd_img",
    )
    path = scratch_path(spark, "card-rows")
    raw.write.parquet(path)  # the cleaner reads its rows twice: the pages are parsed once
    good, _ = C.split_rejects(C.clean_store_a(spark.read.schema(raw.schema).parquet(path)))
    return good.select(*CLEAN_COLUMNS)


def _damaged_pages(spark, sf_dir):
    """Store-A pages of which some cannot be read, have no markup or no card."""
    pages = _part_pages(spark, sf_dir, "store_a")
    return pages.withColumn("html", F.expr(DAMAGED_CARDS))


@query("card_rejects")
def q_card_rejects(spark, sf_dir):
    """P-23 in the weekly flow: what ``cards_to_clean`` does not clean, cards
    with a missing field (their fields kept) and pages without cards (kept whole)."""
    cards = X.store_a_cards(_damaged_pages(spark, sf_dir), keep=["page_id", "url"], page_rejects=True)
    _, bad = X.split_cards(cards)
    raw = F.col("raw")
    return bad.select("page_id", "url", "card", "reject_reason", raw["prd_name"].alias("raw_name"), raw["prd_link"].alias("raw_link"), F.length("page_html").alias("page_chars"))


@query("page_rejects")
def q_page_rejects(spark, sf_dir):
    """F-4: every page is in exactly one of records and rejects, whatever it
    holds; rejects keep the whole page."""
    pages = _pages(spark, sf_dir).withColumn("html", F.expr(DAMAGED_PAGE))
    links = H.page_records(pages, {"href": {"self": True, "get": "@href"}}, container={"tag": "a", "has_attrs": ["href"]}, keep=["page_id"])
    good, bad = H.split_pages(links)
    good = good.groupBy("page_id").agg(F.count("*").alias("n_links"))
    return good.unionByName(bad.select("page_id", F.col("page_reject").alias("reason"), F.sha2("page_html", 256).alias("page_sha256")), allowMissingColumns=True)


@query("store_b_rows")
def q_store_b_rows(spark, sf_dir):
    """Store-B listing pages + product pages -> rows in clean names, with
    rejects (missing product page, price or spec field) kept."""
    part = read_table(spark, sf_dir, "part")
    rows = X.EXTRACTORS["HMart"](part_pages(part, "store_b_listing"), product_pages(part))
    return rows.select(
        "listing_page", "card", "category", "prd_url", "prd_img", "prd_price", "org_price", "prd_discount",
        "on_sale_cat", "prd_brand", "prd_name", "average_unit", "prd_id_in_store", "store", "scrap_date", "reject_reason",
    )
