"""Store page extractors (F-2): pages table -> listing rows.

Each store is a function ``(listing pages, related pages) -> listing rows with
reject_reason`` (``EXTRACTORS``), built on one parse of each page where it is
read (page-level fields such as the heading come out on every card row, so no
join back to the page is needed) followed by column expressions. Only small
records move: store A joins the cards with the parent pages' headings on the
See-All link, store B joins listing cards with product records on the URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import timefmt
from ..functions.pricing import strip
from ..schemas import (
    STORE_A_CARD_CLASSES,
    STORE_A_CONTENT_ID,
    STORE_A_EMPTY_NOTICE,
    STORE_A_FIELDS,
    STORE_A_HEADING_CLASS,
    STORE_A_NAV_TESTID,
    STORE_A_NAV_TEXT,
    STORE_A_NOTICE_CLASS,
    STORE_A_ROOT,
    STORE_B_CARD_CLASS,
    STORE_B_IMG_CLASS,
    STORE_B_PRICE_CLASS,
    STORE_B_SCHEMA,
    STORE_B_SPEC_FIELDS,
)
from ..session import not_broadcast

STORE_B = "HMart"
#: What an extractor reads from a card (kept as text when the card is rejected).
CARD_FIELDS = (
    "category", "sub_category", "prd_name", "prd_brand", "prd_price", "prd_per_price", "prd_discount", "prd_link", "prd_img", "prd_url",
)


def missing_reason(required: list[str]) -> Column:
    """H-1: first missing required field -> ``missing:<field>``."""
    out = None
    for name in required:
        cond = F.col(name).isNull()
        val = F.lit(f"missing:{name}")
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def _page_rows(pages: DataFrame, fields: dict, container: dict | None, keep: list[str], page_rejects: bool) -> tuple[DataFrame, list[str]]:
    """Records, and their columns about pages without any (empty or two)."""
    if not page_rejects:
        return H.records(pages, fields, container, keep=keep), []
    return H.page_records(pages, fields, container, keep=keep), ["page_html", "page_reject"]


def with_reason(rows: DataFrame, reason: Column) -> DataFrame:
    """``reject_reason``: the page's reason if there is one, else the row's."""
    if "page_reject" not in rows.columns:
        return rows.withColumn("reject_reason", reason)
    return rows.withColumn("reject_reason", F.coalesce("page_reject", reason)).drop("page_reject")


def store_a_cards(
    pages: DataFrame, heads: DataFrame | None = None, root: str = STORE_A_ROOT, keep: list[str] | None = None, page_rejects: bool = False
) -> DataFrame:
    """Store-A category page -> one raw listing row per product card.

    H-1/H-2 required and optional fields, H-3 regular-else-sale price,
    H-4/H-5 attributes made absolute, H-6 one row per card, H-12 headings on
    every row, H-13 pages with the empty notice dropped. Heading and notice are
    found by their classes, whatever other classes they have, and trimmed.

    ``sub_category`` is the page's own heading. ``category`` is the heading of
    the page in ``heads`` (page_id, html) whose See-All link leads here (by URL
    without query); null if there is none. With ``page_rejects`` a page that
    gives no card has one row with a ``page:`` reason and all of the page in
    ``page_html`` (pages with the empty notice are no rejects).
    """
    f = STORE_A_FIELDS
    fields = {
        "heading": {"all_classes": STORE_A_HEADING_CLASS.split(), "scope": "page"},
        "notice": {"all_classes": STORE_A_NOTICE_CLASS.split(), "scope": "page"},
        "prd_name": {"class": f["prd_name"]},
        "prd_brand": {"class": f["prd_brand"]},
        "price_regular": {"class": f["prd_price_regular"]},
        "price_sale": {"class": f["prd_price_sale"]},
        "prd_per_price": {"class": f["prd_per_price"]},
        "prd_discount": {"class": f["prd_discount"]},
        "href": {"class": f["prd_link"], "get": "@href"},
        "prd_img": {"class": f["prd_img"], "get": "@src"},
    }
    keep = keep if keep is not None else ["page_id"]
    extra = ["url"] if heads is not None and "url" not in keep else []
    recs, about_page = _page_rows(pages, fields, {"all_classes": STORE_A_CARD_CLASSES}, [*keep, *extra], page_rejects)
    recs = recs.filter(not_empty("notice"))
    if heads is None:
        recs = recs.withColumn("category", F.lit(None).cast("string"))
    else:
        parents = store_a_parents(heads, root).select(F.col("link").alias("parent_link"), "category")
        recs = recs.join(not_broadcast(parents), F.substring_index("url", "?", 1) == F.col("parent_link"), "left")
    out = recs.select(
        *keep,
        F.col("ord").alias("card"),
        "category",
        strip(F.col("heading")).alias("sub_category"),
        "prd_name",
        "prd_brand",
        F.coalesce("price_regular", "price_sale").alias("prd_price"),
        "prd_per_price",
        "prd_discount",
        F.when(F.col("href").isNotNull(), H.join_root(root, "href")).alias("prd_link"),
        "prd_img",
        *about_page,
    )
    return with_reason(out, missing_reason(["prd_name", "prd_price", "prd_per_price", "prd_link"]))


def split_cards(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cards for the cleaner, and P-23's rejects: every other card with its
    fields as text in ``raw``, and every page without a card in ``page_html``."""
    bad = F.col("reject_reason").isNotNull()
    if "page_html" not in cards.columns:
        cards = cards.withColumn("page_html", F.lit(None).cast("string"))
    fields = [c for c in CARD_FIELDS if c in cards.columns]
    raw = F.map_from_arrays(F.array(*[F.lit(c) for c in fields]), F.array(*[F.col(c).cast("string") for c in fields]))
    rest = [c for c in cards.columns if c not in fields]
    rejects = cards.where(bad).select(*rest, F.when(F.col("page_html").isNull() & F.col("card").isNotNull(), raw).alias("raw"))
    return cards.where(~bad).drop("reject_reason", "page_html"), rejects


def not_empty(notice: str) -> Column:
    """H-13: no notice, or one that does not say that the page is empty."""
    return F.col(notice).isNull() | (strip(F.col(notice)) != STORE_A_EMPTY_NOTICE)


def store_a_parents(heads: DataFrame, root: str = STORE_A_ROOT) -> DataFrame:
    """(link, category): heading of the page that holds the See-All link (of
    several pages with one link the first by page_id)."""
    heading = H.records(heads, {"heading": {"all_classes": STORE_A_HEADING_CLASS.split()}}, keep=["page_id"])
    links = store_a_see_all_links(heads, root)
    first = links.groupBy("link").agg(F.min("page_id").alias("page_id"))
    return first.join(not_broadcast(heading), "page_id").select("link", strip(F.col("heading")).alias("category"))


def store_a_page_info(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """H-14/H-15: number of result pages, from the first ``nav`` inside the
    page's content (a header menu does not count): its buttons - 2, at least 0;
    no pager = 1 page (``has_pager`` false)."""
    keep = keep if keep is not None else ["page_id", "url"]
    has, n = pager_columns()
    return H.records(pages, PAGER_FIELDS, keep=keep).select(*keep, has.alias("has_pager"), n.alias("n_pages"))


PAGER_FIELDS = {
    "n_pager": {"attrs": {"id": STORE_A_CONTENT_ID}, "find": {"tag": "nav", "get": "count"}},
    "n_buttons": {"attrs": {"id": STORE_A_CONTENT_ID}, "find": {"tag": "nav", "find": {"tag": "button", "get": "count"}}},
}


def pager_columns() -> tuple[Column, Column]:
    """(has_pager, n_pages) from the ``PAGER_FIELDS`` of a page."""
    has = F.coalesce(F.col("n_pager").cast("int") > 0, F.lit(False))
    return has, F.when(has, F.greatest(F.col("n_buttons").cast("int") - 2, F.lit(0))).otherwise(F.lit(1))


SEE_ALL = {"tag": "a", "attrs": {"data-testid": STORE_A_NAV_TESTID}, "text": STORE_A_NAV_TEXT}
SEE_ALL_FIELDS = {"href": {"self": True, "get": "@href"}}


def store_a_leads(pages: DataFrame, root: str = STORE_A_ROOT) -> DataFrame:
    """H-8 and H-14 from one parse, as ``(from_url, url, has_pager, n_pages)``: a
    row per See-All link, with the link as ``url``, and one per page that has a
    pager, with the pager's root."""
    recs = H.kind_records(pages, {"link": (SEE_ALL, SEE_ALL_FIELDS), "pager": (None, PAGER_FIELDS)}, keep=["url"])
    has, n = pager_columns()  # a link row has neither field: no pager, one page
    is_link = F.col("kind") == "link"
    to = F.when(is_link, H.join_root(root, "href")).otherwise(F.substring_index("url", "?", 1))
    return recs.where(is_link | has).select(F.col("url").alias("from_url"), to.alias("url"), has.alias("has_pager"), n.alias("n_pages"))


def store_a_see_all_links(pages: DataFrame, root: str = STORE_A_ROOT, keep: list[str] | None = None) -> DataFrame:
    """H-8: links tagged as navigation whose text is exactly 'See All'."""
    keep = keep if keep is not None else ["page_id"]
    recs = H.records(pages, SEE_ALL_FIELDS, container=SEE_ALL, keep=keep)
    return recs.select(*keep, F.col("rec").alias("pos"), H.join_root(root, F.col("href")).alias("link"))


def store_b_listing_cards(pages: DataFrame, keep: list[str] | None = None, page_rejects: bool = False) -> DataFrame:
    """Store-B listing page -> (category, card order, product URL, image).

    H-7: the first ``a`` that has an ``href`` and the product ``img``; the
    category is the page's ``base`` heading (H-12).
    """
    keep = keep if keep is not None else ["page_id"]
    fields = {
        "category": {"class": "base", "scope": "page"},
        "prd_url": {"tag": "a", "has_attrs": ["href"], "get": "@href"},
        "prd_img": {"tag": "img", "class": STORE_B_IMG_CLASS, "get": "@src"},
    }
    recs, about_page = _page_rows(pages, fields, {"tag": "li", "class": STORE_B_CARD_CLASS}, keep, page_rejects)
    out = recs.select(*keep, F.col("ord").alias("card"), "category", "prd_url", "prd_img", *about_page)
    return with_reason(out, missing_reason(["prd_url", "prd_img"]))


def store_b_page_info(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """H-14/H-15: pager ``li`` count - 1 pages (last ``li`` is 'next'); no pager = 1."""
    keep = keep if keep is not None else ["page_id", "url"]
    recs = H.records(
        pages,
        {
            "n_pager": {"tag": "ul", "class": "pages-items", "get": "count"},
            "n_li": {"tag": "ul", "class": "pages-items", "find": {"tag": "li", "get": "count"}},
        },
        keep=keep,
    )
    n = F.when(F.col("n_pager").cast("int") > 0, F.greatest(F.col("n_li").cast("int") - 1, F.lit(0))).otherwise(F.lit(1))
    return recs.select(*keep, n.alias("n_pages"))


def store_b_products(pages: DataFrame, keep: list[str] | None = None, page_rejects: bool = False) -> DataFrame:
    """Store-B product page -> prices (H-10/H-11) and spec table (H-9).

    More than one price: discounted, price = first, original = second;
    otherwise both are the single price. The spec table gives brand, name,
    unit and id from the first ``td`` in the row of the 1st..4th ``th``.
    """
    keep = keep if keep is not None else ["page_id", "url"]
    price = {"tag": "span", "class": STORE_B_PRICE_CLASS}
    fields = {
        "price_1": {**price, "nth": 0},
        "price_2": {**price, "nth": 1},
        "n_prices": {**price, "get": "count"},
    }
    for j, name in enumerate(STORE_B_SPEC_FIELDS):
        fields[name] = {"tag": "th", "nth": j, "up": 1, "find": {"tag": "td"}}
    recs, about_page = _page_rows(pages, fields, None, keep, page_rejects)
    n = F.col("n_prices").cast("int")
    disc = n > 1
    out = recs.select(
        *keep,
        F.when(n > 0, disc).alias("prd_discount"),
        F.col("price_1").alias("prd_price"),
        F.when(disc, F.col("price_2")).otherwise(F.col("price_1")).alias("org_price"),
        F.when(disc, F.lit("SAVING")).alias("on_sale_cat"),
        *STORE_B_SPEC_FIELDS,
        *about_page,
    )
    return with_reason(out, missing_reason(["prd_price", *STORE_B_SPEC_FIELDS]))


def store_b_rows(listing_pages: DataFrame, product_pages: DataFrame, captured_col: str = "captured_at", page_rejects: bool = False) -> DataFrame:
    """Store-B rows in clean names: listing cards joined to product pages by URL.

    Of several captures of a product page the latest counts, and its capture
    time gives the scrape day (H-18; UTC wall clock). A left join: a card whose
    product page is missing or unreadable is kept as a reject, never dropped
    (with ``page_rejects`` so is a listing page without cards).
    """
    cards = (
        store_b_listing_cards(listing_pages, keep=["page_id"], page_rejects=page_rejects)
        .withColumnRenamed("page_id", "listing_page")
        .withColumnRenamed("reject_reason", "card_reject")
    )
    products = store_b_products(product_pages, keep=["url", captured_col], page_rejects=True).drop("page_html")
    rest = [c for c in products.columns if c not in ("url", captured_col)]
    latest = products.groupBy("url").agg(F.max(F.struct(captured_col, *rest)).alias("p"))
    latest = latest.select("url", timefmt.scrape_day(F.col(f"p.{captured_col}")).alias("scrap_date"), *[f"p.{c}" for c in rest])
    latest = latest.withColumnRenamed("reject_reason", "page_reject")
    joined = cards.join(not_broadcast(latest), cards["prd_url"] == latest["url"], "left")
    reason = F.coalesce(
        F.col("card_reject"),
        F.when(F.col("url").isNull(), F.lit("missing:product_page")),
        F.col("page_reject"),
    )
    joined = joined.withColumn("reject_reason", reason).drop("url", "card_reject", "page_reject")
    joined = joined.withColumns({"sub_category": F.lit(None).cast("string"), "store": F.lit(STORE_B)})
    # the declared store-B schema (names, order, types) + bookkeeping columns
    return joined.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORE_B_SCHEMA.fields],
        "listing_page",
        "card",
        *(["page_html"] if page_rejects else []),
        "reject_reason",
    )


# F-2: store -> (listing pages, related pages) -> listing rows with a reject
# reason. Related are the parent pages (store A) or the product pages (store B).
EXTRACTORS = {
    "Loblaws": store_a_cards,
    STORE_B: store_b_rows,
}
