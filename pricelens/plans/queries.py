"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver tables (or data Spark derives from them), runs one
operator family of the library over the whole table, and returns a
DataFrame whose column names match the DuckDB oracle in ``oracles.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pricing as P
from ..functions import timefmt
from ..operators import clean as C
from ..schemas import CLEAN_COLUMNS
from .fixtures import raw_listings, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_listings(read_table(spark, sf_dir, "part"))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw row cleaned on its own (no de-duplication), keyed by ``k``."""
    return C.clean_store_a_rows(_raw(spark, sf_dir), keep=["k", "file", "pos"])


def _clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows of the full chain, keyed by ``k`` (= ``pos``)."""
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    return good.withColumn("k", F.col("pos"))


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full chain (A-1 then cleaning) over the raw rows, with reasons."""
    return C.clean_store_a(_raw(spark, sf_dir).drop("k"))


# --- 2.4 projections / scalar functions --------------------------------------
@query("clean_listings")
def clean_listings(spark, sf_dir):
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    return good.select(*CLEAN_COLUMNS)


@query("clean_listings_lines")
def clean_listings_lines(spark, sf_dir):
    """The same chain over listing text built from ``lineitem`` (30x the rows
    of ``part``, many duplicate product ids per file)."""
    raw = raw_listings(read_table(spark, sf_dir, "lineitem"), source="lineitem").drop("k")
    good, _ = C.split_rejects(C.clean_store_a(raw))
    return good.select(*CLEAN_COLUMNS)


@query("product_id")
def q_product_id(spark, sf_dir):
    return _raw(spark, sf_dir).select("k", "prd_link", P.product_id("prd_link").alias("prd_id_in_store"))


@query("promo_category")
def q_promo(spark, sf_dir):
    return _rows(spark, sf_dir).select("k", "prd_discount", "on_sale_cat")


@query("parse_price")
def q_parse_price(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select("k", F.col("prd_price").alias("prd_price_text"), P.parse_price("prd_price").alias("prd_price"))


@query("unit_price")
def q_unit_price(spark, sf_dir):
    raw = _raw(spark, sf_dir).filter(F.col("prd_per_price").isNotNull())
    parts = P.unit_parts("prd_per_price")
    df = raw.select(
        "k",
        parts.n_parts.alias("n_parts"),
        parts.unit_part.alias("unit_part"),
        parts.price_part.alias("price_part"),
        parts.price_per_unit_1.alias("price_per_unit_1"),
        parts.price_per_unit_2.alias("price_per_unit_2"),
    )
    up = P.unit_price("price_per_unit_1")
    return df.select("*", up.unit_price.alias("unit_price"), up.base.alias("unit_base"), up.word.alias("unit_word"))


@query("average_unit")
def q_average_unit(spark, sf_dir):
    return _clean_rows(spark, sf_dir).select("k", "prd_price", "average_unit")


@query("unit_price_text")
def q_unit_price_text(spark, sf_dir):
    return _clean_rows(spark, sf_dir).select("k", "price_per_unit_1", "price_per_unit_2")


@query("na_words")
def q_na_words(spark, sf_dir):
    return _rows(spark, sf_dir).select("k", "prd_brand", "prd_discount")


@query("clean_name")
def q_clean_name(spark, sf_dir):
    return _raw(spark, sf_dir).select("k", P.clean_name("prd_name").alias("prd_name"))


@query("rejects")
def q_rejects(spark, sf_dir):
    _, bad = C.split_rejects(_chain(spark, sf_dir))
    raw = {"raw_date": "date", "raw_price": "prd_price", "raw_per_price": "prd_per_price", "raw_link": "prd_link"}
    return bad.select("file", "pos", "prd_id_in_store", "reject_reason", *[F.col("raw").getItem(c).alias(a) for a, c in raw.items()])


@query("record_id")
def q_record_id(spark, sf_dir):
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    return good.select(
        "store", "prd_id_in_store", "scrap_date", P.record_id("store", "prd_id_in_store", "scrap_date").alias("record_id")
    )


@query("processing_time")
def q_processing_time(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", timefmt.iso_local_text("ts").alias("processing_time"))


@query("scrape_day")
def q_scrape_day(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        timefmt.scrape_day("ts").alias("scrap_date"),
        timefmt.file_name_day("ts").alias("file_day"),
    )


# --- 2.5 aggregations ----------------------------------------------------------
@query("dedup_first")
def q_dedup_first(spark, sf_dir):
    raw = C.with_product_id(_raw(spark, sf_dir).drop("k")).filter(F.col("prd_id_in_store").isNotNull())
    return C.first_listings(raw).select("file", "prd_id_in_store", "pos")


@query("part_width")
def q_part_width(spark, sf_dir):
    return C.part_width(_raw(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the other plan modules registers their queries
    from . import queries_html, queries_io  # noqa: F401

    return dict(QUERIES)
