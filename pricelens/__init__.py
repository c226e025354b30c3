"""pricelens: retail price analytics on Spark.

Store pages and raw listing files -> clean, comparable price tables, as
DataFrame expressions (Python reads pages and CSV files, over Arrow batches).

Main entry points::

    from pricelens import clean_dispatch, split_rejects, read_listing_csv
    raw = read_listing_csv(spark, "<landing>")             # S-1, S-3
    good, rejects = split_rejects(clean_dispatch(raw))     # F-1, P-22, A-1, P-23
    upsert_clean_rows(spark, with_record_meta(good), "<table>")            # K-5
"""

from .operators.clean import clean_listings, clean_store_a, clean_store_a_rows, first_listings, split_rejects, with_record_meta
from .operators.closure import page_closure, page_links
from .operators.dispatch import clean_dispatch, union_stores
from .operators.extract import EXTRACTORS, split_cards, store_a_cards, store_b_rows
from .operators.lookup import lookup, unknown_keys
from .operators.open_schema import extra_field, union_open
from .operators.quality import Quality
from .operators.worklist import store_a_page_urls, store_b_page_urls, worklist
from .schemas import CLEAN_LISTING_SCHEMA, DEFAULT_UPSERT_KEY, RAW_LISTING_SCHEMA
from .sinks.files import json_record, write_by_store, write_csv, write_json
from .sinks.named_files import write_named_files
from .sinks.upsert import upsert, write_upsert
from .sources.listings import read_listing_csv, read_store_config, store_dimension, stream_listing_csv
from .sources.pages import decode_pages, read_page_files, read_pages
from .streaming.alerts import alerts_once, failure_alerts, start_alert_once_stream, start_alert_stream
from .streaming.files import clean_and_upsert_batch, start_clean_upsert_stream, upsert_clean_rows

__all__ = [
    "CLEAN_LISTING_SCHEMA",
    "DEFAULT_UPSERT_KEY",
    "EXTRACTORS",
    "Quality",
    "RAW_LISTING_SCHEMA",
    "alerts_once",
    "clean_and_upsert_batch",
    "clean_dispatch",
    "clean_listings",
    "clean_store_a",
    "clean_store_a_rows",
    "decode_pages",
    "extra_field",
    "failure_alerts",
    "first_listings",
    "json_record",
    "lookup",
    "page_closure",
    "page_links",
    "read_listing_csv",
    "read_page_files",
    "read_pages",
    "read_store_config",
    "split_cards",
    "split_rejects",
    "start_alert_once_stream",
    "start_alert_stream",
    "start_clean_upsert_stream",
    "store_a_cards",
    "store_a_page_urls",
    "store_b_page_urls",
    "store_b_rows",
    "store_dimension",
    "stream_listing_csv",
    "union_open",
    "union_stores",
    "unknown_keys",
    "upsert",
    "upsert_clean_rows",
    "with_record_meta",
    "worklist",
    "write_by_store",
    "write_csv",
    "write_json",
    "write_named_files",
    "write_upsert",
]
