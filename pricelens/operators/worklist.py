"""Work-list expansion (X-1, X-2) and page URL lists (H-16, H-17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import JOB_PREFIX

REASON_NO_PAGES = "pager:no_pages"


def page_numbers(n_pages) -> Column:
    """1..n, empty when n < 1 (``sequence(1, 0)`` would count down to 0)."""
    n = F.col(n_pages) if isinstance(n_pages, str) else n_pages
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _page_rows(info: DataFrame, n_col: str, url: Column) -> DataFrame:
    """One row per page; a pager that counts to no page keeps its row, without
    page and URL but with a reason."""
    rows = info.select("*", F.explode_outer(page_numbers(n_col)).alias("page_no"))
    none = F.col("page_no").isNull()
    return rows.withColumns({"page_url": F.when(~none, url), "reject_reason": F.when(none, F.lit(REASON_NO_PAGES))})


def store_a_page_urls(info: DataFrame, url_col: str = "url", n_col: str = "n_pages", pager_col: str = "has_pager") -> DataFrame:
    """H-16: ``root?page=1 .. root?page=n``; without a pager the URL as it is."""
    numbered = F.concat(F.col(url_col), F.lit("?page="), F.col("page_no").cast("string"))
    return _page_rows(info, n_col, F.when(F.col(pager_col), numbered).otherwise(F.col(url_col)))


def store_b_page_urls(info: DataFrame, url_col: str = "url", n_col: str = "n_pages") -> DataFrame:
    """H-17: ``root`` then ``root?p=i`` for i >= 2 (each from the root URL)."""
    numbered = F.concat(F.col(url_col), F.lit("?p="), F.col("page_no").cast("string"))
    return _page_rows(info, n_col, F.when(F.col("page_no") == 1, F.col(url_col)).otherwise(numbered))


def worklist(stores: DataFrame, shards: DataFrame, prefix: str = JOB_PREFIX) -> DataFrame:
    """X-1/X-2: one row per (store, shard) with its job name."""
    dim = shards.select("store", F.explode("shards").alias("shard"))
    jobs = stores.select("store").distinct().join(dim, "store", "inner")
    return jobs.withColumn("job_name", F.concat_ws("_", F.lit(prefix), F.col("store"), F.col("shard").cast("string")))
