"""H-8 to H-16 together: all pages that lead on from some pages.

A category page links to listing pages (See All), a listing page's pager to
its pages, and these may lead on again. ``page_links`` gives these links of the
captured pages; ``page_closure`` follows them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path
from . import extract as X
from . import worklist as W


def page_links(pages: DataFrame) -> DataFrame:
    """(from_url, to_url): See-All links and pager pages of store-A pages.

    Links and pagers are read from each captured page; a page of a pager
    (``?page=i``) has the same pager as the others, so the pages of a pager are
    those of the URL without the query. A page is parsed once for both.
    """
    leads = W.store_a_page_urls(X.store_a_leads(pages))
    return leads.select("from_url", F.col("page_url").alias("to_url")).where("to_url is not null")


def page_closure(seeds: DataFrame, links: DataFrame, captured: DataFrame | None = None) -> DataFrame:
    """(url, depth, captured): every URL that links lead to from the ``url``s of
    ``seeds``, with the least number of links, and whether ``captured`` has it.

    Frontier rounds: the URLs found last are joined with the links, new ones are
    written to the shared folder and are the next frontier; the rounds end when
    there are none, so circles of links do no harm. Only new URLs move in a
    round; a URL with many links is split by the join, not collected. Null URLs
    are ignored, a repeated seed counts once. The links are read once per
    round: pass a written table.
    """
    spark = seeds.sparkSession
    path = scratch_path(spark, "closure")
    frontier = seeds.select(F.col("url").cast("string").alias("url")).where("url is not null").distinct()
    depth = 0
    while True:
        frontier.withColumn("depth", F.lit(depth)).write.parquet(f"{path}/round={depth}")
        last = spark.read.schema("url string, depth int").parquet(f"{path}/round={depth}")
        if last.isEmpty():
            break
        seen = spark.read.schema("url string, depth int").parquet(path)
        found = links.join(last, links["from_url"] == last["url"]).select(F.col("to_url").alias("url")).where("url is not null").distinct()
        frontier = found.join(seen, "url", "left_anti")
        depth += 1
    delete_path(spark, f"{path}/round={depth}")  # the empty round
    out = spark.read.schema("url string, depth int").parquet(path) if depth else seeds.sparkSession.createDataFrame([], "url string, depth int")
    if captured is None:
        return out
    have = captured.select(F.col("url").alias("_have")).where("_have is not null").distinct()
    return out.join(have, out["url"] == have["_have"], "left").select("url", "depth", F.col("_have").isNotNull().alias("captured"))
