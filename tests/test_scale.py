"""What lets the queries grow: plans, memory and files that do not depend on guesses."""

from pyspark.sql import functions as F

A_DAY = "2023-11-01 12:00:00"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_parsed_rows_do_not_go_through_the_driver(spark):
    from pricelens.operators import clean as C
    from pricelens.operators import extract as X
    from pricelens.schemas import RAW_LISTING_COLUMNS

    pages = spark.createDataFrame([(1, "u", "<p></p>")], "page_id long, url string, html string").withColumn("captured_at", F.lit(A_DAY).cast("timestamp_ntz"))
    raw = pages.select(F.col("url").alias("file"), F.col("page_id").alias("pos"), *[F.lit("x").alias(c) for c in RAW_LISTING_COLUMNS])
    for df in (X.store_b_rows(pages, pages), X.store_a_cards(pages, pages), C.clean_store_a(raw)):
        assert "Broadcast" not in plan(df) and "SortMergeJoin" in plan(df)


def test_plain_pages_give_the_stdlib_parsers_tree():
    from pricelens.functions import html as H

    pages = [
        '<!DOCTYPE html><html><head><title>a &amp; b</title><script>x("</p>", 1<2)</script><style>p>b</style></head><body><!-- c --><P Class="b  a" id=\'q\'>t</P></body></html>',
        '<ul><li class="a b" class="c">1<li>2 &lt; 3</ul><br/><img src="x?a=1&amp;b=2"/>tail > end',
        "<p>a & b</p><template>hid</template>x</b>",
    ]
    seen = 0
    for page in pages:
        whole = H._Tree()
        whole.feed(page)
        whole.finish()
        for plain in filter(None, [H.plain_tree(page), H.parse_tree(page)]):
            seen += 1
            for name in ("tags", "attrs", "parent", "last", "cls", "start", "end", "by_tag", "by_class", "by_attr", "visible", "all"):
                assert getattr(plain, name) == getattr(whole, name)
    assert seen >= 5
    for page in ("<a href=x>", "<p", "a < b", "<![CDATA[x]]>", "<!-- a - b -->", "<script>1", "<title>a<b></title>", "<p>a &amp"):
        assert H.plain_tree(page) is None


def test_links_and_pagers_of_a_page_come_from_one_parse(spark):
    from pricelens.operators.closure import page_links

    html = '<div id="site-content"><a data-testid="nav-list-link" href="/x">See All</a><nav>' + "<button>.</button>" * 4 + "</nav></div>"
    links = page_links(spark.createDataFrame([("https://u/c?page=2", html), ("v", None), ("w", "<p>")], "url string, html string"))
    assert plan(links).count("MapInArrow") == 1
    assert sorted(r.to_url.split("/", 3)[-1] for r in links.collect()) == ["c?page=1", "c?page=2", "x"]


def test_a_page_is_parsed_once_for_the_cleaner(spark):
    from pricelens.plans.queries_html import q_cards_to_clean

    assert "MapInArrow" not in plan(q_cards_to_clean(spark, "/root/testdata/sf0.001"))


def test_a_folder_is_written_by_one_task(spark, tmp_path):
    from pricelens.sinks.files import write_by_store

    df = spark.range(400).selectExpr("CAST(id % 4 AS STRING) AS store", "id").repartition(8, "id")
    write_by_store(df, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("store=*/*.parquet"))) == 4 and spark.read.parquet(str(tmp_path / "t")).count() == 400


def test_a_csv_file_is_not_held_as_text():
    import tracemalloc

    import pyarrow as pa

    from pricelens.functions.csvrows import file_rows

    for content, rows in ((None, []), (b"", []), (b"\xef", []), (b"\xef\xbb\xbfa,b\r\n1,\"x\ny\"\r\n\xff,2", [["1", "x\ny"], ["�", "2"]])):
        assert [cells for _, cells, _ in file_rows(content)] == rows
    content = pa.py_buffer(b"a,b\n" + b"1,xxxxxxxxxxxxxxxxxxxxxxxxxx\n" * 200_000)
    tracemalloc.start()
    n = sum(1 for _ in file_rows(content))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200_000 and peak < content.size / 4


def test_many_small_page_files_do_not_make_many_tasks(spark, tmp_path):
    from pricelens.sources.pages import read_page_files

    for i in range(400):
        (tmp_path / f"{i}.html").write_text(f"<p>{i}</p>")
    pages = read_page_files(spark, str(tmp_path))
    assert pages.rdd.getNumPartitions() <= 8 and pages.select("key").distinct().count() == 400


def test_the_chain_does_not_run_in_methods_too_large_to_compile(spark):
    from pricelens.operators import clean as C
    from pricelens.schemas import RAW_LISTING_COLUMNS

    limit = "spark.sql.codegen.hugeMethodLimit"
    raw = spark.range(3).select(F.lit("f").alias("file"), F.col("id").alias("pos"), *[F.lit("x").alias(c) for c in RAW_LISTING_COLUMNS])
    for before, after in (("65535", "8000"), ("4000", "4000")):
        spark.conf.set(limit, before)
        C.clean_store_a(raw)
        assert spark.conf.get(limit) == after
    spark.conf.unset(limit)
