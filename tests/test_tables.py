"""De-duplication, upsert, streams and the driver contract."""

import os

from conftest import SF_SMALL, raw_df
from pyspark.sql import functions as F

from pricelens.operators import clean as C
from pricelens.session import scratch_path
from pricelens.sinks.upsert import latest_per_key, upsert, write_upsert


def test_first_listings_with_hot_key(spark):
    # one key holds most rows; the first by position must win
    rows = [("f", "/hot", 1000 - i, f"v{i}") for i in range(1000)] + [("f", "/cold", 1005, "c"), ("g", "/hot", 7, "g"), ("f", None, 2000, "n"), ("f", None, 2001, "n")]
    df = spark.createDataFrame(rows, "file string, prd_link string, pos long, v string").repartition(8)
    got = sorted((r.file, r.prd_link or "", r.pos, r.v) for r in C.first_listings(df).collect())
    assert got == [("f", "", 2000, "n"), ("f", "", 2001, "n"), ("f", "/cold", 1005, "c"), ("f", "/hot", 1, "v999"), ("g", "/hot", 7, "g")]


def test_every_row_is_clean_rejected_or_duplicate(spark):
    from pricelens.plans.fixtures import raw_listings, read_table

    raw = raw_listings(read_table(spark, SF_SMALL, "part")).drop("k")
    good, bad = C.split_rejects(C.clean_store_a(raw))
    with_id = C.with_product_id(raw).filter(F.col("prd_id_in_store").isNotNull())
    dupes = with_id.count() - with_id.select("file", "prd_id_in_store").distinct().count()
    assert dupes > 0 and bad.count() > 0
    assert good.count() + bad.count() + dupes == raw.count()


def test_odd_row_leaves_others_unchanged(spark):
    base = [{"date": "2023-11-20", "prd_price": "$5.99", "prd_per_price": "500 g, $1.20/100g", "prd_link": f"https://h/a/p/{i}_EA"} for i in range(3)]
    odd = {"date": "2023-11-20", "prd_price": "$5.99", "prd_per_price": "a, b, c, d, $1/1g", "prd_link": "https://h/a/p/9_EA"}
    cols = ["pos", "average_unit", "price_per_unit_1", "reject_reason"]
    alone = C.clean_store_a(raw_df(spark, base)).select(*cols).orderBy("pos").collect()
    mixed = C.clean_store_a(raw_df(spark, base + [odd])).select(*cols).orderBy("pos").collect()
    assert mixed[:3] == alone and mixed[3].reject_reason == "parts"


def test_upsert_latest_wins(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, seq int")
    assert sorted(tuple(r) for r in upsert(target, batch, ["k"], "seq").collect()) == [(1, "a"), (2, "y"), (3, "z")]
    assert latest_per_key(batch, ["k"], "seq").count() == 2


def test_write_upsert_touches_only_batch_partitions(spark):
    path = scratch_path(spark, "test-upsert")
    first = spark.createDataFrame([("A", "1", "d1", 1.0, 0), ("A", "2", "d2", 2.0, 0)], "store string, id string, day string, p double, seq int")
    write_upsert(spark, path, first, ["store", "id", "day"], "seq", ["store", "day"])
    second = spark.createDataFrame([("A", "1", "d1", 9.0, 1)], "store string, id string, day string, p double, seq int")
    for _ in range(2):  # replaying the same batch changes nothing
        write_upsert(spark, path, second, ["store", "id", "day"], "seq", ["store", "day"])
    got = sorted((r.id, r.day, r.p) for r in spark.read.parquet(path).collect())
    assert got == [("1", "d1", 9.0), ("2", "d2", 2.0)]


def write_file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


HEAD = "date,category,sub_category,prd_name,prd_brand,prd_price,prd_per_price,prd_discount,prd_link,prd_img\n"


def listing(i, price, name="n", day="2023-11-12"):
    return f"{day},c,s,{name},b,${price},250 ml,,https://h/a/p/{i}_EA,\n"


def test_stream_routes_files_by_store_and_name(spark, tmp_path):
    from pricelens.streaming.files import start_clean_upsert_stream

    land = tmp_path / "land"
    write_file(land / "Loblaws", "Loblaws_2023-11-12_2.csv", HEAD + listing(1, "1.00", '"two\nlines"') + listing(2, "2.00") + listing(2, "3.00") + "2023-11-12,c,s,n,b,$1,1 ml,,l,i,extra\n")
    order = "prd_link,prd_price,prd_name,date,prd_per_price,more\n"
    write_file(land / "Loblaws", "Loblaws_2023-11-12_3.csv", order + "https://h/a/p/9_EA,$9.00,swapped,2023-11-12,250 ml,x\n")
    write_file(land / "HMart", "HMart_2023-11-12_1.csv", "scrap_date,prd_url,prd_price\n2023-11-12,https://m/p/1.html,$4.00\n")
    write_file(land / "Metro", "Metro_2023-11-12_1.csv", HEAD + listing(5, "5.00"))
    table, rejects = str(tmp_path / "table"), str(tmp_path / "rejects")
    start_clean_upsert_stream(spark, str(land), table, str(tmp_path / "ckpt"), rejects_path=rejects).awaitTermination()
    good = {r.prd_id_in_store: (r.store, r.prd_name, str(r.prd_price), r.category) for r in spark.read.parquet(table).collect()}
    assert good == {"1_EA": ("Loblaws", "two\nlines", "1.00", "c"), "2_EA": ("Loblaws", "n", "2.00", "c"), "9_EA": ("Loblaws", "swapped", "9.00", None)}
    bad = sorted((r.store, r.reject_reason, r.raw.get("prd_url") or r.raw.get("prd_link")) for r in spark.read.parquet(rejects).collect())
    assert bad == [("HMart", "unknown_store", "https://m/p/1.html"), ("Loblaws", "columns", "l"), ("Metro", "unknown_store", "https://h/a/p/5_EA")]


def test_last_arrival_wins_and_replay_changes_nothing(spark, tmp_path):
    from pricelens.sources.listings import read_listing_csv
    from pricelens.streaming.files import clean_and_upsert_batch

    land, table = tmp_path / "land", str(tmp_path / "table")
    write_file(land / "Loblaws", "Loblaws_2023-11-12_9.csv", HEAD + listing(1, "1.00") + listing(3, "3.00", day="12/11/2023"))
    write_file(land / "Loblaws", "Loblaws_2023-11-12_2.csv", HEAD + "".join(listing(i, "7.00") for i in range(50, 500)) + listing(1, "2.00"))
    os.utime(land / "Loblaws" / "Loblaws_2023-11-12_9.csv", (1e9, 1e9))
    for _ in range(3):
        clean_and_upsert_batch(spark, read_listing_csv(spark, str(land)), table, str(tmp_path / "rejects"))
        rows = spark.read.parquet(table).collect()
        assert len(rows) == 451 and [str(r.prd_price) for r in rows if r.prd_id_in_store == "1_EA"] == ["2.00"]
    bad = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [(r.reject_reason, r.raw["date"]) for r in bad] == [("date", "12/11/2023")]


def test_store_b_rows_reach_the_table(spark, tmp_path):
    from pricelens.operators import extract as X
    from pricelens.operators.dispatch import union_stores
    from pricelens.plans.fixtures import raw_listings, read_table
    from pricelens.plans.html_fixtures import part_pages, product_pages
    from pricelens.streaming.files import upsert_clean_rows

    part = read_table(spark, SF_SMALL, "part")
    b = X.EXTRACTORS["HMart"](part_pages(part, "store_b_listing"), product_pages(part)).drop("listing_page", "card")
    good, _ = C.split_rejects(C.clean_store_a(raw_listings(part).drop("k")))
    rows, bad = C.split_rejects(union_stores(good.drop("file", "pos"), b))
    table = str(tmp_path / "t")
    for _ in range(2):
        upsert_clean_rows(spark, C.with_record_meta(rows).withColumn("pos", F.lit(0)), table)
    got = spark.read.parquet(table)
    assert got.count() == rows.count() and got.where("record_id is null or scrap_date is null").count() == 0
    assert got.where("store = 'HMart'").count() > 0 and bad.where("reject_reason = 'price'").count() > 0


def test_upsert_refuses_null_keys(spark):
    import pytest

    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(None, "x", 1)], "k int, v string, seq int")
    with pytest.raises(Exception, match="null in key column k"):
        upsert(target, batch, ["k"], "seq").collect()


def test_scratch_folders_are_deleted(spark):
    from pricelens.session import local_path, written_once

    with written_once(spark.range(5), "gone") as df:
        path = local_path(df.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "file:"))
        assert os.path.isdir(path) and df.count() == 5
    assert not os.path.isdir(path)


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert os.path.exists("/root/testdata/sf0.001/part.parquet")


def test_stream_takes_each_file_once(spark):
    from pricelens.plans.fixtures import raw_listings, read_table
    from pricelens.sources.listings import write_listing_csv
    from pricelens.streaming.files import start_clean_upsert_stream

    raw = raw_listings(read_table(spark, SF_SMALL, "part"))
    landing, table, ckpt = (scratch_path(spark, n) for n in ("t-land", "t-table", "t-ckpt"))
    write_listing_csv(raw.filter("shard < 5"), landing)
    start_clean_upsert_stream(spark, landing, table, ckpt).awaitTermination()
    n1 = spark.read.parquet(table).count()
    start_clean_upsert_stream(spark, landing, table, ckpt).awaitTermination()  # restart: nothing new
    assert spark.read.parquet(table).count() == n1
    write_listing_csv(raw.filter("shard >= 5"), landing)  # a new arrival
    start_clean_upsert_stream(spark, landing, table, ckpt).awaitTermination()
    full = C.split_rejects(C.clean_store_a(raw.drop("k")))[0].count()
    assert 0 < n1 < full and spark.read.parquet(table).count() == full
    from pricelens.sources.listings import read_listing_csv

    assert read_listing_csv(spark, landing).count() == raw.count()


def test_row_order_does_not_change_results(spark):
    from pricelens.plans.fixtures import raw_listings, read_table

    raw = raw_listings(read_table(spark, SF_SMALL, "part")).drop("k")
    shuffled = raw.orderBy(F.rand(7)).repartition(5)  # same rows (and positions), other order
    a = sorted(map(tuple, C.clean_store_a(raw).collect()), key=repr)
    b = sorted(map(tuple, C.clean_store_a(shuffled).collect()), key=repr)
    assert a == b


def test_write_upsert_rejects_a_different_layout(spark):
    import pytest

    path = scratch_path(spark, "test-upsert-layout")
    a = spark.createDataFrame([("A", "1", "d1", 1.0, 0)], "store string, id string, day string, p double, seq int")
    write_upsert(spark, path, a, ["store", "id", "day"], "seq", ["store", "day"])
    b = a.withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="do not match"):
        write_upsert(spark, path, b, ["store", "id", "day"], "seq", ["store", "day"])


def test_upsert_reads_only_the_batch_partitions(spark):
    from pricelens.sinks.upsert import _values

    path = scratch_path(spark, "test-prune")
    rows = spark.createDataFrame([(str(i % 5), i, f"d{i % 3}", float(i)) for i in range(60)], "store string, id int, day string, p double")
    rows.write.partitionBy("store", "day").parquet(path)
    current = spark.read.schema(rows.schema).parquet(path)
    batch = rows.where("id < 2")
    touched = current.join(_values(batch, ["store", "day"]), ["store", "day"], "left_semi")
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString()
    assert {(r.store, r.day) for r in touched.collect()} == {("0", "d0"), ("1", "d1")}
    write_upsert(spark, path, batch.withColumn("p", F.lit(-1.0)).withColumn("seq", F.lit(1)), ["store", "id", "day"], "seq", ["store", "day"])
    after = spark.read.schema(rows.schema).parquet(path)
    assert after.count() == 60 and after.where("p = -1").count() == 2


def test_no_cell_is_lost(spark, tmp_path):
    from pricelens.sources.listings import read_listing_csv

    land = tmp_path / "land"
    head = ",".join(f"h{i}" for i in range(60))
    write_file(land / "A", "wide.csv", head + "\n" + ",".join(f"0{i}" for i in range(60)) + "\n" + "x\n\n" + ",".join("y" * 63) + "\n" + ",".join(["z"] * 60) + ",,\n")
    write_file(land / "B", "odd.csv", "﻿a,a,,b,a.1,\n1,2,,4,5,\n1,2,3,4,5,\n\"q\"\"q\",\"l\nl\", s ,,\"\",6\n")
    write_file(land / "C", "empty.csv", "")
    write_file(land / "C", "head.csv", "a,b\n")
    rows = {(r.store, r.pos): r for r in read_listing_csv(spark, str(land), ["h0", "h59", "a", "nothing"]).collect()}
    assert sorted(rows) == [("A", 1), ("A", 2), ("A", 3), ("A", 4), ("B", 1), ("B", 2), ("B", 3)]
    a1, a2, a3, a4 = (rows["A", i] for i in (1, 2, 3, 4))
    assert (a1.h0, a1.h59, a1.malformed, len(a1.cells), a1.nothing) == ("00", "059", False, 60, None)
    assert (a2.h0, a2.h59, a2.malformed) == ("x", None, False)
    assert a3.malformed and [a3.cells[f"+{i}"] for i in (1, 2, 3)] == ["y"] * 3
    assert not a4.malformed and a4.cells["+2"] is None
    b1, b2, b3 = (rows["B", i] for i in (1, 2, 3))
    assert b1.cells == {"a": "1", "a.2": "2", "Unnamed: 2": None, "b": "4", "a.1": "5", "Unnamed: 5": None} and not b1.malformed
    assert b2.malformed and b2.cells["Unnamed: 2"] == "3"
    assert b3.malformed and b3.cells["a"] == 'q"q' and b3.cells["a.2"] == "l\nl" and b3.cells["Unnamed: 2"] == " s " and b3.cells["Unnamed: 5"] == "6"


def test_a_huge_cell(spark, tmp_path):
    from pricelens.sources.listings import read_listing_csv

    write_file(tmp_path / "l" / "A", "f.csv", "a,b\n" + "v" * 500_000 + ",1\n")
    assert [len(r.a) for r in read_listing_csv(spark, str(tmp_path / "l"), ["a"]).collect()] == [500_000]


def test_named_files_commit_and_abort(spark, tmp_path):
    import pytest

    from pricelens.sinks.named_files import checked_name, write_named_files

    path = tmp_path / "out"
    df = spark.createDataFrame([("s/b.csv", 2, "x,\n\"y\""), ("s/a.csv", 1, None), ("s/b.csv", 1, "é")], "file string, pos int, v string")
    write_named_files(df, f"file:{path}", order=["pos"])
    listed = lambda: sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file())
    assert listed() == ["s/a.csv", "s/b.csv"]
    assert (path / "s/b.csv").read_text() == 'v\né\n"x,\n""y"""\n' and (path / "s/a.csv").read_text() == 'v\n""\n'
    # a task that fails for good: nothing of the run is seen, nothing is left over
    bad = df.withColumn("v", F.expr("CASE WHEN file = 's/a.csv' AND pos = 1 THEN raise_error('broken') ELSE 'new' END"))
    with pytest.raises(Exception):
        write_named_files(bad, str(path), order=["pos"])
    assert listed() == ["s/a.csv", "s/b.csv"] and "new" not in (path / "s/b.csv").read_text() and sorted(p.name for p in path.iterdir()) == ["s"]
    write_named_files(df.where("file = 's/b.csv'").withColumn("v", F.lit("n")), str(path), order=["pos"])
    assert listed() == ["s/a.csv", "s/b.csv"] and (path / "s/b.csv").read_text() == "v\nn\nn\n"
    write_named_files(df.where("file = 's/a.csv'"), str(path), order=["pos"], mode="overwrite")
    assert listed() == ["s/a.csv"]
    for name in (None, "", "/a", "../a", "a/../b", "a//b", ".hidden", "a/_x"):
        with pytest.raises(ValueError):
            checked_name(name)


def test_charsets(spark):
    from pricelens.functions.charset import decode_page
    from pricelens.sources.pages import decode_pages

    text = "<html><p>é ß “x” €</p>"
    assert decode_page(text.encode()) == (text, "utf-8") and decode_page(None) == (None, None) and decode_page(b"") == ("", "utf-8")
    assert decode_page(b"\xef\xbb\xbf" + text.encode(), "latin1") == (text, "utf-8")
    assert decode_page(text.encode("utf-16")) == (text, "utf-16-le")
    assert decode_page(b"\xfe\xff" + text.encode("utf-16-be")) == (text, "utf-16-be")
    assert decode_page(text.encode("cp1252")) == (text, "cp1252")  # nothing said, not UTF-8
    assert decode_page("я".encode("koi8-r"), "text/html; charset=KOI8-R") == ("я", "koi8-r")
    assert decode_page(b'<meta http-equiv="x" content="text/html; charset=windows-1251">' + "я".encode("cp1251"))[0].endswith("я")
    assert decode_page(b"<meta charset='utf-16'>" + "é".encode())[1] == "utf-8"
    assert decode_page("é".encode(), "no-such-charset") == ("é", "utf-8") and decode_page("é".encode(), "hex") == ("é", "utf-8")
    assert decode_page(b"a\xffb", "utf-8") == ("a�b", "utf-8")
    df = spark.createDataFrame([(1, bytearray(text.encode("utf-16")), None), (2, None, None), (3, bytearray("я".encode("koi8-r")), "koi8-r")], "id int, content binary, said string")
    got = {r.id: (r.html, r.charset) for r in decode_pages(df, header_col="said").collect()}
    assert got == {1: (text, "utf-16-le"), 2: (None, None), 3: ("я", "koi8-r")}


def test_page_closure(spark):
    from pricelens.operators.closure import page_closure

    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "b"), ("c", "d"), ("x", "y"), ("d", None), (None, "z")], "from_url string, to_url string")
    seeds = spark.createDataFrame([("a",), ("a",), ("q",), (None,)], "url string")
    got = page_closure(seeds, links, spark.createDataFrame([("a",), ("a",), ("d",), (None,)], "url string")).collect()
    assert sorted((r.url, r.depth, r.captured) for r in got) == [("a", 0, True), ("b", 1, False), ("c", 2, False), ("d", 3, True), ("q", 0, False)]
    assert page_closure(seeds.limit(0), links).count() == 0 and page_closure(seeds, links.limit(0)).count() == 2


def test_alerts_once_keep_state_and_forget_it(spark, tmp_path):
    import datetime as dt

    from pricelens.schemas import FAILURE_DETAIL_TYPE, FAILURE_SOURCE, FAILURE_STATUS, JOB_EVENT_SCHEMA
    from pricelens.streaming.alerts import alerts_once, start_alert_once_stream

    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    event = lambda i, ts, status=FAILURE_STATUS: (i, ts, FAILURE_DETAIL_TYPE, FAILURE_SOURCE, status, "job")
    deliveries = [
        [event(1, day(1)), event(1, day(1)), event(2, day(1), "SUCCEEDED"), event(None, day(1))],
        [event(3, day(2)), event(1, day(1)), event(4, day(1, 12))],  # 4 is late, 1 comes again
        [event(5, day(9))],
        [event(1, day(1)), event(5, day(9)), event(6, day(9))],  # 1 is older than the watermark by now
    ]
    land, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    stream = spark.readStream.schema(JOB_EVENT_SCHEMA).parquet(land + "/*")
    for k, rows in enumerate(deliveries):
        spark.createDataFrame(rows, JOB_EVENT_SCHEMA).coalesce(1).write.parquet(f"{land}/{k}")
        q = start_alert_once_stream(stream, out, ckpt, delay="2 days")
        q.awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 3, 4, 5, 6]
    assert sum(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress[-1:]) <= 2  # the first days are forgotten
    batch = spark.createDataFrame([r for rows in deliveries for r in rows], JOB_EVENT_SCHEMA)
    assert sorted(r.event_id for r in alerts_once(batch).collect()) == [1, 3, 4, 5, 6]


def test_quality_figures_add_up(spark, tmp_path):
    from pricelens.operators.dispatch import clean_dispatch
    from pricelens.operators.quality import Quality
    from pricelens.plans.fixtures import raw_listings, read_table

    raw = raw_listings(read_table(spark, SF_SMALL, "part")).drop("k").withColumn("store", F.expr("CASE WHEN pos % 9 = 0 THEN 'Metro' ELSE 'Loblaws' END"))
    raw = raw.unionByName(raw.where("pos % 4 = 0").withColumn("pos", F.col("pos") + 1_000_000)).withColumn("malformed", F.col("pos") % 50 == 7)
    quality = Quality()
    clean_dispatch(raw, quality=quality).write.parquet(str(tmp_path / "out"))
    got, out = quality.figures(), spark.read.parquet(str(tmp_path / "out"))
    assert got["rows_in"] == raw.count() and got["kept"] == out.where("reject_reason is null").count()
    assert got["rows_in"] == got["duplicates"] + got["kept"] + sum(n for k, n in got.items() if k.startswith("reject:"))
    reasons = {f"reject:{r.reject_reason}": r["count"] for r in out.where("reject_reason is not null").groupBy("reject_reason").count().collect()}
    assert {k: n for k, n in got.items() if k.startswith("reject:") and n} == reasons and len(reasons) >= 5
    empty = Quality()
    clean_dispatch(raw.limit(0), quality=empty).write.parquet(str(tmp_path / "none"))
    assert set(empty.figures().values()) == {0}


def test_undeclared_columns_are_kept(spark):
    from pyspark.sql import types as T

    from pricelens.operators.open_schema import extra_field, merged_fields, union_open

    declared = T.StructType([T.StructField("id", T.StringType()), T.StructField("price", T.DecimalType(12, 2))])
    a = spark.createDataFrame([("1", "2.50", "x"), ("2", "ask", None)], "id string, price string, `odd name` string")
    b = spark.createDataFrame([("3", 4, [1, 2])], "id string, n int, list array<int>")
    c = spark.createDataFrame([("4", {"id": "4", "new": "007", "gone": None})], "id string, cells map<string,string>")
    rows = union_open([a, b, c], declared, cells="cells")
    got = {r.id: r for r in rows.select("*", extra_field("odd name").alias("odd"), extra_field("n", "int").alias("n"), extra_field("new").alias("new"), extra_field("price").alias("text"), F.to_json("extra").alias("j")).collect()}
    assert rows.columns == ["id", "price", "extra"] and len(got) == 4
    assert str(got["1"].price) == "2.50" and got["1"].odd == "x" and got["1"].text is None
    assert got["2"].price is None and got["2"].text == "ask" and got["2"].odd is None
    assert got["3"].n == 4 and got["3"].j == '{"list":[1,2],"n":4}' and got["4"].new == "007" and got["4"].j == '{"new":"007"}'
    assert "odd name: STRING" in merged_fields(rows).first().fields.replace("`", "") and union_open([b.limit(0)], declared).count() == 0
