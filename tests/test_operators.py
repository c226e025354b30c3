"""Paths, page lists, work list, lookups, JSON records, union, dispatch, alerts."""

import datetime as dt
import json

from conftest import raw_df
from pyspark.sql import functions as F

from pricelens.functions import paths
from pricelens.operators import dispatch as D
from pricelens.operators import worklist as W
from pricelens.sinks.files import json_record
from pricelens.sources.listings import store_dimension
from pricelens.streaming.alerts import failure_alerts


def test_path_columns(spark):
    df = spark.createDataFrame([("s3x://b/root/HMart/HMart_2023-11-20_7.csv",), ("root/odd.csv",)], "p string")
    key = paths.relative_key("p", "s3x://b/root")
    st, day, shard = paths.name_parts(paths.file_name("p"))
    rows = df.select(key.alias("k"), paths.key_store(key).alias("s"), st.alias("ns"), day.alias("d"), shard.alias("sh")).collect()
    assert tuple(rows[0]) == ("HMart/HMart_2023-11-20_7.csv", "HMart", "HMart", dt.date(2023, 11, 20), 7)
    assert (rows[1].ns, rows[1].d, rows[1].sh) == (None, None, None)


def test_page_numbers_guard(spark):
    df = spark.createDataFrame([(0, "u0", True), (1, "u1", False), (3, "u3", True)], "n_pages int, url string, has_pager boolean")
    a = W.store_a_page_urls(df).select("url", "page_url", "reject_reason").collect()
    assert [r.page_url for r in a] == [None, "u1", "u3?page=1", "u3?page=2", "u3?page=3"]
    assert [r.reject_reason for r in a] == ["pager:no_pages"] + [None] * 4
    b = W.store_b_page_urls(df.filter("n_pages = 3")).select("page_url").collect()
    assert [r.page_url for r in b] == ["u3", "u3?p=2", "u3?p=3"]


def test_worklist_counts(spark):
    stores = spark.createDataFrame([("Loblaws",), ("HMart",), ("Metro",), ("Loblaws",)], "store string")
    jobs = W.worklist(stores, store_dimension(spark).filter(F.col("shards").isNotNull()))
    assert jobs.count() == 42
    assert jobs.filter("store = 'HMart' AND shard = 4").count() == 0
    assert jobs.filter("job_name = 'daily_scrapping_Loblaws_15'").count() == 1


def test_json_record_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    rec = json.loads(df.select(json_record().alias("j")).first().j)
    assert rec == {"x": "a", "y": None}


def test_union_type_conflict(spark):
    a = spark.createDataFrame([("Loblaws", "SAVE $1")], "store string, prd_discount string")
    b = spark.createDataFrame([("HMart", True, "$3.50", "$4.00")], "store string, prd_discount boolean, prd_price string, org_price string")
    u = D.union_stores(a, b).orderBy("store").collect()
    assert (u[0].store, u[0].is_discounted, str(u[0].prd_price)) == ("HMart", True, "3.50")
    assert (u[1].store, u[1].prd_discount, u[1].is_discounted) == ("Loblaws", "SAVE $1", None)
    odd = spark.createDataFrame([("HMart", True, "ask", "$4.00")], "store string, prd_discount boolean, prd_price string, org_price string")
    bad = D.union_stores(a, odd).where("store = 'HMart'").first()
    assert (bad.reject_reason, bad.raw["prd_price"], bad.prd_price) == ("price", "ask", None)


def test_dispatch_unknown_store(spark):
    base = {"date": "2023-11-20", "prd_price": "$1.00", "prd_per_price": "250 ml", "prd_name": "n"}
    raw = raw_df(spark, [{**base, "prd_link": "https://h/a/p/1_EA"}, {**base, "prd_link": "https://h/a/p/2_EA"}])
    raw = raw.withColumn("store", F.when(F.col("pos") == 0, "Loblaws").otherwise("Metro"))
    out = {r.pos: r for r in D.clean_dispatch(raw).collect()}
    assert out[0].reject_reason is None and out[0].prd_id_in_store == "1_EA"
    assert out[1].reject_reason == "unknown_store" and out[1].prd_id_in_store is None
    assert out[1].raw["prd_link"].endswith("2_EA") and out[1].raw["prd_name"] == "n" and out[0].raw is None


def test_failure_pattern(spark):
    ev = spark.createDataFrame(
        [
            ("Batch Job State Change", "aws.batch", "FAILED"),
            ("Batch Job State Change", "aws.batch", "SUCCEEDED"),
            ("Batch Job State Change", "other", "FAILED"),
            ("Other", "aws.batch", "FAILED"),
        ],
        "detail_type string, source string, status string",
    )
    assert failure_alerts(ev).count() == 1


def test_store_zone_days_and_iso_text(spark):
    from pricelens.functions import timefmt

    df = spark.createDataFrame(
        [("2024-07-01 12:00:00",), ("2024-07-02 04:30:00",), ("2024-01-15 03:00:00.250000",)], "s string"
    ).select(F.col("s").cast("timestamp_ntz").alias("ts"))
    rows = df.select(
        timefmt.iso_local_text("ts").alias("iso"),
        timefmt.scrape_day("ts").alias("day"),
        timefmt.file_name_day("ts").alias("file_day"),
    ).collect()
    assert rows[0].iso == "2024-07-01T08:00:00-04:00"  # summer time, no fraction
    assert (rows[1].day, rows[1].file_day) == (dt.date(2024, 7, 2), dt.date(2024, 7, 1))  # the hour they differ
    assert rows[2].iso == "2024-01-14T22:00:00.250000-05:00" and rows[2].day == dt.date(2024, 1, 14)


def test_scale_conf_sizes_shuffles():
    from pricelens.session import scale_conf

    conf = scale_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_dispatch_registry_is_extensible(spark):
    from pricelens.operators import clean as C

    base = {"date": "2023-11-20", "prd_price": "$1.00", "prd_per_price": "250 ml", "prd_name": "n"}
    raw = raw_df(spark, [{**base, "prd_link": f"https://h/a/p/{i}_EA"} for i in range(3)])
    raw = raw.withColumn("store", F.element_at(F.array(F.lit("Loblaws"), F.lit("Other"), F.lit("Else")), (F.col("pos") + 1).cast("int")))
    registry = {"Loblaws": C.clean_listings, "Other": lambda df, store_col, stores: C.clean_listings(df, store_col, stores)}
    out = {r.pos: (r.store, r.reject_reason) for r in D.clean_dispatch(raw, registry).collect()}
    assert out == {0: ("Loblaws", None), 1: ("Other", None), 2: ("Else", "unknown_store")}


def test_store_config_file(spark, tmp_path):
    from pricelens.sources.listings import read_store_config, store_dimension

    text = "# stores\n---\nLoblaws: https://www.loblaws.ca/\n'H Mart' : \"https://h/a#b\"  # quoted\n\nMetro: https://m/x#y # note\nEmpty:\nLoblaws: https://second/\nnot a pair\n"
    (tmp_path / "c.yaml").write_text(text)
    got = {r.store: r.site for r in read_store_config(spark, str(tmp_path / "c.yaml")).collect()}
    assert got == {"Loblaws": "https://second/", "H Mart": "https://h/a#b", "Metro": "https://m/x#y", "Empty": None}
    dim = {r.store: (r.site, r.shards) for r in store_dimension(spark).collect()}
    assert dim["HMart"][1] == [1, 2, 3, *range(5, 14)] and dim["NoFrills"][1] is None
