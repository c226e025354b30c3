"""Registered source / sink / join / stream queries.

Queries that write (CSV, Parquet, streams) use a fresh folder under the
shared checkpoint folder (``spark.checkpoint.dir``) and return what was
read back, so the comparison covers the round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions import paths
from ..operators import clean as C
from ..operators import dispatch as D
from ..operators import extract as X
from ..operators import lookup as L
from ..operators import worklist as W
from ..operators.open_schema import extra_field, read_merged, union_open
from ..operators.quality import Quality
from ..schemas import CLEAN_COLUMNS, CLEAN_LISTING_SCHEMA, JOB_EVENT_SCHEMA, RAW_LISTING_COLUMNS
from ..session import scratch_path
from ..sinks import files as K
from ..sinks.named_files import write_named_files
from ..sinks.upsert import upsert
from ..sources.listings import read_listing_csv, read_store_config, store_dimension, stream_listing_csv, write_listing_csv
from ..sources.pages import decode_pages, read_page_files, read_pages
from ..streaming.alerts import start_alert_once_stream, start_alert_stream
from ..streaming.files import clean_and_upsert_batch, start_clean_upsert_stream
from .fixtures import raw_listings, read_table
from .html_fixtures import part_pages, product_pages
from .queries import _chain, query

STORES3 = "CASE {x} % 3 WHEN 0 THEN 'Loblaws' WHEN 1 THEN 'HMart' ELSE 'Metro' END"


def _landing(spark, sf_dir, name, raw=None):
    """Raw listing CSV files written from ``part``; returns the folder. The
    files of odd shards have their columns in another order."""
    path = scratch_path(spark, name)
    raw = raw_listings(read_table(spark, sf_dir, "part"), with_helpers=True) if raw is None else raw
    for odd, columns in ((0, RAW_LISTING_COLUMNS), (1, RAW_LISTING_COLUMNS[::-1])):
        write_listing_csv(raw.where(F.col("shard") % 2 == odd), path, columns)
    return path


def _landing_of_stores(spark, sf_dir, name):
    """Files of three stores; store B's files have columns of their own."""
    raw = raw_listings(read_table(spark, sf_dir, "part"), with_helpers=True)
    raw = raw.withColumn("store", F.expr(STORES3.format(x="shard"))).withColumn("file", F.replace("file", F.lit("Loblaws"), F.col("store")))
    path = _landing(spark, sf_dir, name, raw.where("store != 'HMart'"))
    own = raw.where("store = 'HMart'").withColumnsRenamed({"date": "scrap_date", "prd_link": "prd_url"})
    write_listing_csv(own, path, ["scrap_date", "prd_url", "prd_img", "prd_price", "prd_name"])
    return path


@query("csv_scan")
def q_csv_scan(spark, sf_dir):
    return read_listing_csv(spark, _landing(spark, sf_dir, "csv-scan")).select(*RAW_LISTING_COLUMNS)


#: Lines of a listing file with 40 columns: rows that end early, rows as long as
#: the header and, every fifth, a row with a cell too many.
WIDE_HEAD = ",".join(["prd_link", *[f"w{i}" for i in range(1, 39)], "prd_name"])
WIDE_LINE = (
    "CASE WHEN p_partkey % 3 = 0 THEN '/p/' || p_partkey || ',a' ELSE '/p/' || p_partkey || ',a' || repeat(',00' || p_partkey % 7, 37) || ',\"' || p_name || ', \"\"x\"\"\"' "
    "|| CASE WHEN p_partkey % 5 = 0 THEN ',beyond' ELSE '' END END"
)


@query("csv_wide")
def q_csv_wide(spark, sf_dir):
    """S-1 with files of 40 columns and ragged rows: every cell comes back or
    its row is a ``columns`` reject that holds it."""
    part = read_table(spark, sf_dir, "part")
    lines = part.selectExpr("CAST(p_partkey % 4 AS STRING) AS name", "p_partkey AS k", f"{WIDE_LINE} AS line")
    heads = part.selectExpr("CAST(p_partkey % 4 AS STRING) AS name", "CAST(-1 AS BIGINT) AS k").distinct().withColumn("line", F.lit(WIDE_HEAD))
    path = scratch_path(spark, "csv-wide")
    rows = lines.unionByName(heads).repartition("name").sortWithinPartitions("name", "k").select("name", "line")
    rows.write.options(sep="\u0001", quote="", header="false").partitionBy("name").csv(f"{path}/store=Loblaws")
    files = read_listing_csv(spark, path)
    read = scratch_path(spark, "csv-wide-rows")
    files.write.parquet(read)  # used three times below: a file is read by one task, once
    raw = spark.read.schema(files.schema).parquet(read)
    cleaned = D.clean_dispatch(raw).select("prd_id_in_store", "reject_reason", "raw", "pos", "file")
    cells = F.col("cells")
    got = raw.join(cleaned, ["file", "pos"], "left").select(
        "prd_link", "prd_name", cells["w2"].alias("w2"), cells["w35"].alias("w35"), cells["w38"].alias("w38"),
        F.size("cells").alias("n_cells"), "malformed", "reject_reason", F.col("raw")["+1"].alias("beyond"),
    )
    return got


@query("named_files")
def q_named_files(spark, sf_dir):
    """Clean rows as one file per (store, day, shard) under the producers' name,
    listed and read back."""
    raw = raw_listings(read_table(spark, sf_dir, "part"), with_helpers=True)
    named = raw.select(F.format_string("%s/%s_%s_%d.csv", F.lit("Loblaws"), F.lit("Loblaws"), F.lit("2023-11-16"), F.col("shard")).alias("file"), "pos", *RAW_LISTING_COLUMNS)
    path = scratch_path(spark, "named-files")
    write_named_files(named.where("shard < 6"), path, order=["pos"])
    write_named_files(named.where("shard >= 5"), path, order=["pos"])  # shard 5 again: replaced by the same rows
    rows = read_listing_csv(spark, path)
    name = paths.file_name("file")
    return rows.select(
        paths.relative_key("file", path).alias("object_key"), *[c.alias(a) for c, a in zip(paths.name_parts(name), ("name_store", "name_day", "shard"))], *RAW_LISTING_COLUMNS
    )


@query("page_bytes")
def q_page_bytes(spark, sf_dir):
    """S-6: pages saved as files in UTF-8, with a byte order mark, in Latin-1
    and in UTF-16 give the same rows."""
    pages = read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet", ("page_id", "html"))
    bom = F.unhex(F.lit("EFBBBF"))
    latin = F.replace("html", F.lit('charset="utf-8"'), F.lit('charset="ISO-8859-1"'))
    copies = {"utf8": F.encode("html", "UTF-8"), "bom": F.concat(bom, F.encode(latin, "UTF-8")), "latin1": F.encode(latin, "ISO-8859-1"), "utf16": F.encode("html", "UTF-16")}
    files = pages.select("page_id", F.explode(F.create_map(*[x for n, c in copies.items() for x in (F.lit(n), c)])).alias("copy", "content"))
    path = scratch_path(spark, "page-bytes")
    write_named_files(files.select(F.format_string("%s/%d.html", "copy", "page_id").alias("file"), "content"), path, content="content")
    got = decode_pages(read_page_files(spark, path))
    fields = {"title": {"tag": "title"}, "h1": {"tag": "h1"}, "n_links": {"tag": "a", "get": "count"}, "footer": {"tag": "footer"}}
    recs = H.records(got, fields, keep=["key", "charset"])
    key = F.split("key", "[/.]")
    return recs.select(F.try_element_at(key, F.lit(2)).cast("bigint").alias("page_id"), F.try_element_at(key, F.lit(1)).alias("copy"), "charset", "title", "h1", F.col("n_links").cast("bigint").alias("n_links"), "footer")


@query("file_stream")
def q_file_stream(spark, sf_dir):
    landing = _landing(spark, sf_dir, "file-stream-in")
    out = scratch_path(spark, "file-stream-out")

    def each(batch, epoch_id):
        named = batch.select(*RAW_LISTING_COLUMNS, F.lit(epoch_id).cast("long").alias("batch_id"))
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    q = (
        stream_listing_csv(spark, landing)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", scratch_path(spark, "file-stream-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(out).select(*RAW_LISTING_COLUMNS)


@query("path_columns")
def q_path_columns(spark, sf_dir):
    """S-3 to S-5 on the paths of real files: the rows of every landed file."""
    landing = _landing_of_stores(spark, sf_dir, "path-columns")
    rows = read_listing_csv(spark, landing)
    folder = F.regexp_extract(paths.relative_key("file", landing), "name=([^/]+)/", 1)
    return rows.groupBy("store", folder.alias("file_name")).agg(F.count("*").alias("n_rows")).select(
        "store",
        "file_name",
        paths.object_key("store", paths.name_parts("file_name")[1], paths.name_parts("file_name")[2]).alias("object_key"),
        *[c.alias(a) for c, a in zip(paths.name_parts("file_name"), ("name_store", "name_day", "shard"))],
        "n_rows",
    )


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    path = scratch_path(spark, "csv-roundtrip")
    K.write_csv(good.select(*CLEAN_COLUMNS), path)
    return K.read_csv(spark, path, CLEAN_LISTING_SCHEMA)


@query("partitioned_write")
def q_partitioned_write(spark, sf_dir):
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    path = scratch_path(spark, "by-store")
    K.write_by_store(good.select(*CLEAN_COLUMNS), path, partition_cols=("store", "scrap_date"))
    return spark.read.parquet(path).select(*CLEAN_COLUMNS)


@query("json_records")
def q_json_records(spark, sf_dir):
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    cols = ["store", "prd_id_in_store", "scrap_date", "prd_price", "prd_brand", "on_sale_cat", "average_unit"]
    floats = good.withColumn("prd_price", F.col("prd_price").cast("double"))  # what a float-typed source delivers
    return K.exact_decimals(floats, ["prd_price"]).select("prd_id_in_store", K.json_record(cols).alias("record"))


def _versions(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    base = p.select(
        F.col("p_partkey").alias("k"),
        "p_name",
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )
    target = base.filter((F.col("k") % 3 != 0) | (F.col("k") % 2 == 0)).withColumn("version", F.lit(1))
    # every key is in the target, the batch or both; two deliveries (seq 1, 2) of every batch key: the later one must win
    batch = (
        base.filter(F.col("k") % 3 == 0)
        .withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
        .select("k", "p_name", (F.col("price") + F.col("seq")).cast("decimal(12,2)").alias("price"), (F.col("seq") + 1).alias("version"), "seq")
    )
    return target, batch


@query("upsert_by_key")
def q_upsert_by_key(spark, sf_dir):
    target, batch = _versions(spark, sf_dir)
    return upsert(target, batch, ["k"], seq_col="seq")


def _stores(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    names = "CASE p_partkey % 5 WHEN 0 THEN 'Loblaws' WHEN 1 THEN 'HMart' WHEN 2 THEN 'Metro' WHEN 3 THEN 'NoFrills' ELSE 'Costco' END"
    return p.select(F.col("p_partkey").alias("k"), F.expr(names).alias("store"))


@query("store_lookup")
def q_store_lookup(spark, sf_dir):
    dim = store_dimension(spark)
    out = L.lookup(_stores(spark, sf_dir), dim, "store")
    return out.select("k", "store", "site", F.when(F.col("shards").isNotNull(), F.size("shards")).alias("n_shards"))


@query("store_config")
def q_store_config(spark, sf_dir):
    """S-7 and J-1 with a config file: a YAML map of nations to sites, written
    from ``nation``, gives every supplier its site."""
    nation = read_table(spark, sf_dir, "nation")
    path = scratch_path(spark, "store-config")
    value = F.expr("CASE n_nationkey % 3 WHEN 0 THEN '\"https://' || lower(n_name) || '.example/a#b\"  # quoted' WHEN 1 THEN 'https://' || lower(n_name) || '.example/' ELSE '' END")
    lines = nation.select(F.concat(F.lit('"'), "n_name", F.lit('": '), value).alias("value"))
    heads = nation.limit(1).select(F.explode(F.array(F.lit("# sites by store"), F.lit("---"), F.lit(""))).alias("value"))
    heads.unionByName(lines).coalesce(1).write.text(path)
    config = read_store_config(spark, path).withColumnRenamed("store", "n_name")
    suppliers = read_table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return L.lookup(suppliers, config, "n_name")


@query("unknown_store")
def q_unknown_store(spark, sf_dir):
    return L.unknown_keys(_stores(spark, sf_dir), store_dimension(spark), "store").select("k", "store")


def _multi_store_raw(spark, sf_dir):
    raw = raw_listings(read_table(spark, sf_dir, "part"), with_helpers=True)
    store = F.expr(STORES3.format(x="shard"))
    raw = raw.withColumn("file", F.regexp_replace("file", "Loblaws", store))
    return raw.withColumn("store", paths.key_store("file")).drop("k", "u", "u2", "amt", "cents", "shard")


@query("clean_dispatch")
def q_clean_dispatch(spark, sf_dir):
    out = D.clean_dispatch(_multi_store_raw(spark, sf_dir))
    raw = {"raw_date": "date", "raw_price": "prd_price", "raw_link": "prd_link", "raw_name": "prd_name"}
    return out.select("file", "pos", "store", "prd_id_in_store", "prd_price", "reject_reason", *[F.col("raw").getItem(c).alias(a) for a, c in raw.items()])


def _store_b(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    rows = X.EXTRACTORS["HMart"](part_pages(part, "store_b_listing"), product_pages(part))
    return rows.filter(F.col("reject_reason").isNull()).drop("reject_reason", "listing_page", "card")


@query("union_stores")
def q_union_stores(spark, sf_dir):
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    u = D.union_stores(good.select(*CLEAN_COLUMNS), _store_b(spark, sf_dir))
    return u.select(
        "store", "prd_id_in_store", "scrap_date", "prd_name", "prd_price", "org_price", "prd_discount",
        "is_discounted", "on_sale_cat", "category", "prd_url", "prd_link", "reject_reason", F.col("raw").getItem("prd_price").alias("raw_price"),
    )


#: Store-B columns that no schema declares: they differ by shard, and one of
#: them has another type than the declared column of its name.
OPEN_COLUMNS = {
    0: ["'Origin ' || CAST(k % 7 AS STRING) AS origin"],
    1: ["k % 2 = 0 AS organic", "CAST(k % 900 AS INT) AS weight"],
    2: ["named_struct('kcal', CAST(k % 500 AS BIGINT), 'per', '100g') AS nutrition", "CASE WHEN k % 2 = 0 THEN 'ask' ELSE '1.50' END AS org_price"],
}


@query("union_open_schema")
def q_union_open_schema(spark, sf_dir):
    """U-1 over files of different columns: one Parquet folder per kind of file,
    read with a merged schema and put beside store A's clean rows."""
    part = read_table(spark, sf_dir, "part")
    base = part.selectExpr("p_partkey AS k", "'HMart' AS store", "CAST(p_partkey AS STRING) AS prd_id_in_store", "p_name AS prd_name", "CAST('2.50' AS DECIMAL(12,2)) AS prd_price")
    path = scratch_path(spark, "open-schema")
    for kind, columns in OPEN_COLUMNS.items():
        own = base.where(F.col("k") % 3 == kind).selectExpr("*", *columns)
        own.withColumnRenamed("org_price", "org_price_text").write.parquet(f"{path}/kind={kind}")
    declared = T.StructType([*[f for f in CLEAN_LISTING_SCHEMA.fields if f.name in ("store", "prd_id_in_store", "prd_name", "prd_price")], T.StructField("org_price", T.DecimalType(12, 2))])
    b = read_merged(spark, path).withColumnRenamed("org_price_text", "org_price")
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    rows = union_open([good.select("store", "prd_id_in_store", "prd_name", "prd_price", "on_sale_cat"), b.drop("k", "kind")], declared)
    return rows.select(
        *declared.names, extra_field("origin").alias("origin"), extra_field("organic", "boolean").alias("organic"), extra_field("weight", "int").alias("weight"),
        extra_field("nutrition.kcal", "bigint").alias("kcal"), extra_field("on_sale_cat").alias("on_sale_cat"), extra_field("org_price").alias("org_price_text"),
        F.col("extra").isNull().alias("nothing_extra"),
    )


@query("quality_figures")
def q_quality_figures(spark, sf_dir):
    """P-23 / A-5: the figures of one batch run over ``part``, and of the stream
    over the same rows as files of three stores, observed while they ran."""
    quality = Quality()
    raw = raw_listings(read_table(spark, sf_dir, "part")).drop("k")
    C.clean_listings(raw, quality=quality).write.parquet(scratch_path(spark, "quality-batch"))
    landing = _landing_of_stores(spark, sf_dir, "quality-in")
    figures = scratch_path(spark, "quality-figures")
    start_clean_upsert_stream(spark, landing, scratch_path(spark, "quality-table"), scratch_path(spark, "quality-ckpt"), figures_path=figures).awaitTermination()
    streamed = spark.read.parquet(figures).groupBy("figure").agg(F.sum("n").alias("n"))
    return quality.rows(spark, run="batch").unionByName(streamed.withColumn("run", F.lit("stream")))


@query("worklist")
def q_worklist(spark, sf_dir):
    shards = store_dimension(spark).filter(F.col("shards").isNotNull())
    return W.worklist(_multi_store_raw(spark, sf_dir), shards).select("store", "shard", "job_name")


@query("stream_clean_upsert")
def q_stream_clean_upsert(spark, sf_dir):
    """Landed files of three stores -> table and rejects, both returned."""
    landing = _landing_of_stores(spark, sf_dir, "stream-in")
    table, rejects = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-rejects")
    q = start_clean_upsert_stream(spark, landing, table, scratch_path(spark, "stream-ckpt"), rejects_path=rejects)
    q.awaitTermination()
    good = spark.read.parquet(table).select(*CLEAN_COLUMNS)
    raw = F.col("raw")
    bad = spark.read.parquet(rejects).select(
        "store", "prd_id_in_store", "scrap_date", "reject_reason", raw["prd_price"].alias("raw_price"), F.coalesce(raw["prd_link"], raw["prd_url"]).alias("raw_link")
    )
    return good.unionByName(bad, allowMissingColumns=True)


@query("replay_idempotent")
def q_replay_idempotent(spark, sf_dir):
    landing = _landing(spark, sf_dir, "replay-in")
    table = scratch_path(spark, "replay-table")
    for _ in range(3):  # the same files delivered three times
        clean_and_upsert_batch(spark, read_listing_csv(spark, landing), table)
    return spark.read.parquet(table).select(*CLEAN_COLUMNS)


JOB_EVENTS = [
    "event_id",
    "ts",
    "'Batch Job State Change' AS detail_type",
    "CASE WHEN user_id % 10 = 0 THEN 'other.service' ELSE 'aws.batch' END AS source",
    "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'RUNNING' END AS status",
    "'daily_scrapping_' || " + STORES3.format(x="user_id") + " || '_' || CAST(user_id % 16 AS STRING) AS job_name",
]


@query("failure_alerts")
def q_failure_alerts(spark, sf_dir):
    sf_dir = sf_dir.rstrip("/")
    schema = read_table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    job_events = events.selectExpr(*JOB_EVENTS)
    assert [f.name for f in job_events.schema] == [f.name for f in JOB_EVENT_SCHEMA]
    out = scratch_path(spark, "alerts")
    q = start_alert_stream(job_events, out, scratch_path(spark, "alerts-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out).select("event_id", "ts", "status", "job_name")


#: First and repeated deliveries of job events, by ten days: a seventh arrives
#: only with the next delivery, a third again with it, a sixth twice in one.
DELIVERIES = "CAST(FLOOR((day(ts) - 1) / 10) AS INT)"


@query("alerts_once")
def q_alerts_once(spark, sf_dir):
    """Events delivered late and more than once, in four deliveries with a
    restart of the stream at each: one notice per failure."""
    events = read_table(spark, sf_dir, "events").selectExpr(*JOB_EVENTS, f"{DELIVERIES} AS d")
    late = F.col("event_id") % 7 == 0
    again = F.when(F.col("event_id") % 3 == 0, F.array(F.col("d") + 1)).otherwise(F.array().cast("array<int>"))
    twice = F.when(F.col("event_id") % 6 == 0, F.array(F.col("d") + 1)).otherwise(F.array().cast("array<int>"))
    first = F.array(F.when(late, F.col("d") + 1).otherwise(F.col("d")))
    sent = events.withColumn("delivery", F.explode(F.concat(first, again, twice))).drop("d")
    landing, out, checkpoint = (scratch_path(spark, f"alerts-once-{n}") for n in ("in", "out", "ckpt"))
    stream = spark.readStream.schema(sent.drop("delivery").schema).parquet(landing + "/*")
    for d in range(4):
        sent.where(F.col("delivery") == d).drop("delivery").write.parquet(f"{landing}/{d}")
        start_alert_once_stream(stream, out, checkpoint, delay="21 days").awaitTermination()
    return spark.read.parquet(out).select("event_id", "ts", "status", "job_name")


@query("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    """K-3 file form: clean rows as JSON lines (nulls written out), read back
    with the declared schema (decimals stay exact)."""
    good, _ = C.split_rejects(_chain(spark, sf_dir))
    path = scratch_path(spark, "json-roundtrip")
    K.write_json(good.select(*CLEAN_COLUMNS), path)
    return spark.read.schema(CLEAN_LISTING_SCHEMA).json(path)
