"""Listing CSV sources (S-1, S-2) and the store dimension (S-7).

Every file is read once, whole, by one task (a CSV file with newlines in quoted
cells cannot be split; the producers write one file per (store, shard), which
keeps files small, and 2 GB is the most). Its columns are matched by the names
in its own header row, whatever their number and order, so files of different
stores are read in one scan; ``functions.csvrows`` says how no cell is lost.
``store`` comes from the path (S-3). ``pos`` is the row's place in its file,
which is what "keep the first row" needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..functions.csvrows import csv_rows
from ..schemas import RAW_LISTING_COLUMNS, STORE_SHARDS, STORE_SITES
from ..sinks.files import CSV_WRITE_OPTIONS

FILE_OPTIONS = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _files(df: DataFrame, root: str) -> DataFrame:
    return df.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        paths.key_store(paths.relative_key("_metadata.file_path", root)).alias("store"),
        "content",
    )


def with_names(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The named columns beside all ``cells``; a column that a file does not have is null."""
    return rows.select(*[F.col("cells").getItem(c).alias(c) for c in columns or RAW_LISTING_COLUMNS], "file", "file_time", "store", "pos", "cells", "malformed")


def read_listing_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S-1: batch read of every ``*.csv`` in any folder below ``path``.

    Keys are ``<store>/<file>.csv`` (or ``store=X/...``). Adds ``file``,
    ``file_time``, ``store``, ``pos``, ``cells`` and ``malformed``.
    """
    return with_names(csv_rows(_files(spark.read.format("binaryFile").options(**FILE_OPTIONS).load(path), path)), columns)


def stream_listing_csv(spark: SparkSession, path: str, max_files: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """S-2: the same rows as a stream; each new ``*.csv`` is read once.

    The checkpoint of the query that consumes this stream records which files
    were taken, so a restart does not read a file twice. A file is always whole
    in one micro-batch.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).options(**FILE_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return with_names(csv_rows(_files(reader.load(path), path)), columns)


def write_listing_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "append") -> None:
    """K-1 for raw listings: header, quoted fields, one CSV file per ``file``.

    ``file`` is the key ``<store>/<name>``; the file lands in the folder
    ``store=<store>/name=<name>``, its rows in ``pos`` order, so a reader finds
    the same rows in the same file and the same "first" row.
    """
    rows = df.repartition("file").select(
        paths.key_store("file").alias("store"), paths.file_name("file").alias("name"), "pos", *[F.col(c).alias(c) for c in columns or RAW_LISTING_COLUMNS]
    )
    rows = rows.sortWithinPartitions("store", "name", "pos").drop("pos")
    rows.write.mode(mode).options(**CSV_WRITE_OPTIONS).partitionBy("store", "name").csv(path)


def store_dimension(spark: SparkSession) -> DataFrame:
    """S-7: store -> site root and shard list (a handful of configured rows)."""
    shards = dict(STORE_SHARDS)
    text = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    numbers = lambda x: f"array({', '.join(map(str, x))})" if x else "CAST(NULL AS ARRAY<INT>)"
    rows = ", ".join(f"({text(s)}, {text(url)}, {numbers(shards.get(s))})" for s, url in STORE_SITES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(store, site, shards)")


def read_store_config(spark: SparkSession, path: str) -> DataFrame:
    """S-7 from a file: (store, site) of a flat YAML map, one ``store: site`` a
    line. Comments, blank lines and quotes round a value are allowed; of a
    repeated store the last line counts, as in a map."""
    line = r"^\s*(?:\"([^\"]+)\"|'([^']+)'|([^\s#:'\"][^:#]*?))\s*:(?:\s+(?:\"([^\"]*)\"|'([^']*)'|([^#\s](?:[^#]|(?<!\s)#)*?))?)?(?:\s+#.*)?\s*$"
    part = lambda *groups: F.nullif(F.concat(*[F.regexp_extract("value", line, g) for g in groups]), F.lit(""))
    lines = spark.read.text(path).select(part(1, 2, 3).alias("store"), part(4, 5, 6).alias("site"), F.monotonically_increasing_id().alias("line"))
    lines = lines.where("store IS NOT NULL AND NOT (store = '---')")
    return lines.groupBy("store").agg(F.max_by("site", "line").alias("site"))
