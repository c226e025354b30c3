"""File sinks: CSV (K-1), store-partitioned layout (K-2), JSON records (K-3/K-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    # keep blanks at either end of a field (names keep a trailing blank)
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K-1: header row, no index column, quotes escaped by doubling."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(header="true", multiLine="true", escape='"').csv(path)


def write_by_store(df: DataFrame, path: str, partition_cols=("store",), mode: str = "overwrite") -> None:
    """K-2: one folder per store (and any further partition columns).

    Readers filtering on ``store`` then list and read only that folder. A folder's
    rows are brought together first, so the number of files grows with the
    folders and the data, not with folders times tasks; a folder with more rows
    than a task should write is split over several.
    """
    df = df.hint("rebalance", *partition_cols)
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)


def json_record(cols: list[str] | None = None) -> Column:
    """K-3: one JSON object per row, null fields kept as ``null``."""
    target = F.struct(*(cols or ["*"]))
    return F.to_json(target, {"ignoreNullFields": "false"})


def exact_decimals(df: DataFrame, cols: list[str], type_sql: str = "decimal(12,2)") -> DataFrame:
    """K-4: binary floats -> exact decimals before records leave the job."""
    return df.withColumns({c: F.col(c).try_cast(type_sql) for c in cols})


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K-3 file form: JSON lines, nulls written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
