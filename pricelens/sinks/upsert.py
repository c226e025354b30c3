"""Keyed upsert (K-5): insert or replace rows by key; the latest row wins.

Two forms:

* ``upsert(target, batch, keys, seq)``: a pure DataFrame plan,
  ``target`` minus the batch keys (anti join) plus the latest batch row per
  key.
* ``write_upsert(...)``: the same against a Parquet table partitioned by
  columns that are part of the key (default store and day). The table is
  semi-joined with the batch's distinct partition values, which the optimizer
  turns into dynamic partition pruning, and only these partitions are rewritten
  (dynamic partition overwrite). Re-running the same batch leaves the table
  unchanged.

A key without a value names no row: a null in a key column is an error.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, written_once


def latest_per_key(df: DataFrame, keys: list[str], seq_col: str) -> DataFrame:
    """Latest row per key by ``seq_col`` (ties: the greatest row).

    ``max(struct(seq, ...))`` aggregates with a map-side partial step, so a
    key with very many rows never lands whole in one task.
    """
    cols = df.columns
    rest = [c for c in cols if c not in keys and c != seq_col]
    packed = F.struct(F.col(seq_col).alias(seq_col), *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_latest"))
    return agg.select(*[F.col(c) if c in keys else F.col(f"_latest.{c}").alias(c) for c in cols])


def _with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` that fails on a null key."""
    return df.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"upsert: null in key column {k}")).cast(df.schema[k].dataType)) for k in keys})


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], seq_col: str) -> DataFrame:
    """New table = target rows whose key is not in the batch + latest batch rows."""
    latest = latest_per_key(_with_keys(batch, keys), keys, seq_col).drop(seq_col)
    kept = target.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*target.columns))


def _values(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of the partition columns. The comparison holds for every
    value; the optimizer prunes partitions only by a side with a filter."""
    out = rows.select(*cols).distinct()
    for c in cols:
        out = out.where(F.col(c).cast("string") >= "")
    return out


def write_upsert(
    spark: SparkSession,
    table_path: str,
    batch: DataFrame,
    keys: list[str],
    seq_col: str,
    partition_cols: list[str],
    batch_written: bool = False,
) -> None:
    """Upsert ``batch`` into the Parquet table at ``table_path``.

    The batch is read up to three times; it is first written to a scratch
    folder (deleted afterwards) unless ``batch_written`` says it already is
    cheap to read. Rows are rebalanced by the partition columns before the
    write: one task per small partition, several for a large one.
    """
    if not partition_cols or any(c not in keys for c in partition_cols):
        raise ValueError("partition columns are required and must be part of the key")
    there = path_exists(spark, table_path)
    scope = written_once(batch, "upsert-batch") if there and not batch_written else nullcontext(batch)
    with scope as rows:
        latest = latest_per_key(_with_keys(rows, keys), keys, seq_col).drop(seq_col)
        out = latest
        if there:
            columns = spark.read.parquet(table_path).columns
            if set(columns) != set(latest.columns):
                raise ValueError(f"batch columns {sorted(latest.columns)} do not match the table's {sorted(columns)}")
            # the batch's types, so that a partition value such as '12' is not read as a number
            current = spark.read.schema(latest.select(*columns).schema).parquet(table_path)
            touched = current.join(_values(rows, partition_cols), partition_cols, "left_semi")
            kept = touched.join(rows.select(*keys).distinct(), keys, "left_anti")
            out = kept.unionByName(latest.select(*current.columns))
        out = out.hint("rebalance", *[F.col(c) for c in partition_cols])
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(table_path)
