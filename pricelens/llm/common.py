"""Shared steps: written intermediate tables, column names, checks of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.session import scratch_path


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under spark.checkpoint.dir and read again:
    cuts lineage, and later steps see one fixed set of rows."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing will read again."""
    path = getattr(df, "_written_path", None)
    if path:
        spark = df.sparkSession
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not have yet (any letter case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name, i = base, 0
        while name.lower() in taken:
            i += 1
            name = f"{base}_{i}"
        taken.add(name.lower())
        out.append(name)
    return out


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) with v as array<double>: not null, not zero, all components
    finite, and as long as the table's most common length (ties: longer)."""
    v = F.col(vec_col).cast("array<double>")
    ok = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = ok.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    if not sizes:
        return ok
    return ok.where(F.size("v") == sizes[0]["n"])
