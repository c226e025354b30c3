"""Session helpers: building a session and finding the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "pricelens") -> SparkSession:
    """Session for tests and local runs. On a cluster the launcher sets these."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    workers_find_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a folder every executor can reach; it is
    only filled in here when unset and the master is local (tests, local runs).
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server owns the context
        sc = None
    if not conf_dir and sc is not None:
        conf_dir = sc.getCheckpointDir()
    if not conf_dir:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pricelens/{name}-{uuid.uuid4().hex[:12]}"


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough for local masters and shared installs; on other clusters submit the
    package with the job (``--py-files``).
    """
    try:
        env = spark.sparkContext.environment
    except Exception:  # remote session: the server's workers have their own path
        return
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, here])


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system (works for any scheme)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def code_for_jit(spark: SparkSession) -> None:
    """Let Spark split generated methods that the JVM would only interpret: it
    compiles none above 8,000 bytes, and a projection of many text expressions
    in one method is larger. Results do not depend on it; a limit that was set
    lower stays."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit, "65535")) > 8000:
        spark.conf.set(limit, "8000")


def not_broadcast(df: DataFrame) -> DataFrame:
    """``df`` as a join side that is shuffled and sorted, never sent through the
    driver. Spark guesses a frame's size from the files below it and the types of
    its columns: texts and pages built or parsed on the way are many times
    larger, and so are the rows that one page gives."""
    return df.hint("merge")


@contextmanager
def written_once(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to a scratch folder and read from there (for frames that
    are read more than once); the folder is deleted at the end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for Python-side checks in tests only)."""
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any scheme)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(hpath))
    except Exception:  # no JVM handle: ask the data source instead
        try:
            spark.read.parquet(path).schema
            return True
        except Exception:
            return False


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "local_path", "path_exists", "delete_path", "written_once", "workers_find_package", "not_broadcast", "code_for_jit"]


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the input, for a job over ``input_bytes`` on a
    cluster with ``total_cores`` task slots.

    * shuffle partitions: enough that each holds about
      ``target_partition_bytes`` of the input (never fewer than 2x the
      cores); AQE then merges small ones and splits skewed ones;
    * scan splits of 256 MB for splittable inputs (Parquet, page tables);
    * skew handling: a partition 5x the median and over 512 MB is split.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        # page batches for the parser: 256 pages (tens of MB for real pages)
        "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
