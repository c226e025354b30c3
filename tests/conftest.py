import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("pricelens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from pricelens.session import ensure_checkpoint_dir, workers_find_package

    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pricelens-test-ckpt-"))
    ensure_checkpoint_dir(s)
    workers_find_package(s)
    yield s


def raw_df(spark, rows):
    """Raw listing rows from dicts (missing fields -> null), with file/pos."""
    from pricelens.schemas import RAW_LISTING_COLUMNS

    data = []
    for i, r in enumerate(rows):
        data.append(tuple(r.get(c) for c in RAW_LISTING_COLUMNS) + (r.get("file", "f.csv"), r.get("pos", i)))
    schema = ", ".join(f"{c} string" for c in RAW_LISTING_COLUMNS) + ", file string, pos long"
    return spark.createDataFrame(data, schema)
