"""S-6: captured pages as input rows ``(page_id, url, html)``, or as bytes.

Page fetching itself is not part of the library: pages arrive as a table
(Parquet, one row per page; only the named columns are read) or as files, one
per page, in whatever charset the store sent. The HTML is parsed later by
``functions.html``.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import charset, paths

PAGE_COLUMNS = ("page_id", "url", "html")
OUT_BYTES = 16_000_000  # of pages per output batch


def _ship_by_value() -> None:
    """Executors then need no install of this package (as in ``html``)."""
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(charset)
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:
        pass


_ship_by_value()


def read_pages(spark: SparkSession, path: str, columns=PAGE_COLUMNS) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def read_page_files(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """``(key, captured_at, content)`` of every page file in any folder below
    ``path``; ``key`` is the path below it, the capture time the file's."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    # Spark counts 4 MB for opening a file, so a task would read some 30 pages: as many tasks as the
    # job's shuffles have are enough (nothing is shuffled, and never more than there were)
    files = files.coalesce(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.select(paths.relative_key("_metadata.file_path", path).alias("key"), F.col("modificationTime").alias("captured_at"), "content")


def decode_pages(pages: DataFrame, content_col: str = "content", header_col: str | None = None, html_col: str = "html", charset_col: str = "charset") -> DataFrame:
    """Pages as bytes -> text: ``html_col`` and ``charset_col`` in place of the
    bytes (``functions.charset`` says how). ``header_col`` holds what the server
    said, a charset or a Content-Type. Null bytes give nulls."""
    keep = [c for c in pages.columns if c != content_col]
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField(html_col, T.StringType()), T.StructField(charset_col, T.StringType())])

    def decode(batches):
        import pyarrow as pa

        for batch in batches:
            contents, lo = batch.column(content_col), 0
            headers = batch.column(header_col) if header_col else None
            while lo < batch.num_rows:
                texts, names, size, hi = [], [], 0, lo
                while hi < batch.num_rows and size < OUT_BYTES:
                    content = contents[hi].as_py()
                    text, name = charset.decode_page(content, headers[hi].as_py() if headers is not None else None)
                    texts.append(text)
                    names.append(name)
                    size += len(content or b"")
                    hi += 1
                part = batch.slice(lo, hi - lo)
                arrays = [part.column(c) for c in keep] + [pa.array(texts, pa.string()), pa.array(names, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, html_col, charset_col])
                lo = hi

    return pages.mapInArrow(decode, schema)
