"""Object keys and file names (S-3, S-4, S-5).

Keys look like ``<store>/<store>_<yyyy-mm-dd>_<shard>.csv``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_RE = r"^(.+)_(\d{4}-\d{2}-\d{2})_(\d+)\.csv$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


SITE_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def relative_key(path, root: str) -> Column:
    """Path below a root folder (the object key). Either may have a scheme
    and authority; they are left out of the comparison."""
    root = re.sub(SITE_RE, "", root).rstrip("/") + "/"
    p = F.regexp_replace(_col(path), SITE_RE, "")
    return F.when(p.startswith(root), F.substring(p, len(root) + 1, 1 << 30)).otherwise(p)


def key_store(key) -> Column:
    """S-3: first segment of the key (``store=X`` of a partitioned layout too)."""
    return F.nullif(F.regexp_replace(F.substring_index(_col(key), "/", 1), "^store=", ""), F.lit(""))


def file_name(path) -> Column:
    """S-5: last segment of a path."""
    return F.element_at(F.split(_col(path), "/"), -1)


def name_parts(name) -> tuple[Column, Column, Column]:
    """S-4: (store, day, shard) from ``<store>_<day>_<shard>.csv``."""
    n = _col(name)
    store = F.nullif(F.regexp_extract(n, NAME_RE, 1), F.lit(""))
    day = F.nullif(F.regexp_extract(n, NAME_RE, 2), F.lit("")).try_cast("date")
    shard = F.nullif(F.regexp_extract(n, NAME_RE, 3), F.lit("")).try_cast("int")
    return store, day, shard


def object_key(store, day, shard) -> Column:
    """The key a shard's file is stored under."""
    s = _col(store)
    return F.concat(s, F.lit("/"), s, F.lit("_"), F.date_format(_col(day), "yyyy-MM-dd"), F.lit("_"), _col(shard).cast("string"), F.lit(".csv"))
