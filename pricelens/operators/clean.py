"""Store-A listing cleaning: raw text rows -> typed clean rows + rejects.

"Keep the first row per product id within a file" comes first, on the raw rows:
an aggregation over (file, id, position) alone, then a semi join; only the rows
that stay are parsed, in one projection without a shuffle. A bad row is kept
with a ``reject_reason`` and its whole raw text (``raw``, by column name)
instead of failing the whole file.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pricing as P
from ..schemas import CLEAN_COLUMNS, NA_WORDS, RAW_LISTING_COLUMNS
from ..session import code_for_jit, not_broadcast

STORE_A = "Loblaws"

REJECT_PRODUCT_ID = "product_id"
REJECT_PRICE = "price"
REJECT_PARTS = "parts"
REJECT_UNIT = "unit"
REJECT_UNIT_PRICES = "unit_prices"  # more than two unit prices
REJECT_DATE = "date"
REJECT_COLUMNS = "columns"  # more cells than the file's header names
REJECT_UNKNOWN_STORE = "unknown_store"


def null_na_text(df: DataFrame, columns=None, na_words=NA_WORDS) -> DataFrame:
    """P-17 over all (or the given) string columns."""
    cols = columns if columns is not None else [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: P.null_na_words(c, na_words) for c in cols})


def with_product_id(df: DataFrame, link_col: str = "prd_link") -> DataFrame:
    """P-1."""
    return df.withColumn("prd_id_in_store", P.product_id(link_col))


def _unit_steps() -> list[dict]:
    parts = P.unit_parts("prd_per_price")
    up = P.unit_price("price_per_unit_1")
    up_cols = P.UnitPrice(F.col("_up"), F.col("_base"), F.col("_word"))
    unit_bad = F.col("prd_per_price").isNotNull() & (
        (F.col("price_per_unit_1").isNotNull() & (F.col("_up").isNull() | F.col("_base").isNull() | F.col("_word").isNull()))
        | F.col("average_unit").isNull()
    )
    return [
        {
            "_n_parts": parts.n_parts,
            "_mid_dollar": parts.middle_has_dollar,
            "_unit_part": parts.unit_part,
            "price_per_unit_1": parts.price_per_unit_1,
            "price_per_unit_2": parts.price_per_unit_2,
            "_n_prices": parts.n_price_tokens,
        },
        {"_up": up.unit_price, "_base": up.base, "_word": up.word},
        {"average_unit": P.average_unit("_unit_part", "prd_price", up_cols)},
        {"_unit_bad": unit_bad},
        {"price_per_unit_1": P.unit_price_text("price_per_unit_1", "prd_price", "average_unit")},
    ]


def reject_reason() -> Column:
    """P-23: first failing rule, or null for a clean row."""
    return (
        F.when(F.col("prd_id_in_store").isNull(), F.lit(REJECT_PRODUCT_ID))
        .when(F.col("scrap_date").isNull(), F.lit(REJECT_DATE))
        .when(F.col("prd_price").isNull(), F.lit(REJECT_PRICE))
        .when((F.col("_n_parts") > 3) | ((F.col("_n_parts") == 3) & ~F.col("_mid_dollar")), F.lit(REJECT_PARTS))
        .when(F.col("_n_prices") > 2, F.lit(REJECT_UNIT_PRICES))
        .when(F.col("_unit_bad"), F.lit(REJECT_UNIT))
    )


@functools.lru_cache(maxsize=16)
def _row_steps(na_words: tuple, raw_cols: tuple):
    """The chain's Column expressions, built once per process.

    They name their inputs and refer to nothing else, so the same objects
    serve every DataFrame; building them costs one JVM round trip per
    function call, which is worth paying once, not per query.
    """
    there = [c for c in RAW_LISTING_COLUMNS if c in raw_cols]
    cells = F.col("cells") if "cells" in raw_cols else F.map_from_arrays(F.array(*[F.lit(c) for c in there]), F.array(*[F.col(c) for c in there]))
    na_raw = {"_raw": cells} | {c: P.null_na_words(c, na_words) for c in there}
    na_raw |= {c: F.lit(None).cast("string") for c in RAW_LISTING_COLUMNS if c not in raw_cols}
    typed = {
        "prd_id_in_store": P.null_na_words(P.product_id("prd_link"), na_words),
        "scrap_date": F.col("date").try_cast("date"),
        "prd_discount": P.first_line("prd_discount"),
        "prd_price": P.parse_price("prd_price"),
    }
    steps = [typed, {"on_sale_cat": P.promo_category("prd_discount")}, *_unit_steps(), {"reject_reason": reject_reason()}]
    # second NA pass: values produced by cleaning that a re-read would null
    na_again = {c: P.null_na_words(c, na_words) for c in ["prd_discount", "average_unit", "price_per_unit_1", "price_per_unit_2"]}
    na_again["prd_name"] = P.null_na_words(P.clean_name("prd_name"), na_words)
    final = {c: na_again.get(c, F.col(c)) for c in CLEAN_COLUMNS}
    return na_raw, steps, final


def clean_store_a_rows(
    raw: DataFrame,
    store: str = STORE_A,
    na_words=NA_WORDS,
    keep: list[str] | None = None,
    store_col: str | None = None,
    stores: list[str] | None = None,
) -> DataFrame:
    """P-2 ... P-21 on each row (no de-duplication): clean columns, ``reject_reason``, ``raw``.

    ``keep`` names extra input columns carried through (e.g. ``file``, ``pos``).
    With ``store_col`` the store is read from that column and rows of a store
    not in ``stores`` are ``unknown_store`` rejects: nothing of them is parsed.
    """
    code_for_jit(raw.sparkSession)
    keep = list(keep or [])
    na_raw, steps, final = _row_steps(tuple(na_words), tuple(raw.columns))
    known = F.coalesce(F.col(store_col).isin(stores), F.lit(False)) if store_col else F.lit(True)
    df = raw.withColumns(na_raw | {"store": F.col(store_col) if store_col else F.lit(store)})
    for step in steps:
        df = df.withColumns(step)
    reason = F.col("reject_reason")
    if "malformed" in raw.columns:
        reason = F.when(F.col("malformed"), F.lit(REJECT_COLUMNS)).otherwise(reason)
    if store_col:
        reason = F.when(known, reason).otherwise(F.lit(REJECT_UNKNOWN_STORE))
        final = {c: e if c == "store" else F.when(known, e) for c, e in final.items()}
    # A filter on the reason must not be pushed below the parse, which would run every step twice
    # (and again inside the predicate): an always-true condition that is not deterministic stops it.
    df = df.withColumn("reject_reason", F.when(F.monotonically_increasing_id() >= 0, reason))
    return df.select(*keep, *[e.alias(c) for c, e in final.items()], "reject_reason", F.when(F.col("reject_reason").isNotNull(), F.col("_raw")).alias("raw"))


def first_listings(raw: DataFrame, file_col: str = "file", pos_col: str = "pos", na_words=NA_WORDS, dedup=None, quality=None) -> DataFrame:
    """A-1 on raw rows: the first row per (file, product id); rows without an
    id, or for which the condition ``dedup`` does not hold, all stay. Positions
    are unique within a file (they come from the scan).

    The aggregation moves (file, id, position) only, with a map-side partial
    step, so an id with a third of all rows is one row per map task before the
    shuffle; whole rows move once, by (file, position), which no key can skew.
    A ``quality`` (``operators.quality``) counts rows and duplicates on the way.
    """
    pid = P.null_na_words(P.product_id(P.null_na_words("prd_link", na_words)), na_words)
    if dedup is not None:
        pid = F.when(dedup, pid)
    own = F.concat(F.lit("\u0001"), F.to_json(F.struct(F.col(pos_col).alias("p"))))
    keys = raw.select(F.col(file_col).alias("_file"), F.coalesce(pid, own).alias("_key"), F.col(pos_col).alias("_pos"))
    first = keys.groupBy("_file", "_key").agg(F.min("_pos").alias("_pos"), *([F.count("*").alias("_n")] if quality else []))
    if quality:
        first = quality.watch_input(first, "_n")
    return raw.join(not_broadcast(first), raw[file_col].eqNullSafe(first["_file"]) & (raw[pos_col] == first["_pos"]), "left_semi")


def clean_listings(raw: DataFrame, store_col: str | None = None, stores: list[str] | None = None, file_col: str = "file", pos_col: str = "pos", store: str = STORE_A, na_words=NA_WORDS, quality=None) -> DataFrame:
    """P-22: full chain with A-1. Output keeps ``file`` and ``pos`` (and ``file_time`` if there).

    A ``quality`` collects the run's figures while it runs.
    """
    one = [F.coalesce(F.col(store_col).isin(stores), F.lit(False))] if store_col else []
    one += [~F.col("malformed")] if "malformed" in raw.columns else []
    dedup = functools.reduce(lambda a, b: a & b, one) if one else None
    keep = [c for c in (file_col, pos_col, "file_time") if c in raw.columns]
    out = clean_store_a_rows(first_listings(raw, file_col, pos_col, na_words, dedup, quality), store, na_words, keep, store_col, stores)
    return quality.watch_output(out) if quality else out


def clean_store_a(raw: DataFrame, file_col: str = "file", pos_col: str = "pos", store: str = STORE_A, na_words=NA_WORDS) -> DataFrame:
    """The chain over rows of one store (a ``store`` column is not looked at)."""
    return clean_listings(raw, file_col=file_col, pos_col=pos_col, store=store, na_words=na_words)


def split_rejects(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows (no reason) and rejected rows (with reason)."""
    good = cleaned.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw")
    bad = cleaned.filter(F.col("reject_reason").isNotNull())
    return good, bad


def with_record_meta(clean: DataFrame, stable_ids: bool = True, keys=("store", "prd_id_in_store", "scrap_date")) -> DataFrame:
    """P-18 / P-19: record id and processing time (one value per query)."""
    from ..functions.timefmt import processing_time_text

    return clean.withColumn(
        "record_id", P.record_id(*keys, stable=stable_ids)
    ).withColumn("processing_time", processing_time_text())


def part_width(raw: DataFrame, file_col: str = "file") -> DataFrame:
    """A-5: file-wide maximum of comma parts and blank-separated unit prices.

    A data-quality measure only; parsing uses each row's own widths.
    """
    parts = P.unit_parts(P.null_na_words("prd_per_price"))
    return raw.groupBy(file_col).agg(
        F.max(parts.n_parts).alias("max_comma_parts"),
        F.max(F.when(parts.price_part.isNotNull(), parts.n_price_tokens)).alias("max_price_tokens"),
        F.count(F.lit(1)).alias("n_rows"),
    )
