"""Per-store cleaner registry (F-1) and store union (U-1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import clean as C

#: (raw rows, column with the store, names of the stores it cleans) -> rows with a reject reason
Cleaner = Callable[[DataFrame, str, list[str]], DataFrame]

# Stores with a cleaner. The other configured stores have no cleaning rules;
# their rows are set apart as ``unknown_store`` rejects.
DEFAULT_REGISTRY: dict[str, Cleaner] = {C.STORE_A: C.clean_listings}


def clean_dispatch(raw: DataFrame, registry: dict[str, Cleaner] | None = None, store_col: str = "store", quality=None) -> DataFrame:
    """Clean each store's rows with its own cleaner; unknown stores -> rejects.

    One pass per different cleaner. The first one also takes the rows of all
    unknown stores, which it rejects with their whole raw row; so with one
    cleaner the input is read once, whatever the number of stores. A
    ``quality`` is handed to every cleaner (as a keyword) for its figures.
    """
    registry = registry or DEFAULT_REGISTRY
    stores: dict[Cleaner, list[str]] = {}
    for name, fn in registry.items():
        stores.setdefault(fn, []).append(name)
    out = None
    for fn, names in stores.items():
        others = [n for n in registry if n not in names]
        mine = raw if not others else raw.filter(F.col(store_col).isin(names) if out is not None else ~F.coalesce(F.col(store_col).isin(others), F.lit(False)))
        cleaned = fn(mine, store_col, names, **({"quality": quality} if quality else {}))
        out = cleaned if out is None else out.unionByName(cleaned, allowMissingColumns=True)
    return out


def union_stores(store_a_clean: DataFrame, store_b_rows: DataFrame) -> DataFrame:
    """U-1: append store tables by column name, missing columns -> null.

    Store B flags a sale with a boolean ``prd_discount`` while store A keeps
    the promotion label there; the flag is renamed ``is_discounted`` first
    and store-B price texts become decimals, so no column has two types. A
    store-B price text that is no number is a ``price`` reject with its text
    in ``raw`` (``split_rejects`` sets it apart).
    """
    from ..functions.pricing import parse_price

    b = store_b_rows.withColumnRenamed("prd_discount", "is_discounted")
    raw = F.create_map(F.lit("prd_price"), F.col("prd_price"), F.lit("org_price"), F.col("org_price"))
    bad = parse_price("prd_price").isNull() | parse_price("org_price").isNull()
    before = F.col("reject_reason") if "reject_reason" in b.columns else F.lit(None).cast("string")
    reason = F.coalesce(before, F.when(bad, F.lit(C.REJECT_PRICE)))
    b = b.withColumns({"reject_reason": reason, "raw": F.when(bad, raw)}).withColumns(
        {"prd_price": parse_price("prd_price"), "org_price": parse_price("org_price")}
    )
    return store_a_clean.unionByName(b, allowMissingColumns=True)
