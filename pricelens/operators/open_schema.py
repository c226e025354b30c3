"""U-1 with columns that nobody declared.

A store-B file has whatever columns its pages gave. ``union_open`` keeps the
declared ones as typed columns and all others, whatever their types, in one
Variant column, so tables of any columns can be put together and no new field
needs a change of schema or is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRA = "extra"


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of different columns as one table (columns by name)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_extra(df: DataFrame, declared: T.StructType, extra: str = EXTRA, cells: str | None = None) -> DataFrame:
    """Declared columns (null where missing), and the others in ``extra``.

    A value that the declared type cannot hold also goes to ``extra``, under its
    column's name. Null fields are left out; a row without others has null.
    Of ``cells`` (a map of all cells, as the listing source gives them) the
    undeclared ones are taken too.
    """
    types = {f.name: f.dataType for f in declared.fields}
    if extra in types:
        raise ValueError(f"{extra} is a declared column")
    fixed, rest = [], []
    for name, dtype in types.items():
        if name not in df.columns:
            fixed.append(F.lit(None).cast(dtype).alias(name))
            continue
        value = F.col(_quoted(name))
        typed = value if df.schema[name].dataType == dtype else value.try_cast(dtype)
        fixed.append(typed.alias(name))
        if df.schema[name].dataType != dtype:
            rest.append((name, F.when(typed.isNull(), value)))
    rest += [(c, F.col(_quoted(c))) for c in df.columns if c not in types and c not in (cells, extra)]
    objects = [F.to_json(F.struct(*[v.alias(n) for n, v in rest]))] if rest else []
    if cells:
        undeclared = F.map_filter(cells, lambda k, v: v.isNotNull() & ~k.isin(*types))
        objects.append(F.to_json(undeclared))
    joined = F.concat_ws(",", *[F.nullif(F.regexp_replace(o, r"^\{|\}$", ""), F.lit("")) for o in objects]) if objects else F.lit("")
    return df.select(*fixed, F.when(joined != "", F.parse_json(F.concat(F.lit("{"), joined, F.lit("}")))).alias(extra))


def union_open(frames: list[DataFrame], declared: T.StructType, extra: str = EXTRA, cells: str | None = None) -> DataFrame:
    """U-1 over tables of any columns: declared ones by name, the rest in ``extra``."""
    out = None
    for df in frames:
        part = with_extra(df, declared, extra, cells if cells in df.columns else None)
        out = part if out is None else out.unionByName(part)
    return out


def extra_field(name: str, type_sql: str = "string", extra: str = EXTRA) -> Column:
    """An undeclared field as a typed column; null where it is missing or of
    another type. ``name`` may lead into an object (``a.b``)."""
    path = "$" + "".join(f"['{p}']" for p in name.replace("'", "\\'").split("."))
    return F.try_variant_get(F.col(extra), path, type_sql)


def merged_fields(df: DataFrame, extra: str = EXTRA) -> DataFrame:
    """One row: the merged schema of all undeclared fields (an aggregate with a
    map-side step, so no rows are moved)."""
    return df.agg(F.schema_of_variant_agg(F.col(extra)).alias("fields"))
