"""P-23 / A-5: quality figures of a cleaning run, without a second pass.

The chain is watched while it runs (``DataFrame.observe``): rows in, duplicates
dropped by keep-first, rows kept, and rejects by reason. The figures are sums
of each task's own rows, so they cost no shuffle; they are there once the one
action that writes the result is done.

    quality = Quality()
    clean_dispatch(raw, quality=quality).write.parquet(...)
    quality.figures()   # {"rows_in": ..., "duplicates": ..., "kept": ..., "reject:price": ...}
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import REJECT_REASONS

OTHER = "other"  # reasons of other cleaners


class Quality:
    """Figures of one run. Every row that comes in is kept, a duplicate or a reject."""

    def __init__(self):
        self._seen: list[tuple[Observation, list[str]]] = []

    def _observe(self, df: DataFrame, **figures) -> DataFrame:
        seen = Observation()
        self._seen.append((seen, list(figures)))
        return df.observe(seen, *[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in figures.items()])

    def watch_input(self, groups: DataFrame, n_col: str) -> DataFrame:
        """``groups``: one row per listing that stays, with the number of its copies."""
        return self._observe(groups, rows_in=F.sum(n_col), duplicates=F.sum(F.col(n_col) - 1))

    def watch_output(self, cleaned: DataFrame) -> DataFrame:
        """``cleaned``: rows with a ``reject_reason``."""
        reason = F.col("reject_reason")
        by_reason = {f"reject:{r}": F.count_if(reason == r) for r in REJECT_REASONS}
        rest = F.count_if(reason.isNotNull() & ~reason.isin(*REJECT_REASONS))
        return self._observe(cleaned, kept=F.count_if(reason.isNull()), **by_reason, **{f"reject:{OTHER}": rest})

    def figures(self) -> dict[str, int]:
        """Totals of the finished run (waits for its end)."""
        out: dict[str, int] = {}
        for seen, names in self._seen:
            found = _measured(seen)
            for name in names:
                out[name] = out.get(name, 0) + found.get(name, 0)
        return out

    def rows(self, spark: SparkSession, **labels) -> DataFrame:
        """(labels ..., figure, n): a dozen rows to keep beside the result."""
        rows = [(*labels.values(), k, n) for k, n in sorted(self.figures().items())]
        names = {**labels, "figure": "", "n": 0}
        return spark.createDataFrame(rows, ", ".join(f"{n} {'long' if isinstance(v, int) else 'string'}" for n, v in names.items()))


def _measured(seen: Observation) -> dict[str, int]:
    """Of a chain over an input known to be empty, the observation is optimized
    away with the rest, and has no row to give."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return {}
