"""CSV files -> named rows, in the task that reads the file.

A listing file names its columns itself, may have any number of them, and holds
quoted cells with newlines, so it can only be read from its start. Each file is
therefore read whole by one task (``binaryFile``), which takes the header row
and gives every other row as a map from column name to cell. Nothing is
shuffled or joined, there is no limit of columns, and no cell is lost:

* of columns with one name the second is called ``name.1``, the third ``name.2``;
* a cell under an empty header is called ``Unnamed: i`` (i from 0);
* a cell beyond the header is called ``+i`` (i from 1).

A row with a value in one of the last two is ``malformed``. Empty cells are
null; a row that is shorter than the header has nulls; blank lines are skipped.
"""

from __future__ import annotations

import codecs
import csv
import io
import sys

from pyspark.sql import DataFrame
from pyspark.sql import types as T

OUT_ROWS = 20_000  # rows per output batch
OUT_CELLS = 100_000  # and their cells: rows may be of any width


def _ship_by_value() -> None:
    """Executors then need no install of this package (as in ``html``)."""
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:
        pass


_ship_by_value()


def header_names(cells: list[str]) -> list[str]:
    """Unique names of a header row's cells."""
    seen: dict[str, int] = {}
    taken = set(cells)
    out = []
    for i, cell in enumerate(cells):
        name = cell or f"Unnamed: {i}"
        k = seen.get(name, 0)
        unique = name
        while k and (unique := f"{name}.{k}") in taken:
            k += 1
        seen[name] = k + 1
        taken.add(unique)
        out.append(unique)
    return out


def file_rows(content):
    """(names, cells, malformed) of each row below the header of one file (bytes,
    or an Arrow buffer of them); decoded as it is read, never as a whole."""
    import pyarrow as pa

    csv.field_size_limit(sys.maxsize)
    data = pa.py_buffer(content or b"")
    if data.size >= 3 and data.slice(0, 3).to_pybytes() == codecs.BOM_UTF8:
        data = data.slice(3)
    text = io.TextIOWrapper(io.BufferedReader(pa.BufferReader(data), 1 << 16), "utf-8", "replace", newline="")
    rows = (r for r in csv.reader(text) if r)
    head = next(rows, None)
    if head is None:
        return
    names = header_names(head)
    unnamed = [i for i, cell in enumerate(head) if not cell]
    n = len(names)
    for cells in rows:
        if len(cells) > n:
            beyond = cells[n:]
            yield names + [f"+{i}" for i in range(1, len(beyond) + 1)], cells, any(beyond) or any(cells[i] for i in unnamed)
        else:
            yield names, cells + [""] * (n - len(cells)), any(i < len(cells) and cells[i] for i in unnamed)


def _rows(keep: list[str], content_col: str):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            contents = batch.column(content_col)
            schema = pa.schema(
                [batch.schema.field(k) for k in keep]
                + [pa.field("pos", pa.int64()), pa.field("cells", pa.map_(pa.string(), pa.string())), pa.field("malformed", pa.bool_())]
            )
            src, pos, offsets, keys, values, bad = [], [], [0], [], [], []

            def out():
                cells = pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
                idx = pa.array(src, pa.int64())
                arrays = [batch.column(k).take(idx) for k in keep] + [pa.array(pos, pa.int64()), cells, pa.array(bad, pa.bool_())]
                return pa.RecordBatch.from_arrays(arrays, schema=schema)

            for i in range(batch.num_rows):
                for at, (names, cells, malformed) in enumerate(file_rows(contents[i].as_buffer()), start=1):
                    src.append(i)
                    pos.append(at)
                    keys += names
                    values += [c or None for c in cells]
                    offsets.append(len(keys))
                    bad.append(malformed)
                    if len(src) == OUT_ROWS or len(keys) >= OUT_CELLS:
                        yield out()
                        src, pos, offsets, keys, values, bad = [], [], [0], [], [], []
            yield out()

    return run


def csv_rows(files: DataFrame, content_col: str = "content") -> DataFrame:
    """One row per CSV row below the header of each file: the other columns of
    ``files``, ``pos`` (1, 2, ... in a file), ``cells`` and ``malformed``."""
    keep = [c for c in files.columns if c != content_col]
    schema = T.StructType(
        [files.schema[k] for k in keep]
        + [
            T.StructField("pos", T.LongType()),
            T.StructField("cells", T.MapType(T.StringType(), T.StringType())),
            T.StructField("malformed", T.BooleanType()),
        ]
    )
    return files.mapInArrow(_rows(keep, content_col), schema)
