"""K-1 with S-4's names: one file per key, under exactly that name.

Spark's own writers choose the names of their part files. The producers'
files are called ``<store>/<store>_<day>_<shard>.csv``, so this is a small
data source (``named_files``) with a commit of its own:

* a task writes each of its keys to a hidden staging folder of its attempt;
* when all tasks are done, the driver moves the files of the attempts that
  counted to their names; readers see nothing before that, and a file only whole;
* if a task fails for good, the staging folder is deleted and nothing was written.

Rows of one key must be in one task and next to each other: use
``write_named_files``. The folder is reached through ``pyarrow.fs`` (local or
mounted paths, HDFS, object stores), which the driver and all executors must share.
"""

from __future__ import annotations

import json
import posixpath
import re
import sys
import uuid
import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


def _ship_by_value() -> None:
    """Executors then need no install of this package (as in ``html``)."""
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:
        pass


_ship_by_value()


@dataclass
class WrittenFiles(WriterCommitMessage):
    folder: str  # of the attempt, in the staging folder
    names: bytes  # of its files, as compressed JSON: all tasks' messages meet in the driver


MOVES = 16  # files moved at a time


def file_system(path: str):
    """(file system, path in it) of a folder."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def checked_name(name: str | None) -> str:
    """A relative name that stays below the folder and is no hidden file."""
    parts = (name or "").split("/")
    if not name or any(p in ("", ".", "..") or p[0] in "._" for p in parts):
        raise ValueError(f"not the name of a file: {name!r}")
    return name


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, names: list[str], overwrite: bool):
        self.path, self.key, self.content = options["path"], options.get("key", "file"), options.get("content")
        self.names = [n for n in names if n != self.key]
        self.overwrite = overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"
        if self.content and self.names != [self.content]:
            raise ValueError(f"beside {self.key} and {self.content} there is no room for other columns")

    def write(self, iterator) -> WrittenFiles:
        import csv
        import io

        fs, root = file_system(self.path)
        folder = posixpath.join(root, self.staging, uuid.uuid4().hex)  # of this attempt
        done, folders, name, out = set(), set(), None, None

        def header() -> bytes:
            if self.content:
                return b""
            text = io.StringIO()
            csv.writer(text, lineterminator="\n").writerow(self.names)
            return text.getvalue().encode()

        for batch in iterator:
            keys = batch.column(self.key).to_pylist()
            columns = [batch.column(n).to_pylist() for n in self.names]
            lo = 0
            while lo < len(keys):
                hi = lo
                while hi < len(keys) and keys[hi] == keys[lo]:
                    hi += 1
                if keys[lo] != name or out is None:
                    if out is not None:
                        out.close()
                    name = checked_name(keys[lo])
                    if name in done or (self.content and hi - lo > 1):
                        raise ValueError(f"the rows of {name} are not next to each other, or too many")
                    done.add(name)
                    path = posixpath.join(folder, name)
                    if posixpath.dirname(path) not in folders:
                        folders.add(posixpath.dirname(path))
                        fs.create_dir(posixpath.dirname(path), recursive=True)
                    out = fs.open_output_stream(path)
                    out.write(header())
                elif self.content:
                    raise ValueError(f"{name} has more than one row")
                if self.content:
                    out.write(columns[0][lo] or b"")
                else:
                    text = io.StringIO()
                    csv.writer(text, lineterminator="\n").writerows(zip(*(c[lo:hi] for c in columns)))
                    out.write(text.getvalue().encode())
                lo = hi
        if out is not None:
            out.close()
        return WrittenFiles(folder, zlib.compress(json.dumps(sorted(done)).encode()))

    def commit(self, messages) -> None:
        from pyarrow import fs as pafs

        fs, root = file_system(self.path)
        messages = [m for m in messages if m is not None]
        files = lambda: ((m.folder, name) for m in messages for name in json.loads(zlib.decompress(m.names)))
        seen = set()
        for _, name in files():
            if name in seen:
                self.abort(messages)
                raise ValueError("two tasks wrote one file: the rows of a key must be in one task")
            seen.add(name)
        if self.overwrite:
            for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if info.base_name != self.staging:
                    fs.delete_dir(info.path) if info.type == pafs.FileType.Directory else fs.delete_file(info.path)
        for folder in {posixpath.dirname(name) for name in seen}:
            fs.create_dir(posixpath.join(root, folder), recursive=True)

        def move(part: list[tuple[str, str]]) -> None:
            for folder, name in part:
                fs.move(posixpath.join(folder, name), posixpath.join(root, name))

        todo = files()
        with ThreadPoolExecutor(MOVES) as pool:
            while parts := [p for p in (list(islice(todo, 250)) for _ in range(MOVES)) if p]:
                list(pool.map(move, parts))
        self._clear(fs, root)

    def abort(self, messages) -> None:
        fs, root = file_system(self.path)
        self._clear(fs, root)

    def _clear(self, fs, root: str) -> None:
        from pyarrow import fs as pafs

        staging = posixpath.join(root, self.staging)
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(dict(self.options), schema.names, overwrite)


def write_named_files(df: DataFrame, path: str, key: str = "file", order: list[str] | None = None, content: str | None = None, mode: str = "append") -> None:
    """One CSV file per value of ``key`` (or, with ``content``, a file of that
    binary column's bytes), named like it below ``path``.

    The columns other than ``key`` and ``order`` are written as text, rows in
    ``order``. A file is written by one task. ``append`` replaces files of the
    same name, ``overwrite`` removes all others first.
    """
    df.sparkSession.dataSource.register(NamedFiles)
    rows = df.repartition(key).sortWithinPartitions(key, *(order or []))
    if content:
        rows = rows.select(key, content)
    else:
        rows = rows.select(key, *[F.col(c).cast("string").alias(c) for c in df.columns if c != key and c not in (order or [])])
    w = rows.write.format("named_files").mode(mode).option("key", key).option("path", path)
    (w.option("content", content) if content else w).save()
