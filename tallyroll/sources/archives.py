"""Rows of delimited files inside zip archives, as a data source: the driver lists the members, a task streams each.

A member is decompressed, decoded (bytes that aren't text become the replacement character), parsed and handed over in Arrow
batches as it is read, so a member of any size takes the memory of a batch. Archives are opened by pyarrow's file systems,
which know local paths and the usual stores; the bytes of a member are read once.

Options: path (an archive, or a folder of archives), members (patterns of the members' own names, divided by "|", letters of
either case alike), sep, quote (empty: none), encoding, columns (divided by ","; all if empty), rows (of a batch).
"""

from __future__ import annotations

import csv
import fnmatch
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

NAME = "zip_members"
#: Where a row stands: the archive and its member, and the row's place in it.
WHERE = "_path string, _block long, _at long"
BATCH_ROWS = 10_000
#: Characters that a field may have.
LONGEST_FIELD = 2**31 - 1


def _opened(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, name


def _archives(path: str) -> list[str]:
    """The archive itself, or the archives of a folder, in the order of their names."""
    from pyarrow import fs

    system, name = _opened(path)
    if system.get_file_info(name).type != fs.FileType.Directory:
        return [path]
    found = system.get_file_info(fs.FileSelector(name))
    return [f"{path.rstrip('/')}/{f.base_name}" for f in sorted(found, key=lambda f: f.base_name) if f.type == fs.FileType.File and f.base_name.lower().endswith(".zip")]


@dataclass
class Member(InputPartition):
    """One member of one archive; a deflated stream can't be cut."""

    archive: str
    member: str


class _Format:
    def __init__(self, options: dict[str, str]):
        self.sep, self.quote = options.get("sep", ","), options.get("quote", '"')
        self.encoding = options.get("encoding", "utf-8-sig")

    def rows(self, raw) -> Iterator[list[str]]:
        """The parsed rows of a binary stream, the head first; blank lines are no rows."""
        csv.field_size_limit(LONGEST_FIELD)
        text = io.TextIOWrapper(raw, encoding=self.encoding, errors="replace", newline="")
        how = {"quoting": csv.QUOTE_NONE, "quotechar": None} if self.quote == "" else {"quotechar": self.quote}
        return (row for row in csv.reader(text, delimiter=self.sep, **how) if row)


class ZipMembers(DataSource):
    """spark.read.format("zip_members"): every column a string, and the row's place (_path, _block, _at)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _members(self) -> list[Member]:
        patterns = self.options.get("members", "*").lower().split("|")
        out = []
        for archive in _archives(self.options["path"]):
            system, name = _opened(archive)
            with system.open_input_file(name) as f, zipfile.ZipFile(f) as z:
                names = sorted(n for n in z.namelist() if not n.endswith("/") and any(fnmatch.fnmatch(n.rsplit("/", 1)[-1].lower(), p) for p in patterns))
            out += [Member(archive, n) for n in names]
        return out

    def _heads(self) -> list[str]:
        """The columns of all members, in the order in which they come up first."""
        fmt, out = _Format(self.options), {}
        for m in self._members():
            system, name = _opened(m.archive)
            with system.open_input_file(name) as f, zipfile.ZipFile(f) as z, z.open(m.member) as raw:
                out |= dict.fromkeys(next(fmt.rows(raw), []))
        return list(out)

    def schema(self) -> str:
        wanted = [c for c in self.options.get("columns", "").split(",") if c]
        return ", ".join([f"`{c.replace('`', '``')}` string" for c in wanted or self._heads()] + [WHERE])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self._members(), schema.names[:-3], _Format(self.options), int(self.options.get("rows", BATCH_ROWS)))


class _Reader(DataSourceReader):
    def __init__(self, members: list[Member], columns: list[str], fmt: _Format, rows: int):
        self.members, self.columns, self.fmt, self.size = members, columns, fmt, rows

    def partitions(self) -> list[Member]:
        return self.members

    def read(self, partition: Member) -> Iterator:
        import pyarrow as pa

        columns, where = self.columns, f"{partition.archive}!{partition.member}"

        def batch(cells: list[list], first: int) -> pa.RecordBatch:
            n = len(cells[0]) if cells else 0
            arrays = [pa.array(c, pa.string()) for c in cells]
            arrays += [pa.array([where] * n, pa.string()), pa.array([0] * n, pa.int64()), pa.array(range(first, first + n), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=[*columns, "_path", "_block", "_at"])

        system, name = _opened(partition.archive)
        with system.open_input_file(name) as f, zipfile.ZipFile(f) as z, z.open(partition.member) as raw:
            rows = self.fmt.rows(raw)
            head = next(rows, [])
            at = {c: i for i, c in reversed(list(enumerate(head)))}
            places = [at.get(c, -1) for c in columns]
            cells, first = [[] for _ in columns], 0
            for row in rows:
                for out, i in zip(cells, places, strict=True):
                    out.append(row[i] if 0 <= i < len(row) else None)
                if len(cells[0]) == self.size:
                    yield batch(cells, first)
                    cells, first = [[] for _ in columns], first + self.size
            if cells and cells[0]:
                yield batch(cells, first)


def read_members(spark: SparkSession, path: str, members: str = "*", **options: str) -> DataFrame:
    """The rows of an archive's members (or those of a folder of archives)."""
    spark.dataSource.register(ZipMembers)
    return spark.read.format(NAME).options(path=path, members=members, **options).load()
