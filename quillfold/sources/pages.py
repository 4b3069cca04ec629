"""Files as tables of their parts, and tables as files: two data sources for ``spark.read.format`` and ``df.write.format``.

Reading: files are packed into partitions of about ``PARTITION_BYTES`` when the
query is planned. Filters on ``page`` reach the parser, which may skip pages, and
columns that a schema leaves out aren't built. A file that fails is one row with
``error``. Writing: each task writes files under a name of its own; they get
their names when all tasks have ended, and go if one fails.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .store import PAGE_PARTS

PARTITION_BYTES = 32 << 20
BATCH_ROWS = 2000
PUSHED = "spark.sql.python.filterPushdown.enabled"


@dataclass
class Pages:
    """The pages that a query wants: a range, and single ones if they are named."""

    first: int = 1
    last: int | None = None
    only: frozenset[int] | None = None

    def __contains__(self, page: int) -> bool:
        return page >= self.first and (self.last is None or page <= self.last) and (self.only is None or page in self.only)

    def narrowed(self, f: Filter) -> bool:
        """Whether the filter is one on pages, which is then kept here."""
        if getattr(f, "attribute", None) != ("page",):
            return False
        values = f.value if isinstance(f, In) else (getattr(f, "value", None),)
        if not values or not all(isinstance(v, int) for v in values):
            return False
        if isinstance(f, EqualTo | In):
            self.only = frozenset(values) if self.only is None else self.only & frozenset(values)
        elif isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.first = max(self.first, values[0] + isinstance(f, GreaterThan))
        elif isinstance(f, LessThan | LessThanOrEqual):
            end = values[0] - isinstance(f, LessThan)
            self.last = end if self.last is None else min(self.last, end)
        else:
            return False
        return True


class FileGroup(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)


def _listed(path: str, pattern: str) -> list[tuple[str, int]]:
    fs, root = pyarrow.fs.FileSystem.from_uri(path)
    infos = fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
    keep = re.compile(pattern).search
    return sorted((i.path, i.size) for i in infos if i.type == pyarrow.fs.FileType.File and keep(i.base_name) and not i.base_name.startswith(("_", ".")))


def page_source(name: str, parser: Callable[[bytes, Pages], Iterable[dict]], parts: str = PAGE_PARTS) -> type[DataSource]:
    """A data source ``name``: ``path, error`` and the fields ``parts`` of what ``parser(content, pages)`` gives.

    The parser is the caller's, as there is none for PDFs here. It may leave out
    pages that aren't in ``pages``; rows of other pages are dropped in any case.
    Options: ``path`` (a folder's URI), ``pattern`` (of file names, by default
    all), ``partitionBytes``.
    """
    whole = f"path string, error string, {parts}"

    class Reader(DataSourceReader):
        def __init__(self, schema: StructType, options: dict):
            self.schema, self.options, self.pages = schema, options, Pages()

        def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
            for f in filters:
                self.pages.narrowed(f)
                # an error has no page: Spark filters such rows itself
                yield f

        def partitions(self) -> list[InputPartition]:
            size, groups, held = int(self.options.get("partitionbytes", PARTITION_BYTES)), [[]], 0
            for path, n in _listed(self.options["path"], self.options.get("pattern", "")):
                if groups[-1] and held + n > size:
                    groups.append([])
                    held = 0
                groups[-1].append(path)
                held += n
            return [FileGroup(g) for g in groups if g] or [FileGroup([])]

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            fs, _ = pyarrow.fs.FileSystem.from_uri(self.options["path"])
            arrow, rows = to_arrow_schema(self.schema), []
            names = arrow.names
            batch = lambda: pa.RecordBatch.from_pylist(rows, arrow)
            for path in partition.value:
                found: list[dict] = []
                try:
                    with fs.open_input_stream(path) as f:
                        for r in parser(f.read(), self.pages):
                            if r.get("page") is None or r["page"] in self.pages:
                                found.append({c: path if c == "path" else r.get(c) for c in names})
                except Exception as e:  # one bad file must not end the job; it becomes a row
                    found = [{c: path if c == "path" else f"{type(e).__name__}: {e}"[:500] if c == "error" else None for c in names}]
                rows += found
                if len(rows) >= BATCH_ROWS:
                    yield batch()
                    rows = []
            if rows or not partition.value:
                yield batch()

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return whole

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader(schema, {k.lower(): v for k, v in self.options.items()})

    return Source


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class FilesWriter(DataSourceWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        names = [f.name for f in schema.fields]
        if names != ["name", "html"]:
            raise ValueError(f"files are rows of name and html, not of {', '.join(names)}")
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex

    def _store(self):
        return pyarrow.fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        fs, root = self._store()
        beside, files = f"{root}/_writing-{self.job}/{uuid.uuid4().hex}", []
        fs.create_dir(beside, recursive=True)
        for k, row in enumerate(iterator):
            if not row[0] or "/" in row[0] or row[0].startswith(("_", ".")):
                raise ValueError(f"not a file name: {row[0]!r}")
            with fs.open_output_stream(f"{beside}/{k}") as out:
                out.write((row[1] or "").encode())
            files.append((f"{beside}/{k}", row[0]))
        return Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Names are checked before any file is moved: two rows of one name are an error, and nothing is there then."""
        fs, root = self._store()
        files = [f for m in messages if m for f in m.files]
        if len({name for _, name in files}) != len(files):
            self.abort(messages)
            raise ValueError("two rows have the same file name")
        if self.overwrite:
            for info in fs.get_file_info(pyarrow.fs.FileSelector(root)):
                if info.type == pyarrow.fs.FileType.File:
                    fs.delete_file(info.path)
        for beside, name in files:
            fs.move(beside, f"{root}/{name}")
        self.abort([])

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = self._store()
        if fs.get_file_info(f"{root}/_writing-{self.job}").type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(f"{root}/_writing-{self.job}")


class ReportFiles(DataSource):
    """``format("report_files")``: a file for each row ``name, html``, in the folder ``path`` (a URI)."""

    @classmethod
    def name(cls) -> str:
        return "report_files"

    def schema(self) -> str:
        return "name string, html string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return FilesWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession, *sources: type[DataSource]) -> None:
    """Make sources known to a session, and let it push filters to them."""
    spark.conf.set(PUSHED, "true")
    for s in (*sources, ReportFiles):
        spark.dataSource.register(s)
