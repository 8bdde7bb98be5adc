"""One file per page as a data source: page JSON and OCR texts in the folders where people look for them.

``<root>/<document>/pages/Page_NNN/<document>_page_NNNN.json``, and OCR texts as
``.../Page_NNN/ocr/<document>_page_NNNN_ocr_<pass>.txt``. Files are listed once, by name; a partition reads a group of pages,
and page ranges choose files before any is opened. A file that can't be read or decoded is a row with its error. Writing goes
through a folder of the job: only its commit, after all tasks have ended, gives files their names, and an abort deletes
what was written, so a failed job leaves nothing and a task that ran twice wrote once.

Paths may be of any file system that Arrow opens (``file``, ``hdfs``, ``s3``, ...).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from ravelin.shipping import ship

NAME = "ravelin_pages"
SCHEMA = "document string, page_num bigint, reading string, file string, content string, error string"
#: Files of a partition, about; renames at a time.
GROUP, AT_ONCE = 200, 16
JSON = re.compile(r"(?:^|/)(?P<document>[^/]+)/pages/Page_\d+/[^/]*_page_(?P<page>\d+)(?P<reading>)\.json$")
TEXT = re.compile(r"(?:^|/)(?P<document>[^/]+)/pages/Page_\d+/ocr/[^/]*_page_(?P<page>\d+)_ocr_(?P<reading>\w+)\.txt$")
#: The setting under which Spark hands filters to Python sources.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass
class PageGroup(InputPartition):
    files: list[tuple[str, int, str, str]]


@dataclass
class Written(WriterCommitMessage):
    moves: list[tuple[str, str]]


def page_name(document: str, page_num: int, reading: str | None = None) -> str:
    """Where a page's file lies below the root."""
    folder, stem = f"{document}/pages/Page_{page_num:03d}", f"{document}_page_{page_num:04d}"
    return f"{folder}/{stem}.json" if not reading else f"{folder}/ocr/{stem}_ocr_{reading}.txt"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"/{path}")


class PageFiles(DataSource):
    """``path`` is the root; ``kind`` is json or text; ``pages`` such as 1-50,60 chooses pages; ``pushdown`` takes filters."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (FilteredReader if self.options.get("pushdown") == "true" else PageReader)(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return PageWriter(self.options)


def in_spec(spec: str | None, page: int) -> bool:
    if not spec:
        return True
    bounds = [part.split("-", 1) for part in spec.replace(" ", "").split(",") if part]
    return any(int(b[0]) <= page <= int(b[-1]) for b in bounds)


class PageReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.root, self.kind, self.spec = options["path"], options.get("kind", "json"), options.get("pages")
        self.group = int(options.get("group", GROUP))
        self.tests: list[Filter] = []

    def wanted(self, document: str, page: int) -> bool:
        tests = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b}
        return in_spec(self.spec, page) and all(tests[type(t)](page if t.attribute == ("page_num",) else document, t.value) for t in self.tests)

    def partitions(self) -> list[PageGroup]:
        system, root = opened(self.root)
        listed = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = []
        for info in listed:
            m = (JSON if self.kind == "json" else TEXT).search(info.path.removeprefix(root.rstrip("/")))
            if m and info.type == fs.FileType.File and self.wanted(m["document"], int(m["page"])):
                files.append((m["document"], int(m["page"]), m["reading"], info.path))
        files.sort()
        return [PageGroup(files[i : i + self.group]) for i in range(0, len(files), self.group)]

    def read(self, partition: PageGroup) -> Iterator[tuple]:
        system, _ = opened(self.root)
        for document, page, reading, path in partition.files if partition else []:
            content = error = None
            try:
                with system.open_input_stream(path) as f:
                    content = f.read().decode()
            except (OSError, UnicodeDecodeError) as e:
                error = f"{type(e).__name__}: {e}"
            yield document, page, reading or None, path, content, error


class FilteredReader(PageReader):
    """Takes comparisons of page_num and document; all others stay with Spark."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            plain = isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual | In)
            if plain and getattr(f, "attribute", None) in (("page_num",), ("document",)):
                self.tests.append(f)
            else:
                yield f


class PageWriter(DataSourceWriter):
    """Rows of (document, page_num, reading, content); a page of one job has one row."""

    def __init__(self, options) -> None:
        self.root = options["path"]
        self.job = f"_job-{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        system, root = opened(self.root)
        task, moves = f"{root.rstrip('/')}/{self.job}/{uuid.uuid4().hex}", []
        system.create_dir(task, recursive=True)
        for n, row in enumerate(iterator):
            path = f"{task}/{n}"
            with system.open_output_stream(path) as f:
                f.write((row["content"] or "").encode())
            moves.append((path, f"{root.rstrip('/')}/{page_name(row['document'], row['page_num'], row['reading'])}"))
        return Written(moves)

    def _cleared(self) -> None:
        system, root = opened(self.root)
        if system.get_file_info(job := f"{root.rstrip('/')}/{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(job)

    def commit(self, messages) -> None:
        system, _ = opened(self.root)
        moves = {to: path for m in messages if m for path, to in m.moves}
        for folder in sorted({to.rpartition("/")[0] for to in moves}):
            system.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(lambda move: system.move(move[1], move[0]), moves.items()))
        self._cleared()

    def abort(self, messages) -> None:
        self._cleared()


def _registered(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(PageFiles)


def read_files(spark: SparkSession, root: str, kind: str = "json", pages: str | None = None, group: int = GROUP) -> DataFrame:
    """(document, page_num, reading, file, content, error) of the files of ``kind`` below ``root``.

    ``pages`` names page ranges; where the session has ``PUSHDOWN`` set, filters on page_num and document choose files as well.
    """
    _registered(spark)
    options = {"kind": kind, "group": str(group), "pushdown": str(spark.conf.get(PUSHDOWN, "false")).lower()} | ({"pages": pages} if pages else {})
    return spark.read.format(NAME).options(**options).load(root)


def write_files(rows: DataFrame, root: str) -> None:
    """One file for each of ``rows`` (document, page_num, content and, for OCR texts, reading); files of other pages stay."""
    _registered(rows.sparkSession)
    reading = F.col("reading") if "reading" in rows.columns else F.lit(None).cast("string")
    full = rows.select(F.col("document").cast("string"), F.col("page_num").cast("long"), reading.alias("reading"), F.lit(None).cast("string").alias("file"), "content", F.lit(None).cast("string").alias("error"))
    full.write.format(NAME).mode("append").save(root)
