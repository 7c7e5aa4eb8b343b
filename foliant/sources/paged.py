"""A data source of pages: a file is read in ranges of pages, dealt over tasks, so a very long one isn't one task.

    register_pages(spark, "pages", count, read, "text string")
    spark.read.format("pages").option("path", folder).option("pagesPerTask", 50).load()
"""
from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from foliant.sources.calls import called

PAGES_PER_TASK = 32
COUNTED_AT_ONCE = 16  #: files whose pages the driver counts at a time
TASKS = 1024  #: tasks at most; where there are more ranges, a task reads several
FIXED = "path string, page_num int, processing_status string, error_message string"


class PageRanges(InputPartition):
    """Ranges of pages that a task reads: the file, its pages `first` up to `last`, from 0, and the error that counting
    them gave."""

    def __init__(self, ranges: list[tuple[str, int, int, str | None]]):
        super().__init__(ranges[0][:3])
        self.ranges = ranges


@lru_cache(maxsize=16)
def _line_starts(path: str, size: int, changed: int) -> np.ndarray:
    found, at = [np.zeros(1, np.int64)], 0
    with open(path, "rb") as f:
        while chunk := f.read(1 << 20):
            found.append(np.flatnonzero(np.frombuffer(chunk, np.uint8) == 10) + (at + 1))
            at += len(chunk)
    out = np.concatenate(found)
    return out if out[-1] == size else np.append(out, size)


def line_starts(path: str) -> np.ndarray:
    """Where a local text file's lines start, and its size; a process goes through a file once, while it stays as it is."""
    told = os.stat(path)
    return _line_starts(path, told.st_size, told.st_mtime_ns)


def read_lines(path: str, first: int, last: int) -> list[str]:
    """Lines `first` up to `last`, from 0, of a local text file; no others are read."""
    starts = line_starts(path)
    at, end = (int(starts[min(n, len(starts) - 1)]) for n in (first, last))
    with open(path, "rb") as f:
        f.seek(at)
        text = f.read(end - at)
    return [line.decode() for line in text.removesuffix(b"\n").split(b"\n")] if text else []


def pages_of(read: Callable[[str, int, int], Iterable], path: str, first: int, last: int) -> Iterator[tuple[int, Any, str | None]]:
    """(page, what was read, error) of a range. A damaged page costs a read of its own and one of the pages behind it,
    not one of every page, as long as the reader gives the pages before it first."""

    def alone(at: int) -> tuple[int, Any, str | None]:
        try:
            return at, next(iter(read(path, at, at + 1))), None
        except Exception as e:  # noqa: BLE001  one page's failure is its row's
            return at, None, str(e) or type(e).__name__

    at = first
    while at < last:
        held, ended = [], False
        try:
            for page in read(path, at, last):
                held.append(page)
            ended = True
        except Exception:  # noqa: BLE001  the page that fails is found below
            pass
        good = len(held) == last - at if ended else len(held) < last - at
        if good:
            yield from ((at + n, page, None) for n, page in enumerate(held))
            at += len(held)
        if ended and good:
            return
        found = alone(at)
        yield found
        at += 1
        if not good or (not held and found[2] is None):  # the range says nothing of its pages
            yield from map(alone, range(at, last))
            return




def listed(folder: str, ending: str) -> list[str]:
    """The files below a folder with an ending, whatever its case, sorted."""
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    head = folder.partition("://")[0] + "://" if "://" in folder else ""
    found = store.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted(head + f.path for f in found if f.is_file and f.path.lower().endswith(ending.lower()))


def register_pages(spark: SparkSession, name: str, count: Callable[[str], int], read: Callable[[str, int, int], Iterable[dict[str, Any]]], fields: str) -> None:
    """Make spark.read.format(name) a source of pages: rows of path, page_num (from 1), processing_status, error_message
    and `fields`. count(path) gives a file's pages, read(path, first, last) the fields of those pages, in order; both
    are injected. Where a page of a range can't be read, it is read alone, and if it fails again it is a row of status
    `error` (pages_of()); so is a file whose pages can't be counted, without a page number. A file without pages has no rows.
    Options: path, ending (all files), pagesPerTask."""
    schema = T._parse_datatype_string(f"{FIXED}, {fields}")
    names = schema.names[4:]

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.folder, self.ending = options["path"], options.get("ending", "")
            self.size = int(options.get("pagesPerTask", PAGES_PER_TASK))

        def partitions(self) -> list[PageRanges]:
            out = []
            for path, pages, status in called(listed(self.folder, self.ending), count, width=COUNTED_AT_ONCE, ordered=True):
                if pages is None:
                    out.append((path, 0, 0, status))
                else:
                    out += [(path, at, min(at + self.size, pages), None) for at in range(0, pages, self.size)]
            each = -(-len(out) // TASKS)
            return [PageRanges(out[at : at + each]) for at in range(0, len(out), each)] if out else []

        def read(self, part: PageRanges) -> Iterator[tuple]:
            for path, first, last, error in part.ranges:
                if error:
                    yield (path, None, "error", error.removeprefix("error: "), *[None] * len(names))
                for at, page, failed in pages_of(read, path, first, last):
                    values = [None] * len(names) if failed is not None else [page.get(n) for n in names]
                    yield (path, at + 1, "success" if failed is None else "error", failed, *values)

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return schema

        def reader(self, schema: T.StructType) -> Reader:
            return Reader(self.options)

    spark.dataSource.register(Pages)
