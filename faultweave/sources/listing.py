"""Capture files with their sizes and first two lines, listed in tasks.

A Python data source: the driver lists only the roots' own entries, an input partition is
one capture date of one root, and its task lists the files, asks for their sizes and reads
the start of each. No file name passes through the driver, and an empty file is listed like
any other. Paths are opened with pyarrow's file systems, so that each executor must reach
them: a local path, S3, GCS or HDFS. `can_list` tells whether a path is of these.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = (
    "relative_path string, root string, capture_date string, kind string, size_bytes long, "
    "header string, first_row string"
)
# Bytes read at once from the start of a file, until two lines are found.
HEAD = 1 << 14
# Files per batch of rows.
BATCH = 4096

LINE_END = re.compile(rb"\r\n|\r|\n")


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        path = os.path.abspath(path)
    elif path.startswith("file:"):
        path = "file://" + path.removeprefix("file:").removeprefix("//")
    elif path.startswith(("s3a://", "s3n://")):
        path = "s3://" + path.split("://", 1)[1]
    return pafs.FileSystem.from_uri(path)


def can_list(path: str) -> bool:
    try:
        filesystem, base = open_path(path)
        filesystem.get_file_info(base)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def first_lines(stream) -> list[str]:
    """The first line and the second, if there are so many. A file's last line end ends no other line."""
    held, lines, done = b"", [], False
    while len(lines) < 2 and not done:
        more = stream.read(HEAD)
        held, done = held + more, not more
        while len(lines) < 2:
            end = LINE_END.search(held)
            # A carriage return at the end may be half of a line end.
            if end is None or (end.group() == b"\r" and end.end() == len(held) and not done):
                break
            lines.append(held[: end.start()])
            held = held[end.end() :]
    if done and held and len(lines) < 2:
        lines.append(held)
    return [line.decode("utf-8", "replace").removeprefix("\ufeff") for line in lines]


def _hidden(relative: str) -> bool:
    """Names that Spark's own listing leaves out."""
    return any(part.startswith(("_", ".")) for part in relative.split("/"))


class _Folder(InputPartition):
    def __init__(self, root: str, entry: str):
        self.root, self.entry = root, entry


class _Reader(DataSourceReader):
    def __init__(self, path: str, roots: list[str]):
        self.path, self.roots = path, roots

    def partitions(self) -> list[InputPartition]:
        filesystem, base = open_path(self.path)
        found = []
        for root in self.roots:
            folder = pafs.FileSelector(f"{base}/{root}", allow_not_found=True)
            found += [_Folder(root, info.base_name) for info in filesystem.get_file_info(folder)]
        return sorted(found, key=lambda f: (f.root, f.entry))

    def read(self, partition: _Folder | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no root is there
            return
        filesystem, base = open_path(self.path)
        top = f"{base}/{partition.root}/{partition.entry}"
        here = filesystem.get_file_info(top)
        below = pafs.FileSelector(top, recursive=True)
        infos = filesystem.get_file_info(below) if here.type == pafs.FileType.Directory else [here]
        rows: list[tuple] = []
        for info in infos:
            relative = f"{partition.root}/{partition.entry}" + info.path.removeprefix(top)
            if info.type != pafs.FileType.File or _hidden(relative):
                continue
            lines: list[str] = []
            if info.size:
                with filesystem.open_input_stream(info.path, compression=None, buffer_size=HEAD) as stream:
                    lines = first_lines(stream)
            parts = relative.split("/")
            date = parts[1] if len(parts) > 2 else "unknown"
            kind = parts[2] if len(parts) > 3 else "unknown"
            rows.append((relative, parts[0], date, kind, info.size, *(lines + [None, None])[:2]))
            if len(rows) == BATCH:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 2
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


class CaptureListing(DataSource):
    """Options: path, roots (a JSON list)."""

    @classmethod
    def name(cls) -> str:
        return "capture_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], json.loads(self.options["roots"]))


def capture_files(spark: SparkSession, path: str, roots: Sequence[str]) -> DataFrame:
    """relative_path, root, capture_date, kind, size_bytes, header and first_row of every file."""
    spark.dataSource.register(CaptureListing)
    reader = spark.read.format("capture_listing").option("roots", json.dumps(list(roots)))
    return reader.option("path", path.rstrip("/")).load()
