"""Trees of page files (#2, #4, #5): ``<tree>/<host>/<file_name>``, one real file a
page, for users who read crawled pages with other tools.

A Spark data source of its own, so that files are written and read by tasks:

* *Write.*  A task writes each page under a name of its attempt, then moves its
  files to their places in the job's staging tree.  A file is whole when it gets its
  name, and an attempt that runs again puts the same content there.  The job commits
  by one rename of the staging tree; until then readers see nothing of it.  When the
  job fails, the staging tree is deleted, with what lost attempts left in it.
* *Read.*  A host's files are dealt out over partitions of ``FILES_PER_SPLIT``; tasks
  list their host and read their share.

The driver handles hosts, never pages, unless a tree is appended to hosts that are
there already: those files are moved one by one.  For very large trees prefer the
dataset form (:func:`webloom.sources.io.write_files`): no store likes a file a page.

Names: hosts and file names are used as they are, but for what would leave the tree
(``.``, ``..``, a slash), which is percent-encoded, and names beyond ``NAME_BYTES``,
which are cut and end in a digest.  Rows that share a place overwrite each other in
no particular order; choose winners first (:func:`webloom.sources.io.name_files`).
Rows without a host or file name are an error; null content is an empty file.
"""

from __future__ import annotations

import hashlib
import os
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FORMAT = "webloom_page_files"
FILES_PER_SPLIT = 2000
BATCH_BYTES = 4 << 20          # of a batch of pages read
NAME_BYTES = 255
STAGED, ATTEMPTS = ".staging-", "_attempts"

# Schemes of stores under their names in the Arrow library, and those
# whose folders can be renamed, which a commit needs.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "viewfs": "viewfs", "hdfs": "hdfs", "file": "file", "abfss": "abfss", "abfs": "abfs"}
RENAMES = {"local", "hdfs"}


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or URI, and the path in it.  A scheme that Python tasks
    can't reach is an error that says so."""
    scheme, colon, rest = path.partition(":")
    if colon and re.fullmatch("[A-Za-z][A-Za-z0-9+.-]*", scheme):
        path = f"{SCHEMES.get(scheme, scheme)}:{rest}"
        if scheme == "file":           # file:/x, file:///x
            path = "file:///" + rest.lstrip("/")
    else:
        path = os.path.abspath(path)
    try:
        return pafs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError) as e:
        raise ValueError(f"Python tasks can't open {scheme}: paths ({e}); give a shared folder, an hdfs: path or a store "
                         "that the Arrow library knows") from e


def safe_name(name: str) -> str:
    """A file or folder name that stays in its folder and fits one."""
    if not name.strip("."):
        name = name.replace(".", "%2E") or "%"
    name = name.replace("/", "%2F").replace("\0", "%00")
    data = name.encode()
    if len(data) > NAME_BYTES:
        stem, ext = os.path.splitext(name)
        ext = ext if len(ext.encode()) <= 16 else ""
        digest = f"-{hashlib.md5(data).hexdigest()}{ext}"
        name = data[:NAME_BYTES - len(digest.encode())].decode("utf-8", "ignore") + digest
    return name


@dataclass
class Written(WriterCommitMessage):
    files: int


@dataclass
class HostSplit(InputPartition):
    host: str
    part: int
    parts: int


class PageFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite = path.rstrip("/"), columns, overwrite
        folder, _, name = self.path.rpartition("/")
        self.staged = f"{folder}/{STAGED}{name}-{uuid.uuid4().hex[:12]}"
        store, staged = open_store(self.staged)
        if store.type_name not in RENAMES:
            raise ValueError(f"{store.type_name} folders can't be renamed, so page files can't be committed there; "
                             "write the dataset form")
        # made once, here: tasks that outlive an aborted job find no folder to write to
        store.create_dir(f"{staged}/{ATTEMPTS}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, staged = open_store(self.staged)
        attempt = f"{staged}/{ATTEMPTS}/{uuid.uuid4().hex}"
        store.create_dir(attempt, recursive=False)
        places: list[str] = []
        hosts: set[str] = set()

        def settle() -> None:
            """Move this attempt's files to their places."""
            for i, place in enumerate(places):
                if store.type_name != "local" and store.get_file_info(place).is_file:
                    store.delete_file(place)        # of an attempt before this one
                store.move(f"{attempt}/{i}", place)
            places.clear()

        n = 0
        for batch in iterator:
            for host, name, content in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in self.columns)):
                if host is None or name is None:
                    raise ValueError("a page file needs a host and a file name")
                folder = f"{staged}/{safe_name(host)}"
                if folder not in hosts:
                    store.create_dir(folder, recursive=False)
                    hosts.add(folder)
                with store.open_output_stream(f"{attempt}/{len(places)}") as f:
                    f.write((content or "").encode())
                places.append(f"{folder}/{safe_name(name)}")
                n += 1
            settle()
        return Written(n)

    def commit(self, messages: list) -> None:
        store, staged = open_store(self.staged)
        _, path = open_store(self.path)
        store.delete_dir(f"{staged}/{ATTEMPTS}")
        there = store.get_file_info(path).type == pafs.FileType.Directory
        if not there:
            store.move(staged, path)
        elif self.overwrite:
            old = f"{staged}-old"
            store.move(path, old)
            store.move(staged, path)
            store.delete_dir(old)
        else:
            for host in store.get_file_info(pafs.FileSelector(staged)):
                place = f"{path}/{host.base_name}"
                if store.get_file_info(place).type == pafs.FileType.NotFound:
                    store.move(host.path, place)
                else:
                    for page in store.get_file_info(pafs.FileSelector(host.path)):
                        store.move(page.path, f"{place}/{page.base_name}")
            store.delete_dir(staged)

    def abort(self, messages: list) -> None:
        store, staged = open_store(self.staged)
        for left in reversed(range(5)):
            try:
                if store.get_file_info(staged).type == pafs.FileType.Directory:
                    store.delete_dir(staged)
                return
            except OSError:                                 # a task that is still at work
                if not left:
                    raise
                time.sleep(0.2)


class PageFilesReader(DataSourceReader):
    def __init__(self, path: str, per_split: int):
        self.path, self.per_split = path, per_split

    def partitions(self) -> list[HostSplit]:
        store, path = open_store(self.path)
        out = []
        for host in sorted(store.get_file_info(pafs.FileSelector(path)), key=lambda f: f.base_name):
            if host.type == pafs.FileType.Directory and not host.base_name.startswith(STAGED):
                parts = -(-len(store.get_file_info(pafs.FileSelector(host.path))) // self.per_split)
                out += [HostSplit(host.base_name, i, parts) for i in range(parts)]
        return out or [HostSplit("", 0, 0)]

    def read(self, split: HostSplit) -> Iterator[pa.RecordBatch]:
        store, path = open_store(self.path)
        rows: list[tuple] = []
        size = 0
        files = store.get_file_info(pafs.FileSelector(f"{path}/{split.host}")) if split.parts else []
        files = sorted((f for f in files if f.is_file), key=lambda f: f.base_name)
        for f in files[split.part::split.parts or 1]:
            with store.open_input_stream(f.path) as page:
                content = page.read()
            rows.append((split.host, f.base_name, content.decode("utf-8", "replace")))
            size += len(content)
            if size >= BATCH_BYTES:
                yield self._batch(rows)
                rows, size = [], 0
        yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.record_batch([pa.array(c, pa.string()) for c in columns], names=["host", "file_name", "content"])


class PageFiles(DataSource):
    """Format ``webloom_page_files``: ``host``, ``file_name``, ``content``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "host string, file_name string, content string"

    def reader(self, schema) -> PageFilesReader:
        return PageFilesReader(self.options["path"], int(self.options.get("filesPerSplit", FILES_PER_SPLIT)))

    def writer(self, schema, overwrite: bool) -> PageFilesWriter:
        wanted = ["host", "file_name", "content"]
        if [f.name for f in schema] != wanted:
            raise ValueError(f"page files have the columns {wanted}")
        return PageFilesWriter(self.options["path"], wanted, overwrite)


def write_page_files(files: DataFrame, path: str, content: str = "content", mode: str = "overwrite") -> None:
    """Write ``(host, file_name, <content>)`` as a tree of files; ``mode`` is
    ``overwrite`` or ``append``.  Nothing is shuffled: tasks write what they hold."""
    files.sparkSession.dataSource.register(PageFiles)
    out = files.select("host", "file_name", F.col(content).cast("string").alias("content"))
    out.write.format(FORMAT).mode(mode).save(path)


def read_page_files(spark: SparkSession, path: str, files_per_split: int = FILES_PER_SPLIT) -> DataFrame:
    """A tree of files as ``(host, file_name, content)``; invalid UTF-8 is replaced."""
    spark.dataSource.register(PageFiles)
    return spark.read.format(FORMAT).option("filesPerSplit", files_per_split).load(path)
