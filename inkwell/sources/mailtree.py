"""The mail tree as a Spark data source: format ``mailtree``.

*Reading* lists ``<root>/<user>/<folder>/**``: the driver sees the users' names alone, which it deals out to partitions;
each task lists its users' sent and inbox folders, hidden names included, and yields a row per file (path,
user, folder, length). A bound on ``length`` is pushed into the listing. File contents are read by
``read_contents`` in as many tasks as the session shuffles to, dealt by path, so one user's many files are no hot task.

*Writing* commits: tasks write below a staging folder of the job, one folder per attempt; when all have succeeded, the files of
the attempts that count are moved to their places and the staging folder goes. A repeated or speculative attempt never
touches another's files, and a job that fails leaves nothing.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, IsNotNull,
                                    LessThan, LessThanOrEqual, WriterCommitMessage)

from inkwell.functions import fixed
from inkwell.session import ship_package

LISTING = "path string, user string, folder string, length bigint"
FILES = "path string, user string, folder string, length bigint, bytes binary"
USERS = 8       # users listed by one task
MOVERS = 32     # files moved at once when a job commits
FOLDERS = frozenset(fixed.SENT_FOLDER_NAMES) | frozenset(fixed.INBOX_FOLDER_NAMES)


def open_tree(root: str):
    """File system and path of a root given as URI."""
    from pyarrow import fs as pafs

    fs, base = pafs.FileSystem.from_uri(root)
    return fs, base.rstrip("/")


def listed(fs, path: str, recursive: bool = False):
    from pyarrow import fs as pafs

    return sorted(fs.get_file_info(pafs.FileSelector(path, recursive=recursive, allow_not_found=True)), key=lambda i: i.path)


def is_mail_folder(name: str) -> bool:
    return name.lower().strip("_").replace(" ", "_") in FOLDERS


@dataclass
class Users(InputPartition):
    names: list


class MailTreeReader(DataSourceReader):
    def __init__(self, root: str):
        self.root, self.scheme = root, root.partition(":")[0] if "://" in root else "file"
        self.most = None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute == ("length",):
                bound = f.value - isinstance(f, LessThan)
                self.most = bound if self.most is None else min(self.most, bound)
            elif not (isinstance(f, IsNotNull) and f.attribute == ("length",)):  # a length is never null
                yield f

    def partitions(self):
        from pyarrow import fs as pafs

        fs, base = open_tree(self.root)
        users = [i.base_name for i in listed(fs, base) if i.type == pafs.FileType.Directory and not i.base_name.startswith(STAGING)]
        return [Users(users[i:i + USERS]) for i in range(0, len(users), USERS)] or [Users([])]

    def read(self, partition):
        from pyarrow import fs as pafs

        fs, base = open_tree(self.root)
        for user in partition.names:
            for folder in listed(fs, f"{base}/{user}"):
                if folder.type != pafs.FileType.Directory or not is_mail_folder(folder.base_name):
                    continue
                for f in listed(fs, folder.path, recursive=True):
                    if f.type == pafs.FileType.File and (self.most is None or f.size <= self.most):
                        yield f"{self.scheme}:{f.path}", user, folder.base_name, f.size


STAGING = ".staging-"


@dataclass
class Attempt(WriterCommitMessage):
    """An attempt that counts: its folder and the files in it, by their place in the tree."""

    folder: str
    files: list


class MailTreeWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root, self.job = root, STAGING + uuid.uuid4().hex

    def write(self, iterator):
        fs, base = open_tree(self.root)
        own = f"{base}/{self.job}/{uuid.uuid4().hex}"
        made, files = set(), []
        for batch in iterator:
            columns = [batch.column(c).to_pylist() for c in ("user", "folder", "name", "content")]
            for user, folder, name, content in zip(*columns):
                place = f"{user}/{folder}"
                if place not in made:
                    fs.create_dir(f"{own}/{place}", recursive=True)
                    made.add(place)
                with fs.open_output_stream(f"{own}/{place}/{name}.") as out:
                    out.write((content or "").encode("utf-8"))
                files.append(f"{place}/{name}.")
        return Attempt(own, files)

    def commit(self, messages):
        fs, base = open_tree(self.root)
        for place in sorted({f.rsplit("/", 1)[0] for m in messages if m for f in m.files}):
            fs.create_dir(f"{base}/{place}", recursive=True)
        with ThreadPoolExecutor(MOVERS) as pool:
            for _ in pool.map(lambda f: fs.move(*f), [(f"{m.folder}/{f}", f"{base}/{f}") for m in messages if m for f in m.files]):
                pass
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs as pafs

        fs, base = open_tree(self.root)
        if fs.get_file_info(f"{base}/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/{self.job}")


class MailTreeSource(DataSource):
    """Options: ``path``, the root as URI. Reads ``LISTING`` rows; writes rows (user, folder, name, content)."""

    @classmethod
    def name(cls):
        return "mailtree"

    def schema(self):
        return LISTING

    def reader(self, schema):
        return MailTreeReader(self.options["path"])

    def writer(self, schema, overwrite):
        return MailTreeWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and this package to its workers."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MailTreeSource)


def list_tree(spark: SparkSession, root: str, max_bytes: int) -> DataFrame:
    """A row per file of at most ``max_bytes`` in a sent or inbox folder below ``root`` (a URI)."""
    register(spark)
    return spark.read.format("mailtree").option("path", root).load().where(f"length <= {int(max_bytes)}")


def read_contents(listing: DataFrame, root: str) -> DataFrame:
    """``listing`` with the files' bytes, read by tasks that files are dealt to by path."""
    def read(batches):
        import pyarrow as pa

        fs, _ = open_tree(root)
        for batch in batches:
            for k in range(len(batch)):  # a file at a time: a batch never holds more
                row = batch.slice(k, 1)
                with fs.open_input_stream(row["path"][0].as_py().partition(":")[2]) as f:
                    data = f.read()
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([data], pa.binary())], names=[*row.schema.names, "bytes"])

    n = int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listing.repartition(n, "path").mapInArrow(read, FILES)
