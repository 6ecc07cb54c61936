"""Table scans by name (S3, S4, S5) over a lake folder.

A lake is a root folder with one parquet (or delta, when the session has it)
table per data file at ``<root>/files/<NAME>`` and its schema document at
``<root>/schemas/lake_table=<NAME>``.  The layout is a template, so a folder of
``<name>.parquet`` files (the test data) is a lake too.

A table is replaced as a whole: the new rows go to a folder of their own below
the table's, and only when they are complete (and checked) does a commit name that
folder.  Commits are numbered files in ``_commits``; the last one is the table.  A
commit is put in place only if its number is free, so of two writers that began at
the same commit one publishes and the other gets ``ConcurrentReplace``; neither
removes rows of a commit it has not seen.  A failed write leaves the old rows
readable; the version before the current one stays for readers that opened it.  A
folder without commits is a plain table of parquet files.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_identifier_py

COMMITS, VERSION, SCHEMA_PART = "_commits", "version-", "lake_table"
CODEC = "zstd"                  # of stored files, also in sessions whose own codec is another

# How stored files are written, in any session.  A dictionary serves columns of few values;
# by default one of up to 1 MB is kept for a column of many, whose numbers compress badly.
# Past 64 KB such texts are stored as differences from the text before instead (parquet's
# second format version; Spark, DuckDB and Arrow read it): ids, names, addresses and links
# begin alike, and after a join by key the same facility's texts follow each other.
STORED = {"compression": CODEC, "parquet.writer.version": "PARQUET_2_0", "parquet.dictionary.page.size": str(64 << 10)}


class TableNotFound(LookupError):
    pass


class ConcurrentReplace(RuntimeError):
    """Another writer has published since this one began; nothing was changed."""


class Files:
    """The few file operations of the driver, by Hadoop's file system of the path
    (whatever scheme the session's reads and writes can reach)."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def below(cls, files: "Files", name: str) -> "Files":
        out = cls.__new__(cls)
        out.jvm, out._gateway, out.fs, out.root = files.jvm, files._gateway, files.fs, files._path(name)
        return out

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name) if name else self.root

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def names(self) -> list[str]:
        return [x.getPath().getName() for x in self.fs.listStatus(self.root)] if self.exists() else []

    def is_file(self) -> bool:
        return self.exists() and self.fs.getFileStatus(self.root).isFile()

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a small file that nothing reads or waits for yet."""
        stream = self.fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> None:
        if not self.fs.rename(self._path(name), self._path(to)):
            raise OSError(f"{self._path(name)} could not be renamed to {to}")

    def put_if_absent(self, name: str, text: str) -> bool:
        """Put a small file in place, whole, unless the name is taken: of several
        writers one succeeds.  A hard link on a local file system, elsewhere a rename
        that refuses an existing target (atomic on HDFS and on object stores that
        offer conditional renames)."""
        fresh = f".{uuid.uuid4().hex}"
        self.put(fresh, text)
        source, target = self.fs.makeQualified(self._path(fresh)), self.fs.makeQualified(self._path(name))
        try:
            self.fs.mkdirs(target.getParent())
            if source.toUri().getScheme() == "file":
                on_disk = [self.jvm.java.io.File(x.toUri().getPath()).toPath() for x in (target, source)]
                self.jvm.java.nio.file.Files.createLink(*on_disk)
            else:
                none = self._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.fs.getConf()).rename(source, target, none)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.delete(fresh)

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class Commits:
    """The numbered commits of one table folder.  A commit's state names folders of
    the table: ``version`` (the whole table), or ``parts`` (a folder for each part)."""

    def __init__(self, files: Files):
        self.files, self.log = files, Files.below(files, COMMITS)

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in self.log.names() if n.isdigit())

    def head(self) -> tuple[int, dict]:
        """(number, state) of the last commit; (0, {}) if there is none."""
        for _ in range(20):                  # a commit may be cleaned up between listing and reading
            numbers = self.numbers()
            if not numbers:
                return 0, {}
            try:
                return numbers[-1], self.state(numbers[-1])
            except Py4JJavaError as e:
                if "FileNotFound" not in e.java_exception.getClass().getName():
                    raise
        raise OSError(f"no stable commit below {self.files.root}")

    def state(self, number: int) -> dict:
        return json.loads(self.log.read(f"{number:08d}"))

    def publish(self, base: tuple[int, dict], state: dict) -> None:
        """Make ``state`` the commit after ``base``, or raise ``ConcurrentReplace``."""
        number, token = base[0] + 1, uuid.uuid4().hex
        moved = ConcurrentReplace(f"{self.files.root}: replaced by another writer since commit {base[0]}")
        if self.head()[0] != base[0]:
            raise moved
        if not self.log.put_if_absent(f"{number:08d}", json.dumps({**state, "token": token, "after": base[1].get("token")})):
            raise moved
        # the number may have been free because others' commits were cleaned up meanwhile
        later = [n for n in self.numbers() if n > number]
        if later and (later[0] != number + 1 or self.state(later[0])["after"] != token):
            self.log.delete(f"{number:08d}")
            raise moved

    @staticmethod
    def folders(state: dict) -> set[str]:
        return ({state["version"]} if "version" in state else set()) | set(state.get("parts", {}).values())

    def clean(self, base: tuple[int, dict], state: dict) -> None:
        """Remove commits older than ``base`` and the folders that only they name:
        never what a newer commit, or a writer at work, has made."""
        kept = self.folders(base[1]) | self.folders(state)
        for number in [n for n in self.numbers() if n < base[0]]:
            try:
                old = self.folders(self.state(number))
            except Py4JJavaError:            # another writer is cleaning up too
                continue
            for folder in old - kept:
                self.files.delete(folder)
                whole = folder.split("/")[0]
                if whole != folder and not any(k.split("/")[0] == whole for k in kept):
                    self.files.delete(whole)
            self.log.delete(f"{number:08d}")

    def unreferenced(self) -> list[str]:
        """Version folders that no commit names: of failed writers, or of writers at
        work."""
        named = {f.split("/")[0] for n in self.numbers() for f in self.folders(self.state(n))}
        return [x for x in self.files.names() if x.startswith(VERSION) and x not in named]


def fresh_version(base: int) -> str:
    return f"{VERSION}{base + 1:08d}-{uuid.uuid4().hex[:12]}"


class Staged:
    """A new version of a table: written, but not yet the table."""

    def __init__(self, lake: "Lake", path: str):
        self.lake, self.path = lake, path

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> None:
        w = df.write.format(self.lake.fmt).options(**STORED)
        if self.lake.fmt != "parquet":       # versions of its own
            w = w.mode("overwrite").option("overwriteSchema", "true")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(self.path)

    def read(self) -> DataFrame:
        return self.lake.spark.read.format(self.lake.fmt).load(self.path)


@dataclass
class Lake:
    spark: SparkSession
    root: str
    layout: str = "{root}/files/{name}"
    schema_layout: str = "{root}/schemas/" + SCHEMA_PART + "={name}"
    fmt: str = "parquet"

    def path(self, name: str) -> str:
        return self.layout.format(root=self.root.rstrip("/"), name=name)

    def schema_path(self, name: str) -> str:
        return self.schema_layout.format(root=self.root.rstrip("/"), name=name)

    def _files(self, name: str) -> Files:
        return Files(self.spark, self.path(name))

    def commits(self, name: str) -> Commits:
        return Commits(self._files(name))

    def current(self, name: str) -> str | None:
        """The version that is the table now; None for a plain table."""
        return self.commits(name).head()[1].get("version") if self.fmt == "parquet" else None

    def location(self, name: str) -> str:
        """Where the table's committed rows are; ``TableNotFound`` if nowhere."""
        version = self.current(name)
        if version:
            return f"{self.path(name)}/{version}"
        files = self._files(name)
        rows = [x for x in files.names() if x == "_delta_log" or not x.startswith((".", "_", VERSION))]
        if not rows and not files.is_file():              # nothing was ever committed
            raise TableNotFound(name)
        return self.path(name)

    def exists(self, name: str) -> bool:
        """Is there a committed table?  A metadata lookup on the driver (no data
        is read); an empty folder, or one of a failed first write, is none."""
        try:
            self.location(name)
            return True
        except TableNotFound:
            return False

    def version(self, name: str) -> str:
        """A stamp that changes with every change of the stored rows: version, and
        number, bytes and newest time of the files.  Errors other than a missing
        table are raised."""
        try:
            files = Files(self.spark, self.location(name))
        except TableNotFound:
            return "absent"
        n = size = newest = 0
        listing = files.fs.listFiles(files.root, True)
        while listing.hasNext():
            f = listing.next()
            if not f.getPath().getName().startswith(("_", ".")):
                n, size, newest = n + 1, size + f.getLen(), max(newest, f.getModificationTime())
        return f"{self.current(name) or 'plain'}:{n}:{size}:{newest}"

    def bytes(self, name: str, partition: str = "") -> int | None:
        """On-disk bytes of a table or one of its partitions; None if there is none."""
        try:
            files = Files(self.spark, f"{self.location(name)}/{partition}".rstrip("/"))
        except TableNotFound:
            return None
        return int(files.fs.getContentSummary(files.root).getLength()) if files.exists() else None

    def reader(self, name: str, session: SparkSession) -> DataFrame:
        path = self.location(name)
        try:
            return session.read.format(self.fmt).load(path)
        except AnalysisException as e:
            raise TableNotFound(name) from e

    def read(self, name: str) -> DataFrame:
        """S3: open a stored table; ``TableNotFound`` when it is absent."""
        return self.reader(name, self.spark)

    def read_limited(self, name: str, limit: int | None) -> DataFrame:
        """The base table, cut to ``limit`` rows *before* any query runs."""
        df = self.read(name)
        return first_rows(df, int(limit)) if limit else df

    def load(self, name: str, session: SparkSession | None = None) -> str:
        """S3: register the table as a temp view named with ``-`` -> ``_``."""
        alias = clean_identifier_py(name)
        self.reader(name, session or self.spark).createOrReplaceTempView(alias)
        return alias

    @contextmanager
    def replace(self, name: str) -> Iterator[Staged]:
        """K1/K2/K6: a new version of a table.  It becomes the table when the block
        ends; if the block raises, or another writer has published since it began
        (``ConcurrentReplace``), it is removed and the table stays as it is."""
        if self.fmt != "parquet":
            yield Staged(self, self.path(name))
            return
        files, commits = self._files(name), self.commits(name)
        base = commits.head()
        state = {"version": fresh_version(base[0])}
        try:
            yield Staged(self, f"{self.path(name)}/{state['version']}")
            commits.publish(base, state)
        except BaseException:
            files.delete(state["version"])
            raise
        commits.clean(base, state)
        if base[0]:                              # rows of a plain table, two versions ago
            for old in files.names():
                if not old.startswith(("_", ".", VERSION)):
                    files.delete(old)

    def vacuum(self, name: str, hours: float = 24.0) -> list[str]:
        """Remove what writers that died left behind: version folders that no commit
        names and that are older than ``hours`` (longer than any write takes)."""
        commits = self.commits(name)
        now = commits.files.jvm.java.lang.System.currentTimeMillis()
        gone = [x for x in commits.unreferenced()
                if now - commits.files.fs.getFileStatus(commits.files._path(x)).getModificationTime() > hours * 3_600_000]
        for x in gone:
            commits.files.delete(x)
        return gone

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              partition_by: list[str] | None = None) -> None:
        """K1/K2: replace (or append to) a stored table.  A replacement also
        replaces the schema, so schema evolution needs no extra option; delta has
        versions of its own, there ``overwriteSchema`` is set."""
        if self.fmt == "parquet" and mode == "overwrite":
            with self.replace(name) as new:
                new.write(df, partition_by)
            return
        w = df.write.format(self.fmt).options(**STORED).mode(mode)
        if self.fmt == "delta":
            w = w.option("overwriteSchema", "true")
        if partition_by:
            w = w.partitionBy(*partition_by)
        before = self.current(name)
        w.save(self.location(name) if self.fmt == "parquet" and self.exists(name) else self.path(name))
        if self.current(name) != before:         # the rows went to a version that is no longer the table
            raise ConcurrentReplace(f"{name}: replaced by another writer during an append")


def folder_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The driver's test folder seen as a lake (``<dir>/<name>.parquet``)."""
    return Lake(spark, sf_dir, layout="{root}/{name}.parquet")


def stored_files(df: DataFrame) -> list[str]:
    """Names of the files below a frame, also of a table that is kept in memory (for
    which Spark's ``inputFiles`` has none)."""
    found = df.inputFiles()
    if found or not hasattr(df, "_jdf"):
        return sorted(found)
    leaves, files = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            files += list(leaf.relation().location().inputFiles())
    return sorted(files)


def _is_stored(df: DataFrame) -> bool:
    """Is the frame a stored table as it is, without filters or joins?"""
    if not hasattr(df, "_jdf"):
        return False
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() == "SubqueryAlias":
        plan = plan.child()
    return plan.getClass().getSimpleName() == "LogicalRelation"


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a stored parquet table, in the order of its files' names.

    The files' row counts (from their footers, in tasks; of the first files, then of
    more until ``n`` is reached) say how many rows each file gives; files that give
    none are not opened, and each task keeps its own share by the rows' numbers in
    their file.  So no task sees the others' rows, and the rows are the same on every
    read.  Other frames take Spark's ``limit``."""
    if not _is_stored(df):
        return df.limit(n)
    files = stored_files(df)
    try:
        df.select("_metadata.row_index")
    except AnalysisException:                    # not a table of parquet files
        return df.limit(n)
    share, left, at, size = {}, n, 0, 64
    while left > 0 and at < len(files):
        chunk = df.sparkSession.read.schema(df.schema).parquet(*files[at:at + size])
        counts = chunk.groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n")).collect()   # a row a file
        for path, rows in sorted(counts):
            if left > 0:
                share[path] = (min(rows, left), rows)
                left -= min(rows, left)
        at, size = at + size, size * 4
    name, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    whole = [p for p, (k, rows) in share.items() if k == rows]
    keep = name.isin(whole) if whole else F.lit(False)
    for path, (k, rows) in share.items():
        if k < rows:                             # the last file only
            keep = keep | ((name == path) & (row < k))
    return df.where(name.isin([*share]) & keep) if share else df.where(F.lit(False))
