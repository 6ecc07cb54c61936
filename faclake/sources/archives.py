"""Archive expansion (S7): .zip, .tar.gz/.tgz and .gz files -> plain files.

The archives are listed with the ``binaryFile`` source *without* reading their
content.  Each archive's work units are listed by its own task (zip members
come from the central directory; a tar.gz / gz stream is one unit), then each
unit is extracted by its own task (``mapInPandas``), streaming through
``pyarrow.fs`` into the destination folder in fixed-size chunks.  No archive
is ever held in memory or passed through the driver, and the expanded CSV
files are then read by the normal (splittable) CSV scan.

Kinds by name, in this order: ``.zip``; ``.tar.gz`` / ``.tgz``; ``.gz``
(one stream, output named without ``.gz``).  A corrupt archive is reported as
``corrupt`` and skipped; members with absolute or ``..`` paths are refused.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_DDL = "archive string, kind string, member string, target string, bytes long, status string, message string"
CHUNK = 8 * 1024 * 1024
TASK_BYTES = 128 * 1024 * 1024
STAGING = "_staging-"          # folder of the members whose names are not judged yet


def archive_kind(name: str) -> str | None:
    low = name.lower()
    if low.endswith(".zip"):
        return "zip"
    if low.endswith(".tar.gz") or low.endswith(".tgz"):
        return "tar"
    if low.endswith(".gz"):
        return "gz"
    return None


def _fs_and_path(uri: str):
    """pyarrow file system and path of a Hadoop path (``file:/x y``, ``s3a://b/x``)."""
    from pyarrow import fs as pafs
    if uri.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:/"):].lstrip("/")
    for hadoop_scheme in ("s3a://", "s3n://"):      # Hadoop connector names
        if uri.startswith(hadoop_scheme):
            uri = "s3://" + uri[len(hadoop_scheme):]
    return pafs.FileSystem.from_uri(uri)


def _join(dest_uri: str, member: str) -> str:
    return dest_uri.rstrip("/") + "/" + member


def _safe(member: str) -> bool:
    norm = posixpath.normpath(member)
    return not (member.startswith("/") or norm.startswith("..") or "/../" in f"/{norm}/")


def _copy(src, fs, target_path: str, size: int | None = None) -> int:
    """Stream ``src`` to a hidden file of this attempt, and move it into place when
    it is complete: a corrupt archive, a retry or a speculative task never leaves
    part of a file under its final name."""
    parent, base = posixpath.split(target_path)
    if parent:
        fs.create_dir(parent, recursive=True)
    hidden, n = posixpath.join(parent, f".{base}.{uuid.uuid4().hex}"), 0
    try:
        with fs.open_output_stream(hidden, compression=None) as out:
            while buf := src.read(CHUNK):
                out.write(buf)
                n += len(buf)
        if size is not None and n != size:
            raise ValueError(f"{n} bytes instead of {size}")
    except BaseException:
        fs.delete_file(hidden)
        raise
    fs.move(hidden, target_path)
    return n


def _exists(fs, path: str) -> bool:
    from pyarrow import fs as pafs
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _expand_one(archive_uri: str, dest_uri: str, skip_existing: bool, staging: str) -> list[tuple]:
    import gzip
    import tarfile
    import zipfile

    src_fs, src_path = _fs_and_path(archive_uri)
    dst_fs, dst_root = _fs_and_path(dest_uri)
    name = posixpath.basename(src_path)
    kind = archive_kind(name)
    rows: list[tuple] = []
    if kind is None:
        return [(archive_uri, None, None, None, None, "unsupported", None)]

    def target_of(member):
        return posixpath.join(dst_root, member)

    try:
        if kind == "zip":
            with src_fs.open_input_file(src_path) as f, zipfile.ZipFile(f) as z:
                for info in z.infolist():
                    if info.is_dir():
                        continue
                    m = info.filename
                    if not _safe(m):
                        rows.append((archive_uri, kind, m, None, None, "refused", "unsafe path"))
                        continue
                    t = target_of(m)
                    if skip_existing and _exists(dst_fs, t):
                        rows.append((archive_uri, kind, m, _join(dest_uri, m), None, "exists", None))
                        continue
                    with z.open(info) as member:
                        n = _copy(member, dst_fs, t, info.file_size)
                    rows.append((archive_uri, kind, m, _join(dest_uri, m), n, "extracted", None))
        elif kind == "tar":
            staged = posixpath.join(dst_root, staging, hashlib.sha256(archive_uri.encode()).hexdigest()[:32])
            with src_fs.open_input_stream(src_path, compression=None) as f, tarfile.open(fileobj=f, mode="r|gz") as tar:
                for info in tar:
                    if not info.isfile():
                        continue
                    m = info.name
                    if not _safe(m):
                        rows.append((archive_uri, kind, m, None, None, "refused", "unsafe path"))
                        continue
                    if skip_existing and _exists(dst_fs, target_of(m)):
                        rows.append((archive_uri, kind, m, _join(dest_uri, m), None, "exists", None))
                        continue
                    n = _copy(tar.extractfile(info), dst_fs, posixpath.join(staged, posixpath.normpath(m)), info.size)
                    rows.append((archive_uri, kind, m, _join(dest_uri, m), n, "staged", None))
        else:
            m = name[: -len(".gz")]
            t = target_of(m)
            if skip_existing and _exists(dst_fs, t):
                return [(archive_uri, kind, m, _join(dest_uri, m), None, "exists", None)]
            with src_fs.open_input_stream(src_path, compression=None) as f, gzip.GzipFile(fileobj=f) as g:
                n = _copy(g, dst_fs, t)
            rows.append((archive_uri, kind, m, _join(dest_uri, m), n, "extracted", None))
    except (zipfile.BadZipFile, tarfile.TarError, gzip.BadGzipFile, EOFError, OSError, ValueError, zlib.error) as e:
        rows.append((archive_uri, kind, None, None, None, "corrupt", f"{type(e).__name__}: {e}"))
    return rows


def list_archives(spark: SparkSession, src: str, pattern: str | None = None) -> DataFrame:
    """Archive files under ``src`` (path, length); contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r.load(src).select("path", "length")


UNITS_DDL = "archive string, member string, target string, bytes long"


def _units(archive_uri: str, length: int) -> list[tuple]:
    """Work units of one archive: one per zip member (read from the central
    directory only); a whole tar.gz / gz stream, or an unreadable zip, is one
    unit (member NULL)."""
    import zipfile
    kind, name = archive_kind(archive_uri), posixpath.basename(archive_uri)
    if kind != "zip":
        return [(archive_uri, None, name[:-3] if kind == "gz" else None, length)]
    fs, path = _fs_and_path(archive_uri)
    try:
        with fs.open_input_file(path) as f, zipfile.ZipFile(f) as z:
            members = [(i.filename, i.file_size) for i in z.infolist() if not i.is_dir()]
    except (zipfile.BadZipFile, OSError, ValueError, EOFError):
        return [(archive_uri, None, None, length)]
    return [(archive_uri, m, posixpath.normpath(m), n) for m, n in members] or [(archive_uri, None, None, length)]


def _expand_member(archive_uri: str, member: str, dest_uri: str, skip_existing: bool) -> tuple:
    import zipfile
    kind = "zip"
    if not _safe(member):
        return (archive_uri, kind, member, None, None, "refused", "unsafe path")
    src_fs, src_path = _fs_and_path(archive_uri)
    dst_fs, dst_root = _fs_and_path(dest_uri)
    t = posixpath.join(dst_root, member)
    if skip_existing and _exists(dst_fs, t):
        return (archive_uri, kind, member, _join(dest_uri, member), None, "exists", None)
    try:
        with src_fs.open_input_file(src_path) as f, zipfile.ZipFile(f) as z, z.open(member) as m:
            n = _copy(m, dst_fs, t, z.getinfo(member).file_size)
    except (zipfile.BadZipFile, EOFError, OSError, ValueError, zlib.error) as e:
        return (archive_uri, kind, member, None, None, "corrupt", f"{type(e).__name__}: {e}")
    return (archive_uri, kind, member, _join(dest_uri, member), n, "extracted", None)


def expand_archives(spark: SparkSession, src: str, dest: str, skip_existing: bool = False,
                    pattern: str | None = None) -> DataFrame:
    """Expand every archive under ``src`` into ``dest``; returns the report
    (one row per member, or one row per unsupported/corrupt archive).

    Two stages: each archive lists its work units (zip members from the central
    directory; a tar.gz / gz stream is one unit because it can only be read front
    to back); the units are then extracted, a task for about ``TASK_BYTES`` of
    them.  A zip holding several large files is expanded by several tasks at
    once, a million small members are not a million tasks.  Members that would share
    a name are not extracted but reported as ``clash``, whatever their archives: the
    names inside a tar.gz are only known while it is read, so its members are
    written below a staging folder of their archive, and moved to their names when
    the names of all archives are known.
    """
    from ..session import scratch_path, ship_package
    ship_package(spark)
    listing = list_archives(spark, src, pattern)
    cols = [c.split(" ")[0] for c in REPORT_DDL.split(", ")]

    def list_units(batches):
        for pdf in batches:
            rows = [u for uri, n in zip(pdf["path"], pdf["length"]) for u in _units(uri, n)]
            yield pd.DataFrame(rows, columns=["archive", "member", "target", "bytes"])

    found = listing.agg(F.count(F.lit(1)).alias("n")).first().n
    if not found:
        return spark.createDataFrame([], REPORT_DDL)
    path = scratch_path(spark, "archive-units")
    (listing.repartitionByRange(max(1, min(found, 1000)), "path").mapInPandas(list_units, UNITS_DDL)
     .write.parquet(path))
    units = spark.read.parquet(path)
    total = units.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).first()
    tasks = max(1, min(total.n, max(64, int(total.b or 0) // TASK_BYTES + 1)))

    staging = f"{STAGING}{uuid.uuid4().hex}"

    def stage(batches):
        for pdf in batches:
            yield pd.DataFrame([r for uri in pdf["archive"] for r in _expand_one(uri, dest, skip_existing, staging)], columns=cols)

    # streams first, so that all targets are known; what they hold is not yet in place
    is_tar = F.lower("archive").rlike(r"\.(tar\.gz|tgz)$")
    tar_path = scratch_path(spark, "archive-streams")
    (units.where(is_tar).select("archive").repartitionByRange(tasks, "archive").mapInPandas(stage, REPORT_DDL)
     .write.parquet(tar_path))
    streams = spark.read.schema(REPORT_DDL).parquet(tar_path)
    kept = ["archive", "kind", "member", "target", "bytes", "status", "message"]
    todo = units.where(~is_tar).select("archive", F.lit(None).cast("string").alias("kind"), "member", "target", "bytes",
                                       F.lit("unit").alias("status"), F.lit(None).cast("string").alias("message"))
    staged = streams.where("status = 'staged'").select(*kept)
    name = F.when(F.col("status") == "unit", F.col("target")).otherwise(F.col("member"))
    judged = todo.unionByName(staged).withColumn("name", _normal(name))
    same = judged.where("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("same")).where("same > 1")
    judged = judged.join(same, "name", "left").select(*kept, F.coalesce("same", F.lit(1)).alias("same"))

    def finish(batches):
        for pdf in batches:
            out = []
            for row in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False):
                uri, whole = row.archive, row.member is None
                if row.status == "staged":
                    out.append(_publish(tuple(row)[:7], dest, staging, int(row.same)))
                elif row.same > 1:
                    out.append((uri, archive_kind(uri), row.member, None, None, "clash", f"{row.same} members of one name"))
                elif whole:
                    out.extend(_expand_one(uri, dest, skip_existing, staging))
                else:
                    out.append(_expand_member(uri, row.member, dest, skip_existing))
            yield pd.DataFrame(out, columns=cols)

    done = judged.repartitionByRange(tasks, "archive", "member").mapInPandas(finish, REPORT_DDL)
    report = scratch_path(spark, "archive-report")
    done.unionByName(streams.where("status <> 'staged'").select(*cols)).write.parquet(report)
    fs, root = _fs_and_path(dest)
    if _exists(fs, posixpath.join(root, staging)):
        fs.delete_dir(posixpath.join(root, staging))
    return spark.read.schema(REPORT_DDL).parquet(report)


def _normal(c):
    """A member's name as a path: no ``./`` and no doubled slashes."""
    return F.regexp_replace(F.regexp_replace(c, r"/(?:\./|/)+", "/"), r"^(?:\./)+", "")


def _publish(row: tuple, dest: str, staging: str, same: int) -> tuple:
    """Move a staged member to its name, or remove it if the name is claimed by more
    than one archive.  Repeating this changes nothing."""
    uri, kind, member, target, n, _, message = row
    fs, root = _fs_and_path(dest)
    held = posixpath.join(root, staging, hashlib.sha256(uri.encode()).hexdigest()[:32], posixpath.normpath(member))
    if same > 1:
        if _exists(fs, held):
            fs.delete_file(held)
        return (uri, kind, member, None, None, "clash", f"{same} members of one name")
    place = posixpath.join(root, member)
    if _exists(fs, held):
        fs.create_dir(posixpath.dirname(place), recursive=True)
        fs.move(held, place)
    elif not _exists(fs, place):
        return (uri, kind, member, None, None, "corrupt", "the staged member is gone")
    return (uri, kind, member, target, int(n), "extracted", message)
