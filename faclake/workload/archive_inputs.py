"""Archives made from Spark-written CSV parts: inputs of the registered archive query."""

from __future__ import annotations

import posixpath

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.archives import CHUNK, _fs_and_path


def pack_archives(files: DataFrame, dest: str) -> DataFrame:
    """Pack plain part files (``path`` column) into archives, one for each file,
    streamed by the task that holds it: zip, tar.gz and gz in turn by part number, so
    three parts or more always hold every kind."""

    def run(batches):
        import gzip
        import tarfile
        import zipfile
        dfs, droot = _fs_and_path(dest)
        dfs.create_dir(droot, recursive=True)
        for pdf in batches:
            rows = []
            for uri, kind_no in zip(pdf["path"], pdf["kind_no"]):
                fs, p = _fs_and_path(uri)
                base = posixpath.basename(p)
                kind = ("zip", "tar", "gz")[int(kind_no)]
                with fs.open_input_stream(p, compression=None) as f:
                    if kind == "zip":
                        target = posixpath.join(droot, f"{base}.zip")
                        with dfs.open_output_stream(target, compression=None) as out, \
                                zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, \
                                z.open(f"csv/{base}.csv", "w", force_zip64=True) as zf:
                            _stream(f, zf)
                    elif kind == "tar":
                        target = posixpath.join(droot, f"{base}.tar.gz")
                        info = tarfile.TarInfo(f"tar/{base}.csv")
                        info.size = fs.get_file_info(p).size
                        with dfs.open_output_stream(target, compression=None) as out, \
                                tarfile.open(fileobj=out, mode="w|gz") as t:
                            t.addfile(info, f)
                    else:
                        target = posixpath.join(droot, f"{base}.csv.gz")
                        with dfs.open_output_stream(target, compression=None) as out, \
                                gzip.GzipFile(fileobj=out, mode="wb") as g:
                            _stream(f, g)
                rows.append((uri, target, kind))
            yield pd.DataFrame(rows, columns=["source", "archive", "kind"])

    part = F.regexp_extract("path", r"part-([0-9]+)", 1).cast("int")
    chosen = files.withColumn("kind_no", F.pmod(part, F.lit(3)))
    return chosen.mapInPandas(run, "source string, archive string, kind string")


def _stream(src, dst) -> None:
    while True:
        buf = src.read(CHUNK)
        if not buf:
            break
        dst.write(buf)
