"""Sizes of stored parquet columns from the files' footers, read in tasks.

How large rows are in memory decides whether a side can be broadcast or a table
cached.  Sizes of files do not tell: a dictionary-encoded column of repeated long
texts is a few bits a row on disk.  Footers hold the number of values of each column
chunk, their encodings, uncompressed bytes, and smallest and largest value;
``memory_bytes`` adds up an estimate from them.  Where the files are in a store that
only Spark opens, the columns are scanned instead, and the result is exact.
"""

from __future__ import annotations

from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archives import _fs_and_path
from .tables import stored_files

FOOTER_DDL = "path string, column string, rows long, memory long"
_WORD = 8                       # a row holds a word for each column, and texts in whole words
_LONG = 4096                    # bytes of smallest and largest value beyond which a footer has neither


def _chunk_bytes(chunk) -> int:
    """Bytes that a column chunk's values take in rows.  Texts stored by dictionary or as
    differences count as wide as the wider of the smallest and the largest value."""
    n = chunk.num_values
    if chunk.physical_type != "BYTE_ARRAY":
        return n * 2 * _WORD if chunk.physical_type in ("INT96", "FIXED_LEN_BYTE_ARRAY") else n * _WORD
    stats = chunk.statistics
    present = n - (stats.null_count or 0) if stats is not None and stats.null_count is not None else n
    text = chunk.total_uncompressed_size               # plain values: their bytes and a length each
    delta = any("DELTA" in e for e in chunk.encodings)
    if delta or any("DICTIONARY" in e for e in chunk.encodings):
        # each value is stored once, or what differs from the one before: rows x the wider
        # of smallest and largest value (bounds are left out when they are long)
        wide = _LONG if delta else 0
        if stats is not None and stats.has_min_max:
            wide = max(len(v if isinstance(v, bytes) else str(v).encode()) for v in (stats.min, stats.max))
        text = max(text, present * wide)
    return n * _WORD + text + present * _WORD // 2


def footers(spark: SparkSession, files: list[str], at_once: int = 64) -> DataFrame:
    """(path, column, rows, memory) of every column of every file; a task reads the
    footers of about ``at_once`` files."""
    from ..session import ship_package
    ship_package(spark)

    def read(batches):
        import pyarrow.parquet as pq
        for pdf in batches:
            out = []
            for uri in pdf["path"]:
                # Spark's file lists are escaped, local paths are not
                fs, path = _fs_and_path(unquote(uri) if uri.startswith("file:") else uri)
                with fs.open_input_file(path) as f:
                    meta = pq.ParquetFile(f).metadata
                sums: dict[str, int] = {}
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        name = chunk.path_in_schema.split(".")[0]
                        sums[name] = sums.get(name, 0) + _chunk_bytes(chunk)
                out += [(uri, name, meta.num_rows, size) for name, size in sums.items()]
            yield pd.DataFrame(out, columns=["path", "column", "rows", "memory"])

    listed = spark.createDataFrame([(f,) for f in files], "path string")
    return listed.repartition(max(1, -(-len(files) // at_once))).mapInPandas(read, FOOTER_DDL)


def scanned(df: DataFrame, columns: list[str], by: str | None) -> DataFrame:
    """(part, column, memory) from the values themselves, in one pass."""
    width = {c: F.lit(_WORD) + (F.coalesce(F.octet_length(c), F.lit(0)) if t in ("string", "binary") else F.lit(0))
             for c, t in df.select(*columns).dtypes}
    part = F.col(by).cast("string") if by else F.lit("")
    sums = df.groupBy(part.alias("part")).agg(*[F.sum(w.cast("long")).alias(f"m{i}") for i, w in enumerate(width.values())])
    return sums.select("part", F.explode(F.create_map(*[x for i, c in enumerate(width) for x in (F.lit(c), F.col(f"m{i}"))]))
                       .alias("column", "memory"))


def memory_by_column(df: DataFrame, by_partition: str | None = None, columns: list[str] | None = None) -> dict[str, dict[str, int]] | None:
    """Bytes that each column of a stored parquet table takes as rows in memory, by the
    value of a partition column (all under "" without one).  None if the frame is not
    made of parquet files."""
    files = stored_files(df)
    if not files or not all(f.split("?")[0].endswith(".parquet") for f in files):
        return None
    columns = [c for c in (df.columns if columns is None else columns) if c != by_partition]
    try:
        _fs_and_path(files[0])
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        sizes = scanned(df, columns, by_partition)
    else:
        part = F.regexp_extract("path", rf"/{by_partition}=([^/]+)/", 1) if by_partition else F.lit("")
        sizes = footers(df.sparkSession, files).where(F.col("column").isin(columns)).withColumn("part", part)
    out: dict[str, dict[str, int]] = {}
    for r in sizes.groupBy("part", "column").agg(F.sum("memory")).collect():          # partitions x columns numbers
        out.setdefault(r[0], {})[r[1]] = int(r[2] or 0)
    return out


def memory_bytes(df: DataFrame, columns: list[str] | None = None) -> int | None:
    """Bytes that the ``columns`` (default: all) of a stored parquet table take as rows
    in memory; None if the frame is not made of parquet files."""
    found = memory_by_column(df, None, columns)
    return None if found is None else sum(found.get("", {}).values())
