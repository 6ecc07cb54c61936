"""Typed CSV scan (S1) and header drift check.

The declared schema binds columns **by position**; the header line is
skipped, never used for names.  Bad values become NULL (PERMISSIVE), a short
row is padded with NULLs and extra fields are dropped.  The scan is splittable
for plain files, so a large CSV is read by many tasks.
"""

from __future__ import annotations

import codecs
import csv
import io
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def scan_csv(spark: SparkSession, path: str | list[str], schema: StructType,
             rfc_quotes: bool = False, multiline: bool = False,
             keep_corrupt: bool = False, sep: str = ",",
             encoding: str | None = None, recursive: bool = False,
             boolean_tokens: tuple[tuple[str, ...], tuple[str, ...]] | None = None) -> DataFrame:
    """Read CSV files with a header under a declared schema.

    ``rfc_quotes`` makes a doubled quote inside a quoted field one quote
    (RFC 4180) instead of keeping it raw; ``multiline`` lets quoted fields
    hold line breaks (the file is then read by one task);
    ``keep_corrupt`` adds ``_corrupt_record`` with the raw line of any row
    that did not fit the schema.  By default a boolean column accepts only
    ``true``/``false``; ``boolean_tokens=((true tokens), (false tokens))``
    maps other spellings (case-insensitive, trimmed), anything else is NULL.
    """
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE")
              .option("sep", sep))
    if rfc_quotes:
        reader = reader.option("escape", '"')
    if multiline:
        reader = reader.option("multiLine", True)
    if encoding:
        reader = reader.option("encoding", encoding)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if keep_corrupt:
        schema = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if not boolean_tokens:
        return reader.schema(schema).csv(path)
    bools = [f.name for f in schema.fields if isinstance(f.dataType, BooleanType)]
    read_schema = StructType([StructField(f.name, StringType(), True) if f.name in bools else f
                              for f in schema.fields])
    yes, no = ([t.lower() for t in group] for group in boolean_tokens)
    df = reader.schema(read_schema).csv(path)
    return df.withColumns({
        b: F.when(F.lower(F.trim(b)).isin(*yes), F.lit(True))
            .when(F.lower(F.trim(b)).isin(*no), F.lit(False)) for b in bools})


HEADER_DDL = "path string, names array<string>, problem string"
_HEAD_STEP = 1 << 16


def first_record(read, encoding: str | None = None, sep: str = ",", most: int = 1 << 20) -> list[str]:
    """The fields of the first CSV record of a byte stream (``read(n)`` gives up to n
    bytes).  Line breaks inside quotes belong to the record; only as much is read as
    the record needs, at most ``most`` bytes."""
    decoder = codecs.getincrementaldecoder(encoding or "utf-8")("replace")
    text, used = "", 0
    while True:
        data = read(_HEAD_STEP)
        used += len(data)
        text = (text + decoder.decode(data, not data)).removeprefix("\ufeff")
        quotes = 0
        for i, c in enumerate(text):
            quotes += c == '"'
            if quotes % 2 == 0 and (c == "\n" or (c == "\r" and (i + 1 < len(text) or not data))):
                return next(csv.reader(io.StringIO(text[:i], newline=""), delimiter=sep), [])
        if not data:
            if quotes % 2:
                raise ValueError("the header's quotes are not closed")
            return next(csv.reader(io.StringIO(text, newline=""), delimiter=sep), [])
        if used >= most:
            raise ValueError(f"the header has no end within {most} bytes")


def headers(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str | None = None,
            recursive: bool = False, at_once: int = 32, most: int = 1 << 20) -> DataFrame:
    """(path, names, problem) of every CSV file at ``path`` (files, folders, globs).

    The listing is Spark's (no content is read); tasks of about ``at_once`` files then
    read the head of each, gzip included, and stop at the end of its first record.
    A file whose header cannot be read has a ``problem`` and no names."""
    from ..session import ship_package
    ship_package(spark)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
              .load(path).select("path"))
    n = len(listed.inputFiles())

    def read(batches):
        import gzip

        from .archives import _fs_and_path
        for pdf in batches:
            out = []
            for uri in pdf["path"]:
                try:
                    fs, name = _fs_and_path(uri)
                    with fs.open_input_stream(name, compression=None) as raw:
                        stream = gzip.GzipFile(fileobj=raw) if name.lower().endswith(".gz") else raw
                        out.append((uri, first_record(stream.read, encoding, sep, most), None))
                except (OSError, EOFError, ValueError, zlib.error, csv.Error) as e:
                    out.append((uri, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "names", "problem"])

    return listed.repartition(max(1, -(-n // at_once))).mapInPandas(read, HEADER_DDL)


def differing(names: Column, declared: Column) -> Column:
    """Number of positions where a header and the declared names differ (any case,
    blanks around a name do not count)."""
    same = F.zip_with(names, declared, lambda a, b: F.upper(F.trim(a)).eqNullSafe(F.upper(b)))
    return F.size(F.filter(same, lambda x: ~x))


def header_drift(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",",
                 encoding: str | None = None, recursive: bool = False, **_) -> DataFrame:
    """Header names next to the declared names, by position, for every distinct
    header among the files at ``path``; takes the scan's options.

    Columns: position, header_name, declared_name, same (case-insensitive).
    """
    distinct = headers(spark, path, sep, encoding, recursive).where("names IS NOT NULL").select("names").distinct()
    declared = F.array(*[F.lit(f.name) for f in schema.fields]) if schema.fields else F.array().cast("array<string>")
    pairs = F.zip_with("names", declared, lambda a, b: F.struct(a.alias("header_name"), b.alias("declared_name")))
    return (distinct.select(F.posexplode(pairs).alias("position", "p"))
            .select("position", "p.header_name", "p.declared_name",
                    (F.col("p.header_name").isNotNull() & F.col("p.declared_name").isNotNull()
                     & F.upper(F.trim("p.header_name")).eqNullSafe(F.upper("p.declared_name"))).alias("same")))
