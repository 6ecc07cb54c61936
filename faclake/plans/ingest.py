"""Ingest run (S1, S6, K1, K2, D1, D3, D4): landing CSVs -> typed lake tables.

Per file: resolve its schema document, build the StructType, scan the CSV
under it, compare with the stored table's schema, overwrite (data and schema
together), store the schema document next to it, and check row parity.  Files
are independent, so they are submitted to Spark concurrently from a small
thread pool; each one is its own set of distributed jobs.
"""

from __future__ import annotations

import os
import re
from concurrent.futures import ThreadPoolExecutor
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import file_stem_py
from ..operators import quality as Q
from ..operators import schema as S
from ..sources.csv import CORRUPT, differing, headers, scan_csv
from ..sources.tables import SCHEMA_PART, Lake


def resolve(csv_name: str, mapping: Mapping[str, str]) -> str | None:
    """``<stem>.csv`` -> schema document; None when unmapped."""
    doc = mapping.get(f"{file_stem_py(csv_name)}.csv")
    if not doc or "missing" in doc:
        return None
    return doc


def header_problems(spark: SparkSession, files: Mapping[str, StructType], sep: str = ",",
                    encoding: str | None = None, recursive: bool = False, **_) -> dict[str, int]:
    """For each CSV file (or folder of parts), the number of positions where a
    header differs from the declared schema, the worst of its parts; -1 if a header
    cannot be read.  One job for all files of a run: heads are read in tasks, and one
    row a file comes back."""
    if not files:
        return {}
    declared = spark.createDataFrame([(_plain_path(f), [x.name for x in t.fields]) for f, t in files.items()],
                                     "file string, declared array<string>")
    # a part belongs to the file itself or to a folder above it
    steps = F.split(F.regexp_replace("path", "^file:/+", "/"), "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))
    found = headers(spark, sorted(files), sep, encoding, recursive).select("names", F.explode(above).alias("file"))
    per_file = found.join(declared, "file").groupBy("file").agg(
        F.max(F.when(F.col("names").isNotNull(), differing(F.col("names"), F.col("declared")))).alias("drift"),
        F.max(F.col("names").isNull()).alias("unread"))
    counts = {r["file"]: -1 if r["unread"] else r["drift"] for r in per_file.collect()}
    return {f: counts.get(_plain_path(f), 0) for f in files}


def _plain_path(uri: str) -> str:
    """A path without the empty authority that some listings write."""
    return re.sub("^file:/+", "/", uri).rstrip("/")


def ingest_file(spark: SparkSession, lake: Lake, csv_path: str, mapping: Mapping[str, str],
                registry: DataFrame, check_header: bool = True, count_malformed: bool = True,
                known: Mapping[str, StructType] | None = None, drift: int | None = None,
                store_schema: bool = True, **scan_opts) -> Q.RunRecord:
    """Ingest one CSV file (or folder of parts) into the lake.

    Besides parity, the report carries ``header_drift`` (header names that
    differ from the declared schema -- binding is by position, so a moved
    column is misbound, not rejected) and ``malformed_rows`` (rows PERMISSIVE
    parsing turned into NULLs), both without a second pass over the data.

    A landing run passes what it has found for all files at once: the declared
    schemas (``known``) and this file's ``drift``, and stores the schema documents
    itself.  A file then takes two jobs: scan and write, and the stored count.
    """
    name = os.path.basename(csv_path.rstrip("/"))
    table = file_stem_py(name)
    doc = resolve(name, mapping)
    if not name.lower().endswith((".csv", ".csv.gz")):
        return Q.RunRecord(name, table, "skipped", message="not a CSV file")
    if doc is None:
        # Reported, never deleted.
        return Q.RunRecord(name, table, "unmapped", message="no schema mapping")
    try:
        schema = known[doc] if known and doc in known else S.struct_for(registry, doc)
        if check_header and drift is None:
            drift = header_problems(spark, {csv_path: schema}, **scan_opts)[csv_path]
        if drift is not None and drift < 0:
            raise ValueError("the header cannot be read")
        changed = None
        if lake.exists(table):
            changed = S.schemas_differ(lake.read(table).schema, schema)
        malformed = None
        with lake.replace(table) as new:
            if count_malformed:
                df = scan_csv(spark, csv_path, schema, keep_corrupt=True, **scan_opts)
                written, malformed = Q.observed_write_with_malformed(df, CORRUPT, new.write)
            else:
                df = scan_csv(spark, csv_path, schema, **scan_opts)
                written = Q.observed_write(df, new.write)
            stored = new.read().count()
            if not Q.row_parity(written, stored):
                raise ValueError(f"row count mismatch: {written} read, {stored} stored")
        if store_schema:
            store_schemas(lake, {table: doc}, registry)
        return Q.RunRecord(name, table, "ingested", written, stored, changed, None, malformed, drift)
    except Exception as e:  # noqa: BLE001 -- a bad file must not stop the run
        return Q.RunRecord(name, table, "failed", message=f"{type(e).__name__}: {e}")


def store_schemas(lake: Lake, docs: Mapping[str, str], registry: DataFrame) -> None:
    """The schema documents of the given tables, stored next to them: one job, which
    replaces only these tables' folders."""
    if not docs:
        return
    pairs = lake.spark.createDataFrame(sorted(docs.items()), f"{SCHEMA_PART} string, schema_file string")
    # a document's rows lie in one file
    (registry.join(pairs, "schema_file").repartition(SCHEMA_PART)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SCHEMA_PART)
     .parquet(lake.schema_path("").rsplit("/", 1)[0]))


def list_landing(spark: SparkSession, landing_dir: str) -> list[str]:
    """Every data file below the landing folder, whatever its name.  A folder of
    part files (``part.csv/part-00000...``) is one data file, named by the folder.
    Uses the binaryFile source for the listing only -- the ``content`` column is never
    selected, so no file is read; the list of names (not data) comes to the
    driver.  A ``.gz`` file is read by one task, so large ones are better
    landed as parts, or expanded first."""
    path = F.col("path")
    folder, name = F.regexp_extract(path, "^(.*)/[^/]*$", 1), F.regexp_extract(path, "([^/]*)$", 1)
    of_parts = name.startswith("part-") & F.regexp_extract(folder, "([^/]*)$", 1).contains(".")
    rows = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing_dir)
            .select(F.when(of_parts, folder).otherwise(path).alias("path")).distinct().collect())
    return sorted(r.path for r in rows)


def ingest_landing(spark: SparkSession, lake: Lake, landing_dir: str, mapping: Mapping[str, str],
                   registry: DataFrame, parallel: int = 4, check_header: bool = True, **scan_opts) -> DataFrame:
    """Ingest every CSV of a landing folder; returns the run report, a row for
    each file.  Files of one stem would replace each other's table: none of them
    is ingested, each is reported as a ``clash``.  Other files are ``skipped``."""
    paths = list_landing(spark, landing_dir)
    tables: dict[str, list[str]] = {}
    for p in paths:
        if p.lower().endswith((".csv", ".csv.gz")):
            tables.setdefault(file_stem_py(os.path.basename(p)), []).append(p)

    def one(path: str) -> Q.RunRecord:
        name = os.path.basename(path)
        table = file_stem_py(name)
        same = tables.get(table, [])
        if path in same and len(same) > 1:
            return Q.RunRecord(name, table, "clash", message=f"{len(same)} files for one table")
        return ingest_file(spark, lake, path, mapping, registry, check_header, known=known, drift=drift.get(path),
                           store_schema=False, **scan_opts)

    registry = registry.cache()
    try:
        alone = [p for same in tables.values() if len(same) == 1 for p in same]
        docs = {p: d for p in alone if (d := resolve(os.path.basename(p), mapping))}
        known = S.structs_for(registry, set(docs.values()))
        drift = header_problems(spark, {p: known[d] for p, d in docs.items() if d in known}, **scan_opts) if check_header else {}
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            records = list(pool.map(one, paths))
        ingested = {r.target: docs[p] for p, r in zip(paths, records) if r.status == "ingested"}
        store_schemas(lake, ingested, registry)
    finally:
        registry.unpersist()
    return Q.report(spark, records)
