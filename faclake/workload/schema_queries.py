"""Registered queries for schema governance.

The registry is derived from ``part`` rows, one schema-document column per
part, 64 columns per document (``P<block>``): column names come from the part
type (``_id`` added for every fifth size), source types cycle through the
names the data dictionaries use.  So the registry grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import split_notes, text_fixups
from ..operators import schema as S
from ..session import scratch_path
from . import adapters as A
from .catalog import register

BLOCK = 64
_NAME = ("lower(replace(p_type, ' ', '_')) || CASE WHEN p_size % 5 = 0 THEN '_id' ELSE '' END "
         "|| '_' || CAST(p_partkey AS STRING)")
_SRC_TYPE = ("CASE p_size % 6 WHEN 0 THEN 'num' WHEN 1 THEN 'number' WHEN 2 THEN 'char' "
             "WHEN 3 THEN 'varchar2' WHEN 4 THEN 'date' ELSE 'bigint' END")
_BLK = f"CAST(floor(p_partkey / {BLOCK}) AS BIGINT)"
_SOURCE_COLS = [f"'P' || CAST({_BLK} AS STRING) AS table_name",
                f"CAST(p_partkey % {BLOCK} AS INT) AS position",
                f"{_NAME} AS COLUMN_NAME", f"{_SRC_TYPE} AS ORIGINAL_DATA_TYPE"]
SOURCE_SQL = f"SELECT {', '.join(_SOURCE_COLS)} FROM part"
LAST_MODIFIED = "Mon, 01 Jan 2024 00:00:00 "

_MAP_SQL = ("CASE WHEN COLUMN_NAME LIKE '%id%' AND ORIGINAL_DATA_TYPE IN ('num', 'number') THEN '{l}' "
            "WHEN ORIGINAL_DATA_TYPE IN ('num', 'number') THEN '{d}' ELSE '{s}' END")
SPARK_T = _MAP_SQL.format(l="LongType()", d="DoubleType()", s="StringType()")
PANDAS_T = _MAP_SQL.format(l="int64", d="float64", s="str")
REGISTRY_SQL = (f"SELECT table_name || '_schema.json' AS schema_file, table_name, position, COLUMN_NAME, "
                f"ORIGINAL_DATA_TYPE, {SPARK_T} AS SPARK_DATA_TYPE, {PANDAS_T} AS PANDAS_DATA_TYPE, "
                f"'{LAST_MODIFIED}' AS last_modified FROM ({SOURCE_SQL})")


def source_rows(spark, sf_dir):
    return A.read(spark, sf_dir, "part").selectExpr(*_SOURCE_COLS)


def registry(spark, sf_dir):
    mapped = S.apply_type_mapping(source_rows(spark, sf_dir)).drop("supported_type")
    return mapped.select(F.concat("table_name", F.lit("_schema.json")).alias("schema_file"),
                         "table_name", "position", "COLUMN_NAME", "ORIGINAL_DATA_TYPE",
                         "SPARK_DATA_TYPE", "PANDAS_DATA_TYPE",
                         F.lit(LAST_MODIFIED).alias("last_modified"))


@register("type_mapping", f"SELECT *, {SPARK_T} AS SPARK_DATA_TYPE, {PANDAS_T} AS PANDAS_DATA_TYPE, "
          "ORIGINAL_DATA_TYPE IN ('num', 'number', 'char', 'varchar', 'varchar2', 'date') AS supported_type "
          f"FROM ({SOURCE_SQL})")
def _type_mapping(spark, sf_dir):
    return S.apply_type_mapping(source_rows(spark, sf_dir))


@register("schema_registry_build", REGISTRY_SQL)
def _registry_build(spark, sf_dir):
    path = scratch_path(spark, "schema-docs")
    S.write_schema_docs(registry(spark, sf_dir), path)
    return S.read_written_docs(spark, path).select(*S.REGISTRY_COLUMNS)


@register("schema_registry_scan", REGISTRY_SQL)
def _registry_scan(spark, sf_dir):
    # documents named as the survey's are: one file each, read by their file names
    root = scratch_path(spark, "schema-docs")
    S.write_schema_docs(registry(spark, sf_dir), f"{root}/docs")
    return S.scan_schema_docs(spark, f"{root}/docs/*_schema.json").select(*S.REGISTRY_COLUMNS)


_DDL_T = ("CASE SPARK_DATA_TYPE WHEN 'LongType()' THEN 'bigint' WHEN 'DoubleType()' THEN 'double' "
          "ELSE 'string' END")


@register("struct_from_registry",
          f"SELECT schema_file, count(*) AS n_columns, string_agg(upper(COLUMN_NAME) || ' ' || {_DDL_T}, ', ' "
          f"ORDER BY position) AS ddl FROM ({REGISTRY_SQL}) GROUP BY schema_file")
def _struct(spark, sf_dir):
    return S.struct_ddl(registry(spark, sf_dir))


_NEW_SQL = (f"SELECT table_name, CASE WHEN p_size % 17 = 0 THEN position + 1000 ELSE position END AS position, "
            f"CASE WHEN p_size % 11 = 0 THEN COLUMN_NAME || '_v2' ELSE COLUMN_NAME END AS COLUMN_NAME, "
            f"CASE WHEN p_size % 13 = 0 THEN 'StringType()' ELSE SPARK_DATA_TYPE END AS SPARK_DATA_TYPE "
            f"FROM (SELECT p_size, r.* FROM part JOIN ({REGISTRY_SQL}) r "
            f"ON r.table_name = 'P' || CAST({_BLK} AS STRING) AND r.position = p_partkey % {BLOCK}) "
            f"WHERE p_size % 7 <> 0")


@register("schema_diff",
          "SELECT table_name, position, o.COLUMN_NAME AS old_name, o.SPARK_DATA_TYPE AS old_type, "
          "n.COLUMN_NAME AS new_name, n.SPARK_DATA_TYPE AS new_type, "
          "CASE WHEN o.COLUMN_NAME IS NULL AND o.SPARK_DATA_TYPE IS NULL THEN 'added' "
          "WHEN n.COLUMN_NAME IS NULL AND n.SPARK_DATA_TYPE IS NULL THEN 'removed' "
          "WHEN o.COLUMN_NAME IS DISTINCT FROM n.COLUMN_NAME AND o.SPARK_DATA_TYPE IS DISTINCT FROM n.SPARK_DATA_TYPE THEN 'renamed_retyped' "
          "WHEN o.COLUMN_NAME IS DISTINCT FROM n.COLUMN_NAME THEN 'renamed' "
          "WHEN o.SPARK_DATA_TYPE IS DISTINCT FROM n.SPARK_DATA_TYPE THEN 'retyped' ELSE 'same' END AS change "
          f"FROM ({REGISTRY_SQL}) o FULL OUTER JOIN ({_NEW_SQL}) n USING (table_name, position)")
def _schema_diff(spark, sf_dir):
    part = A.read(spark, sf_dir, "part").select(
        "p_size", F.concat(F.lit("P"), F.floor(F.col("p_partkey") / BLOCK).cast("string")).alias("table_name"),
        (F.col("p_partkey") % BLOCK).cast("int").alias("position"))
    old = registry(spark, sf_dir)
    new = (old.join(part, ["table_name", "position"]).where(F.col("p_size") % 7 != 0)
           .select("table_name",
                   F.when(F.col("p_size") % 17 == 0, F.col("position") + 1000)
                   .otherwise(F.col("position")).alias("position"),
                   F.when(F.col("p_size") % 11 == 0, F.concat("COLUMN_NAME", F.lit("_v2")))
                   .otherwise(F.col("COLUMN_NAME")).alias("COLUMN_NAME"),
                   F.when(F.col("p_size") % 13 == 0, F.lit("StringType()"))
                   .otherwise(F.col("SPARK_DATA_TYPE")).alias("SPARK_DATA_TYPE")))
    return S.schema_diff(old, new)


_FILES_SQL = (f"SELECT DISTINCT {_BLK} AS blk FROM part")
_FILE_NAME = "CASE WHEN blk % 3 = 0 THEN 'P' || CAST(blk AS STRING) || '.2024.csv' ELSE 'P' || CAST(blk AS STRING) || '.csv' END"


@register("schema_resolve",
          f"SELECT {_FILE_NAME} AS file_name, 'P' || CAST(blk AS STRING) AS table_name, "
          "'P' || CAST(blk AS STRING) || '.csv' AS csv_file, "
          "CASE WHEN blk % 7 = 0 THEN 'P' || CAST(blk AS STRING) || '_missing.json' "
          "WHEN blk % 5 <> 0 THEN 'P' || CAST(blk AS STRING) || '_schema.json' END AS schema_file, "
          "CASE WHEN blk % 7 <> 0 AND blk % 5 <> 0 THEN 'mapped' ELSE 'unmapped' END AS status "
          f"FROM ({_FILES_SQL})")
def _resolve(spark, sf_dir):
    blk = A.read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / BLOCK).alias("blk")).distinct()
    name = F.concat(F.lit("P"), F.col("blk").cast("string"))
    files = blk.select(F.when(F.col("blk") % 3 == 0, F.concat(name, F.lit(".2024.csv")))
                       .otherwise(F.concat(name, F.lit(".csv"))).alias("file_name"))
    mapping = blk.select(
        F.concat(name, F.lit(".csv")).alias("csv_file"),
        F.when(F.col("blk") % 7 == 0, F.concat(name, F.lit("_missing.json")))
        .when(F.col("blk") % 5 != 0, F.concat(name, F.lit("_schema.json"))).alias("schema_file"))
    return S.resolve_schemas(files, mapping.where(F.col("schema_file").isNotNull()))


@register("manual_schema_exclude",
          f"SELECT 'P' || CAST(blk AS STRING) AS name FROM ({_FILES_SQL}) WHERE blk % 3 <> 0")
def _manual(spark, sf_dir):
    blk = A.read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / BLOCK).alias("blk")).distinct()
    name = F.concat(F.lit("P"), F.col("blk").cast("string"))
    derived = blk.select(name.alias("name"))
    manual = blk.where(F.col("blk") % 3 == 0).select(F.concat(name, F.lit(".csv")).alias("name"))
    return S.exclude_manual(derived, manual)


@register("schema_describe",
          "SELECT table_name, count(*) AS n_columns, to_json(struct_pack(last_modified := max(last_modified), "
          "schema := list(struct_pack(COLUMN_NAME := COLUMN_NAME, ORIGINAL_DATA_TYPE := ORIGINAL_DATA_TYPE, "
          "SPARK_DATA_TYPE := SPARK_DATA_TYPE, PANDAS_DATA_TYPE := PANDAS_DATA_TYPE) ORDER BY position)))::VARCHAR AS document "
          f"FROM ({REGISTRY_SQL}) GROUP BY table_name")
def _describe(spark, sf_dir):
    return S.describe_schema(registry(spark, sf_dir))


# Fixed example of a keyed fix-up list (ordered literal replacements).
FIXUPS = [("ring", "RING"), ("blue", "BLUE"), ("RING", "ring-x")]


@register("text_fixups",
          "SELECT p_partkey, replace(replace(replace(p_name, 'ring', 'RING'), 'blue', 'BLUE'), 'RING', 'ring-x') AS fixed FROM part")
def _fixups(spark, sf_dir):
    return A.read(spark, sf_dir, "part").select("p_partkey", text_fixups("p_name", FIXUPS).alias("fixed"))


_NOTES = ("CASE WHEN p_size % 9 = 0 THEN 'bad-note' ELSE 'FILE_' || CAST(p_partkey AS STRING) "
          "|| '.xlsx-Sheet' || CAST(p_size % 3 AS STRING) || '-' || CAST(p_size % 5 AS STRING) END")


@register("tracker_notes_split",
          "SELECT p_partkey, notes, "
          "CASE WHEN len(string_split(notes, '-')) = 3 THEN split_part(notes, '-', 1) END AS notes_file, "
          "CASE WHEN len(string_split(notes, '-')) = 3 THEN split_part(notes, '-', 2) END AS notes_sheet, "
          "CASE WHEN len(string_split(notes, '-')) = 3 THEN TRY_CAST(split_part(notes, '-', 3) AS INTEGER) END AS notes_skip, "
          "len(string_split(notes, '-')) = 3 AS notes_valid "
          f"FROM (SELECT p_partkey, {_NOTES} AS notes FROM part)")
def _notes(spark, sf_dir):
    df = A.read(spark, sf_dir, "part").selectExpr("p_partkey", f"{_NOTES} AS notes")
    n = split_notes("notes")
    return df.select("p_partkey", "notes", n["file"].alias("notes_file"), n["sheet"].alias("notes_sheet"),
                     n["skip_rows"].alias("notes_skip"), n["valid"].alias("notes_valid"))
