"""Schema governance: schema documents as a registry DataFrame.

A schema document is ``{last_modified, schema: [{COLUMN_NAME,
ORIGINAL_DATA_TYPE, SPARK_DATA_TYPE, PANDAS_DATA_TYPE}, ...]}``, one per file.
Flattened, the *registry* has one row per (document, position).  All the
operators below are DataFrame operations on that registry; only one
document's columns (bounded by its width) ever come to the driver, to build
the ``StructType`` a scan needs.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DoubleType, FloatType, IntegerType,
                               LongType, StringType, StructField, StructType)

from ..functions import file_stem

DOC_DDL = ("last_modified string, schema array<struct<COLUMN_NAME: string, "
           "ORIGINAL_DATA_TYPE: string, SPARK_DATA_TYPE: string, PANDAS_DATA_TYPE: string>>")
REGISTRY_COLUMNS = ["schema_file", "table_name", "position", "COLUMN_NAME", "ORIGINAL_DATA_TYPE",
                    "SPARK_DATA_TYPE", "PANDAS_DATA_TYPE", "last_modified"]

# Type names in schema documents -> Spark types at ingest.
# Short is widened to integer; dates and timestamps are kept as text.
SPARK_TYPES: dict[str, DataType] = {
    "IntegerType()": IntegerType(),
    "LongType()": LongType(),
    "DoubleType()": DoubleType(),
    "StringType()": StringType(),
    "FloatType()": FloatType(),
    "ShortType()": IntegerType(),
    "BooleanType()": BooleanType(),
    "DateType()": StringType(),
    "TimestampType()": StringType(),
}


# ------------------------------------------------------------------ S2

def scan_schema_docs(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Read schema documents into the registry (one row per column).

    ``multi_line`` reads pretty-printed one-document files; set it to False
    for JSON-lines files holding one document per line.  ``schema_file`` is
    the document's file name and ``table_name`` the name before ``_schema``.
    """
    raw = spark.read.schema(DOC_DDL).option("multiLine", multi_line).json(path)
    return registry_from_docs(raw.withColumn("schema_file", F.col("_metadata.file_name")))


def registry_from_docs(docs: DataFrame) -> DataFrame:
    """Flatten documents (schema_file, last_modified, schema[]) to the registry."""
    table = F.regexp_replace(F.col("schema_file"), r"(_schema)?\.json$", "")
    return (docs.select("schema_file", "last_modified",
                        F.posexplode("schema").alias("position", "c"))
            .select("schema_file", table.alias("table_name"), "position",
                    "c.COLUMN_NAME", "c.ORIGINAL_DATA_TYPE", "c.SPARK_DATA_TYPE",
                    "c.PANDAS_DATA_TYPE", "last_modified"))


# ------------------------------------------------------------------ K8

def docs_from_registry(registry: DataFrame) -> DataFrame:
    """Registry -> one document row per schema file, columns in position order.
    A document holds one table's columns, so its size is bounded by the
    table's width, not by the data."""
    col = F.struct("position", "COLUMN_NAME", "ORIGINAL_DATA_TYPE", "SPARK_DATA_TYPE",
                   "PANDAS_DATA_TYPE")
    return (registry.groupBy("schema_file")
            .agg(F.max("last_modified").alias("last_modified"),
                 F.sort_array(F.collect_list(col)).alias("_cols"))
            .select("schema_file", "last_modified",
                    F.transform("_cols", lambda c: c.dropFields("position")).alias("schema")))


def write_schema_docs(registry: DataFrame, path: str) -> int:
    """K8: replace a folder of schema documents, one JSON file per document, named as
    the document is.  Each task puts its own documents in place, so neither their
    number nor their names come to the driver.  Returns the number of documents."""
    from ..session import ship_package
    from ..sources.archives import _fs_and_path
    from ..sources.tables import Files

    ship_package(registry.sparkSession)
    files = Files(registry.sparkSession, path)
    files.delete("")
    files.fs.mkdirs(files.root)
    folder = files.fs.makeQualified(files.root).toString()

    def put(batches):
        fs, root = _fs_and_path(folder)
        for pdf in batches:
            for name, text in zip(pdf["schema_file"], pdf["text"]):
                base = "unnamed.json" if name is None else name.replace("/", "%2F")
                hidden = f"{root}/.{base}.{uuid.uuid4().hex}"      # a repeated task leaves no part of a file
                with fs.open_output_stream(hidden, compression=None) as out:
                    out.write(text.encode())
                fs.move(hidden, f"{root}/{base}")
            yield pd.DataFrame({"n": [len(pdf)]})

    docs = docs_from_registry(registry)
    text = docs.select("schema_file", F.to_json(F.struct("schema_file", "last_modified", "schema")).alias("text"))
    return text.mapInPandas(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_written_docs(spark: SparkSession, path: str) -> DataFrame:
    raw = (spark.read.schema(DOC_DDL + ", schema_file string").json(path))
    return registry_from_docs(raw)


# ------------------------------------------------------------------ C2

def struct_from_columns(columns: list[tuple[str, str]]) -> StructType:
    """(name, spark type name) pairs -> StructType (upper-case, nullable)."""
    fields = []
    for name, type_name in columns:
        if type_name not in SPARK_TYPES:
            raise KeyError(f"unknown type {type_name!r} for column {name!r}")
        fields.append(StructField(name.upper(), SPARK_TYPES[type_name], True))
    return StructType(fields)


def structs_for(registry: DataFrame, schema_files) -> dict[str, StructType]:
    """The StructTypes of the given documents, by one read of the registry (only their
    columns reach the driver); documents that it does not hold are left out."""
    rows = (registry.where(F.col("schema_file").isin([*schema_files])) if schema_files else registry.limit(0)).select(
        "schema_file", "position", "COLUMN_NAME", "SPARK_DATA_TYPE").collect()
    columns: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r.position):
        columns.setdefault(r.schema_file, []).append((r.COLUMN_NAME, r.SPARK_DATA_TYPE))
    out = {}
    for doc, own in columns.items():
        try:
            out[doc] = struct_from_columns(own)
        except KeyError:                 # a type that documents do not have: this one is left out too
            continue
    return out


def struct_for(registry: DataFrame, schema_file: str) -> StructType:
    """The StructType of one document (its columns only reach the driver)."""
    rows = (registry.where(F.col("schema_file") == F.lit(schema_file))
            .select("position", "COLUMN_NAME", "SPARK_DATA_TYPE").collect())
    if not rows:
        raise KeyError(schema_file)
    return struct_from_columns([(r.COLUMN_NAME, r.SPARK_DATA_TYPE) for r in sorted(rows, key=lambda r: r.position)])


def spark_sql_type(type_col) -> F.Column:
    """Document type name -> Spark SQL type name (as a column)."""
    expr = None
    for name, dt in SPARK_TYPES.items():
        cond = F.col(type_col) == F.lit(name) if isinstance(type_col, str) else type_col == F.lit(name)
        expr = (F.when(cond, F.lit(dt.simpleString())) if expr is None
                else expr.when(cond, F.lit(dt.simpleString())))
    return expr


def struct_ddl(registry: DataFrame) -> DataFrame:
    """C2 for every document at once: (schema_file, n_columns, ddl)."""
    piece = F.concat(F.upper("COLUMN_NAME"), F.lit(" "), spark_sql_type("SPARK_DATA_TYPE"))
    return (registry.groupBy("schema_file")
            .agg(F.count(F.lit(1)).alias("n_columns"),
                 F.sort_array(F.collect_list(F.struct("position", piece.alias("p")))).alias("_p"))
            .select("schema_file", "n_columns",
                    F.array_join(F.transform("_p", lambda x: x["p"]), ", ").alias("ddl")))


# ------------------------------------------------------------------ C3

def schemas_differ(a: StructType, b: StructType) -> bool:
    """True when the lists of (name, type) differ; nullability and metadata are
    not compared."""
    shape = lambda s: [(f.name, f.dataType) for f in s.fields]
    return shape(a) != shape(b)


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """C3 as a table: old vs new registry, matched on (table_name, position).

    change = added | removed | renamed | retyped | renamed_retyped | same.
    """
    o = old.select("table_name", "position", F.col("COLUMN_NAME").alias("old_name"),
                   F.col("SPARK_DATA_TYPE").alias("old_type"))
    n = new.select("table_name", "position", F.col("COLUMN_NAME").alias("new_name"),
                   F.col("SPARK_DATA_TYPE").alias("new_type"))
    j = o.join(n, ["table_name", "position"], "full_outer")
    renamed = ~F.col("old_name").eqNullSafe(F.col("new_name"))
    retyped = ~F.col("old_type").eqNullSafe(F.col("new_type"))
    change = (F.when(F.col("old_name").isNull() & F.col("old_type").isNull(), "added")
              .when(F.col("new_name").isNull() & F.col("new_type").isNull(), "removed")
              .when(renamed & retyped, "renamed_retyped")
              .when(renamed, "renamed").when(retyped, "retyped").otherwise("same"))
    return j.withColumn("change", change)


# ------------------------------------------------------------------ C4

NUMERIC_SOURCE_TYPES = ("num", "number")
TEXT_SOURCE_TYPES = ("char", "varchar", "varchar2", "date")


def map_source_type(name_col, type_col) -> tuple[F.Column, F.Column, F.Column]:
    """C4: source type -> (SPARK_DATA_TYPE, PANDAS_DATA_TYPE, supported).

    A numeric column whose (lower-case) name contains ``id`` is a long id; any
    other numeric is a double; char/varchar/varchar2/date are text; anything
    else falls back to text and is flagged unsupported.
    """
    name = F.col(name_col) if isinstance(name_col, str) else name_col
    typ = F.col(type_col) if isinstance(type_col, str) else type_col
    numeric = typ.isin(*NUMERIC_SOURCE_TYPES)
    spark_t = (F.when(name.contains("id") & numeric, "LongType()")
               .when(numeric, "DoubleType()").otherwise("StringType()"))
    pandas_t = (F.when(name.contains("id") & numeric, "int64")
                .when(numeric, "float64").otherwise("str"))
    supported = numeric | typ.isin(*TEXT_SOURCE_TYPES)
    return spark_t, pandas_t, F.coalesce(supported, F.lit(False))


def apply_type_mapping(rows: DataFrame, name_col: str = "COLUMN_NAME",
                       type_col: str = "ORIGINAL_DATA_TYPE") -> DataFrame:
    s, p, ok = map_source_type(name_col, type_col)
    return rows.withColumns({"SPARK_DATA_TYPE": s, "PANDAS_DATA_TYPE": p, "supported_type": ok})


# ------------------------------------------------------------------ C1, C5, C6

def resolve_schemas(files: DataFrame, mapping: DataFrame) -> DataFrame:
    """Data files -> schema document, with a status per file.

    ``files`` has ``file_name``; ``mapping`` has (csv_file, schema_file).
    Lookup is by ``<stem>.csv``; a missing entry or a document name containing
    "missing" makes the file ``unmapped`` (it is reported, never deleted).
    """
    f = files.withColumn("table_name", file_stem("file_name")).withColumn(
        "csv_file", F.concat(F.col("table_name"), F.lit(".csv")))
    j = f.join(mapping.select("csv_file", "schema_file"), "csv_file", "left")
    ok = F.col("schema_file").isNotNull() & ~F.col("schema_file").contains("missing")
    return j.withColumn("status", F.when(ok, "mapped").otherwise("unmapped"))


def exclude_manual(derived: DataFrame, manual: DataFrame, name_col: str = "name") -> DataFrame:
    """Drop derived schemas listed as manual, compared by file stem (so a
    list entry ``X.csv`` also excludes a derived ``X``)."""
    m = manual.select(F.upper(file_stem(name_col)).alias("_stem")).distinct()
    return (derived.withColumn("_stem", F.upper(file_stem(name_col)))
            .join(m, "_stem", "left_anti").drop("_stem"))


def describe_schema(registry: DataFrame) -> DataFrame:
    """(table_name, n_columns, document JSON) with columns in order."""
    col = F.struct("position", "COLUMN_NAME", "ORIGINAL_DATA_TYPE", "SPARK_DATA_TYPE",
                   "PANDAS_DATA_TYPE")
    g = (registry.groupBy("table_name")
         .agg(F.max("last_modified").alias("last_modified"),
              F.count(F.lit(1)).alias("n_columns"),
              F.sort_array(F.collect_list(col)).alias("_c")))
    doc = F.struct(F.col("last_modified"),
                   F.transform("_c", lambda c: c.dropFields("position")).alias("schema"))
    return g.select("table_name", "n_columns", F.to_json(doc).alias("document"))
