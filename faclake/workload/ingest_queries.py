"""Registered queries for ingest, sinks, quality gates and view refresh
(S1, S3, S6, K1-K6, D1-D4, G1-G2, M1, X2).

The test tables are written as CSV files (with a header) into a fresh folder
below the shared checkpoint root, then ingested under declared schemas into a
lake in that folder, exactly as landing files would be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import crosswalk as X
from ..operators import schema as S
from ..plans import ingest as I
from ..plans import refresh as R
from ..plans.views import VIEWS, ViewSpec
from ..session import scratch_path
from ..sources.csv import scan_csv
from ..sources.tables import Lake
from . import adapters as A
from .catalog import register, view_oracle_sql

# Declared schemas of the test tables as landing files (upper-case, by position).
PART_COLUMNS = [("p_partkey", "LongType()"), ("p_name", "StringType()"), ("p_brand", "StringType()"),
                ("p_type", "StringType()"), ("p_size", "IntegerType()"), ("p_retailprice", "DoubleType()")]
SUPPLIER_V1 = [("s_suppkey", "LongType()"), ("s_name", "StringType()"), ("s_nationkey", "IntegerType()"),
               ("s_acctbal", "DoubleType()")]
SUPPLIER_V2 = [("s_suppkey", "StringType()"), ("s_name", "StringType()"), ("s_nationkey", "LongType()"),
               ("s_acctbal", "DoubleType()")]
ORDERS_COLUMNS = [("o_orderkey", "LongType()"), ("o_custkey", "LongType()"), ("o_orderstatus", "StringType()"),
                  ("o_totalprice", "DoubleType()"), ("o_orderdate", "DateType()"),
                  ("o_orderpriority", "StringType()")]
CUSTOMER_COLUMNS = [("c_custkey", "LongType()"), ("c_name", "StringType()"), ("c_nationkey", "IntegerType()"),
                    ("c_acctbal", "DoubleType()"), ("c_mktsegment", "StringType()")]


def registry_of(spark: SparkSession, docs: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """A registry DataFrame for a few small declared documents."""
    rows = [(doc, doc.replace("_schema.json", ""), i, name, None, t, None, "Mon, 01 Jan 2024")
            for doc, cols in docs.items() for i, (name, t) in enumerate(cols)]
    return spark.createDataFrame(rows, "schema_file string, table_name string, position int, "
                                 "COLUMN_NAME string, ORIGINAL_DATA_TYPE string, SPARK_DATA_TYPE string, "
                                 "PANDAS_DATA_TYPE string, last_modified string")


def write_csv(df: DataFrame, folder: str, name: str, compression: str = "none") -> str:
    """Land a table as one CSV folder ``<folder>/<name>`` (a header per part)."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
    return path


def cut_in_half(spark: SparkSession, folder: str) -> None:
    """Damage a landed folder: its first part keeps only the first half of its bytes.
    A task copies them in pieces of a bounded size."""
    from ..sources.archives import CHUNK, _fs_and_path

    def run(batches):
        for pdf in batches:
            for uri in pdf["path"]:
                fs, path = _fs_and_path(uri)
                left = fs.get_file_info(path).size // 2
                with fs.open_input_stream(path, compression=None) as source, fs.open_output_stream(f"{path}.cut", compression=None) as out:
                    while left > 0:
                        data = source.read(min(left, CHUNK))
                        out.write(data)
                        left -= len(data)
                fs.move(f"{path}.cut", path)
            yield pdf

    parts = spark.read.format("binaryFile").load(folder).select("path")
    first = parts.agg(F.min("path")).first()[0]
    spark.createDataFrame([(first,)], "path string").mapInPandas(run, "path string").collect()      # one row


def _orders_csv(spark, sf_dir):
    return A.read(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


PART_SQL = ("SELECT p_partkey AS P_PARTKEY, p_name AS P_NAME, p_brand AS P_BRAND, p_type AS P_TYPE, "
            "p_size AS P_SIZE, p_retailprice AS P_RETAILPRICE FROM part")


@register("csv_typed_scan", PART_SQL)
def _csv_typed_scan(spark, sf_dir):
    land = scratch_path(spark, "landing")
    path = write_csv(A.read(spark, sf_dir, "part"), land, "part.csv")
    return scan_csv(spark, path, S.struct_from_columns(PART_COLUMNS))


def _ingest(spark, sf_dir, land, lake, name, table_df, doc, cols):
    path = write_csv(table_df, land, name)
    reg = registry_of(spark, {doc: cols})
    return I.ingest_file(spark, lake, path, {name: doc}, reg)


@register("full_refresh", PART_SQL)
def _full_refresh(spark, sf_dir):
    root = scratch_path(spark, "lake")
    lake = Lake(spark, root)
    part = A.read(spark, sf_dir, "part")
    for _ in range(2):  # the second run replaces every row of the first
        rec = _ingest(spark, sf_dir, f"{root}/landing", lake, "part.csv", part, "part_schema.json", PART_COLUMNS)
        assert rec.status == "ingested", rec
    return lake.read("part")


@register("schema_evolve",
          "SELECT CAST(s_suppkey AS VARCHAR) AS S_SUPPKEY, s_name AS S_NAME, "
          "CAST(s_nationkey AS BIGINT) AS S_NATIONKEY, s_acctbal AS S_ACCTBAL FROM supplier")
def _schema_evolve(spark, sf_dir):
    root = scratch_path(spark, "lake")
    lake = Lake(spark, root)
    sup = A.read(spark, sf_dir, "supplier")
    first = _ingest(spark, sf_dir, f"{root}/landing", lake, "supplier.csv", sup, "supplier_schema.json", SUPPLIER_V1)
    second = _ingest(spark, sf_dir, f"{root}/landing", lake, "supplier.csv", sup, "supplier_schema.json", SUPPLIER_V2)
    assert first.status == second.status == "ingested" and second.schema_changed, (first, second)
    return lake.read("supplier")


@register("row_parity",
          "SELECT 'orders.csv' AS name, 'ingested' AS status, count(*) AS source_rows, count(*) AS stored_rows, "
          "true AS parity FROM orders")
def _row_parity(spark, sf_dir):
    root = scratch_path(spark, "lake")
    rec = _ingest(spark, sf_dir, f"{root}/landing", Lake(spark, root), "orders.csv",
                  _orders_csv(spark, sf_dir), "orders_schema.json", ORDERS_COLUMNS)
    return spark.createDataFrame([(rec.name, rec.status, rec.source_rows, rec.stored_rows,
                                   rec.source_rows == rec.stored_rows)],
                                 "name string, status string, source_rows long, stored_rows long, parity boolean")


@register("ingest_batch_report",
          "SELECT 'customer.csv' AS name, 'unmapped' AS status, CAST(NULL AS BIGINT) AS source_rows "
          "UNION ALL SELECT 'nation.csv', 'unmapped', NULL "
          "UNION ALL SELECT 'orders.csv', 'ingested', (SELECT count(*) FROM orders) "
          "UNION ALL SELECT 'part.csv', 'ingested', (SELECT count(*) FROM part) "
          "UNION ALL SELECT 'supplier.csv', 'ingested', (SELECT count(*) FROM supplier)")
def _batch(spark, sf_dir):
    root = scratch_path(spark, "lake")
    land = f"{root}/landing"
    names = ("part", "supplier", "orders", "nation", "customer")
    for name in names:                      # each a folder of part files
        df = _orders_csv(spark, sf_dir) if name == "orders" else A.read(spark, sf_dir, name)
        df.write.option("header", True).csv(f"{land}/{name}.csv")
    lake = Lake(spark, root)
    records = [I.ingest_file(spark, lake, f"{land}/{n}.csv", LANDING_MAPPING, _registry(spark)) for n in names]
    from ..operators import quality as Q
    return Q.report(spark, records).select("name", "status", "source_rows")


LANDING_MAPPING = {"part.csv": "part_schema.json", "supplier.csv": "supplier_schema.json",
                   "orders.csv": "orders_schema.json", "customer.csv": "customer_missing.json"}


def _registry(spark):
    return registry_of(spark, {"part_schema.json": PART_COLUMNS, "supplier_schema.json": SUPPLIER_V1,
                               "orders_schema.json": ORDERS_COLUMNS, "customer_missing.json": CUSTOMER_COLUMNS})


@register("landing_run_report",
          "SELECT 'NATION.CSV' AS name, 'unmapped' AS status, CAST(NULL AS BIGINT) AS source_rows, "
          "CAST(NULL AS BIGINT) AS malformed_rows, CAST(NULL AS BIGINT) AS header_drift "
          "UNION ALL SELECT 'orders.csv.gz', 'ingested', count(*), 0, 0 FROM orders "
          "UNION ALL SELECT 'part.CSV', 'ingested', count(*), 0, 0 FROM part "
          "UNION ALL SELECT 'supplier.csv', 'ingested', count(*), count(*) FILTER (s_suppkey % 10 = 0), 1 FROM supplier "
          "UNION ALL SELECT 'customer.csv', 'clash', NULL, NULL, NULL "
          "UNION ALL SELECT 'customer.2024.csv', 'clash', NULL, NULL, NULL "
          "UNION ALL SELECT 'notes.txt', 'skipped', NULL, NULL, NULL")
def _landing_report(spark, sf_dir):
    """A landing folder with upper-case, unmapped, clashing, malformed, compressed
    and foreign files, each landed as a folder of parts: every one has a row in the
    report."""
    root = scratch_path(spark, "lake")
    land = f"{root}/landing"
    read = lambda t: A.read(spark, sf_dir, t)
    write_csv(read("part"), land, "part.CSV")
    write_csv(read("nation"), f"{land}/deep/er", "NATION.CSV")
    write_csv(_orders_csv(spark, sf_dir), land, "orders.csv.gz", "gzip")
    bad = F.when(F.col("s_suppkey") % 10 == 0, F.lit("many")).otherwise(F.col("s_nationkey").cast("string"))
    write_csv(read("supplier").withColumn("s_nationkey", bad).withColumnRenamed("s_nationkey", "nation_key"), land, "supplier.csv")
    write_csv(read("customer"), land, "customer.csv")
    write_csv(read("customer"), f"{land}/old", "customer.2024.csv")
    read("region").select(F.to_json(F.struct("*"))).write.text(f"{land}/notes.txt")
    report = I.ingest_landing(spark, Lake(spark, root), land, LANDING_MAPPING, _registry(spark))
    return report.select("name", "status", "source_rows", "malformed_rows", "header_drift")


@register("refresh_keeps_old_on_failure", PART_SQL)
def _keeps_old(spark, sf_dir):
    """Good load, truncated load, and the old rows are still the table; the third,
    good load replaces them."""
    root = scratch_path(spark, "lake")
    lake, reg, path = Lake(spark, root), _registry(spark), f"{root}/landing/part.csv.gz"
    part = A.read(spark, sf_dir, "part")
    write_csv(part, f"{root}/landing", "part.csv.gz", "gzip")
    first = I.ingest_file(spark, lake, path, LANDING_MAPPING, reg)
    before = lake.version("part")
    cut_in_half(spark, path)
    cut = I.ingest_file(spark, lake, path, LANDING_MAPPING, reg)
    assert (first.status, cut.status, lake.version("part")) == ("ingested", "failed", before), (first, cut)
    assert lake.read("part").count() == first.stored_rows
    write_csv(part, f"{root}/landing", "part.csv.gz", "gzip")
    again = I.ingest_file(spark, lake, path, LANDING_MAPPING, reg)
    assert again.status == "ingested" and lake.version("part") != before, again
    return lake.read("part")


@register("concurrent_replace", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _concurrent(spark, sf_dir):
    """K1/K2/K6: two writers of one table overlap; the one that publishes second is
    refused, and the first one's rows are the table."""
    from ..sources.tables import ConcurrentReplace
    lake = Lake(spark, scratch_path(spark, "lake"))
    orders = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lake.write(orders, "orders")
    try:
        with lake.replace("orders") as slow:
            slow.write(orders.where("o_orderstatus = 'O'"))
            lake.write(orders.where("o_orderstatus = 'F'"), "orders")
    except ConcurrentReplace:
        return lake.read("orders")
    raise AssertionError("the second writer was not refused")


@register("refresh_one_program",
          "SELECT name, status FROM (VALUES ('EXP_PGM', 'ok'), ('AIR_COMPLIANCE_MVIEW', 'unchanged'), "
          "('RCRA_VIOLATIONS_MVIEW', 'ok'), ('SDWA_VIOLATIONS_MVIEW', 'unchanged')) t(name, status)")
def _one_program(spark, sf_dir):
    """M1, only changed: facilities lose their hazardous-waste ids; of the crosswalk
    views, only that program's is rebuilt."""
    names = ("AIR_COMPLIANCE_MVIEW", "RCRA_VIOLATIONS_MVIEW", "SDWA_VIOLATIONS_MVIEW")
    specs = [s for s in VIEWS if s.name in names]
    lake = _fact_lake(spark, sf_dir, sorted({t for s in specs for t in s.tables} - {"ECHO_EXPORTER", "EXP_PGM"}))
    lake.write(A.listed_facility(spark, sf_dir), "ECHO_EXPORTER")
    R.refresh_views(spark, lake, specs, only_changed=True)
    facility = lake.read("ECHO_EXPORTER")                # the stored rows: their joins are not made again
    lake.write(facility.withColumn("RCRA_IDS", F.when(F.col("REGISTRY_ID").cast("long") % 2 == 0, F.col("RCRA_IDS"))), "ECHO_EXPORTER")
    report = R.refresh_views(spark, lake, specs, only_changed=True)
    return report.select("name", "status")


def _fact_lake(spark, sf_dir, tables, files: int | None = None) -> Lake:
    """A lake holding the adapted test tables (facility, crosswalk, facts); with
    ``files``, each table is dealt over that many, as an ingested one is."""
    root = scratch_path(spark, "lake")
    lake = Lake(spark, root)
    for t, df in A.view_tables(spark, sf_dir, tables).items():
        df = df.repartition(files) if files else df
        if t == "EXP_PGM":
            lake.write(df, t, partition_by=["PGM"])
        else:
            lake.write(df, t)
    return lake


@register("table_scan_alias",
          f"SELECT PGM_SYS_ID, ACTIVITY_ID, PROGRAM_CODES FROM ({A.fact_sql('ICIS-AIR_FCES_PCES')})")
def _alias(spark, sf_dir):
    lake = _fact_lake(spark, sf_dir, ["ICIS-AIR_FCES_PCES"])
    session = spark.newSession()
    alias = lake.load("ICIS-AIR_FCES_PCES", session)
    return session.sql(f"SELECT PGM_SYS_ID, ACTIVITY_ID, PROGRAM_CODES FROM {alias}")


@register("crosswalk_rebuild_idempotent", f"SELECT PGM, REGISTRY_ID, PGM_ID FROM ({A.crosswalk_sql()})")
def _rebuild(spark, sf_dir):
    root = scratch_path(spark, "lake")
    lake = Lake(spark, root)
    lake.write(A.wide_facility(spark, sf_dir), "ECHO_EXPORTER")
    R.rebuild_crosswalk(lake)
    R.rebuild_crosswalk(lake)  # a rerun replaces, never appends
    return lake.read("EXP_PGM").select("PGM", "REGISTRY_ID", "PGM_ID")


@register("filtered_temp_view",
          f"SELECT PGM, REGISTRY_ID, PGM_ID FROM ({A.crosswalk_sql()}) WHERE PGM = 'RCRA_IDS'")
def _filtered_view(spark, sf_dir):
    # A filtered temp view over the stored (PGM-partitioned) crosswalk;
    # the filter prunes partitions at the scan.
    lake = _fact_lake(spark, sf_dir, ["EXP_PGM"])
    session = spark.newSession()
    X.program_slice(lake.reader("EXP_PGM", session), "RCRA_IDS").createOrReplaceTempView("EXP_PGM_RCRA")
    return session.sql("SELECT PGM, REGISTRY_ID, PGM_ID FROM EXP_PGM_RCRA")


_EMPTY_SPEC = ViewSpec("NO_SUCH_SOURCE_MVIEW", "none", "POLL_RPT_COMBINED_EMISSIONS", "REGISTRY_ID",
                       "f.REGISTRY_ID, e.FAC_NAME", fact_filter=("PGM_SYS_ACRNM", "NONE"))
_GATE_SPECS = [s for s in VIEWS if s.name in ("GREENHOUSE_GASES_MVIEW", "TOXIC_RELEASES_MVIEW")] + [_EMPTY_SPEC]


def _count_sql(spec: ViewSpec, status: str | None = None) -> str:
    st = f"'{status}'" if status else "CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END"
    return f"SELECT '{spec.name}' AS name, {st} AS status, count(*) AS source_rows FROM ({view_oracle_sql(spec)})"


@register("non_empty_check", " UNION ALL ".join(_count_sql(s) for s in _GATE_SPECS))
def _non_empty(spark, sf_dir):
    lake = _fact_lake(spark, sf_dir, ["ECHO_EXPORTER", "POLL_RPT_COMBINED_EMISSIONS"])
    rep = R.refresh_views(spark, lake, _GATE_SPECS, rebuild=False, share_dimension=False)
    return rep.select("name", "status", "source_rows")


_ALL_TABLES = sorted({t for s in VIEWS for t in s.tables})


@register("view_refresh_report", " UNION ALL ".join(_count_sql(s) for s in VIEWS))
def _refresh(spark, sf_dir):
    lake = _fact_lake(spark, sf_dir, _ALL_TABLES)
    rep = R.refresh_views(spark, lake, VIEWS, rebuild=False)
    return rep.select("name", "status", "source_rows")


_ORDERS_CSV_SQL = ("SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY, o_orderstatus AS O_ORDERSTATUS, "
                   "o_totalprice AS O_TOTALPRICE, strftime(o_orderdate, '%Y-%m-%d') AS O_ORDERDATE, "
                   "o_orderpriority AS O_ORDERPRIORITY FROM orders")


@register("expand_archives", _ORDERS_CSV_SQL)
def _expand(spark, sf_dir):
    from ..sources.archives import expand_archives
    from .archive_inputs import pack_archives
    root = scratch_path(spark, "archives")
    _orders_csv(spark, sf_dir).repartition(6).write.option("header", True).csv(f"{root}/stage")
    parts = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .load(f"{root}/stage").select("path"))
    packed = pack_archives(parts, f"{root}/archives").collect()   # one row per archive
    assert {r.kind for r in packed} == {"zip", "tar", "gz"}, packed
    report = expand_archives(spark, f"{root}/archives", f"{root}/landing").collect()
    assert report and all(r.status == "extracted" for r in report), report
    return scan_csv(spark, f"{root}/landing", S.struct_from_columns(ORDERS_COLUMNS), recursive=True)


@register("landing_stream_ingest", PART_SQL)
def _stream(spark, sf_dir):
    # Two landings of half the rows each; each run appends only the new file.
    from ..streaming.landing import ingest_new_files
    root = scratch_path(spark, "stream")
    lake = Lake(spark, root)
    schema = S.struct_from_columns(PART_COLUMNS)
    part = A.read(spark, sf_dir, "part")
    for i, cond in enumerate([F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 2 == 1]):
        part.where(cond).write.option("header", True).csv(f"{root}/landing/batch{i}")
        ingest_new_files(spark, f"{root}/landing/*", schema, lake, "part", f"{root}/_checkpoint")
    return lake.read("part")


_SQL_SPECS = [s for s in VIEWS if s.name in ("AIR_COMPLIANCE_MVIEW", "RCRA_VIOLATIONS_MVIEW",
                                             "AIR_ENFORCEMENTS_MVIEW", "TOXIC_RELEASES_MVIEW")]


@register("sql_view_refresh", " UNION ALL ".join(_count_sql(s) for s in _SQL_SPECS))
def _sql_views(spark, sf_dir):
    # Views given as SQL text ({statements, tables}), run over the lake tables;
    # RCRA's definition first creates a filtered temp view of the crosswalk.
    from ..plans.views import sql_text
    lake = _fact_lake(spark, sf_dir, sorted({t for s in _SQL_SPECS for t in s.tables}))
    defs = {}
    for spec in _SQL_SPECS:
        stmts = [sql_text(spec)]
        if spec.program == "RCRA_IDS":
            # the view's statement reads the temp view in place of the crosswalk
            own = sql_text(spec, lambda t: "EXP_PGM_RCRA" if t == "EXP_PGM" else t.replace("-", "_"))
            assert "EXP_PGM_RCRA link" in own and own != stmts[0]
            stmts = ["CREATE OR REPLACE TEMP VIEW EXP_PGM_RCRA AS SELECT * FROM EXP_PGM WHERE PGM = 'RCRA_IDS'", own]
        defs[spec.name] = {"statements": stmts, "tables": spec.tables}
    return R.refresh_sql_views(spark, lake, defs).select("name", "status", "source_rows")


# Declared with P_SIZE and P_NAME swapped: binding is by position, so every row
# puts a part name into an integer column (malformed) and two header names differ.
PART_SWAPPED = [("p_partkey", "LongType()"), ("p_size", "IntegerType()"), ("p_brand", "StringType()"),
                ("p_type", "StringType()"), ("p_name", "StringType()"), ("p_retailprice", "DoubleType()")]


@register("ingest_quality_report",
          "SELECT 'part.csv' AS name, 'ingested' AS status, count(*) AS source_rows, "
          "count(*) AS malformed_rows, CAST(2 AS INTEGER) AS header_drift FROM part")
def _quality(spark, sf_dir):
    root = scratch_path(spark, "lake")
    rec = _ingest(spark, sf_dir, f"{root}/landing", Lake(spark, root), "part.csv",
                  A.read(spark, sf_dir, "part"), "part_schema.json", PART_SWAPPED)
    from ..operators import quality as Q
    return Q.report(spark, [rec]).select("name", "status", "source_rows", "malformed_rows", "header_drift")
