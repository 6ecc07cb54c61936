"""Shape the driver's test tables into the compliance data model.

The test data is a TPC-H-like star schema.  These adapters turn it into the
tables the views read, with one rule per column so that Spark and DuckDB
compute identical inputs from the same parquet files:

* facility (``ECHO_EXPORTER``) = ``customer``: ``REGISTRY_ID`` = custkey;
* crosswalk (``EXP_PGM``) = ``orders``: status F/O/P -> AIR/NPDES/RCRA,
  plus SDWA for every fourth order key;
* program facts = ``lineitem`` keyed by the order key (so a fact reaches a
  facility through the crosswalk);
* registry facts and the case bridge = ``orders`` keyed by the customer.

Every column expression is plain SQL that both engines accept; the Spark side
applies them with ``selectExpr`` on the parquet scan (Catalyst prunes the
unused ones, so only the referenced parquet columns are read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.contracts import BASE_TABLE_DDL, ddl_fields

# Which test table stands in for which data file.
LINEITEM_FACTS = (
    "ICIS-AIR_FCES_PCES", "ICIS-AIR_FORMAL_ACTIONS", "ICIS-AIR_VIOLATION_HISTORY",
    "NPDES_DMRS_FY2020", "NPDES_DMRS_FY2022", "NPDES_EFF_VIOLATIONS",
    "NPDES_FORMAL_ENFORCEMENT_ACTIONS", "NPDES_INSPECTIONS", "NPDES_QNCR_HISTORY",
    "RCRA_ENFORCEMENTS", "RCRA_EVALUATIONS", "RCRA_VIOLATIONS",
    "SDWA_ENFORCEMENTS", "SDWA_PUB_WATER_SYSTEMS", "SDWA_SERIOUS_VIOLATORS",
    "SDWA_SITE_VISITS", "SDWA_VIOLATIONS", "CASE_ENFORCEMENTS",
)
ORDERS_FACTS = ("ICIS_FEC_EPA_INSPECTIONS", "POLL_RPT_COMBINED_EMISSIONS", "CASE_FACILITIES")

# The fact column holding the crosswalk key of each program fact.
PROGRAM_KEYS = {
    "ICIS-AIR_FCES_PCES": "PGM_SYS_ID", "ICIS-AIR_FORMAL_ACTIONS": "PGM_SYS_ID",
    "ICIS-AIR_VIOLATION_HISTORY": "PGM_SYS_ID", "NPDES_DMRS_FY2020": "EXTERNAL_PERMIT_NMBR",
    "NPDES_DMRS_FY2022": "EXTERNAL_PERMIT_NMBR", "NPDES_EFF_VIOLATIONS": "NPDES_ID",
    "NPDES_FORMAL_ENFORCEMENT_ACTIONS": "NPDES_ID", "NPDES_INSPECTIONS": "NPDES_ID",
    "NPDES_QNCR_HISTORY": "NPDES_ID", "RCRA_ENFORCEMENTS": "ID_NUMBER",
    "RCRA_EVALUATIONS": "ID_NUMBER", "RCRA_VIOLATIONS": "ID_NUMBER",
    "SDWA_ENFORCEMENTS": "PWSID", "SDWA_PUB_WATER_SYSTEMS": "PWSID",
    "SDWA_SERIOUS_VIOLATORS": "PWSID", "SDWA_SITE_VISITS": "PWSID", "SDWA_VIOLATIONS": "PWSID",
}

STATUS_PROGRAM = "CASE o_orderstatus WHEN 'F' THEN 'AIR_IDS' WHEN 'O' THEN 'NPDES_IDS' WHEN 'P' THEN 'RCRA_IDS' END"

_OVERRIDES = {
    "CASE_ENFORCEMENTS": {
        "ACTIVITY_ID": "l_orderkey",
        "CASE_NUMBER": "'CASE-' || CAST(l_orderkey AS STRING)",
        "HQ_DIVISION": "CASE l_returnflag WHEN 'A' THEN 'AIR' WHEN 'R' THEN 'RCRA' ELSE 'WATER' END",
    },
    "CASE_FACILITIES": {
        "ACTIVITY_ID": "o_orderkey",
        "CASE_NUMBER": "'CASE-' || CAST(o_orderkey AS STRING)",
        "REGISTRY_ID": "CAST(o_custkey AS STRING)",
    },
    "NPDES_INSPECTIONS": {"REGISTRY_ID": "CAST(l_suppkey AS STRING)"},
    "ICIS_FEC_EPA_INSPECTIONS": {"REGISTRY_ID": "CAST(o_custkey AS STRING)"},
    "POLL_RPT_COMBINED_EMISSIONS": {
        "REGISTRY_ID": "CAST(o_custkey AS STRING)",
        "PGM_SYS_ACRNM": "CASE o_orderstatus WHEN 'F' THEN 'E-GGRT' WHEN 'O' THEN 'TRIS' ELSE 'NEI' END",
    },
}


def _generic(base: str, col: str, typ: str) -> str:
    if base == "lineitem":
        return {"string": f"'{col}-' || CAST(l_partkey AS STRING)",
                "double": "l_extendedprice",
                "long": "l_orderkey * 8 + l_linenumber",
                "int": "l_linenumber"}[typ]
    if base == "orders":
        return {"string": f"'{col}-' || CAST(o_orderkey AS STRING)",
                "double": "o_totalprice",
                "long": "o_orderkey",
                "int": "CAST(o_orderkey % 1000 AS INT)"}[typ]
    # customer (facility)
    return {"string": f"'{col}-' || CAST(c_custkey AS STRING)",
            "double": "CAST(c_custkey AS DOUBLE)"}[typ]


def fact_base(table: str) -> str:
    return "lineitem" if table in LINEITEM_FACTS else "orders"


def fact_exprs(table: str) -> list[str]:
    """``expr AS COL`` for every column of a fact table's declared schema."""
    base = fact_base(table)
    over = dict(_OVERRIDES.get(table, {}))
    if table in PROGRAM_KEYS:
        over.setdefault(PROGRAM_KEYS[table], "CAST(l_orderkey AS STRING)")
    return [f"{over.get(c) or _generic(base, c, t)} AS {c}"
            for c, t in ddl_fields(BASE_TABLE_DDL[table])]


_FACILITY_SPECIAL = {
    "REGISTRY_ID": "CAST(c_custkey AS STRING)",
    "FAC_NAME": "c_name",
    "FAC_STATE": "CAST(c_nationkey AS STRING)",
    "FAC_LAT": "c_acctbal",
}
FACILITY_COLUMNS = ("REGISTRY_ID FAC_NAME FAC_STREET FAC_CITY FAC_STATE FAC_ZIP FAC_COUNTY "
                    "FAC_EPA_REGION FAC_LAT FAC_LONG FAC_DERIVED_HUC FAC_DERIVED_WBD "
                    "FAC_DERIVED_CD113 FAC_PERCENT_MINORITY FAC_POP_DEN DFR_URL FAC_SIC_CODES "
                    "FAC_NAICS_CODES").split()


def facility_exprs() -> list[str]:
    types = dict(ddl_fields(BASE_TABLE_DDL["ECHO_EXPORTER"]))
    return [f"{_FACILITY_SPECIAL.get(c) or _generic('customer', c, types[c])} AS {c}"
            for c in FACILITY_COLUMNS]


# ------------------------------------------------------------------ Spark side

def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(*facility_exprs())


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP_PGM from one scan of ``orders``: each order gives its status
    program and, for every fourth key, an SDWA row too."""
    return (read(spark, sf_dir, "orders")
            .selectExpr(f"explode(array({STATUS_PROGRAM}, "
                        "CASE WHEN o_orderkey % 4 = 0 THEN 'SDWA_IDS' END)) AS PGM",
                        "CAST(o_custkey AS STRING) AS REGISTRY_ID",
                        "CAST(o_orderkey AS STRING) AS PGM_ID")
            .where("PGM IS NOT NULL"))


def fact(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read(spark, sf_dir, fact_base(table)).selectExpr(*fact_exprs(table))


def view_tables(spark: SparkSession, sf_dir: str, tables) -> dict[str, DataFrame]:
    out = {}
    for t in tables:
        if t == "ECHO_EXPORTER":
            out[t] = facility(spark, sf_dir)
        elif t == "EXP_PGM":
            out[t] = crosswalk(spark, sf_dir)
        else:
            out[t] = fact(spark, sf_dir, t)
    return out


def wide_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility rows carrying space-separated program id lists and Y/N flags.

    Orders are grouped by (customer, block of 32 order keys): every group has
    at most 32 orders whatever the customer's size, so no group grows with
    the data.  Exploding the lists gives the crosswalk adapter back.
    """
    o = read(spark, sf_dir, "orders").select(
        F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderstatus"),
        F.floor(F.col("o_orderkey") / 32).alias("blk"))
    pid = F.col("o_orderkey").cast("string")

    def id_list(cond):
        return F.nullif(F.concat_ws(" ", F.sort_array(F.collect_list(F.when(cond, pid)))),
                        F.lit(""))

    g = o.groupBy("o_custkey", "blk").agg(
        id_list(F.col("o_orderstatus") == "F").alias("AIR_IDS"),
        id_list(F.col("o_orderstatus") == "O").alias("NPDES_IDS"),
        id_list(F.col("o_orderstatus") == "P").alias("RCRA_IDS"),
        id_list(F.col("o_orderkey") % 4 == 0).alias("SDWA_IDS"))
    flag = lambda c: F.when(F.col(c).isNotNull(), F.lit("Y")).otherwise(F.lit("N"))
    return g.select(
        F.col("o_custkey").cast("string").alias("REGISTRY_ID"),
        flag("AIR_IDS").alias("AIR_FLAG"), flag("NPDES_IDS").alias("NPDES_FLAG"),
        flag("SDWA_IDS").alias("SDWIS_FLAG"), flag("RCRA_IDS").alias("RCRA_FLAG"),
        "AIR_IDS", "NPDES_IDS", "RCRA_IDS", "SDWA_IDS")


def listed_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every facility once, with all ids of all its blocks in one list a program; one
    without orders has no lists and its flags are N.  A facility's lists are one row, as
    in the exporter file."""
    wide = wide_facility(spark, sf_dir)
    lists = [c for c in wide.columns if c.endswith("_IDS")]
    flags = [c for c in wide.columns if c.endswith("_FLAG")]
    whole = wide.groupBy("REGISTRY_ID").agg(
        *[F.max(c).alias(c) for c in flags],
        *[F.nullif(F.array_join(F.sort_array(F.collect_list(c)), " "), F.lit("")).alias(c) for c in lists])
    return facility(spark, sf_dir).join(whole, "REGISTRY_ID", "left").fillna("N", flags)


# Rows of the id-list facility: one for a customer and block of order keys, so the
# registry id is unique and a list has as many ids as the customer's orders there.
_BLOCK = 1 << 18
_LIST_RULES = {
    "REGISTRY_ID": "CASE WHEN o_custkey % 17 <> 0 THEN CAST(o_custkey AS STRING) || '-' || CAST(blk AS STRING) END",
    "FLAG": "CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 13 = 0 THEN 'N' ELSE 'Y' END",
    # some lists are empty texts, some have doubled blanks
    "IDS": "CASE WHEN o_custkey % 7 = 0 THEN '' ELSE {joined} END",
    "GAP": "CASE WHEN o_custkey % 5 = 0 THEN '  ' ELSE ' ' END",
}
_LIST_PROGRAMS = (("AIR_FLAG", "AIR_IDS", "o_orderstatus = 'F'"), ("NPDES_FLAG", "NPDES_IDS", "o_orderstatus = 'O'"),
                  ("RCRA_FLAG", "RCRA_IDS", "o_orderstatus = 'P'"), ("SDWIS_FLAG", "SDWA_IDS", "o_orderkey % 4 = 0"))


def id_list_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility rows as the crosswalk meets them: unique registry ids (some missing),
    lists of several ids, doubled blanks, empty and missing lists, missing flags."""
    orders = read(spark, sf_dir, "orders").selectExpr("o_custkey", "o_orderkey", "o_orderstatus", f"o_orderkey div {_BLOCK} AS blk")
    lists = orders.groupBy("o_custkey", "blk").agg(*[
        F.expr(f"sort_array(collect_list(CASE WHEN {cond} THEN CAST(o_orderkey AS STRING) END))").alias(name)
        for _, name, cond in _LIST_PROGRAMS])
    out = [f"{_LIST_RULES['REGISTRY_ID']} AS REGISTRY_ID"]
    for flag, name, _ in _LIST_PROGRAMS:
        joined = _LIST_RULES["IDS"].format(joined=f"array_join({name}, {_LIST_RULES['GAP']})")
        out += [f"{_LIST_RULES['FLAG']} AS {flag}", f"CASE WHEN size({name}) > 0 THEN {joined} END AS {name}"]
    return lists.selectExpr(*out)


def id_list_crosswalk_sql() -> str:
    """The crosswalk of ``id_list_facility``, straight from the orders."""
    parts = []
    for _, name, cond in _LIST_PROGRAMS:
        joined = _LIST_RULES["IDS"].format(joined=f"replace(array_to_string(list_sort(list(CAST(o_orderkey AS VARCHAR))), ' '), ' ', {_LIST_RULES['GAP']})")
        parts.append(f"SELECT '{name}' AS PGM, {_LIST_RULES['REGISTRY_ID']} AS REGISTRY_ID, {_LIST_RULES['FLAG']} AS flag, {joined} AS ids "
                     f"FROM (SELECT *, o_orderkey // {_BLOCK} AS blk FROM orders WHERE {cond}) GROUP BY o_custkey, blk")
    return ("SELECT PGM, REGISTRY_ID, unnest(string_split(ids, ' ')) AS PGM_ID FROM (" + " UNION ALL ".join(parts)
            + ") WHERE flag = 'Y' AND REGISTRY_ID IS NOT NULL")


# ----------------------------------------------------------------- SQL side

def facility_sql() -> str:
    return f"SELECT {', '.join(facility_exprs())} FROM customer"


def crosswalk_sql() -> str:
    return (f"SELECT {STATUS_PROGRAM} AS PGM, CAST(o_custkey AS VARCHAR) AS REGISTRY_ID, "
            "CAST(o_orderkey AS VARCHAR) AS PGM_ID FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') "
            "UNION ALL SELECT 'SDWA_IDS', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR) "
            "FROM orders WHERE o_orderkey % 4 = 0")


def fact_sql(table: str) -> str:
    return f"SELECT {', '.join(fact_exprs(table))} FROM {fact_base(table)}"


def wide_facility_sql() -> str:
    def lst(cond):
        return (f"NULLIF(array_to_string(list_sort(list(CAST(o_orderkey AS VARCHAR)) "
                f"FILTER (WHERE {cond})), ' '), '')")
    return ("SELECT CAST(o_custkey AS VARCHAR) AS REGISTRY_ID, "
            f"{lst("o_orderstatus = 'F'")} AS AIR_IDS, "
            f"{lst("o_orderstatus = 'O'")} AS NPDES_IDS, "
            f"{lst("o_orderstatus = 'P'")} AS RCRA_IDS, "
            f"{lst('o_orderkey % 4 = 0')} AS SDWA_IDS "
            "FROM orders GROUP BY o_custkey, floor(o_orderkey / 32)")
