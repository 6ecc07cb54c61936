"""Registered queries over the driver's test tables, with DuckDB oracles.

Each entry is ``key -> (fn(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
Every query reads the given tables (or data Spark derives from them) in
full, so its work grows with the scale factor.  Computed columns carry the
same alias on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import crosswalk as X
from ..plans.views import VIEWS, ViewSpec, build_view, sql_text
from . import adapters as A

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


# ----------------------------------------------------------------- views

def view_oracle_sql(spec: ViewSpec) -> str:
    """The view's SQL over the adapted test tables as CTEs."""
    own = {spec.fact: A.fact_sql(spec.fact), "ECHO_EXPORTER": A.facility_sql()}
    if spec.shape == "crosswalk":
        own["EXP_PGM"] = A.crosswalk_sql()
    if spec.shape == "bridge":
        own[spec.bridge] = A.fact_sql(spec.bridge)
    ctes = ", ".join(f'"{t}" AS ({q})' for t, q in own.items())
    return f"WITH {ctes} {sql_text(spec, lambda t: chr(34) + t + chr(34))}"


def view_query(spec: ViewSpec, skew: str = "aqe") -> QueryFn:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_view(spec, A.view_tables(spark, sf_dir, spec.tables), skew=skew)
    fn.__name__ = spec.key
    return fn


for _spec in VIEWS:
    register(_spec.key, view_oracle_sql(_spec))(view_query(_spec))


# Cut-down join shapes (J1, J2) used by the join operators' own entries.
J1_SPEC = ViewSpec("FACT_FACILITY", "join_fact_facility", "POLL_RPT_COMBINED_EMISSIONS", "REGISTRY_ID",
                   "f.REPORTING_YEAR, f.REGISTRY_ID, f.PGM_SYS_ACRNM, f.ANNUAL_EMISSION, e.FAC_NAME, e.FAC_STATE, e.FAC_LAT")
J2_SPEC = ViewSpec("FACT_CROSSWALK_FACILITY", "join_fact_crosswalk_facility", "SDWA_VIOLATIONS", "PWSID",
                   "f.PWSID, f.FISCAL_YEAR, f.VIOLATION_ID, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STATE, e.FAC_LAT",
                   program="SDWA_IDS")
register(J1_SPEC.key, view_oracle_sql(J1_SPEC))(view_query(J1_SPEC))
register(J2_SPEC.key, view_oracle_sql(J2_SPEC))(view_query(J2_SPEC))


@register("join_fact_crosswalk_facility_salted", view_oracle_sql(J2_SPEC))
def _j2_salted(spark, sf_dir):
    # Same join with explicit hot-key salting (a key is "hot" from 1/64 of rows).
    return build_view(J2_SPEC, A.view_tables(spark, sf_dir, J2_SPEC.tables), skew="salt")


# ------------------------------------------------------------- crosswalk

@register("crosswalk_build", f"SELECT PGM, REGISTRY_ID, PGM_ID FROM ({A.crosswalk_sql()})")
def _crosswalk_build(spark, sf_dir):
    return X.build_crosswalk(A.wide_facility(spark, sf_dir))


@register("crosswalk_id_lists", A.id_list_crosswalk_sql())
def _id_lists(spark, sf_dir):
    """X1/X2 over lists of several ids with doubled blanks, empty lists, missing lists,
    flags and registry ids; registry ids are unique."""
    return X.build_crosswalk(A.id_list_facility(spark, sf_dir))


@register("flag_filter", f"SELECT REGISTRY_ID, AIR_IDS FROM ({A.wide_facility_sql()}) WHERE AIR_IDS IS NOT NULL")
def _flag_filter(spark, sf_dir):
    return X.flag_filter(A.wide_facility(spark, sf_dir), "AIR_FLAG", "AIR_IDS")


@register("split_explode_ids",
          "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS PGM_ID FROM part")
def _split_explode(spark, sf_dir):
    from ..functions import explode_ids
    return A.read(spark, sf_dir, "part").select("p_partkey", explode_ids("p_name").alias("PGM_ID"))


@register("crosswalk_program_slice",
          f"SELECT PGM, REGISTRY_ID, PGM_ID FROM ({A.crosswalk_sql()}) WHERE PGM = 'NPDES_IDS'")
def _slice(spark, sf_dir):
    return X.program_slice(X.build_crosswalk(A.wide_facility(spark, sf_dir)), "NPDES_IDS")


# The other operator families register themselves on import.
from . import access_queries, ingest_queries, landing_queries, schema_queries  # noqa: E402,F401
