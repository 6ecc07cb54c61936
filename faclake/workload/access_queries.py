"""Registered queries for guarded SQL access
over the test folder seen as a lake (tables ``orders``, ``customer``, ...)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import query as Q
from ..session import scratch_path
from ..sources.tables import folder_lake
from .catalog import register

# Fixed example queries, run through the guarded access path.
PROJECTION_FILTER = ("SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
                     "WHERE o_totalprice > 200000 AND o_orderstatus = 'F'")
GROUP_BY = ("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, "
            "max(o_totalprice) AS top FROM orders GROUP BY o_orderstatus, o_orderpriority")
ORDER_LIMIT = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
WINDOW = ("SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey "
          "ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS rn FROM orders")
GUARDED = "select o_orderstatus, count(*) as n from orders group by o_orderstatus; -- by status"
GUARDED_ORACLE = "select o_orderstatus, count(*) as n from orders group by o_orderstatus"
EVENTS_DAILY = ("SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS users, "
                "max(value) AS top_value FROM events GROUP BY event_type, CAST(ts AS DATE)")
HOT = "SELECT c_nationkey, count(*) AS n, min(c_custkey) AS first_key FROM customer GROUP BY c_nationkey"


def _run(sql, table="orders", **kw):
    def fn(spark, sf_dir):
        return Q.run_query(spark, folder_lake(spark, sf_dir), table, sql, **kw)
    return fn


register("sql_projection_filter", PROJECTION_FILTER)(_run(PROJECTION_FILTER))
register("sql_group_by", GROUP_BY)(_run(GROUP_BY))
register("sql_order_limit", ORDER_LIMIT)(_run(ORDER_LIMIT))
register("sql_window", WINDOW)(_run(WINDOW))
register("select_guard", GUARDED_ORACLE)(_run(GUARDED))
register("sql_events_daily", EVENTS_DAILY)(_run(EVENTS_DAILY, table="events"))


def keep_result(df):
    """The result written to scratch, so that it outlives the hot table."""
    path = scratch_path(df.sparkSession, "result")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register("missing_table", "SELECT * FROM (VALUES ('no_such_table', CAST(NULL AS BIGINT)), ('schemas', NULL)) t(name, n) "
          "UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part "
          "UNION ALL SELECT 'events', count(*) FROM events")
def _missing(spark, sf_dir):
    """Q5: a stored table is counted through the guarded access path; a name that is
    not stored is refused by name and counts as missing."""
    lake, out = folder_lake(spark, sf_dir), None
    for name in ("orders", "no_such_table", "part", "schemas", "events"):
        try:
            found = Q.run_query(spark, lake, name, f"SELECT count(*) AS n FROM {name}").select(F.lit(name).alias("name"), "n")
        except Q.TableNotFound as e:
            assert str(e) == name
            found = spark.range(1).select(F.lit(name).alias("name"), F.lit(None).cast("long").alias("n"))
        # frames of different sessions meet as rows written apart
        out = keep_result(found) if out is None else out.unionByName(keep_result(found))
    return out


@register("limit_before_sql", "SELECT CAST(1000 AS BIGINT) AS n UNION ALL SELECT count(*) // 2 FROM orders "
          "UNION ALL SELECT count(*) FROM orders")
def _limit(spark, sf_dir):
    """The limit applies to the base table, before the query counts it: below, at
    half and beyond the table's rows."""
    lake = folder_lake(spark, sf_dir)
    rows = lake.read("orders").count()
    counted = [keep_result(Q.run_query(spark, lake, "orders", "SELECT count(DISTINCT o_orderkey) AS n FROM orders", limit=n))
               for n in (1000, rows // 2, rows * 2)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@register("hot_table_cache", HOT)
def _hot(spark, sf_dir):
    lake = folder_lake(spark, sf_dir)
    Q.run_query(spark, lake, "customer", HOT, hot_tables=("customer",)).write.format("noop").mode("overwrite").save()
    out = keep_result(Q.run_query(spark, lake, "customer", HOT, hot_tables=("customer",)))
    Q.release_hot_tables()               # later queries scan the table again
    return out


@register("result_cache", GROUP_BY)
def _result_cache(spark, sf_dir):
    root = scratch_path(spark, "results")
    lake = folder_lake(spark, sf_dir)
    store = Q.ResultStore(spark, f"{root}/store")
    first, hit1 = Q.cached_query(spark, lake, store, f"{root}/log", "orders", GROUP_BY)
    second, hit2 = Q.cached_query(spark, lake, store, f"{root}/log", "orders", GROUP_BY)
    assert not hit1 and hit2
    return second


@register("query_log",
          f"SELECT 'orders' AS table_name, '{PROJECTION_FILTER.replace(chr(39), chr(39) * 2)}' AS query, "
          f"count(*) AS result_rows FROM ({PROJECTION_FILTER})")
def _query_log(spark, sf_dir):
    root = scratch_path(spark, "results")
    lake = folder_lake(spark, sf_dir)
    store = Q.ResultStore(spark, f"{root}/store")
    Q.cached_query(spark, lake, store, f"{root}/log", "orders", PROJECTION_FILTER, ip="10.0.0.1")
    log = Q.read_log(spark, f"{root}/log")
    key = log.select("result_key").first()[0]
    counts = store.get(key).agg(F.count(F.lit(1)).alias("result_rows")).withColumn("result_key", F.lit(key))
    return log.join(counts, "result_key").select("table_name", "query", "result_rows")


_PRIO = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END"


@register("json_export",
          "SELECT '{\"o_orderkey\":' || CAST(o_orderkey AS VARCHAR) || ',\"o_orderstatus\":\"' || o_orderstatus || '\"'"
          f" || CASE WHEN ({_PRIO}) IS NULL THEN '' ELSE ',\"prio\":\"' || ({_PRIO}) || '\"' END || '}}' AS value FROM orders")
def _json_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "o_orderstatus", f"{_PRIO} AS prio")
    Q.export_json(df, path)
    return spark.read.text(path)
