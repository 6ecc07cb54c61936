import pytest

from faclake.operators import query as Q
from faclake.sources.tables import Lake, TableNotFound


@pytest.fixture()
def lake(spark, tmp):
    lk = Lake(spark, tmp)
    lk.write(spark.createDataFrame([(i, f"n{i}") for i in range(100)], "id long, name string"), "ICIS-AIR_X")
    return lk


ALLOWED = ["select * from t", "SELECT 1;", "from t select id", "values 1", "select * from range(3)",
           "WITH a AS (SELECT id FROM t), b AS (SELECT * FROM a) SELECT * FROM b ORDER BY id LIMIT 1; -- c",
           "select ';' as x, \"--\" as y from T ;; /* z */ ", "select id in (select id from t) from t",
           "select (select max(id) from t) m, exists(select 1 from t) e",
           "select count(*), sum(DISTINCT id), coalesce(max(id), 0), if(min(id) > 1, 'a', 'b'), upper(cast(avg(id) as string)) from t",
           "select id, row_number() over (order by id) r, id in (1, 2), id between 1 and 2, substring('abc', 2), trim(both ' ' from ' x '), "
           "extract(year from date'2024-01-01'), case when id like 'a%' then 1 end, transform(array(id), x -> x + 1), current_date() from t",
           "select id div 2, id % 2, -id, id || 'x', to_json(struct(id)), percentile(id, 0.5) over () from t"]
REFUSED = ["", None, "DROP TABLE t", "drop table t -- select", "select 1; drop table t", "insert into t values (1)",
           "select transform(id) using 'cat' from t", "select * from text.`/etc/hostname`", "select * from other",
           "select reflect('java.lang.System', 'getProperty', 'user.home')", "select try_reflect('a', 'b')",
           "select java_method('java.lang.System', 'currentTimeMillis')", "select * from identifier('other')",
           "select * from t where exists (select 1 from parquet.`/x`)", "select * from python_worker_logs()",
           "with a as (select * from json.`/x`) select * from a", "select 1) x; select (1", "select my_function(id) from t",
           "select spark_catalog.default.f(id) from t", "select default.upper(id) from t", "select aggregate(array(1), 0, (a, b) -> mine(a)) from t"]


@pytest.mark.parametrize("sql", ALLOWED)
def test_guard_accepts(spark, sql):
    spark.range(5).createOrReplaceTempView("t")
    assert spark.sql(Q.guard_select(sql, spark, ["t"])).count() > 0


@pytest.mark.parametrize("sql", REFUSED)
def test_guard_refuses(spark, sql):
    with pytest.raises(Q.Forbidden):
        Q.guard_select(sql, spark, ["t"])


def test_trimming_is_linear():
    import time
    begun = time.perf_counter()
    Q.strip_final_semicolon("select 1;" + "-- " * 2000 + "\nx")
    assert Q.strip_final_semicolon("select 1;" + "-- a\n" * 2000) == "select 1"
    assert time.perf_counter() - begun < 0.05


def test_run_query_dash_name_and_limit(spark, lake):
    r = Q.run_query(spark, lake, "ICIS-AIR_X", "SELECT count(*) AS n FROM ICIS_AIR_X").first()
    assert r.n == 100
    r = Q.run_query(spark, lake, "ICIS-AIR_X", "SELECT count(*) AS n FROM ICIS_AIR_X", limit=7).first()
    assert r.n == 7
    with pytest.raises(TableNotFound):
        Q.run_query(spark, lake, "NOPE", "SELECT 1")


def test_sessions_are_isolated(spark, lake):
    Q.run_query(spark, lake, "ICIS-AIR_X", "SELECT * FROM ICIS_AIR_X")
    assert not spark.catalog.tableExists("ICIS_AIR_X")


def test_result_cache_keys_on_version(spark, lake, tmp):
    store = Q.ResultStore(spark, f"{tmp}/store")
    sql = "SELECT count(*) AS n FROM ICIS_AIR_X"
    a, hit_a = Q.cached_query(spark, lake, store, f"{tmp}/log", "ICIS-AIR_X", sql)
    b, hit_b = Q.cached_query(spark, lake, store, f"{tmp}/log", "ICIS-AIR_X", sql)
    assert (hit_a, hit_b) == (False, True) and b.first().n == 100
    # a refresh of the table changes its version: no stale answer
    lake.write(spark.createDataFrame([(1, "x")], "id long, name string"), "ICIS-AIR_X")
    c, hit_c = Q.cached_query(spark, lake, store, f"{tmp}/log", "ICIS-AIR_X", sql)
    assert not hit_c and c.first().n == 1
    log = Q.read_log(spark, f"{tmp}/log")
    assert log.count() == 2 and {r.table_name for r in log.collect()} == {"ICIS-AIR_X"}


def test_json_lines_omit_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a long, b string")
    assert sorted(r.value for r in Q.to_json_lines(df).collect()) == ['{"a":1}', '{"a":2,"b":"b"}']


def test_hot_table_is_cached_and_limited_tables_are_not(spark, lake):
    hot = Q.open_table(spark, lake, "ICIS-AIR_X", hot_tables=("ICIS-AIR_X",))
    assert hot.storageLevel.useMemory
    limited = Q.open_table(spark, lake, "ICIS-AIR_X", limit=5, hot_tables=("ICIS-AIR_X",))
    assert not limited.storageLevel.useMemory and limited.count() == 5
    hot.unpersist()


def test_hot_table_follows_its_versions(spark, lake):
    sql, hot = "SELECT count(*) AS n FROM ICIS_AIR_X", ("ICIS-AIR_X",)
    assert Q.run_query(spark, lake, "ICIS-AIR_X", sql, hot_tables=hot).first().n == 100
    # another process replaces the table
    Lake(spark, lake.root).write(spark.createDataFrame([(1, "x")], "id long, name string"), "ICIS-AIR_X")
    assert Q.run_query(spark, lake, "ICIS-AIR_X", sql, hot_tables=hot).first().n == 1
    Q.release_hot_tables()
    assert not Q._HOT._held
