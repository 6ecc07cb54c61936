"""End-to-end view checks on invented rows against DuckDB running the
generated SQL over the same rows."""

import duckdb
import pytest

from faclake.operators import joins
from faclake.operators.joins import hot_keys
from faclake.plans.contracts import BASE_TABLE_DDL, ddl_fields
from faclake.plans.views import VIEWS, build_view, sql_text

FAC = [("R1", "Y"), ("R2", "Y"), ("R3", "Y"), (None, "Y")]


def _value(col, typ, i):
    if typ == "string":
        return f"{col}-{i}"
    if typ == "double":
        return float(i) + 0.5
    return i


def _table(name, n, overrides):
    cols = ddl_fields(BASE_TABLE_DDL[name])
    rows = []
    for i in range(n):
        row = [_value(c, t, i) for c, t in cols]
        for c, fn in overrides.items():
            idx = [x for x, _ in cols].index(c)
            row[idx] = fn(i)
        rows.append(tuple(row))
    return cols, rows


def _fixture():
    keys = ["K1", "K2", "K3", None, "K1", "KX"]   # K1 twice, KX without crosswalk, a NULL key
    regs = ["R1", "R2", "R9", None, "R1", "R3"]
    tables = {}
    tables["ECHO_EXPORTER"] = _table("ECHO_EXPORTER", 3, {"REGISTRY_ID": lambda i: f"R{i + 1}"})
    xw_rows = []
    for pgm in ("AIR_IDS", "NPDES_IDS", "RCRA_IDS", "SDWA_IDS"):
        xw_rows += [(pgm, "R1", "K1"), (pgm, "R2", "K1"), (pgm, "R2", "K2"), (pgm, "R3", "K3"), (pgm, "R9", "K3")]
    tables["EXP_PGM"] = (ddl_fields(BASE_TABLE_DDL["EXP_PGM"]), xw_rows)
    for spec in VIEWS:
        if spec.fact in tables:
            continue
        over = {}
        cols = [c for c, _ in ddl_fields(BASE_TABLE_DDL[spec.fact])]
        if spec.shape == "crosswalk":
            over[spec.fact_key] = lambda i: keys[i]
        if "REGISTRY_ID" in cols:
            over["REGISTRY_ID"] = lambda i: regs[i]
        if "HQ_DIVISION" in cols:
            over["HQ_DIVISION"] = lambda i: "AIR" if i % 2 == 0 else "WATER"
        if "PGM_SYS_ACRNM" in cols:
            over["PGM_SYS_ACRNM"] = lambda i: ["E-GGRT", "TRIS", "NEI"][i % 3]
        if spec.fact == "CASE_ENFORCEMENTS":
            over["CASE_NUMBER"] = lambda i: f"C{i % 3}"
            over["ACTIVITY_ID"] = lambda i: i % 4
        tables[spec.fact] = _table(spec.fact, 6, over)
    tables["CASE_FACILITIES"] = _table("CASE_FACILITIES", 4, {
        "CASE_NUMBER": lambda i: f"C{i}", "ACTIVITY_ID": lambda i: i, "REGISTRY_ID": lambda i: ["R1", "R2", "R1", None][i]})
    return tables


def _reference_sql(spec):
    return sql_text(spec, lambda t: f'"{t}"')


@pytest.fixture(scope="module")
def fixture(spark):
    import pandas as pd
    raw = _fixture()
    con = duckdb.connect()
    dfs = {}
    for name, (cols, rows) in raw.items():
        ddl = ", ".join(f"`{c}` {t}" for c, t in cols)
        dfs[name] = spark.createDataFrame(rows, ddl)
        pdf = pd.DataFrame(rows, columns=[c for c, _ in cols])
        con.register(f"_{name}", pdf)
        con.execute(f'CREATE TABLE "{name}" AS SELECT * FROM "_{name}"')
    return dfs, con


@pytest.mark.parametrize("spec", VIEWS, ids=[v.key for v in VIEWS])
def test_view_matches_reference_sql(fixture, spec):
    dfs, con = fixture
    got = build_view(spec, dfs)
    assert got.columns == [n for _, n in spec.output()]
    expect = sorted(map(tuple, con.execute(_reference_sql(spec)).fetchall()), key=repr)
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == expect
    if spec.shape == "crosswalk":
        assert rows, spec.name          # fan-out exists in the fixture
        salted = sorted(map(tuple, build_view(spec, dfs, skew="salt", hot_fraction=0.2, buckets=3).collect()), key=repr)
        assert salted == rows


def test_fan_out_and_null_keys(fixture):
    dfs, _ = fixture
    spec = [v for v in VIEWS if v.key == "mview_air_compliance"][0]
    rows = build_view(spec, dfs).collect()
    # K1 appears twice in the fact and maps to R1 and R2: 4 rows; K2 -> R2: 1;
    # K3 -> R3 (R9 has no facility): 1; NULL and KX: none.
    assert len(rows) == 6
    assert {r.PGM_SYS_ID for r in rows} == {"K1", "K2", "K3"}


def test_hot_keys_bounded(spark):
    df = spark.createDataFrame([("hot",)] * 50 + [(f"k{i}",) for i in range(50)], "k string")
    assert hot_keys(df, "k", hot_fraction=0.25) == ["hot"]


def test_linked_rows_keep_every_match_and_drop_most_others(spark):
    keys = spark.range(0, 40000, 2).selectExpr("CAST(id AS STRING) AS k__").union(spark.sql("SELECT CAST(NULL AS STRING)"))
    fact = spark.range(40000).selectExpr("CAST(id AS STRING) AS k", "id").union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    kept = [r.id for r in joins.linked_rows(fact, "k", keys).select("id").collect()]
    assert {*range(0, 40000, 2)} <= {*kept} and len(kept) == len({*kept}) < 20100
    assert joins.linked_rows(fact, "id", keys) is fact          # other types hash differently
    assert joins.linked_rows(fact, "k", keys.limit(0)).isEmpty()


def test_crosswalk_view_shuffles_linked_facts_only(spark):
    """The fact side of a crosswalk view meets the program's ids before its exchange."""
    tables = {n: spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols))
              for n, (cols, rows) in _fixture().items()}
    spec = next(s for s in VIEWS if s.name == "DMR_FY2020_MVIEW")
    plan = build_view(spec, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan


def test_view_of_the_shared_dimension_shuffles_linked_facts_only(spark):
    tables = {n: spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols))
              for n, (cols, rows) in _fixture().items()}
    spec = next(s for s in VIEWS if s.name == "RCRA_VIOLATIONS_MVIEW")
    dim = joins.program_dimension(tables["EXP_PGM"], tables["ECHO_EXPORTER"], None, spec.side_columns("e"))
    view = build_view(spec, tables, shared_dim=dim)
    assert "bitmap_construct_agg" in view._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, view.collect())) == sorted(map(str, build_view(spec, tables, shared_dim=dim, broadcast_dim=True).collect()))


def test_packed_texts_come_back_as_they_were(spark):
    import itertools
    parts = [None, "", "a", "\x1d", "\x1e", "\x1f", "\x1d1", "\x1d3", "\x1e\x1f", "Zürich \U0001f3ed", "\x1d\x1d2\x1f"]
    rows = [(i, a, f"k{i}", b, 0.5 * i, c) for i, (a, b, c) in enumerate(itertools.product(parts, parts, parts[::2]))]
    df = spark.createDataFrame(rows, "n long, a string, key string, b string, x double, c string")
    packed, texts = joins.packed_texts(df, "key", "all__")
    assert packed.columns == ["n", "key", "x", "all__", "all___sizes"] and list(texts) == ["a", "b", "c"]
    back = packed.select(*[texts.get(c, joins.F.col(c)).alias(c) for c in df.columns])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("key", ["mview_case_enforcements", "mview_dmr_fy2022", "mview_air_inspections"])
def test_views_shuffle_each_side_with_its_texts_together(spark, key):
    """The big exchanges carry the key, numbers and the texts' bytes together, not every text by itself."""
    tables = {n: spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols)) for n, (cols, rows) in _fixture().items()}
    spec = next(s for s in VIEWS if s.key == key)
    view = build_view(spec, tables)
    join = view._jdf.queryExecution().optimizedPlan()
    while join.getClass().getSimpleName() != "Join":
        join = join.children().apply(0)
    for side, join_key in ((join.left(), spec.fact_key), (join.right(), joins.KEY)):
        fields = [side.schema().fields()[i] for i in range(side.schema().length())]
        assert len([f for f in fields if f.dataType().simpleString() == "string" and f.name() != join_key]) == 0, key


def test_a_session_without_broadcasts_gets_no_bitmaps(spark):
    tables = {n: spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols))
              for n, (cols, rows) in _fixture().items()}
    spec = next(s for s in VIEWS if s.name == "DMR_FY2022_MVIEW")
    name = "spark.sql.autoBroadcastJoinThreshold"
    filtered, limit = build_view(spec, tables), spark.conf.get(name)
    assert "bitmap_construct_agg" in filtered._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set(name, "-1")
    try:
        whole = build_view(spec, tables)
        assert "bitmap_construct_agg" not in whole._jdf.queryExecution().optimizedPlan().toString()
        assert "BroadcastExchange" not in whole._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, whole.collect())) == sorted(map(str, filtered.collect()))
    finally:
        spark.conf.set(name, limit)


def test_linked_rows_stay_selective_as_keys_grow(spark, monkeypatch):
    """A key to ten bits, as 26 million ids have: one bit a key would keep 9.5 % of the other rows."""
    monkeypatch.setattr(joins, "FILTER_BITS", 1 << 18)
    n = joins.FILTER_BITS // 10
    keys, fact = spark.range(n).selectExpr("CAST(id AS STRING) AS k__"), spark.range(3 * n).selectExpr("CAST(id AS STRING) AS k", "id")
    kept = {r.id for r in joins.linked_rows(fact, "k", keys).select("id").collect()}
    assert {*range(n)} <= kept and len(kept) < n + 0.03 * 2 * n
