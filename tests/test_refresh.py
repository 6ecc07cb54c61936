"""Refresh end to end through a lake, and plan properties of the views."""

import pytest

from faclake.plans import refresh as R
from faclake.plans.views import VIEWS, VIEWS_BY_NAME, build_view, sql_text
from faclake.sources.tables import Lake

from .test_views import _fixture


FACILITY_DDL = ("REGISTRY_ID string, FAC_NAME string, FAC_STREET string, FAC_CITY string, FAC_STATE string, "
                "FAC_ZIP string, FAC_COUNTY string, FAC_EPA_REGION string, FAC_LAT double, FAC_LONG double, "
                "FAC_DERIVED_HUC string, FAC_DERIVED_WBD string, FAC_DERIVED_CD113 string, "
                "FAC_PERCENT_MINORITY double, FAC_POP_DEN double, DFR_URL string, FAC_SIC_CODES string, "
                "FAC_NAICS_CODES string, AIR_FLAG string, NPDES_FLAG string, SDWIS_FLAG string, RCRA_FLAG string, "
                "AIR_IDS string, NPDES_IDS string, RCRA_IDS string, SDWA_IDS string")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    lk = Lake(spark, root)
    raw = _fixture()
    for name, (cols, rows) in raw.items():
        if name in ("ECHO_EXPORTER", "EXP_PGM"):
            continue
        lk.write(spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols)), name)
    fac = []
    for i in range(3):
        base = [f"R{i + 1}"] + [f"F{i}-{j}" for j in range(7)] + [float(i), float(i)] + \
               [f"H{i}", f"W{i}", f"C{i}", float(i), float(i), f"U{i}", f"S{i}", f"N{i}"]
        ids = {0: "K1", 1: "K1 K2", 2: "K3"}[i]
        fac.append(tuple(base + ["Y", "Y", "Y", "Y", ids, ids, ids, ids]))
    fac.append(tuple([None] + [None] * 17 + ["Y"] * 4 + ["K9"] * 4))
    lk.write(spark.createDataFrame(fac, FACILITY_DDL), "ECHO_EXPORTER")
    return lk


def test_refresh_rebuilds_crosswalk_and_all_views(spark, lake):
    rep = {r.name: r for r in R.refresh_views(spark, lake, VIEWS, parallel=4).collect()}
    assert rep["EXP_PGM"].status == "ok" and rep["EXP_PGM"].source_rows == 16
    assert all(rep[v.name].status in ("ok", "empty") for v in VIEWS), rep
    air = lake.read("AIR_COMPLIANCE_MVIEW")
    assert air.columns == [n for _, n in VIEWS_BY_NAME["AIR_COMPLIANCE_MVIEW"].output()]
    # K1 twice in the fact -> facilities R1 and R2; K2 -> R2; K3 -> R3
    assert air.count() == 6
    # idempotent: a second refresh gives the same rows
    before = sorted(map(tuple, air.collect()), key=repr)
    R.refresh_views(spark, lake, VIEWS, parallel=2).collect()
    assert sorted(map(tuple, lake.read("AIR_COMPLIANCE_MVIEW").collect()), key=repr) == before


def test_sql_text_definitions_match_specs(spark, lake):
    R.refresh_views(spark, lake, VIEWS).collect()
    defs = {f"SQL_{v.name}": {"statements": [sql_text(v)], "tables": v.tables} for v in VIEWS}
    rep = {r.name: r for r in R.refresh_sql_views(spark, lake, defs).collect()}
    for v in VIEWS:
        got = sorted(map(tuple, lake.read(f"SQL_{v.name}").collect()), key=repr) if rep[f"SQL_{v.name}"].source_rows else []
        assert got == sorted(map(tuple, lake.read(v.name).collect()), key=repr), v.name


def test_failed_view_is_reported_not_raised(spark, lake):
    bad = VIEWS_BY_NAME["AIR_COMPLIANCE_MVIEW"].__class__(
        "BROKEN_MVIEW", "x", "NO_SUCH_TABLE", "K", "f.K, e.FAC_NAME", program="AIR_IDS")
    rep = R.refresh_views(spark, lake, [bad], rebuild=False).collect()
    assert rep[0].status == "failed" and "NO_SUCH_TABLE" in rep[0].message


def _plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_view_plan_prunes_and_pushes(spark, lake, capsys):
    R.refresh_views(spark, lake, VIEWS).collect()
    spec = VIEWS_BY_NAME["DMR_FY2020_MVIEW"]
    tables = {t: lake.read(t) for t in spec.tables}
    dim = lake.read(R.DIMENSION)
    plan = _plan(build_view(spec, tables, shared_dim=dim, broadcast_dim=True), capsys)
    # the 57-column fact is read with only the view's 28 columns
    fact_schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema") and "EXTERNAL_PERMIT_NMBR" in ln][0]
    assert "VERSION_NMBR" not in fact_schema and "RNC_RESOLUTION_DATE" not in fact_schema
    assert "IsNotNull(EXTERNAL_PERMIT_NMBR)" in plan          # null keys filtered at the scan
    assert "PartitionFilters: [isnotnull(PGM" in plan and "NPDES_IDS" in plan   # one program's files
    assert "BroadcastHashJoin" in plan and "hashpartitioning(EXTERNAL_PERMIT_NMBR" not in plan  # fact not shuffled
    # without the measured broadcast and with broadcasting off, it is one shuffle join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(build_view(spec, tables, shared_dim=dim), capsys)
        assert "SortMergeJoin" in plan and plan.count("Arguments: hashpartitioning(") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")


def test_broadcast_is_measured(spark, lake):
    R.refresh_views(spark, lake, VIEWS).collect()
    assert lake.bytes(R.DIMENSION, "PGM=AIR_IDS") > 0
    assert lake.bytes(R.DIMENSION, "PGM=NONE") is None and lake.bytes("NOPE") is None
    sizes = R.dimension_sizes(lake)
    assert set(sizes) == {"AIR_IDS", "NPDES_IDS", "RCRA_IDS", "SDWA_IDS"} and set(sizes["AIR_IDS"]) == set(lake.read(R.DIMENSION).columns) - {"PGM"}
    # an unmeasured dimension is not broadcast by hint
    spec = next(s for s in VIEWS if s.program == "AIR_IDS")
    seen = []
    real, R.build_view = R.build_view, lambda *a, **k: (seen.append(k["broadcast_dim"]), real(*a, **k))[1]
    try:
        small = R.view_dimension_bytes(spec, sizes)
        assert 0 < small < sum(sizes["AIR_IDS"].values()) + 1 and R.view_dimension_bytes(spec, {}) is None
        for known in (None, small, 1 << 40):
            R.materialise_view(lake, spec, lake.read(R.DIMENSION), dim_bytes=known)
    finally:
        R.build_view = real
    assert seen == [False, True, False]
    # table versions: partitioned tables included, internal tables ("_" prefix) not
    versions = R.table_versions(lake)
    assert {"EXP_PGM", "ECHO_EXPORTER", "AIR_COMPLIANCE_MVIEW"} <= set(versions)
    assert R.DIMENSION not in versions


def test_salting_spreads_a_hot_key(spark):
    from faclake.operators.joins import salted_join
    fact = spark.createDataFrame([("HOT", i) for i in range(300)] + [(f"k{i}", i) for i in range(30)],
                                 "key string, v long")
    dim = spark.createDataFrame([("HOT", "a"), ("HOT", "b"), ("k1", "c")], "k__ string, x string")
    plain = sorted(map(tuple, fact.join(dim, fact.key == dim.k__).collect()))
    salted = salted_join(fact, "key", dim, hot_fraction=0.25, buckets=8)
    assert sorted(map(tuple, salted.collect())) == plain
    # the hot key's rows spread over several salts
    from pyspark.sql import functions as F
    spread = (fact.where("key = 'HOT'").select(F.pmod(F.xxhash64("key", "v"), F.lit(8)).alias("s"))
              .distinct().count())
    assert spread == 8


def test_filtered_views_reuse_the_stored_base(spark, lake):
    names = ("COMBINED_AIR_EMISSIONS_MVIEW", "GREENHOUSE_GASES_MVIEW", "TOXIC_RELEASES_MVIEW")
    specs = [VIEWS_BY_NAME[n] for n in names]
    R.refresh_views(spark, lake, specs, rebuild=False, reuse_views=False).collect()
    direct = {n: sorted(map(tuple, lake.read(n).collect()), key=repr) for n in names}
    rep = {r.name: r for r in R.refresh_views(spark, lake, specs, rebuild=False).collect()}
    for n in names:
        assert sorted(map(tuple, lake.read(n).collect()), key=repr) == direct[n]
        assert rep[n].source_rows == len(direct[n])
    assert direct["GREENHOUSE_GASES_MVIEW"] and direct["TOXIC_RELEASES_MVIEW"]


def test_bucketed_dimension_shuffles_only_the_fact(spark, lake, capsys):
    spec = VIEWS_BY_NAME["SDWA_VIOLATIONS_MVIEW"]
    R.refresh_views(spark, lake, [spec]).collect()
    plain = sorted(map(tuple, lake.read(spec.name).collect()), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rep = R.refresh_views(spark, lake, [spec], rebuild=False, dimension_buckets=8).collect()
        assert rep[0].status == "ok"
        assert sorted(map(tuple, lake.read(spec.name).collect()), key=repr) == plain
        dim = spark.table(R.dimension_table(lake))
        plan = _plan(build_view(spec, {t: lake.read(t) for t in spec.tables}, shared_dim=dim), capsys)
        assert "SortMergeJoin" in plan and plan.count("Arguments: hashpartitioning(") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")


def test_missing_crosswalk_is_reported_per_view(spark, tmp):
    empty = Lake(spark, f"{tmp}/empty-lake")
    rep = R.refresh_views(spark, empty, [VIEWS_BY_NAME["AIR_COMPLIANCE_MVIEW"]], rebuild=False).collect()
    assert rep[0].status == "failed"


def test_runtime_bloom_filter_prefilters_the_fact(spark, lake, capsys):
    spec = VIEWS_BY_NAME["SDWA_VIOLATIONS_MVIEW"]
    R.refresh_views(spark, lake, [spec]).collect()
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        dim = lake.read(R.DIMENSION)
        df = build_view(spec, {t: lake.read(t) for t in spec.tables}, shared_dim=dim)
        plan = _plan(df, capsys)
        assert "might_contain" in plan and "bloom_filter_agg" in plan
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, lake.read(spec.name).collect()), key=repr)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_only_changed_views_are_refreshed(spark, tmp):
    from pyspark.sql import functions as F
    lk = Lake(spark, f"{tmp}/inc-lake")
    raw = _fixture()
    for name, (cols, rows) in raw.items():
        lk.write(spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols)), name)
    specs = [VIEWS_BY_NAME[n] for n in ("AIR_COMPLIANCE_MVIEW", "RCRA_VIOLATIONS_MVIEW",
                                         "COMBINED_AIR_EMISSIONS_MVIEW", "TOXIC_RELEASES_MVIEW")]
    first = {r.name: r.status for r in R.refresh_views(spark, lk, specs, rebuild=False, only_changed=True).collect()}
    assert all(v in ("ok", "empty") for v in first.values()), first
    again = {r.name: r.status for r in R.refresh_views(spark, lk, specs, rebuild=False, only_changed=True).collect()}
    assert set(again.values()) == {"unchanged"}, again
    # a new version of one fact table: only its view is rebuilt
    lk.write(lk.read("RCRA_VIOLATIONS").withColumn("ACTIVITY_LOCATION", F.lit("X")), "RCRA_VIOLATIONS_NEW")
    lk.write(lk.read("RCRA_VIOLATIONS_NEW"), "RCRA_VIOLATIONS")
    third = {r.name: r.status for r in R.refresh_views(spark, lk, specs, rebuild=False, only_changed=True).collect()}
    assert third["RCRA_VIOLATIONS_MVIEW"] == "ok"
    assert {k: v for k, v in third.items() if k != "RCRA_VIOLATIONS_MVIEW"} == {
        "AIR_COMPLIANCE_MVIEW": "unchanged", "COMBINED_AIR_EMISSIONS_MVIEW": "unchanged",
        "TOXIC_RELEASES_MVIEW": "unchanged"}
    assert {r.ACTIVITY_LOCATION for r in lk.read("RCRA_VIOLATIONS_MVIEW").collect()} == {"X"}


def test_a_lake_below_a_files_folder_sees_changes(spark, tmp):
    lake = Lake(spark, f"{tmp}/files/lake")
    for name in ("A", "B"):
        lake.write(spark.range(3), name)
    first = R.table_versions(lake)
    assert set(first) == {"A", "B"}
    lake.write(spark.range(4), "A")
    second = R.table_versions(lake)
    assert second["A"] != first["A"] and second["B"] == first["B"]
    assert R._signature(["A", "X"], second) != R._signature(["A", "X"], second)


def test_a_failed_replacement_keeps_the_table(spark, tmp):
    import os

    import pytest
    from faclake.sources.tables import TableNotFound
    lake = Lake(spark, tmp)
    os.makedirs(lake.path("T"))
    assert not lake.exists("T")                     # an empty folder is no table
    with pytest.raises(ValueError):
        with lake.replace("T") as new:
            new.write(spark.range(9))
            raise ValueError("check failed")
    with pytest.raises(TableNotFound):
        lake.read("T")
    lake.write(spark.range(5), "T")
    old = lake.read("T")
    with pytest.raises(ValueError):
        with lake.replace("T") as new:
            new.write(spark.range(9))
            raise ValueError("check failed")
    assert lake.read("T").count() == 5
    lake.write(spark.range(7), "T")
    assert lake.read("T").count() == 7 and old.count() == 5     # an open reader keeps its version
    lake.write(spark.range(8), "T")
    assert len([x for x in os.listdir(lake.path("T")) if x.startswith("version-")]) == 2


def test_hot_keys_in_one_pass(spark):
    from faclake.operators.joins import hot_keys
    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 30 + [(None,)] * 40 + [(f"k{i}",) for i in range(20)], "k string")
    assert hot_keys(df, "k", 1 / 4) == ["a", "b"] and hot_keys(df, "k", 0.9) == [] and hot_keys(df.limit(0), "k") == []


def test_a_failed_bucketed_dimension_keeps_the_old_one(spark, lake, monkeypatch):
    spec = VIEWS_BY_NAME["SDWA_VIOLATIONS_MVIEW"]
    R.refresh_views(spark, lake, [spec], dimension_buckets=4).collect()
    rows = lake.read(R.DIMENSION).count()
    assert spark.table(R.dimension_table(lake)).count() == rows > 0
    from pyspark.sql import functions as F
    real = R.J.program_dimension
    monkeypatch.setattr(R.J, "program_dimension", lambda *a: real(*a).where(F.raise_error(F.lit("stop")).isNull()))
    with pytest.raises(Exception, match="stop"):
        R.write_dimension(lake, [spec], 4)
    monkeypatch.undo()
    assert lake.read(R.DIMENSION).count() == rows and spark.table(R.dimension_table(lake)).count() == rows
    R.write_dimension(lake, [spec], 4)
    R.write_dimension(lake, [spec], 4)
    database = R.dimension_table(lake).split(".")[0]
    assert spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").count() == 2 and lake.read(R.DIMENSION).count() == rows


def test_a_change_of_one_program_rebuilds_its_views_only(spark, tmp):
    from pyspark.sql import functions as F
    lk = Lake(spark, f"{tmp}/programs")
    raw = _fixture()
    for name, (cols, rows) in raw.items():
        if name not in ("ECHO_EXPORTER", "EXP_PGM"):
            lk.write(spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols)), name)
    fac = [tuple([f"R{i}"] + ["x"] * 7 + [1.0, 1.0] + ["h"] * 3 + [1.0, 1.0] + ["u"] * 3 + ["Y"] * 4 + [f"K{i}"] * 4) for i in range(1, 4)]
    lk.write(spark.createDataFrame(fac, FACILITY_DDL), "ECHO_EXPORTER")
    names = ("AIR_COMPLIANCE_MVIEW", "RCRA_VIOLATIONS_MVIEW", "SDWA_VIOLATIONS_MVIEW", "COMBINED_AIR_EMISSIONS_MVIEW")
    specs = [VIEWS_BY_NAME[n] for n in names]
    status = lambda: {r.name: r.status for r in R.refresh_views(spark, lk, specs, only_changed=True).collect()}
    first = status()
    assert set(first) == {*names, "EXP_PGM"} and all(v in ("ok", "empty") for v in first.values()), first
    assert set(status().values()) == {"unchanged"}
    # one facility loses its hazardous-waste id: a new facility table, one changed program
    changed = lk.read("ECHO_EXPORTER").withColumn("RCRA_IDS", F.when(F.col("REGISTRY_ID") == "R2", "K9").otherwise(F.col("RCRA_IDS")))
    lk.write(changed, "TMP")
    lk.write(lk.read("TMP"), "ECHO_EXPORTER")
    again = status()
    rebuilt = {n for n, s in again.items() if s != "unchanged"}
    # the emissions view reads the facility table itself
    assert rebuilt == {"EXP_PGM", "RCRA_VIOLATIONS_MVIEW", "COMBINED_AIR_EMISSIONS_MVIEW"}, again
    direct = build_view(VIEWS_BY_NAME["RCRA_VIOLATIONS_MVIEW"], {t: lk.read(t) for t in VIEWS_BY_NAME["RCRA_VIOLATIONS_MVIEW"].tables})
    assert sorted(map(tuple, lk.read("RCRA_VIOLATIONS_MVIEW").collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_empty_ids_can_be_left_out(spark, tmp):
    lk = Lake(spark, f"{tmp}/empty-ids")
    fac = [tuple([f"R{i}"] + ["x"] * 7 + [1.0, 1.0] + ["h"] * 3 + [1.0, 1.0] + ["u"] * 3 + ["Y"] * 4 + [ids] * 4)
           for i, ids in enumerate(["A  B", "", " C", None, "D"])]
    lk.write(spark.createDataFrame(fac, FACILITY_DDL), "ECHO_EXPORTER")
    R.rebuild_crosswalk(lk)
    kept = R.write_dimension(lk).where("PGM = 'AIR_IDS'")
    assert kept.where("k__ = ''").count() > 0
    few = R.write_dimension(lk, skip_empty_ids=True).where("PGM = 'AIR_IDS'")
    assert sorted(r.k__ for r in few.collect()) == ["A", "B", "C", "D"]


def test_stored_files_are_compressed_in_any_session(spark, tmp):
    import pyarrow.parquet as pq
    from pathlib import Path
    session = spark.newSession()
    session.conf.set("spark.sql.parquet.compression.codec", "snappy")
    lk = Lake(session, tmp)
    lk.write(session.range(100), "T")
    lk.write(session.range(100), "T", mode="append")
    files = [*Path(lk.location("T")).glob("*.parquet")]
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_sql_view_drops_unlinked_facts_before_their_shuffle(spark, tmp, monkeypatch):
    """The view's own session filters the fact by its program's ids; the caller's keeps its settings."""
    lk, plans = Lake(spark, tmp), []
    for name, (cols, rows) in _fixture().items():
        if name in ("ECHO_EXPORTER", "EXP_PGM", "ICIS-AIR_FCES_PCES"):
            lk.write(spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in cols)), name)
    before = {k: spark.conf.get(k, None) for k in R.SQL_VIEW_CONF}
    monkeypatch.setitem(R.SQL_VIEW_CONF, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    monkeypatch.setitem(R.SQL_VIEW_CONF, "spark.sql.autoBroadcastJoinThreshold", "-1")
    write = Lake.write
    monkeypatch.setattr(Lake, "write", lambda self, df, *a, **k: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(self, df, *a, **k)))
    spec = VIEWS_BY_NAME["AIR_COMPLIANCE_MVIEW"]
    rec = R.run_sql_view(spark, lk, spec.name, [sql_text(spec)], spec.tables)
    assert rec.status == "ok" and "might_contain" in plans[-1], rec
    assert {k: spark.conf.get(k, None) for k in before} == before


def test_a_refresh_leaves_no_shuffle_files(spark, lake):
    import time
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}
    before, limit = shuffles(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        R.refresh_views(spark, lake, VIEWS[:3], broadcast_max_bytes=1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for _ in range(50):                              # files are removed after the statement, in the background
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(R.FREE_SHUFFLES, None) is None


def test_the_changed_facility_is_made_from_the_stored_one(spark, monkeypatch):
    from faclake.workload import catalog

    from .conftest import SF_SMALL
    plans, write = [], Lake.write

    def kept(self, df, name, *args, **options):
        if name == "ECHO_EXPORTER":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(self, df, name, *args, **options)
    monkeypatch.setattr(Lake, "write", kept)
    catalog.QUERIES["refresh_one_program"](spark, SF_SMALL)
    assert ["Aggregate" in p for p in plans] == [True, False]


def test_one_program_refresh_keeps_every_link(spark, monkeypatch):
    """Each facility's list holds all its ids, not those of one block of orders: the first
    refresh stores the whole crosswalk and whole views, the second loses the changed links only."""
    from faclake.workload import adapters as A
    from faclake.workload import catalog

    from .conftest import SF_SMALL
    seen, refresh = [], R.refresh_views

    def kept(spark, lake, specs, **options):
        report = refresh(spark, lake, specs, **options)
        seen.append(({tuple(r) for r in lake.read("EXP_PGM").select("PGM", "REGISTRY_ID", "PGM_ID").collect()},
                     {s.name: lake.read(s.name).count() for s in specs}, lake.read("ECHO_EXPORTER").count()))
        return report
    monkeypatch.setattr(R, "refresh_views", kept)
    catalog.QUERIES["refresh_one_program"](spark, SF_SMALL)
    links = {tuple(r) for r in A.crosswalk(spark, SF_SMALL).select("PGM", "REGISTRY_ID", "PGM_ID").collect()}
    left = {x for x in links if x[0] != "RCRA_IDS" or int(x[1]) % 2 == 0}
    assert left < links and [s[0] for s in seen] == [links, left]
    assert {s[2] for s in seen} == {A.facility(spark, SF_SMALL).count()}
    for name in seen[0][1]:
        spec = VIEWS_BY_NAME[name]
        whole = build_view(spec, A.view_tables(spark, SF_SMALL, spec.tables)).count()
        assert seen[0][1][name] == whole > 0
        assert (seen[1][1][name] < whole) == (name == "RCRA_VIOLATIONS_MVIEW")


@pytest.mark.parametrize("sql", [True, False])
def test_large_views_run_one_at_a_time(spark, lake, monkeypatch, sql):
    """Views that together read more than the room has do not lie on disk together, in a
    refresh of either kind; small ones run side by side.  Every view is made and reported in order."""
    import threading
    import time
    lock, now, most = threading.Lock(), set(), []
    real = getattr(R, name := "run_sql_view" if sql else "materialise_view")

    def run(*args, **options):
        with lock:
            now.add(threading.get_ident())
            most.append(len(now))
        try:
            time.sleep(0.3)
            return real(*args, **options)
        finally:
            with lock:
                now.discard(threading.get_ident())
    monkeypatch.setattr(R, name, run)
    R.rebuild_crosswalk(lake)
    specs = [v for v in VIEWS if v.shape != "crosswalk" and not v.fact_filter] + [v for v in VIEWS if v.program == "AIR_IDS"][:1]
    defs = {f"SQL_{v.name}": {"statements": [sql_text(v)], "tables": v.tables} for v in specs}
    refresh = (lambda: R.refresh_sql_views(spark, lake, defs)) if sql else (lambda: R.refresh_views(spark, lake, specs))
    room, at_once = R.Room, []
    for limit in (1, 256 << 20):
        monkeypatch.setattr(R, "Room", lambda lk, n=limit: room(lk, n))
        most.clear()
        report = [(r.name, r.status) for r in refresh().collect() if r.name != "EXP_PGM"]
        assert report == [(n, "ok") for n in (defs if sql else [s.name for s in specs])]
        at_once.append(max(most))
    assert at_once[0] == 1 < at_once[1]
