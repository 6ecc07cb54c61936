"""Stored tables: overlapping writers, parts, limits, sizes, the query log."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from faclake.operators import query as Q
from faclake.operators.change import ManifestTable, manifest_upsert
from faclake.sources import footers
from faclake.sources.parts import PART, PartTable
from faclake.sources.tables import COMMITS, ConcurrentReplace, Files, Lake, first_rows


def _files(path):
    return {os.path.relpath(os.path.join(d, n), path): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


# ---- replace with several writers

def test_the_second_of_two_overlapping_writers_is_refused(spark, tmp):
    lake = Lake(spark, tmp)
    lake.write(spark.range(3), "T")
    with pytest.raises(ConcurrentReplace):
        with lake.replace("T") as slow:
            slow.write(spark.range(100))
            with lake.replace("T") as quick:
                quick.write(spark.range(7))
                # until one publishes, both versions are there and the old rows are the table
                assert lake.read("T").count() == 3 and slow.read().count() == 100 and quick.read().count() == 7
            assert lake.read("T").count() == 7 and slow.read().count() == 100
    assert lake.read("T").count() == 7
    assert len([x for x in os.listdir(lake.path("T")) if x.startswith("version-")]) == 2      # the loser's rows are gone
    lake.write(spark.range(5), "T")
    assert lake.read("T").count() == 5


def test_a_writer_that_slept_through_several_versions(spark, tmp):
    lake = Lake(spark, tmp)
    lake.write(spark.range(1), "T")
    with pytest.raises(ConcurrentReplace):
        with lake.replace("T") as slow:
            slow.write(spark.range(50))
            for n in (2, 3, 4, 5):          # commits after the one it began at are cleaned up meanwhile
                lake.write(spark.range(n), "T")
    assert lake.read("T").count() == 5


def test_a_free_number_below_the_last_commit_is_no_commit(spark, tmp):
    """A writer that looked before, and puts its commit after others' were cleaned up."""
    lake = Lake(spark, tmp)
    lake.write(spark.range(1), "T")
    commits = lake.commits("T")
    base = commits.head()
    for n in (2, 3, 4, 5):
        lake.write(spark.range(n), "T")
    assert base[0] + 1 not in commits.numbers()
    real, commits.head = commits.head, lambda: base
    with pytest.raises(ConcurrentReplace):
        commits.publish(base, {"version": "version-late"})
    commits.head = real
    assert lake.read("T").count() == 5 and base[0] + 1 not in commits.numbers()


def test_many_threads_publish_one_after_the_other(spark, tmp):
    lake, won, lost = Lake(spark, tmp), [], []

    def one(n):
        try:
            commits = Lake(spark, tmp).commits("T")
            commits.publish(commits.head(), {"version": f"version-{n}"})
            won.append(n)
        except ConcurrentReplace:
            lost.append(n)
    threads = [threading.Thread(target=one, args=(n,)) for n in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    numbers = lake.commits("T").numbers()
    assert len(won) + len(lost) == 12 and numbers == list(range(1, len(won) + 1))
    named = [lake.commits("T").state(n)["version"] for n in numbers]
    assert sorted(named) == sorted(f"version-{n}" for n in won)


def test_vacuum_removes_what_no_commit_names(spark, tmp):
    lake = Lake(spark, tmp)
    lake.write(spark.range(3), "T")
    spark.range(9).write.parquet(f"{lake.path('T')}/version-00000009-dead")
    assert lake.vacuum("T") == [] and lake.vacuum("T", hours=0) == ["version-00000009-dead"]
    assert lake.read("T").count() == 3


def test_a_plain_table_becomes_versions(spark, tmp):
    lake = Lake(spark, tmp)
    spark.range(4).write.parquet(lake.path("T"))
    assert lake.read("T").count() == 4
    lake.write(spark.range(5), "T")
    assert lake.read("T").count() == 5 and any(x.endswith(".parquet") for x in os.listdir(lake.path("T")))
    lake.write(spark.range(6), "T")
    assert lake.read("T").count() == 6 and not any(x.endswith(".parquet") for x in os.listdir(lake.path("T")))
    assert sorted(os.listdir(f"{lake.path('T')}/{COMMITS}"))[-1] == "00000002"


def test_put_if_absent(spark, tmp):
    files = Files(spark, tmp)
    assert files.put_if_absent("a/b", "one") and not files.put_if_absent("a/b", "two")
    assert files.read("a/b") == "one" and [n for n in files.names() if not n.endswith(".crc")] == ["a"]


# ---- limits

def test_first_rows(spark, tmp, capsys):
    lake = Lake(spark, tmp)
    lake.write(spark.range(1000).repartition(7), "T")
    df = lake.read("T")
    for n in (0, 1, 300, 999, 1000, 5000):
        assert first_rows(df, n).count() == min(n, 1000)
    some = first_rows(df, 300)
    assert sorted(some.collect()) == sorted(first_rows(df, 300).collect())            # the same rows every time
    first_rows(df, 300).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Limit" not in plan
    held = df.cache()
    assert first_rows(lake.read("T"), 10).count() == 10
    held.unpersist()
    assert first_rows(spark.range(9).where("id > 2"), 4).count() == 4                # not a stored table
    assert first_rows(df.where("id % 100 = 0"), 5).count() == 5                      # nor is a filtered one


# ---- parts: manifest in buckets

def _listing(spark, rows):
    return spark.createDataFrame(rows, "url string, last_modified string, size_mb string")


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp):
    table = ManifestTable(spark, f"{tmp}/m", buckets=16)
    first = _listing(spark, [(f"http://h/{i}", "2024-01-01 00:00", str(i)) for i in range(400)])
    assert len(table.upsert(first)) == 16
    before = _files(f"{tmp}/m")
    few = _listing(spark, [("http://h/7", "2024-02-01 00:00", "new"), ("http://h/new", "2024-02-01 00:00", "x")])
    touched = table.upsert(few)
    assert 1 <= len(touched) <= 2
    state = table.table.state()
    now = {p: f for p, f in state["parts"].items()}
    assert len(now) == 16 and {p for p, f in now.items() if f.startswith("version-00000002")} == set(touched)
    after = _files(f"{tmp}/m")
    kept = [f for f in before if any(f.startswith(folder + "/") for p, folder in now.items() if p not in touched)]
    assert len(kept) == 16 - len(touched) and all(after[f] == before[f] for f in kept)
    want = manifest_upsert(first, few)
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, want.select(*table.read().columns).collect()))
    table.upsert(few)                                                                 # a repeated upsert changes nothing
    assert table.read().count() == 401
    table.upsert(few.withColumn("note", F.lit("n")).where("url = 'http://h/new'"))    # a new column: NULL elsewhere
    assert table.read().where("note IS NOT NULL").count() == 1 and table.read().count() == 401


def test_overlapping_upserts(spark, tmp):
    table = ManifestTable(spark, f"{tmp}/m", buckets=4)
    table.upsert(_listing(spark, [(f"u{i}", "2024-01-01 00:00", "1") for i in range(20)]))
    with pytest.raises(ConcurrentReplace):
        with table.table.change() as change:
            old = change.read()
            change.put(old.withColumn(PART, F.lit(0)).limit(1), change.parts)
            table.upsert(_listing(spark, [("u3", "2024-03-01 00:00", "2")]))
    assert table.read().count() == 20 and table.read().where("url = 'u3'").first().size_mb == "2"
    assert table.upsert(_listing(spark, []).limit(0)) == []
    assert table.read().count() == 20


def test_a_part_without_rows_goes(spark, tmp):
    table = PartTable(spark, f"{tmp}/p")
    assert table.read() is None
    rows = spark.range(10).withColumn(PART, (F.col("id") % 3).cast("int"))
    with table.change() as change:
        change.put(rows, [0, 1, 2])
    with table.change() as change:
        change.put(rows.where("id = 1"), [1, 2])
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 3, 6, 9]
    assert set(table.state()["parts"]) == {"0", "1"}


# ---- query log

def _request(i, day=1):
    return {"id": f"r{i}", "ip_address": None, "timestamp": dt.datetime(2024, 1, day, 12, 0, i % 60), "table_name": "T",
            "query": f"SELECT {i}", "path": None, "result_key": f"k{i}"}


def test_the_log_stays_small_and_whole(spark, tmp):
    log = Q.QueryLog(spark, f"{tmp}/log", compact_every=100)
    for i in range(1000):
        log.append(_request(i, 1 + i % 3))
    files = [n for d, _, names in os.walk(f"{tmp}/log") for n in names if n.endswith((".json", ".parquet")) and not n.startswith(".")]
    assert len(files) <= 2 * 100 + 3 * 2
    rows = log.read()
    assert rows.count() == 1000 and rows.select("id").distinct().count() == 1000
    assert rows.where("id = 'r999'").first().timestamp == dt.datetime(2024, 1, 1, 12, 0, 39)
    assert len(log.days.state()["parts"]) == 3
    log.compact()
    assert log.read().count() == 1000


def test_appends_beside_a_compaction(spark, tmp):
    log = Q.QueryLog(spark, f"{tmp}/log", compact_every=0)
    for i in range(5):
        log.append(_request(i))
    listed = log.inbox.names()
    real = log.days.change

    def slow():                              # a request comes while the compaction runs
        log.append(_request(99))
        return real()
    log.days.change = slow
    assert log.compact() == 6 or log.read().count() == 6
    log.days.change = real
    assert sorted(r.id for r in log.read().collect()) == ["r0", "r1", "r2", "r3", "r4", "r99"]
    # a reader that listed the inbox before the compaction counts nothing twice
    state = log.days.state()
    assert log._waiting(state, listed) == []
    log.append(_request(100))
    assert log.compact() == 1 and log.read().count() == 7 and len(log.inbox.names()) < 7


# ---- sizes

def test_columns_of_many_texts_are_stored_as_differences(spark, tmp):
    """Columns of few values keep their dictionary, others take no more than their texts'
    differences; values of every type come back, and footers still tell the rows' size."""
    import pyarrow.parquet as pq
    from pathlib import Path
    n = 40_000
    rows = spark.range(n, numPartitions=1).selectExpr(
        "concat('CODE-', id % 9) AS few", "IF(id % 5 = 0, NULL, concat('Facility ', id * 7919 % 9973)) AS many",
        "concat('https://example.org/facility/', lpad(id, 12, '0')) AS link", "CAST(id * 7919 AS decimal(30, 4)) AS wide",
        "CAST(id * 7 AS decimal(9, 2)) AS narrow", "id * 8 + 3 AS long", "CAST(id % 100 AS byte) AS byte", "CAST(id AS float) / 7 AS float",
        "id / 7 AS double", "id % 3 = 0 AS flag", "timestamp_seconds(id * 977) AS at", "date_add(date'2024-01-01', CAST(id % 9000 AS int)) AS day",
        "CAST(concat('x', id) AS binary) AS bytes", "array(concat('a', id), NULL) AS list", "named_struct('k', concat('b', id)) AS part", "map(concat('m', id), id) AS pairs")
    lk = Lake(spark, tmp)
    lk.write(rows, "NEW")
    rows.write.option("compression", "zstd").parquet(f"{tmp}/files/OLD")
    file = next(Path(lk.location("NEW")).glob("*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    chunks = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in chunks["few"].encodings and "DELTA_BYTE_ARRAY" not in chunks["few"].encodings
    assert "DELTA_BYTE_ARRAY" in chunks["many"].encodings and "DELTA_BYTE_ARRAY" in chunks["link"].encodings
    assert lk.bytes("NEW") < 0.8 * lk.bytes("OLD")
    whole = lambda t: sorted(map(repr, lk.read(t).collect()))
    assert whole("NEW") == whole("OLD") == sorted(map(repr, rows.collect()))
    texts = ["few", "many", "link"]
    found = footers.memory_by_column(lk.read("NEW"), None, texts)[""]
    exact = {r["column"]: r["memory"] for r in footers.scanned(lk.read("NEW"), texts, None).collect()}
    assert all(exact[c] <= found[c] <= 2 * exact[c] for c in texts), (found, exact)


def test_footers_see_through_dictionaries(spark, tmp):
    """Long texts that repeat are tiny on disk and large in memory; plain numbers are
    the other way round.  A constant factor of the files' size is wrong for both."""
    n = 200_000
    wide = spark.range(n).select(F.concat(F.lit("x" * 400), (F.col("id") % 3).cast("string")).alias("s"))
    noise = spark.range(n).select(F.rand(1).alias("v"))
    sizes = {}
    for name, df in (("wide", wide), ("noise", noise)):
        df.coalesce(1).write.parquet(f"{tmp}/{name}")
        stored = spark.read.parquet(f"{tmp}/{name}")
        sizes[name] = (sum(os.path.getsize(os.path.join(tmp, name, f)) for f in os.listdir(f"{tmp}/{name}") if f.endswith(".parquet")),
                       footers.memory_bytes(stored))
        exact = {r["column"]: r["memory"] for r in footers.scanned(stored, stored.columns, None).collect()}
        assert 0.9 * sum(exact.values()) <= sizes[name][1] <= 2.5 * sum(exact.values())
    limit = 32 << 20
    assert sizes["wide"][0] * 20 < limit < sizes["wide"][1]          # twenty times the files: would be broadcast
    assert sizes["noise"][1] < sizes["noise"][0] * 20 and sizes["noise"][1] < limit / 8
    assert footers.memory_bytes(spark.range(3)) is None


def test_footers_by_partition_and_column(spark, tmp):
    path = f"{tmp}/a b"
    spark.range(1000).select((F.col("id") % 4).alias("p"), "id", F.lit("xyz").alias("t"), F.lit(None).cast("string").alias("none"),
                             F.array(F.col("id"), F.col("id")).alias("l")).write.partitionBy("p").parquet(path)
    df = spark.read.parquet(path)
    got = footers.memory_by_column(df, "p")
    assert set(got) == {"0", "1", "2", "3"} and set(got["0"]) == {"id", "t", "none", "l"}
    assert got["1"]["id"] == 250 * 8 and got["1"]["l"] == 500 * 8
    assert footers.memory_bytes(df, ["id"]) == 8000
    by_scan = {(r.part, r["column"]): r.memory for r in footers.scanned(df, ["id", "t"], "p").collect()}
    assert by_scan[("1", "id")] == 250 * 8 and by_scan[("1", "t")] == 250 * 11


# ---- hot tables

def test_hot_tables_keep_to_their_bound(spark, tmp):
    lake, hot = Lake(spark, tmp), Q.HotTables()
    assert hot.bound(spark) > 1 << 20
    spark.conf.set("faclake.hotTables.maxBytes", "77")
    assert hot.bound(spark) == 77
    spark.conf.unset("faclake.hotTables.maxBytes")
    for name, n in (("A", 1000), ("B", 1000), ("BIG", 100_000)):
        lake.write(spark.range(n), name)
    one = footers.memory_bytes(lake.read("A"))
    hot.max_bytes = one + one // 2
    assert hot.get(lake, "A", lake.read("A")).storageLevel.useMemory and hot.held() == [lake.path("A")]
    assert hot.get(lake, "B", lake.read("B")).count() == 1000 and hot.held() == [lake.path("B")]     # A made room
    assert not lake.read("A").storageLevel.useMemory
    big = hot.get(lake, "BIG", lake.read("BIG"))
    assert not big.storageLevel.useMemory and big.count() == 100_000 and hot.held() == [lake.path("B")]
    hot.max_bytes = 2 * one
    hot.get(lake, "A", lake.read("A"))
    hot.get(lake, "B", lake.read("B"))
    assert hot.held() == [lake.path("A"), lake.path("B")]
    hot.release()
    assert hot.held() == []


def test_a_running_result_is_no_hit_and_is_waited_for(spark, tmp):
    lake = Lake(spark, f"{tmp}/lake")
    lake.write(spark.range(50), "T")
    store = Q.ResultStore(spark, f"{tmp}/store")
    key = Q.result_key("T", None, "SELECT count(*) AS n FROM T", lake.version("T"))
    spark.range(1).write.parquet(f"{store.path(key)}/version-00000001-unfinished")        # of a driver that died
    assert store.get(key) is None
    hits = []

    def ask():
        df, hit = Q.cached_query(spark, lake, store, f"{tmp}/log", "T", "SELECT count(*) AS n FROM T")
        hits.append((df.first().n, hit))
    threads = [threading.Thread(target=ask) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(hits) == [(50, False)] + [(50, True)] * 3
    assert Q.read_log(spark, f"{tmp}/log").count() == 1 and not Q.ResultStore._locks
    assert json.dumps(store.lake.commits(key).numbers()) == "[1]"
