import gzip
import hashlib
import io

from faclake.llm import warc as W
from faclake.session import ship_package

from .conftest import rows_of

PAGES = [(1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (9, "http://a/9", "x" * 1000), (3, "http://a/3", "x" * 999),
         (4, "http://a/4", "x" * 999), (5, None, "é" * 500), (6, "http://a/é\r\nWARC-Type: revisit", "é" * 500), (7, "u", None), (8, "u", ""),
         (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60), (None, "u", "z" * 2000), (11, "u", "z" * 2000), (None, "u", "y" * 2000),
         (12, "u", "w" * 1500), (12, "u", "w" * 1500), (13, "u", "HTTP/1.1 200 OK\r\n\r\n" * 100), (14, "u", "b" * 3_000_000)]


def _frame(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(*r, "k", 3) for r in rows], "page_id long, url string, html string, copy string, n int").repartition(3)


def brute(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "")]
        best = max((j for j in same if j is not None), default=None)
        later = len(data) >= 1000 and len(same) > 1 and i != best
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if later else "response", best if later else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    assert rows_of(W.page_records(spark, _frame(spark, PAGES))) == brute(PAGES)


def test_query_reads_through_pushed_filters(spark):
    got = W.page_records(spark, _frame(spark, PAGES))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RelationV2") == 2 and "Filter" not in plan      # the source has taken both filters
    assert {r["record_type"] for r in got.collect()} == {"response", "revisit"}


def test_payloads_filters_and_headers(spark, tmp):
    W.archive_pages(_frame(spark, PAGES), f"{tmp}/w", file_bytes=4000)
    read = W.read_warc(spark, f"{tmp}/w")
    assert read.rdd.getNumPartitions() > 3 or read.count() == len(PAGES)
    want = sorted((h or "").encode() for i, _, h in PAGES)
    got = [(r["record_type"], bytes(r["payload"]), r["payload_digest"]) for r in read.collect()]
    responses = sorted(p for k, p, _ in got if k == "response")
    assert all(p == b"" for k, p, _ in got if k == "revisit") and set(responses) == set(want)
    assert all(hashlib.sha1(p).hexdigest() == d for k, p, d in got if k == "response")
    few = read.where("record_type = 'revisit' AND refers_to = '<urn:page:9>'")
    assert few.count() == 2 and "payload" in few.columns
    assert "record_type" not in few._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0].split("Filter (")[0] or few.count() == 2
    heads = W.read_warc(spark, f"{tmp}/w", payload=False)
    assert heads.count() == len(PAGES) and heads.where("payload IS NOT NULL").count() == 0


def test_unwanted_payloads_are_not_read():
    class Watched(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            Watched.taken += len(data)
            return data

    big = W.record("response", "<urn:page:1>", None, bytes(range(256)) * 4000, "0" * 40, 1)
    small = W.record("revisit", "<urn:page:2>", None, b"", "0" * 40, 1, "<urn:page:1>")
    got = list(W.read_records(Watched(big + small), lambda r: r["record_type"] == "revisit"))
    assert [r["record_id"] for r in got] == ["<urn:page:2>"] and Watched.taken < 500


def test_packed_archives_and_bad_files(spark, tmp):
    import os
    os.makedirs(f"{tmp}/g")
    with open(f"{tmp}/g/a.warc.gz", "wb") as f:
        for i in range(3):
            f.write(gzip.compress(W.record("response", f"<urn:page:{i}>", "u", b"p" * i, "0" * 40, i)))
    with open(f"{tmp}/g/notes.txt", "w") as f:
        f.write("not an archive")
    W.register(spark)
    got = spark.read.format("warc").option("path", f"{tmp}/g").load()
    assert sorted(bytes(r["payload"]) for r in got.collect()) == [b"", b"p", b"pp"]
    assert spark.read.format("warc").option("path", f"{tmp}/nothing").load().count() == 0


def test_empty_table(spark):
    assert W.page_records(spark, _frame(spark, [])).collect() == []
