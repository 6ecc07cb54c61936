from faclake.operators.change import manifest_diff, manifest_upsert, tracker_status

M = "url string, link string, last_modified string, size_mb string, file_location string"
L = "url string, link string, last_modified string, size_mb string"


def test_manifest_diff_statuses(spark):
    manifest = spark.createDataFrame([
        ("u1", "u1", "2024-01-01 10:00", "1.00", "a"), ("u2", "u2", "2024-01-01 10:00", "1.00", "b"),
        ("u4", "u4", None, None, None), ("u5", "u5", "2024-01-01 10:00", "1.00", "e")], M)
    listing = spark.createDataFrame([
        ("u1", "u1", "2024-01-01 10:00", "1.00"), ("u2", "u2", "2024-01-01 10:01", "1.00"),
        ("u3", "u3", "2024-01-02 00:00", "2.00"), ("u4", "u4", "2024-01-02 00:00", "2.00"),
        ("u5", "u5", None, "1.00")], L)
    got = {r.url: (r.status, r.to_fetch) for r in manifest_diff(listing, manifest).collect()}
    assert got == {"u1": ("unchanged", False), "u2": ("updated", True), "u3": ("new", True),
                   "u4": ("new", True), "u5": ("unknown", False)}


def test_manifest_upsert_merge_and_replace(spark):
    manifest = spark.createDataFrame([("u1", "l1", "t1", "1", "loc1"), ("u2", "l2", "t2", "2", "loc2")], M)
    updates = spark.createDataFrame([("u2", "l2b", "t2b", None), ("u3", "l3", "t3", "3")], L)
    merged = {r.url: tuple(r)[1:] for r in manifest_upsert(manifest, updates).collect()}
    assert merged == {"u1": ("l1", "t1", "1", "loc1"), "u2": ("l2b", "t2b", None, "loc2"),
                      "u3": ("l3", "t3", "3", None)}
    replaced = {r.url: tuple(r)[1:] for r in manifest_upsert(manifest, updates, mode="replace").collect()}
    assert replaced["u2"] == ("l2b", "t2b", None, None) and replaced["u1"] == ("l1", "t1", "1", "loc1")


def test_tracker_status(spark):
    tracker = spark.createDataFrame([("https://x/d/a.zip",), ("https://x/d/b.zip?x=1",)], "download_link string")
    archive = spark.createDataFrame([("a.zip",)], "file_name string")
    got = {r.remote_name: r.status for r in tracker_status(tracker, archive).collect()}
    assert got == {"a.zip": "present", "b.zip": "missing"}


def test_repeated_keys_count_once(spark):
    manifest = spark.createDataFrame([("u", "l", "2024-01-01 10:00", "1.00", "old"), ("u", "l", "2024-02-01 10:00", "2.00", "new"),
                                      ("v", "l", "2024-01-01 10:00", "1.00", "v")], M)
    updates = spark.createDataFrame([("u", "l", "2024-03-02 10:00", "4.00"), ("u", "l", "2024-03-01 10:00", "3.00"),
                                     ("w", "l", "garbled", "5.00")], L)
    once = manifest_upsert(manifest, updates)
    want = [("u", "l", "2024-03-02 10:00", "4.00", "new"), ("v", "l", "2024-01-01 10:00", "1.00", "v"), ("w", "l", "garbled", "5.00", None)]
    assert sorted(map(tuple, once.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, manifest_upsert(once, updates).collect()), key=str) == sorted(want, key=str)
    assert [r.status for r in manifest_diff(updates.where("url = 'u'").limit(1), manifest).collect()] == ["updated"]
