import gzip
import io
import os
import tarfile
import zipfile

from faclake.sources.archives import expand_archives


def test_expand_archives(spark, tmp):
    src, dest = f"{tmp}/src", f"{tmp}/dest"
    os.makedirs(src)
    with zipfile.ZipFile(f"{src}/a.zip", "w") as z:
        z.writestr("A.csv", "x\n1\n")
        z.writestr("dir/B.csv", "x\n2\n")
        z.writestr("../evil.csv", "no")
    with tarfile.open(f"{src}/b.tar.gz", "w:gz") as t:
        data = b"x\n3\n"
        info = tarfile.TarInfo("C.csv")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    with gzip.open(f"{src}/D.csv.gz", "wb") as g:
        g.write(b"x\n4\n")
    with open(f"{src}/broken.zip", "wb") as f:
        f.write(b"not a zip")
    with open(f"{src}/notes.txt", "w") as f:
        f.write("skip")
    rep = {(os.path.basename(r.archive), r.member, r.status) for r in expand_archives(spark, src, dest).collect()}
    assert ("a.zip", "A.csv", "extracted") in rep and ("a.zip", "dir/B.csv", "extracted") in rep
    assert ("a.zip", "../evil.csv", "refused") in rep
    assert ("b.tar.gz", "C.csv", "extracted") in rep and ("D.csv.gz", "D.csv", "extracted") in rep
    assert ("broken.zip", None, "corrupt") in rep and ("notes.txt", None, "unsupported") in rep
    assert open(f"{dest}/dir/B.csv").read() == "x\n2\n"
    assert not os.path.exists(f"{tmp}/evil.csv")
    again = {r.status for r in expand_archives(spark, src, dest, skip_existing=True, pattern="*.gz").collect()}
    assert again == {"exists"}


def test_zip_members_are_separate_units(tmp):
    from faclake.sources.archives import _units
    with zipfile.ZipFile(f"{tmp}/m.zip", "w") as z:
        for i in range(3):
            z.writestr(f"part{i}.csv", "x\n1\n")
    with gzip.open(f"{tmp}/one.csv.gz", "wb") as g:
        g.write(b"x\n")
    assert sorted(m for _, m, _, _ in _units(f"file://{tmp}/m.zip", 99)) == ["part0.csv", "part1.csv", "part2.csv"]
    assert _units(f"file://{tmp}/one.csv.gz", 7) == [(f"file://{tmp}/one.csv.gz", None, "one.csv", 7)]


def test_a_corrupt_archive_leaves_nothing(spark, tmp):
    os.makedirs(f"{tmp}/in")
    whole = gzip.compress(os.urandom(1 << 20))
    with open(f"{tmp}/in/z.csv.gz", "wb") as f:
        f.write(whole[:len(whole) // 2])
    report = [r.status for r in expand_archives(spark, f"file://{tmp}/in", f"file://{tmp}/out").collect()]
    assert report == ["corrupt"] and not [x for _, _, names in os.walk(f"{tmp}/out") for x in names]
    with open(f"{tmp}/in/z.csv.gz", "wb") as f:
        f.write(whole)
    report = [r.status for r in expand_archives(spark, f"file://{tmp}/in", f"file://{tmp}/out", skip_existing=True).collect()]
    assert report == ["extracted"] and os.path.getsize(f"{tmp}/out/z.csv") == 1 << 20


def test_equal_names_of_two_archives_are_refused(spark, tmp):
    os.makedirs(f"{tmp}/in")
    for name in ("a", "b"):
        with zipfile.ZipFile(f"{tmp}/in/{name}.zip", "w") as z:
            z.writestr("same.csv", name)
            z.writestr(f"{name}.csv", name)
    report = sorted((r.member, r.status) for r in expand_archives(spark, f"file://{tmp}/in", f"file://{tmp}/out").collect())
    assert report == [("a.csv", "extracted"), ("b.csv", "extracted"), ("same.csv", "clash"), ("same.csv", "clash")]
    assert sorted(os.listdir(f"{tmp}/out")) == ["a.csv", "b.csv"]


def _tar(path, members):
    with tarfile.open(path, "w:gz") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def test_equal_names_in_streams_are_refused(spark, tmp):
    """Names inside a tar.gz are known late: still no member overwrites another."""
    os.makedirs(f"{tmp}/in d")
    _tar(f"{tmp}/in d/a.tar.gz", [("same.csv", b"a"), ("only/a.csv", b"a"), ("zipped.csv", b"t")])
    _tar(f"{tmp}/in d/b.tgz", [("./same.csv", b"b"), ("twice.csv", b"1"), ("twice.csv", b"2"), ("../out.csv", b"x")])
    with zipfile.ZipFile(f"{tmp}/in d/c.zip", "w") as z:
        z.writestr("zipped.csv", "z")
        z.writestr("c.csv", "c")
    with gzip.open(f"{tmp}/in d/same.csv.gz", "wb") as g:
        g.write(b"g")
    _tar(f"{tmp}/whole", [("half.csv", os.urandom(100_000))])
    with open(f"{tmp}/in d/half.tar.gz", "wb") as f:
        f.write(open(f"{tmp}/whole", "rb").read()[:50_000])
    report = expand_archives(spark, f"file://{tmp}/in d", f"file://{tmp}/out").collect()
    got = sorted((os.path.basename(r.archive), r.member or "", r.status) for r in report if "half" not in r.archive)
    assert got == [("a.tar.gz", "only/a.csv", "extracted"), ("a.tar.gz", "same.csv", "clash"), ("a.tar.gz", "zipped.csv", "clash"),
                   ("b.tgz", "../out.csv", "refused"), ("b.tgz", "./same.csv", "clash"), ("b.tgz", "twice.csv", "clash"),
                   ("b.tgz", "twice.csv", "clash"), ("c.zip", "c.csv", "extracted"), ("c.zip", "zipped.csv", "clash"),
                   ("same.csv.gz", "", "clash")]
    assert "corrupt" in {r.status for r in report if "half" in r.archive}
    assert sorted(os.listdir(f"{tmp}/out")) == ["c.csv", "only"] and open(f"{tmp}/out/only/a.csv").read() == "a"


def test_staged_members_are_published_once(tmp):
    from faclake.sources import archives as R
    import hashlib
    held = f"{tmp}/out/st/{hashlib.sha256(b'file:/x.tar.gz').hexdigest()[:32]}"
    os.makedirs(held)
    open(f"{held}/m.csv", "w").write("1")
    row = ("file:/x.tar.gz", "tar", "m.csv", "t", 1, "staged", None)
    for _ in range(2):                                        # a repeated task finds the member in place
        assert R._publish(row, f"file://{tmp}/out", "st", 1)[5] == "extracted"
    assert open(f"{tmp}/out/m.csv").read() == "1"
    os.remove(f"{tmp}/out/m.csv")
    assert R._publish(row, f"file://{tmp}/out", "st", 1)[5] == "corrupt"
