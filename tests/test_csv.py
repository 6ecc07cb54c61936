from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from faclake.sources.csv import CORRUPT, header_drift, scan_csv

SCHEMA = StructType([StructField("A", StringType()), StructField("B", IntegerType()),
                     StructField("C", DoubleType())])


def _write(tmp, name, text):
    path = f"{tmp}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_binds_by_position_not_header(spark, tmp):
    p = _write(tmp, "x.csv", "B,A,C\nfoo,1,2.5\n")
    r = scan_csv(spark, p, SCHEMA).collect()
    assert [tuple(x) for x in r] == [("foo", 1, 2.5)]
    drift = {(x.header_name, x.declared_name, x.same) for x in header_drift(spark, p, SCHEMA).collect()}
    assert drift == {("B", "A", False), ("A", "B", False), ("C", "C", True)}


def test_permissive_values_and_row_shapes(spark, tmp):
    p = _write(tmp, "y.csv", "A,B,C\nok,1,1.5\nbad,notanint,x\nshort,2\nlong,3,3.5,extra\nempty,,\n")
    rows = [tuple(x) for x in scan_csv(spark, p, SCHEMA).collect()]
    assert rows == [("ok", 1, 1.5), ("bad", None, None), ("short", 2, None), ("long", 3, 3.5),
                    ("empty", None, None)]
    bad = scan_csv(spark, p, SCHEMA, keep_corrupt=True).cache()
    assert bad.where(f"{CORRUPT} IS NOT NULL").count() >= 1


def test_quotes_and_multiline(spark, tmp):
    p = _write(tmp, "q.csv", 'A,B,C\n"a ""q"" b",1,1.0\n"two\nlines",2,2.0\n')
    raw = [x.A for x in scan_csv(spark, p, SCHEMA).collect()]
    assert raw[0] == '"a ""q"" b"'        # default escape (backslash): the field stays raw
    assert len(raw) == 3                   # the embedded newline splits the row
    rfc = [x.A for x in scan_csv(spark, p, SCHEMA, rfc_quotes=True, multiline=True).collect()]
    assert rfc == ['a "q" b', "two\nlines"]


def test_booleans_accept_true_false_only(spark, tmp):
    schema = StructType([StructField("F", BooleanType())])
    p = _write(tmp, "b.csv", "F\ntrue\nfalse\nt\n1\n")
    assert [x.F for x in scan_csv(spark, p, schema).collect()] == [True, False, None, None]


def test_boolean_token_map(spark, tmp):
    schema = StructType([StructField("F", BooleanType()), StructField("A", StringType())])
    p = _write(tmp, "bt.csv", "F,A\nY,a\nn,b\n1,c\n true ,d\nmaybe,e\n")
    got = [(x.F, x.A) for x in scan_csv(spark, p, schema,
                                         boolean_tokens=(("y", "1", "true", "t"), ("n", "0", "false", "f"))).collect()]
    assert got == [(True, "a"), (False, "b"), (True, "c"), (True, "d"), (None, "e")]


def _head(data, **kw):
    import io

    from faclake.sources.csv import first_record
    return first_record(io.BytesIO(data).read, **kw)


def test_first_records():
    assert _head(b"A,B\nx,y\n") == ["A", "B"] and _head(b"A,B\r\nx") == ["A", "B"] and _head(b"A,B\rx,y\r") == ["A", "B"]
    assert _head(b"") == [] and _head(b"A") == ["A"] and _head("﻿A,É\nx".encode()) == ["A", "É"]
    assert _head(b'"two\nlines","a ""q"", b"\nx,y\n') == ["two\nlines", 'a "q", b']
    for code in ("utf-16", "utf-16-le", "utf-16-be", "utf-32", "latin-1"):
        assert _head('A,"B\né"\nx,y\n'.encode(code), encoding=code) == ["A", "B\né"]
    assert _head(b"A;B\n", sep=";") == ["A", "B"]
    long = ",".join(f"COLUMN_{i}" for i in range(20_000))
    assert len(_head(long.encode() + b"\n" + b"x" * 10_000_000)) == 20_000
    import pytest
    with pytest.raises(ValueError, match="no end"):
        _head(b"x" * 3_000_000)
    with pytest.raises(ValueError, match="not closed"):
        _head(b'"open\nfor ever')


def test_headers_are_read_in_tasks(spark, tmp):
    import gzip
    import os

    from faclake.sources.csv import headers
    os.makedirs(f"{tmp}/t.csv/deep")
    for i in range(40):
        _write(tmp, f"t.csv/p{i}.csv", "A,B,C\n1,2,3\n")
    _write(tmp, "t.csv/q.csv", '"A","B","c "\n1,2,3\n')
    with gzip.open(f"{tmp}/t.csv/z z.csv.gz", "wt") as f:
        f.write("A,X\n1,2\n")
    with open(f"{tmp}/t.csv/cut.csv.gz", "wb") as f:
        f.write(gzip.compress(os.urandom(1000))[:30])
    found = headers(spark, f"{tmp}/t.csv", at_once=8)
    assert found.rdd.getNumPartitions() == 6
    rows = {os.path.basename(r.path): r for r in found.collect()}
    assert len(rows) == 43 and rows["p7.csv"].names == ["A", "B", "C"] and rows["z z.csv.gz"].names == ["A", "X"]
    assert rows["cut.csv.gz"].names is None and "Error" in rows["cut.csv.gz"].problem
    drift = {(x.position, x.header_name, x.declared_name, x.same) for x in header_drift(spark, f"{tmp}/t.csv", SCHEMA).collect()}
    assert {d for d in drift if not d[3]} == {(1, "X", "B", False), (2, None, "C", False)}


def test_utf16_files_are_checked_and_read(spark, tmp):
    with open(f"{tmp}/u.csv", "wb") as f:
        f.write("A,B,C\né,1,2.5\n".encode("utf-16"))
    drift = header_drift(spark, f"{tmp}/u.csv", SCHEMA, encoding="UTF-16").collect()
    assert len(drift) == 3 and all(d.same for d in drift)
