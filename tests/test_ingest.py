import json
import os

from faclake.operators import schema as S
from faclake.plans.ingest import ingest_landing
from faclake.sources.tables import Lake


def _doc(path, cols, last_modified=True):
    doc = {"schema": [{"COLUMN_NAME": n, "ORIGINAL_DATA_TYPE": "x", "SPARK_DATA_TYPE": t,
                       "PANDAS_DATA_TYPE": "x"} for n, t in cols]}
    if last_modified:
        doc["last_modified"] = "Mon, 01 Jan 2024"
    with open(path, "w") as f:
        json.dump(doc, f, indent=4)


def test_ingest_landing_end_to_end(spark, tmp):
    land, docs = f"{tmp}/landing", f"{tmp}/schemas"
    os.makedirs(land)
    os.makedirs(docs)
    _doc(f"{docs}/FAC_schema.json", [("registry_id", "StringType()"), ("n", "ShortType()"), ("ok", "BooleanType()")])
    _doc(f"{docs}/EV_schema.json", [("d", "DateType()"), ("v", "DoubleType()")], last_modified=False)
    with open(f"{land}/FAC.csv", "w") as f:
        f.write("REGISTRY_ID,N,OK\nR1,1,true\nR2,x,t\n")
    with open(f"{land}/EV.2024.csv", "w") as f:
        f.write("D,V\n2024-01-01,1.5\n")
    with open(f"{land}/UNMAPPED.csv", "w") as f:
        f.write("A\n1\n")
    reg = S.scan_schema_docs(spark, f"{docs}/*.json")
    assert {r.table_name for r in reg.collect()} == {"FAC", "EV"}
    lake = Lake(spark, f"{tmp}/lake")
    mapping = {"FAC.csv": "FAC_schema.json", "EV.csv": "EV_schema.json"}
    rep = {r.name: r for r in ingest_landing(spark, lake, land, mapping, reg).collect()}
    assert rep["FAC.csv"].status == "ingested" and rep["FAC.csv"].source_rows == 2
    assert rep["EV.2024.csv"].status == "ingested" and rep["EV.2024.csv"].stored_rows == 1
    assert rep["UNMAPPED.csv"].status == "unmapped"
    assert os.path.exists(f"{land}/UNMAPPED.csv")          # rejected, not deleted
    fac = lake.read("FAC")
    assert [f.simpleString() for f in fac.schema.fields] == ["REGISTRY_ID:string", "N:int", "OK:boolean"]
    assert sorted(tuple(r) for r in fac.collect()) == [("R1", 1, True), ("R2", None, None)]
    assert lake.read("EV").schema.fields[0].dataType.simpleString() == "string"
    # schema change: re-ingest under a new document -> table and schema replaced
    _doc(f"{docs}/FAC_schema.json", [("registry_id", "StringType()"), ("n", "StringType()")])
    reg2 = S.scan_schema_docs(spark, f"{docs}/*.json")
    rep2 = {r.name: r for r in ingest_landing(spark, lake, land, {"FAC.csv": "FAC_schema.json"}, reg2).collect()}
    assert rep2["FAC.csv"].schema_changed is True
    assert [f.name for f in lake.read("FAC").schema.fields] == ["REGISTRY_ID", "N"]


def test_ingest_reports_header_drift_and_malformed_rows(spark, tmp):
    land, docs = f"{tmp}/landing", f"{tmp}/schemas"
    os.makedirs(land)
    os.makedirs(docs)
    _doc(f"{docs}/T_schema.json", [("a", "StringType()"), ("b", "IntegerType()"), ("c", "DoubleType()")])
    with open(f"{land}/T.csv", "w") as f:
        f.write("B,A,C\nx,1,1.5\ny,notanumber,2.5\nz,3\nw,4,4.5\n")
    reg = S.scan_schema_docs(spark, f"{docs}/*.json")
    lake = Lake(spark, f"{tmp}/lake")
    r = ingest_landing(spark, lake, land, {"T.csv": "T_schema.json"}, reg).collect()[0]
    assert r.status == "ingested" and r.source_rows == 4 and r.stored_rows == 4
    assert r.header_drift == 2                 # A and B swapped in the header
    assert r.malformed_rows == 2               # a bad number and a short row
    assert lake.read("T").columns == ["A", "B", "C"]


def test_ingest_reads_gzip_csv(spark, tmp):
    import gzip
    land, docs = f"{tmp}/landing", f"{tmp}/schemas"
    os.makedirs(land)
    os.makedirs(docs)
    _doc(f"{docs}/G_schema.json", [("k", "LongType()"), ("v", "StringType()")])
    with gzip.open(f"{land}/G.csv.gz", "wt") as f:
        f.write("K,V\n1,a\n2,b\n3,c\n")
    reg = S.scan_schema_docs(spark, f"{docs}/*.json")
    lake = Lake(spark, f"{tmp}/lake")
    r = ingest_landing(spark, lake, land, {"G.csv": "G_schema.json"}, reg).collect()[0]
    assert (r.name, r.status, r.source_rows) == ("G.csv.gz", "ingested", 3)
    assert sorted(tuple(x) for x in lake.read("G").collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_landing_run_reads_headers_in_one_job_and_stores_all_documents(spark, tmp):
    land, docs = f"{tmp}/landing", f"{tmp}/schemas"
    os.makedirs(land)
    os.makedirs(docs)
    for name in ("AA", "BB", "CC"):
        _doc(f"{docs}/{name}_schema.json", [("a", "StringType()"), ("b", "IntegerType()")])
        with open(f"{land}/{name}.csv", "w") as f:
            f.write({"AA": "A,B\nx,1\n", "BB": "B,A,EXTRA\nx,1\n", "CC": '"A\nA",B\n'}[name])
    _doc(f"{docs}/DD_schema.json", [("a", "NoSuchType()")])
    with open(f"{land}/DD.csv", "w") as f:
        f.write("A\n1\n")
    with open(f"{land}/EE.csv", "wb") as f:
        f.write(b'"never closed')
    _doc(f"{docs}/EE_schema.json", [("a", "StringType()")])
    reg = S.scan_schema_docs(spark, f"{docs}/*.json")
    lake = Lake(spark, f"{tmp}/lake")
    mapping = {f"{n}.csv": f"{n}_schema.json" for n in ("AA", "BB", "CC", "DD", "EE")}
    rep = {r.name: r for r in ingest_landing(spark, lake, land, mapping, reg).collect()}
    assert {n: (r.status, r.header_drift) for n, r in rep.items() if n < "DD"} == {
        "AA.csv": ("ingested", 0), "BB.csv": ("ingested", 3), "CC.csv": ("ingested", 1)}
    assert rep["DD.csv"].status == "failed" and rep["EE.csv"].status == "failed" and "header" in rep["EE.csv"].message
    for name in ("AA", "BB"):
        doc = spark.read.parquet(lake.schema_path(name))
        assert doc.count() == 2 and {r.schema_file for r in doc.collect()} == {f"{name}_schema.json"}
    # another run replaces the documents of its tables only
    _doc(f"{docs}/AA_schema.json", [("a", "StringType()")])
    os.remove(f"{land}/BB.csv")
    ingest_landing(spark, lake, land, mapping, S.scan_schema_docs(spark, f"{docs}/*.json")).collect()
    assert spark.read.parquet(lake.schema_path("AA")).count() == 1 and spark.read.parquet(lake.schema_path("BB")).count() == 2
