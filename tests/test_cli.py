import json
import os

from faclake.__main__ import main


def test_cli_ingest_refresh_query_describe(spark, tmp, capsys):
    land, docs = f"{tmp}/landing", f"{tmp}/schemas"
    os.makedirs(land)
    os.makedirs(docs)
    cols = [("registry_id", "StringType()"), ("fac_name", "StringType()"), ("air_flag", "StringType()"),
            ("air_ids", "StringType()")]
    with open(f"{docs}/ECHO_EXPORTER_schema.json", "w") as f:
        json.dump({"schema": [{"COLUMN_NAME": n, "ORIGINAL_DATA_TYPE": "char", "SPARK_DATA_TYPE": t,
                               "PANDAS_DATA_TYPE": "str"} for n, t in cols]}, f)
    with open(f"{land}/ECHO_EXPORTER.csv", "w") as f:
        f.write("REGISTRY_ID,FAC_NAME,AIR_FLAG,AIR_IDS\nR1,One,Y,A1 A2\nR2,Two,N,A3\n")
    with open(f"{tmp}/map.json", "w") as f:
        json.dump({"ECHO_EXPORTER.csv": "ECHO_EXPORTER_schema.json"}, f)
    lake = f"{tmp}/lake"
    main(["ingest", "--lake", lake, "--landing", land, "--schemas", f"{docs}/*.json", "--mapping", f"{tmp}/map.json"])
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert out[0]["status"] == "ingested" and out[0]["source_rows"] == 2
    views = {"FAC_NAMES": {"statements": ["SELECT ep.PGM_ID, ee.FAC_NAME FROM EXP_PGM ep, ECHO_EXPORTER ee "
                                          "WHERE ep.REGISTRY_ID = ee.REGISTRY_ID"],
                           "tables": ["EXP_PGM", "ECHO_EXPORTER"]}}
    with open(f"{tmp}/views.json", "w") as f:
        json.dump(views, f)
    # SQL-text views run after the crosswalk is rebuilt (facility lacks the other programs' columns)
    from pyspark.sql import functions as F
    from faclake.sources.tables import Lake
    lk = Lake(spark, lake)
    fac = lk.read("ECHO_EXPORTER")
    for c in ("NPDES_FLAG", "SDWIS_FLAG", "RCRA_FLAG", "NPDES_IDS", "RCRA_IDS", "SDWA_IDS"):
        fac = fac.withColumn(c, F.lit(None).cast("string"))
    lk.write(fac, "ECHO_EXPORTER_NEXT")
    lk.write(lk.read("ECHO_EXPORTER_NEXT"), "ECHO_EXPORTER")
    main(["refresh", "--lake", lake, "--views-json", f"{tmp}/views.json"])
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {o["name"]: o["status"] for o in out} == {"EXP_PGM": "ok", "FAC_NAMES": "ok"}
    main(["query", "--lake", lake, "--table", "FAC_NAMES", "--sql", "SELECT PGM_ID FROM FAC_NAMES ORDER BY 1",
          "--out", f"{tmp}/q"])
    capsys.readouterr()
    assert sorted(r.value for r in spark.read.text(f"{tmp}/q").collect()) == ['{"PGM_ID":"A1"}', '{"PGM_ID":"A2"}']
    spark.range(3).write.parquet(f"{lake}/files/FAC_NAMES/version-00000099-dead")
    main(["vacuum", "--lake", lake, "--table", "FAC_NAMES", "--hours", "0"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["removed"] == ["version-00000099-dead"]
    from faclake.operators.query import log_query, read_log
    log_query(spark, f"{tmp}/log", "FAC_NAMES", "SELECT 1", None)
    main(["compact-log", "--log", f"{tmp}/log"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["requests"] == 1 and read_log(spark, f"{tmp}/log").count() == 1
    main(["describe", "--schemas", f"{docs}/*.json", "--table", "ECHO_EXPORTER"])
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert out[0]["n_columns"] == 4 and "air_ids" in out[0]["document"]


def test_cli_run_ingests_then_refreshes(spark, tmp, capsys):
    import random
    from .test_end_to_end import _doc, _write_table
    land, docs = f"{tmp}/landing", f"{tmp}/schemas"
    os.makedirs(land)
    os.makedirs(docs)
    rnd = random.Random(1)
    _write_table(land, "ECHO_EXPORTER", {
        "REGISTRY_ID": lambda i: f"R{i}", "RCRA_FLAG": lambda i: "Y", "RCRA_IDS": lambda i: f"K{i}",
        "AIR_FLAG": lambda i: "N", "NPDES_FLAG": lambda i: "N", "SDWIS_FLAG": lambda i: "N"}, 3, rnd)
    _write_table(land, "RCRA_VIOLATIONS", {"ID_NUMBER": lambda i: f"K{i % 2}"}, 4, rnd)
    mapping = {"ECHO_EXPORTER.csv": _doc(docs, "ECHO_EXPORTER"), "RCRA_VIOLATIONS.csv": _doc(docs, "RCRA_VIOLATIONS")}
    with open(f"{tmp}/map.json", "w") as f:
        json.dump(mapping, f)
    main(["run", "--lake", f"{tmp}/lake", "--landing", land, "--schemas", f"{docs}/*.json",
          "--mapping", f"{tmp}/map.json"])
    out = {o["name"]: o for o in (json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{"))}
    assert out["ECHO_EXPORTER.csv"]["status"] == "ingested" and out["RCRA_VIOLATIONS.csv"]["status"] == "ingested"
    assert out["EXP_PGM"]["source_rows"] == 3
    assert out["RCRA_VIOLATIONS_MVIEW"]["status"] == "ok" and out["RCRA_VIOLATIONS_MVIEW"]["source_rows"] == 4
    assert out["AIR_COMPLIANCE_MVIEW"]["status"] == "failed"      # its fact was never landed


def test_submitted_master_and_partitions_survive(tmp):
    """The session of the submit arguments is used as it is."""
    import subprocess
    import sys
    code = ("import faclake.__main__ as m; s = m._session(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=77 --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, timeout=120,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "GOT local[2] 77 UTC" in out.stdout, out.stderr[-2000:]


def test_describe_reports_an_unknown_table(spark, tmp, capsys):
    os.makedirs(f"{tmp}/schemas")
    with open(f"{tmp}/schemas/A_schema.json", "w") as f:
        json.dump({"schema": [{"COLUMN_NAME": "x", "ORIGINAL_DATA_TYPE": "char", "SPARK_DATA_TYPE": "StringType()", "PANDAS_DATA_TYPE": "str"}]}, f)
    assert main(["describe", "--schemas", f"{tmp}/schemas/*.json", "--table", "NOPE"]) == 1
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"table": "NOPE", "status": "not found"}


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest
    from faclake.session import checkpoint_root

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError):
        checkpoint_root(Session())
