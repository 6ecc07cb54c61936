"""The schema-document sink: one file a document, put in place by tasks."""

import os

from faclake.operators import schema as S

DDL = ("schema_file string, table_name string, position int, COLUMN_NAME string, ORIGINAL_DATA_TYPE string, "
       "SPARK_DATA_TYPE string, PANDAS_DATA_TYPE string, last_modified string")


def _registry(spark, docs, columns=3):
    rows = [(f"T{d}_schema.json", f"T{d}", i, f"c\"{i}", None if i else "num", "LongType()", "é", "Mon")
            for d in range(docs) for i in range(columns)]
    return spark.createDataFrame(rows, DDL)


def test_documents_are_files_of_their_names(spark, tmp):
    path = f"{tmp}/docs"
    assert S.write_schema_docs(_registry(spark, 5), path) == 5
    assert S.write_schema_docs(_registry(spark, 3), path) == 3          # replaced as a whole
    assert sorted(n for n in os.listdir(path) if not n.startswith(".")) == [f"T{d}_schema.json" for d in range(3)]
    want = sorted(map(str, _registry(spark, 3).select(*S.REGISTRY_COLUMNS).collect()))
    for read in (S.scan_schema_docs(spark, f"{path}/*_schema.json"), S.read_written_docs(spark, path)):
        assert sorted(map(str, read.select(*S.REGISTRY_COLUMNS).collect())) == want
    assert S.write_schema_docs(_registry(spark, 3).limit(0), path) == 0
