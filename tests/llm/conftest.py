import os

import pytest

from faclake.session import ship_package

os.environ.setdefault("OMP_NUM_THREADS", "1")

SF_ORACLE = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """docs(rows): a documents table of (doc_id, text) rows, with extra columns
    whose names the operators use inside."""
    ship_package(spark)

    def make(rows):
        ddl = DOCS + ", score double, shard int, n int, key string, words int, component_id string, part int"
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), 0.5, 1, 2, "k", 3, "c", 4) for i, t in rows], ddl).repartition(3)
    return make


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
