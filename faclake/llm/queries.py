"""Registered queries of this folder: ``QUERIES[key](spark, sf_dir)`` applies an
operator with its production parameters to a whole table; ``ORACLE[key]`` is
DuckDB SQL for the same rows where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from . import decontaminate as decon
from . import (jaccard, manifest, oracles, packing, pii, resample, sharding, suffix_dedup, token_counts, token_files, topk, toxicity,
               warc)

QUERIES = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)          # operators of this folder run Python on the executors
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op2_decontaminate(spark, sf_dir):
    return decon.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op2_decontaminate"] = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
dw AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
spans AS (SELECT item_id, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i, w FROM iw WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM spans),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_spans AS (SELECT doc_id, w, s.n, unnest(range(1, len(w) - s.n + 2)) AS i FROM dw, sizes s WHERE len(w) >= s.n),
doc_windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM doc_spans),
hits AS (SELECT d.doc_id, d.i, d.n, x.item_id FROM doc_windows d JOIN item_windows x ON d.n = x.n AND d.win = x.win),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN marked USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@register
def op10_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), sharding.even_tree(40))


@register
def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op8_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@register
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register
def op4_warc(spark, sf_dir):
    return warc.page_records(spark, table(spark, sf_dir, "pages"))


ORACLE["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
g AS (SELECT t, max(page_id) AS original, count(*) AS copies FROM p WHERE strlen(t) >= 1000 GROUP BY t)
SELECT page_id, CAST(strlen(p.t) AS BIGINT) AS payload_bytes, sha1(p.t) AS payload_digest,
  CASE WHEN copies > 1 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN copies > 1 AND page_id <> original THEN original END AS refers_to
FROM p LEFT JOIN g ON p.t = g.t
"""


@register
def op3_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


ORACLE["op3_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@register
def op5_jaccard(spark, sf_dir):
    return jaccard.link(table(spark, sf_dir, "documents"))


ORACLE["op5_jaccard"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM p),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM both_ JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * c >= 75 * (na.n + nb.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, low) AS (SELECT a, a FROM edge UNION SELECT e.b, r.low FROM reach r JOIN edge e ON e.a = r.doc_id WHERE r.low < e.b)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.low, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id) m ON m.doc_id = w.doc_id
"""


@register
def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@register
def op6_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.detect(docs, pii.fit(docs))


@register
def op11_manifest(spark, sf_dir):
    return manifest.manifest(table(spark, sf_dir, "documents"), manifest.tampered_text())


ORACLE["op11_manifest"] = oracles.manifest_sql()


@register
def op12_resample(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op12_resample"] = oracles.resample_sql()


@register
def op13_token_files(spark, sf_dir):
    return token_files.token_rows(table(spark, sf_dir, "documents"))
