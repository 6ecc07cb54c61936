"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and judges all documents that the
stage before kept; its result is written as Parquet and read again.  All but
the last return the columns of ``documents``.

For every stage: an empty table gives an empty table; extra columns are left out,
whatever their names; missing columns of ``documents`` are null; null and empty
texts, null doc_ids and repeated rows are rows like others (what a stage decides on
them is in its docstring); very long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faclake.llm import decontaminate as decon
from faclake.llm import jaccard, packing, pii
from faclake.llm import toxicity as tox
from faclake.llm.common import drop, keep
from faclake.llm.queries import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_CARRY = "text string, lang string, source string, n_chars long"


def _documents(df: DataFrame) -> DataFrame:
    """Exactly the columns of ``documents``, whatever else the table holds."""
    types = dict(zip(COLUMNS, ("long", "string", "string", "string", "long")))
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in COLUMNS])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts toxic go.  A text without words has the
    model's bias as its score; equal texts have equal scores."""
    docs = _documents(docs)
    scored = tox.score(docs, tox.fit(docs, table(spark, sf_dir, "labels")), carry=_CARRY)
    return scored.where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: that with the
    smallest doc_id.  Of rows that repeat a doc_id, the one with the smallest text
    stays.  Documents without words or without doc_id stay as they are."""
    docs = _documents(docs)
    first = (jaccard.link(docs).where("component_id = doc_id AND n_shingles > 0").select("doc_id").distinct())
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    alone = F.col("doc_id").isNull() | wordless
    one = docs.where(~alone).join(first, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("text", "lang", "source", "n_chars")).alias("d")).select("doc_id", "d.*")
    return one.unionByName(docs.where(alone)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule marks go; those without words stay."""
    judged = decon.decontaminate(_documents(docs), table(spark, sf_dir, "benchmark"), carry=_CARRY)
    return judged.where("NOT contaminated").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets; n_chars follows.  Null
    texts stay null, and texts without spans stay as they are."""
    docs = _documents(docs)
    found = pii.detect(docs, pii.fit(docs), carry="lang string, source string, n_chars long", redacted=True)
    text = F.col("redacted")
    return found.select("doc_id", text.alias("text"), "lang", "source",
                        F.when(F.col("spans") != "", F.char_length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, in sequences.  A null or empty text is its
    closing id."""
    return packing.pack(_documents(docs))


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontamination),
          ("pii", personal_data), ("packing", pack)]

# SQL cannot express the trained stages; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and what
    the stage before wrote is removed when no stage reads it any more."""
    docs, written = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if written is not None:
            drop(written)
        written = docs
    return docs
