"""Training-corpus pipeline: quality, near-dedup, secrets, packing.

``STAGES`` run in order over ``documents``; each stage's result is written as
Parquet to the shared folder and reread as the next one's ``docs``.  All but the
last keep the columns of ``documents``:

* ``quality``: documents that the classifier predicts as poor go.
* ``near_dedup``: one document of each near-duplicate group (five words, Jaccard
  0.8 or more) stays, the one with the smallest id.
* ``secrets``: every secret span is replaced by a mark; ``n_chars`` follows.
* ``packing``: the kept texts as pieces of padded token sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm import near_dups, packing, quality, secrets
from ordermart.llm.common import release, ship, stage, staged_mark, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a calibrated quality of at least one half."""
    labels = table(spark, sf_dir, "labels")
    found = stage(quality.with_stats(docs), "stats")
    score = quality.scorer(quality.fit(found, labels))
    return docs.filter(score("text") >= 0.5)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group."""
    ship(spark)
    return near_dups.drop_near_duplicates(docs, like=near_dups.AT_80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; other documents stay as they are."""
    ship(spark)
    clean = docs.withColumn("clean_text", secrets.redacted("text"))
    same = F.col("clean_text").eqNullSafe(F.col("text"))
    changed = {"text": F.col("clean_text"), "n_chars": F.when(same, F.col("n_chars")).otherwise(F.length("clean_text"))}
    return clean.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of padded sequences: ids, document and place."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: no stage before the last can be written in SQL (trained model, spans by compression, tokenizer)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages. What a stage has
    staged is deleted once its result is written, or when a stage fails."""
    docs, mark = table(spark, sf_dir, "documents"), staged_mark()
    try:
        for name, step in STAGES:
            docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
            release(spark, mark, keep=1)
    except BaseException:
        release(spark, mark)
        raise
    return docs
