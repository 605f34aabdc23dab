"""The corpus pipeline: toxicity, exact dedup, near dedup, decontamination, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.

1. ``toxicity`` drops the documents that the classifier predicts toxic.
2. ``exact_dedup`` keeps one row of each group of equal texts.
3. ``simhash_dedup`` keeps the smallest doc_id of each SimHash component.
4. ``decontaminate`` drops documents that hold a passage of ``benchmark``.
5. ``tokenize`` encodes what is left and returns the token digests.

Defined cases, in every stage: a null text counts as empty, and an empty text is
a document like any other (all empty texts are copies of each other); a null
doc_id is kept as it is; of repeated rows, and of equal texts, ``exact_dedup``
leaves one; ties go to the smallest doc_id; an empty table gives an empty
result; extra columns, whatever their names, go through all stages but the last;
without labels of both classes the fixed lexicon decides on toxicity, and
without benchmark items nothing is dropped for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panel_edit.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from panel_edit.llm.common import read, remove, scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def simhash_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.token_digests(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_dedup", simhash_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("tokenize", tokenize_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What a stage returns is written to the shared folder, and removed once the
    next one has been written; the last one's files hold the result.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs


#: SQL can't express the classifier, the near-copy components, the edit-distance search or BPE.
ORACLE_SQL = None
