"""The corpus pipeline: quality rules, language ID, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet in the
shared folder and reads again as the next stage's docs. All stages but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobloom.llm import language_id, near_dedup, packing, quality
from jobloom.llm._common import stored
from jobloom.llm.queries import _vocabulary_path, held_out


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them. Rows are judged one by one."""
    return quality.kept_rows(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: null texts and those without a letter, and all if no text is labelled."""
    return language_id.accepted_rows(docs, language_id.train(docs.where(~held_out())))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates on five-word shingles the document with the smallest id stays.

    Texts without words and rows without an id stay; rows that repeat the id of one that goes, go with it.
    """
    dropped = near_dedup.near_duplicates(docs, width=5).where("not kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, packed into sequences. Every row is packed on its own; none gives none."""
    return packing.pack(docs, _vocabulary_path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: Code lengths, sketches and packing can't be put into SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
