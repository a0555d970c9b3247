"""The corpus pipeline: documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendgrid.llm.common import Scratch, read_table
from spendgrid.llm.decontaminate import decontaminate_stage
from spendgrid.llm.line_dedup import line_dedup_stage
from spendgrid.llm.near_duplicates import near_duplicate_stage
from spendgrid.llm.quality_rules import quality_stage
from spendgrid.llm.sentencepiece_bpe import sentencepiece_stage

STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_dedup_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("sentencepiece encoding", sentencepiece_stage),
]

#: The stages after the first are similarity searches and a tokenizer, which
#: SQL does not express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    scratch = Scratch(spark, "corpus-pipeline")
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
