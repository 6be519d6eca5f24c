"""Training-data pipeline: language ID, near-dedup, substring dedup, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seasonlab.llm.common import delete_folder, read_table, scratch_place, scratch_table
from seasonlab.llm.stages import dedup_stage, language_stage, packing_stage, substring_stage

STAGES = [
    ("language ID", language_stage),
    ("MinHash near-dedup", dedup_stage),
    ("substring dedup", substring_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written to the shared folder and read by the next, which then frees them."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        place = scratch_place(spark, name.replace(" ", "-"))
        docs = scratch_table(stage(spark, docs, sf_dir), name, place)
        if before:
            delete_folder(spark, before)
        before = place
    return docs
