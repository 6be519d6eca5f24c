"""Stages of the corpus pipeline: ``(spark, docs, sf_dir)`` to a DataFrame. All but packing return the columns of ``docs``.

Columns that bear the name of an operator's result are kept as they are: a row is
one struct, which stays in the JVM unless its text changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.llm.common import cut, row_key
from seasonlab.llm.lang_id import identify
from seasonlab.llm.probminhash import near_duplicate_classes
from seasonlab.llm.queries import fit_languages, packed_pieces
from seasonlab.llm.substring import remove_repeats


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those that the model rejects go.

    Rejected are null texts, texts without a letter, and texts too far from every
    learned language. Without labelled rows no language is learned and nothing can
    be told from anything, so all rows stay.
    """
    model = fit_languages(docs)
    if not model.languages:
        return docs
    judged = identify(docs, model, keep=[F.struct("*").alias("__row")])
    return judged.where("accepted").select("__row.*")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest id. Rows that repeat id and text are one document."""
    kept = cut(near_duplicate_classes(docs).where("kept").select(F.col("key").alias("__key")).distinct())
    rows = docs.select(F.struct("*").alias("__row"), row_key(F.col("doc_id"), F.col("text"))["b"].alias("__key"))
    return rows.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).select("__row.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages that repeat; texts that lose nothing stay as they are.

    A text that loses words becomes its other words joined by one space (empty if
    none is left), and n_chars, where there is such a column, its length.
    """
    stripped = remove_repeats(docs, keep=[F.struct("*").alias("__row")])
    lost = F.col("n_removed") > 0
    fields = {"text": F.when(lost, F.col("kept_text")).otherwise(F.col("__row.text"))}
    if "n_chars" in docs.columns:
        n_chars = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        fields["n_chars"] = F.when(lost, n_chars).otherwise(F.col("__row.n_chars"))
    return stripped.select(*(fields[c].alias(c) if c in fields else F.col(f"__row.`{c}`").alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of packed sequences."""
    return packed_pieces(docs)
