"""The corpus pipeline: quality classifier, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. docs has doc_id and text; all stages but the
last return its columns, whatever others there are. A null doc_id or a repeated one is a row like others, an empty table gives an empty
one, and texts of any length count whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import neardup, packing, quality, substrings
from tessera.llm.tables import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts; its resampling share is 1 here, so that all of them stay.

    Null and empty texts and such without words go. Without labels all other documents stay.
    """
    return quality.accepted_rows(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id; rows that repeat this id all stay.

    Documents without words or id are in no group and stay.
    """
    gone = neardup.near_duplicates(docs).where("not kept").select(F.col("id").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 20-word windows that start earlier elsewhere; texts that lose nothing stay as they are, null ones too.

    n_chars, where there is one, follows the text. A text that loses all its words is empty and stays.
    """
    names = ["doc_id" if c == "doc_id" else "text" if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)]
    cut = substrings.dedup_substrings(docs.toDF(*names))
    shorter = F.col("n_removed") > 0
    values = {"text": F.when(shorter, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        own = names[docs.columns.index("n_chars")]
        values[own] = F.when(shorter, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(own))
    return cut.withColumns(values).select(names).toDF(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece: its document, its place in the document and in a 2048-token sequence. A text without words is one piece, too."""
    return packing.pack_documents(docs, packing.default_tokenizer()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: No SQL: the classifier's model and the packing plan are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return written(STAGES[-1][1](spark, docs, sf_dir), "packed")
