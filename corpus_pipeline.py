"""From raw documents to packed training rows: five stages, each on all that the one before kept.

Toxic documents go, one document of each near-duplicate group stays, contaminated documents go, sources are
mixed to their weights, and the mix is tokenised and packed. Every stage's result is written as Parquet
in the shared folder and read back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.llm import decontaminate, mixing, neardup, packing, toxicity
from stocklens.llm.common import held_out, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below the threshold by a network trained on the labelled rows of ``docs``."""
    learn = docs.where(~held_out(F.col("doc_id"), 5, 0))
    return toxicity.without_toxic(docs, toxicity.fit(learn, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked at 0.8 or more over five-word shingles."""
    return neardup.without_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which less than a twentieth of the words lies in benchmark windows."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes, a row per time a document is taken."""
    return mixing.mixed_texts(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token rows (columns in ``packing.SCHEMA``)."""
    return packing.pack(docs, packing.read_ranks())


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("mixing", mix_sources), ("packing", pack_tokens)]

#: No SQL: a trained network and a tokenizer are part of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
