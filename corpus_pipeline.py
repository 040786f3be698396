"""A training corpus from raw documents: clean, deduplicate, redact, mix and pack.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again
for the next one. All but the last return the columns of ``documents``. Fitted models and trained
thresholds can't be written as SQL, so ORACLE_SQL is None; tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.llm import mixing, near_copies, packing, pii, simhash, toxicity
from costlake.llm.common import stored, table
from costlake.llm.queries import ranks_path, tokenizer_path

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity classifier rejects."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.reject_toxic(docs, labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Near copies have SimHashes a few
    bits apart, found with pivot tables; or they share 0.8 or more of their five-word shingles (Jaccard), which no
    distance of SimHashes tells (README). Chains may change between the two."""
    return simhash.first_of_each(docs, near_copies.similar_documents(docs))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and keys replaced by the name of their kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source to its target share of all words; a document comes as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1,024 tokens, with their token ids."""
    return packing.pack(docs, tokenizer_path(), ranks=ranks_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
