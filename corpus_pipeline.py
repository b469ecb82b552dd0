"""From raw documents to packed training sequences, in five stages.

Every stage works on all that the one before it kept. Quality rules drop bad
documents and frequent lines; toxic documents go; one document of each
near-duplicate group stays; repeated passages are cut out; what is left is packed:
one row for each sequence, with its token ids and the documents in it.

Defined results: a null or empty text fails the quality rules; every row is a
document of its own, whatever its id, so rows that share an id or have none are
kept or dropped each for itself; of rows that repeat a text one stays; without
labels of both classes no document is toxic; empty tables give no sequences; texts
have any length. Columns besides doc_id, text, source and n_chars, whatever their
names, are passed on until the last stage, which leaves them out.

A stage's result is to be written before the next stage is called: a stage begins
by deleting the tables that earlier ones kept for themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spindrift.llm.jaccard import keep_one
from spindrift.llm.packing import pack_sequences
from spindrift.llm.quality import keep_good
from spindrift.llm.substrings import dedup_substrings
from spindrift.llm.toxicity import remove_toxic
from spindrift.storage import clean
from spindrift.storage import materialise as _materialise


def materialise(df: DataFrame) -> DataFrame:
    """A stage's result, written and reread; it stays when the stage's own tables go."""
    return _materialise(df, keep=True)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean(spark)
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean(spark)
    return remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean(spark)
    return keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean(spark)
    return dedup_substrings(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    clean(spark)
    return pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("packing", packing),
]

#: No SQL expresses the network's verdicts or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
