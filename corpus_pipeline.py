"""A training corpus from ``documents``: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared checkpoint folder and reads again for the next
stage. All but the last return whole rows with the columns of ``documents``,
so columns with clashing names pass unchanged; an empty table stays empty in each.
This module belongs to the optional subpackage ``seriesflow.llm`` and can't be
imported without it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from seriesflow.llm import language_id, minhash_forest, packing, radix_dedup, raking
from seriesflow.llm.common import bound_batches
from seriesflow.llm.queries import vocabulary
from seriesflow.session import checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, have no letter, or whose nearest language codeword has a probability below 1/2."""
    bound_batches(spark)
    return language_id.accepted(docs, language_id.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased; null equals empty), the row with the largest doc_id stays; of repeated rows, one."""
    bound_batches(spark)
    return radix_dedup.keep_first(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked by a Jaccard similarity of 0.8 or more, the smallest doc_id stays.
    Texts without a word are classes of their own; rows with a null doc_id stay."""
    bound_batches(spark)
    return minhash_forest.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that token shares of sources, languages and topics meet tempered targets. Null source and
    lang are values like any other; texts without a token weigh nothing; repeated rows are decided together."""
    return raking.sampled(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents in sequences of 4096; null and empty texts are one end id; repeated rows are packed each."""
    bound_batches(spark)
    return packing.pack(docs, vocabulary())


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packed)]

#: Language identification, the near-duplicate join and the tokenizer have no SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = f"{checkpoint_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
