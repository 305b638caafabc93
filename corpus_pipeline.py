"""A corpus made ready for training, in stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. ``run`` writes each
stage's result as Parquet in the shared folder and rereads it, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import without_leaks
from tidemark.llm.exact import keep_one_copy
from tidemark.llm.language import with_language
from tidemark.llm.piece_bpe import encode_pieces
from tidemark.llm.simhash import one_per_group
from tidemark.session import prepare, scratch_path, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts that are null or have no letter go, a null ``lang`` is predicted.

    Repeated rows stay for the next stage; a tie of languages falls as in the operator.
    """
    prepare(spark)
    return with_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for A-Z and a-z, the row with the largest doc_id; of repeated rows, one."""
    prepare(spark)
    return keep_one_copy(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link them, directly or through others, the one with the smallest doc_id.

    Linked are fingerprints of 3-word shingles at 2 bits or less; rows without an id stay.
    """
    prepare(spark)
    return one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its number of piece ids, the digests of these ids and of the text decoded from them, and the ids."""
    prepare(spark)
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), end_id=2, with_ids=True).drop("decoded")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: SQL cannot express fingerprints, alignments or piece ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
