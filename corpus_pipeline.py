"""Five stages over ``documents``: each is written as Parquet and read again as the next one's input.

Language ID, near duplicates, benchmark leaks, mixing and shards. Every stage but the last returns the
columns it was given; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from areapanel.catalog import Registry
from areapanel.llm.common import documents, llm_query, small_batches
from areapanel.llm.decontamination import decontaminate
from areapanel.llm.jaccard_join import keep_one_of_each
from areapanel.llm.language_id import keep_known
from areapanel.llm.mixing import mix
from areapanel.llm.sharding import shard_documents
from areapanel.session import apply_runtime_conf, shared_folder

query = Registry()


def _ready(spark: SparkSession) -> SparkSession:
    return small_batches(apply_runtime_conf(spark))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and texts far from every learned language, go."""
    _ready(spark)
    return keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that word shingles link, the one with the smallest id stays."""
    _ready(spark)
    return keep_one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    _ready(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    _ready(spark)
    return mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard on the ring and its slot in it."""
    _ready(spark)
    return shard_documents(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("source_mixing", source_mix),
    ("sharding", shards),
]

#: Language ID and the sharding ring have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, written one after another to a folder of this run where all executors see it."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{number}_{name}")
        docs = spark.read.parquet(path)
    return docs


llm_query(query, "pipeline", ORACLE_SQL)(run)
