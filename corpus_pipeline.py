"""A training-corpus pipeline of five stages over the documents table.

Every stage takes the whole output of the one before it.  The first four return
the columns they were given; the last returns the shard of every row that is left.
Defined cases (nulls, empty texts, repeats, empty tables) are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexquarry.llm.decontaminate import decontaminate
from lexquarry.llm.jaccard_join import deduplicate
from lexquarry.llm.language_id import keep_identified
from lexquarry.llm.mixing import mix
from lexquarry.llm.shard import assign_shards
from lexquarry.scratch import save

#: The stages iterate (components, bisection, subdivided ranges): tested against brute force instead.
ORACLE_SQL = None


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that no language claims."""
    return keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold benchmark passages."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks, once at least."""
    return mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return assign_shards(docs)


STAGES = [
    ("language_id", identify_languages),
    ("jaccard_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's output written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
