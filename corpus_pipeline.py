"""A training corpus from raw documents: filter, near-duplicates, benchmark passages, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the documents are written
as Parquet and read again. All stages but the last return the columns of ``documents``:

1. toxicity: documents that the factorization machine scores 0.5 or more go.
2. near_duplicates: one document of each group of near copies (5-word shingles, similarity 0.8) stays.
3. decontamination: documents of which a twentieth of the words or more lie in benchmark windows go.
4. mixing: documents are repeated (or left out) by a Poisson count, towards target weights of their sources.
5. sharding: every copy gets a shard and a slot; counts of shards are at most one apart.

All stages take null keys and texts, repeated rows, extra columns and empty tables, as their operators state.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyweave.llm.decontaminate import remove_documents
from tallyweave.llm.frames import table
from tallyweave.llm.mixing import mix_sources
from tallyweave.llm.sharding import shard_documents
from tallyweave.llm.simhash import drop_near_duplicates
from tallyweave.llm.toxicity import drop_toxic
from tallyweave.session import drop_staged, staged, staged_paths


_WORK: list[str] = []  # tables that the latest stage wrote for itself


def _stage(fn):
    """Before a stage starts, drop what the one before it wrote for itself: its result is a table by then.

    A frame that a stage returned is thus good until the next stage is called.
    """

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_staged(spark, _WORK)
        before = set(staged_paths())
        out = fn(spark, docs, sf_dir)
        _WORK[:] = [p for p in staged_paths() if p not in before]
        return out

    return run_stage


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_documents(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs).select(*[f"`{c}`" for c in docs.columns])


@_stage
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``docs`` with size, text_crc32, law, shard, slot and grown_shard."""
    return shard_documents(docs, keep=docs.columns)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Classifier and fingerprints are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
