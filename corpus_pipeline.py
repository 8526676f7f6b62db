"""From raw documents to token files: five stages, each written and read again.

Every stage works on all documents that the stage before it kept. All but the last return
the columns of `documents`.

Defined results in all stages: further columns are carried along whatever their names, and an
empty table gives none. Texts are read whole; a null or empty text is not toxic unless the
model's bias says so, is no duplicate, holds no benchmark item, is taken 0 times by the mix and
would be stored as its end alone. Rows without an id are duplicates of each other only where
their texts are equal, are judged by their text in the other stages, and come first in the token
files. Of repeated rows the second stage keeps one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faultweave.llm import decontamination, mixing, near_dedup, token_store, toxicity
from faultweave.llm.common import WORD_BPE, table, vocabulary
from faultweave.sources.workspace import materialise, new_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near-duplicates (five-word shingles)."""
    return near_dedup.keep_one(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.mix_documents(docs)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files; doc_id, start, n_tokens and ids_crc32 as read from them."""
    path = new_path(spark, "token-store")
    token_store.write_store(docs, vocabulary(WORD_BPE), path)
    return token_store.read_documents(spark, path)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("source_mix", mix_sources),
    ("token_store", store_tokens),
]

# Training, approximate pairing and tokenising have no SQL; tests hold run() against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
