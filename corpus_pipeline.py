"""Training-data pipeline over ``documents``: identify, deduplicate, decontaminate, redact, tokenize.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what it keeps of docs, all but the last with the columns of docs.
Extra columns pass through. Empty tables give empty results in every stage.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortkit.llm import bpe, decontaminate, jaccard_join, language_id, secret_scan
from cohortkit.llm.common import read_table, staged

#: Word n-grams and similarity (percent) from which two documents are near copies.
SHINGLE_WORDS, LEAST_PERCENT = 5, 80


#: Python workers live through all stages: what one frees goes back to the system before the next.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "4194304"}
#: Small intermediate tables in as few partitions as their bytes need, not in one for each core.
BY_SIZE = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}


def lean_workers(spark: SparkSession) -> None:
    """Give workers started from now on the settings above, unless the session names its own."""
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The settings for the jobs inside; afterwards the session has its own again."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without text or letters go.

    The languages are learned from a bounded sample of the stage's own input,
    from labelled rows outside the held-out fold.
    """
    lean_workers(spark)
    return language_id.drop_unidentified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by 5-word shingles at a Jaccard similarity of 0.8 or more."""
    lean_workers(spark)
    with session_settings(spark, BY_SIZE):
        return jaccard_join.keep_one_of_each(docs, words=SHINGLE_WORDS, num=LEAST_PERCENT, den=100)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    lean_workers(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by ``[SECRET]`` and ``n_chars`` set to the new length."""
    lean_workers(spark)
    return secret_scan.redact_secrets(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``n_tokens`` and ``token_ids`` of their whole texts."""
    lean_workers(spark)
    return bpe.with_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_text),
    ("secret_scan", redact_secrets),
    ("bpe_encoding", encode_tokens),
]

#: SQL can't express language models, component search, the randomness battery or BPE; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
