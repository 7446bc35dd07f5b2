"""From raw documents to token ids, in five stages; each works on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import decontaminate, langid, near_dedup, pieces, secrets
from tarmac.llm.columns import table, written
from tarmac.session import scratch_path


# Languages that stay; None: all that the labels teach.
WANTED = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, those in no language that labels teach, and those in one that is not wanted."""
    return langid.keep_identified(docs, langid.fit_languages(docs), WANTED)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest id stays."""
    return near_dedup.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text become a mark."""
    return secrets.redact(docs, scratch_path(spark, "ledger"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text, and whether they decode to it."""
    # A worker that has done other stages before keeps less here.
    return pieces.encode_checked(docs, generation=80_000)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", benchmark),
    ("secrets", hide_secrets),
    ("encode", encode),
]
# No SQL has the language model, the sketches and the encoder: tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
