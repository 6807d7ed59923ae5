"""From raw documents to packed sequences: quality rules, line dedup, near-duplicate removal, mixing, packing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantilena.llm.common import remove_folder, shared_folder, small_batches
from cantilena.llm.line_dedup import drop_repeated_lines
from cantilena.llm.mixing import mixed_rows
from cantilena.llm.near_duplicates import one_of_each
from cantilena.llm.packing import best_fit_pack
from cantilena.llm.quality_rules import COUNTS, quality_rules


def _beside(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], made: list[str], keep: str | None = None) -> DataFrame:
    """The columns of docs after an operator that makes columns of the names in made, which docs may have too; only rows for which
    keep holds."""
    away = {c: f"docs_{c}" for c in docs.columns if c.lower() in made}
    out = operator(docs.withColumnsRenamed(away))
    out = out.where(keep) if keep else out
    return out.select(*[F.col(away.get(c, c)).alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the fences of their language and source let pass."""
    small_batches(spark)
    return _beside(docs, quality_rules, [*COUNTS, "base_failed", "kept", "rule"], "kept")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that an earlier document has; n_chars follows the text."""
    out = _beside(docs, drop_repeated_lines, ["n_lines", "n_dropped"])
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    small_batches(spark)
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for: not at all, or up to three times."""
    return mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 ids."""
    import public_tokenizers

    small_batches(spark)
    return best_fit_pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Sketch fences, MinHash classes, cube sampling and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder and read again. Packing has read the last of
    them when it returns, so they are deleted then."""
    folder, docs = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", spark.read.parquet(f"{sf_dir}/documents.parquet")
    try:
        for i, (name, stage) in enumerate(STAGES[:-1]):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        remove_folder(spark, folder)
