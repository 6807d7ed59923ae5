"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import cut, remove_folder, shared_folder  # noqa: F401

#: ASCII white space, \x20 and \x09-\x0D: what separates words in every operator here.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that an Arrow batch may hold, so that batches of very long texts stay in memory.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def keeps_columns(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that pass columns through: columns whose names begin with an underscore, as the operators' own do, go by other
    names meanwhile, so none is overwritten."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **how) -> DataFrame:
        used = {x for x in (*args, *how.values()) if isinstance(x, str)}
        away = {c: f"passed{i}{c}" for i, c in enumerate(docs.columns) if c.startswith("_") and c not in used}
        out = operator(docs.withColumnsRenamed(away) if away else docs, *args, **how)
        return out.withColumnsRenamed({v: k for k, v in away.items()}) if away else out

    return run


def text_of(name: str = "text") -> Column:
    """The text, a null one being empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Texts that are all ASCII take the quicker way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest(text: Column, seeds: tuple[int, int] = (11, 29)) -> list[Column]:
    """Two independent 64-bit hashes: together they stand for the text."""
    return [F.xxhash64(F.lit(s), text) for s in seeds]


def release_memory() -> None:
    """Gives freed memory of a Python worker back to the system: workers serve many tasks, of other operators too."""
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # of glibc alone
        ctypes.CDLL(None).malloc_trim(0)
