"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse.session import scratch_dir
from pulsehouse.sources.tables import read_table

__all__ = ["read_table", "stored", "code_points", "pieces", "partitions", "shown", "give_back",
           "prepare"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back: later
    jobs start from files that every executor sees, whatever executor is lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they have it
    there too (one machine, a shared folder); elsewhere it is installed or sent with the job."""
    root = str(Path(__file__).resolve().parents[2])
    set_paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in set_paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [set_paths, root]))


#: Whole texts are passed to Python, so a batch is bounded by its bytes, not by Spark's
#: 10,000 rows and 64 MB.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
           "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b")}


def prepare(spark: SparkSession) -> None:
    """Settings for Python workers: where this package is, and small batches, unless the
    session has sizes of its own."""
    workers_find_package(spark)
    for key, (default, ours) in BATCHES.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, ours)


def give_back() -> None:
    """Return a worker's freed memory to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:      # not glibc
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shown(text: str = "text") -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def pieces(texts: Iterable[str | None], size: int, overlap: int = 0,
           at_space: bool = False) -> Iterator[list[tuple[int, str, bool]]]:
    """Cut and group texts so that a group holds about ``size`` characters.

    Yields lists of (row number, piece, whether the text ends in it). A text over
    ``size`` characters comes in several pieces, which share ``overlap`` characters, or
    are cut behind a white space if ``at_space`` (inside a word only if the word itself
    is longer than ``size``). Memory stays bounded by ``size``, whatever the texts' length.
    """
    group: list[tuple[int, str, bool]] = []
    held = 0
    for row, text in enumerate(texts):
        text = text or ""
        start = 0
        while True:
            end = min(len(text), start + size)
            last = end >= len(text)
            if at_space and not last:
                cut = max(text.rfind(" ", start, end), text.rfind("\n", start, end))
                end = cut + 1 if cut >= start else end
            piece = text[start:end if last else end + overlap]
            if held and held + len(piece) + 2 > size:
                yield group
                group, held = [], 0
            group.append((row, piece, last))
            held += len(piece) + 2      # callers pad a piece at both ends
            if last:
                break
            start = end
    if group:
        yield group
