"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_memo(key: str, make: Callable):
    """An object that a Python worker makes once and keeps for its later tasks.

    Functions travel by value, so their module globals last for one task only; tables that are
    dear to build (a tokenizer's trie) are kept in ``sys.modules`` of the worker. A worker keeps one
    object: it serves the stages of a pipeline one after the other, and their memos must not add up.
    """
    kept = sys.modules.setdefault("_devicelens_memo", types.ModuleType("_devicelens_memo")).__dict__.setdefault("kept", {})
    if key not in kept:
        forget_memo()
        kept[key] = make()
    return kept[key]


def forget_memo() -> None:
    """Free what an earlier stage left in this worker; for functions that need room and keep nothing themselves."""
    home = sys.modules.get("_devicelens_memo")
    kept = home.__dict__.get("kept") if home else None
    if kept:
        kept.clear()
        gc.collect()
        with suppress(OSError, AttributeError):  # where the C library can give free memory back
            ctypes.CDLL(None).malloc_trim(0)


class Memo(dict):
    """A dictionary that makes what it lacks, forgets everything at so many bytes, and does not keep long entries.

    Keys and values count with their lengths, and ``ENTRY`` for what holds them.
    """

    ENTRY, LONGEST = 180, 512

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.size = make, most, 0

    def __missing__(self, key):
        value = self.make(key)
        length = len(key) + len(value or ())
        if length <= self.LONGEST:
            self.size += length + self.ENTRY
            if self.size > self.most:
                self.clear()
                self.size = length + self.ENTRY
            self[key] = value
        return value


def fold(column: Column, modulus: int) -> Column:
    """``crc32`` of the value as text, modulo ``modulus``; null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def fold_of(value, modulus: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus


def ascii_words(text: str | None) -> list[bytes]:
    """Runs of bytes other than space and tab to carriage return (0x20, 0x09-0x0D)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def auc(labels: np.ndarray, scores: np.ndarray) -> float:
    """Area under the ROC curve; ties count half."""
    order = np.argsort(scores, kind="stable")
    s = scores[order]
    _, start, count = np.unique(s, return_index=True, return_counts=True)
    rank = np.repeat(start + (count + 1) / 2, count)
    y = labels[order] == 1
    pos, neg = y.sum(), (~y).sum()
    return float((rank[y].sum() - pos * (pos + 1) / 2) / max(1, pos * neg))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 16) -> Iterator[None]:
    """Within it, planned jobs hand Python so few rows at a time: for rows of a megabyte each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
