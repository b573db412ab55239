"""Helpers the operators share: tables in the shared folder, columns, text pieces."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesforge.scratch import Scratch, file_system, shared_folder  # noqa: F401

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, return.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def settled(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder.  Spark deletes its files once nothing uses it
    where the session cleans checkpoints (``get_session`` does); what is left anywhere
    goes when the session ends."""
    spark = df.sparkSession
    shared_folder(spark)
    fs, own = file_system(spark, spark.sparkContext.getCheckpointDir())  # this application's folder
    fs.deleteOnExit(own)
    return df.checkpoint(eager=True)


def text_of(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def pieces_of(total: int | None, per_piece: int, least: int = 1) -> int:
    """How many groups a quantity is dealt into, so that a group's share stays the same
    however large the input is."""
    return max(least, math.ceil((total or 0) / per_piece))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, *, least: int = 2000, most: int = 8000) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has one row per group and the
    group's ``size``.  Groups of more than ``max(least, rows / most)`` rows, which would
    fill one task, are broadcast: there are at most ``most`` of them."""
    groups = settled(groups)
    total = groups.agg(F.sum(size)).first()[0] or 0
    bound = max(least, total // most)
    hot = groups.where(F.col(size) > bound)
    if hot.isEmpty():
        return rows.join(groups, keys)
    few = F.broadcast(hot)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(groups.where(F.col(size) <= bound), keys)
    return rows.join(few, keys).unionByName(rest)


def slices(batches: Iterator, rows: int = 1000) -> Iterator:
    """Arrow batches in slices, so that a worker unpacks few rows at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def utf8(column) -> list[bytes]:
    """An Arrow text column as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


#: What a Python worker keeps from one task to the next, by what it belongs to.
_KEPT: dict = {}


def kept(key, make):
    """``make()``, made once and kept while this worker serves the same operator."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def lean(forget: bool = False) -> None:
    """Memory that is free goes back to the system; ``forget``: with what is kept.  Spark
    gives a worker the tasks of one stage after another, and an executor's memory holds
    all its workers, so a task should not leave more behind than the next one can use."""
    import ctypes

    import pyarrow as pa

    if forget:
        _KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


SHORT = 15  # bytes of a word that is its own key
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of a long


def packed(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words of up to ``SHORT`` bytes and their length as two longs, equal
    for equal words only.  16 bytes must follow the last word."""
    longs = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), (len(data) - 7,), (1,))
    a = longs[at] & _LOW[np.minimum(n, 8)]
    return a, longs[at + 8] & _LOW[np.maximum(n - 8, 0)] | n.astype(np.uint64) << np.uint64(56)


class KeyTable:
    """Numbers (over 0) by keys of two longs: open addressing in numpy, a whole array of
    keys at a time."""

    def __init__(self, expected: int):
        self._make(max(10, int(2 * expected).bit_length() - 1))

    def _make(self, bits: int) -> None:
        self.bits, self.size = bits, 0
        self.keys, self.numbers = np.zeros((2, 1 << bits), np.uint64), np.zeros(1 << bits, np.int32)

    def _place(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of keys, 0 for those the table has not."""
        out, todo, at = np.zeros(len(a), np.int64), np.arange(len(a)), self._place(a, b)
        while len(todo):
            number = self.numbers[at]
            hit = (self.keys[0][at] == a[todo]) & (self.keys[1][at] == b[todo]) & (number > 0)
            out[todo[hit]] = number[hit]
            more = ~hit & (number > 0)
            todo, at = todo[more], (at[more] + 1) & (len(self.numbers) - 1)
        return out

    def put(self, a: np.ndarray, b: np.ndarray, numbers: np.ndarray) -> None:
        """New and different keys."""
        if self.size + len(a) > 0.7 * len(self.numbers):
            held = np.flatnonzero(self.numbers)
            a, b = np.append(self.keys[0][held], a), np.append(self.keys[1][held], b)
            numbers = np.append(self.numbers[held], numbers)
            self._make(int(2 * len(a)).bit_length())
        self.size += len(a)
        at = self._place(a, b)
        while len(at):
            _, first = np.unique(at, return_index=True)
            put = first[self.numbers[at[first]] == 0]
            self.keys[0][at[put]], self.keys[1][at[put]], self.numbers[at[put]] = a[put], b[put], numbers[put]
            rest = np.delete(np.arange(len(at)), put)
            a, b, numbers, at = a[rest], b[rest], numbers[rest], (at[rest] + 1) & (len(self.numbers) - 1)
