"""Helpers that several operators share: tables, words, hashes and a fixed-size key filter."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let whole texts travel to Python workers a thousand at a time, unless the session chose a smaller number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    chosen = int(spark.conf.get(name))
    if chosen <= 0 or chosen > rows:
        spark.conf.set(name, str(rows))


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return WORD.findall(text.lower()) if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``limit`` words at a time so that memory stays bounded."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, found: list[str]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mixed(keys: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers whose output bits all depend on all input bits."""
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return keys ^ (keys >> np.uint64(32))


def filter_bits(keys: int, low: int = 20, high: int = 30) -> int:
    """Binary logarithm of a filter size with 16 bits a key, between 128 KB and 128 MB.

    A filter at its largest size lets more strangers pass; whoever uses it joins exactly afterwards.
    """
    return min(high, max(low, (16 * max(keys, 1) - 1).bit_length()))


def key_filter(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bit map of 2**bits cells with the cells of all keys set.

    Tasks set bits of 64-bit words; the driver receives at most 2**(bits - 6) words, however many keys there are.
    """
    cells = keys.select(F.shiftrightunsigned(F.col(column), 64 - bits).alias("cell"))
    found = (
        cells.select(F.shiftright("cell", 6).alias("word"), F.expr("shiftleft(1L, cast(cell & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    map_ = np.zeros(1 << (bits - 6), np.int64)
    map_[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return map_.view(np.uint64)


def passes(map_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which unsigned 64-bit keys have their cell set."""
    bits = len(map_).bit_length() - 1 + 6
    cell = keys >> np.uint64(64 - bits)
    return (map_[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) != 0


def crc_class(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))
