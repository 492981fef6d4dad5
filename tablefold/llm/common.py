"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefold.session import cut_lineage

stored = cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str, suffix: str = ".parquet") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}{suffix}")


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo ``modulus``; null for a null identifier."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[list]:
    """Columns of each Arrow batch as Python lists."""
    for batch in batches:
        if batch.num_rows:
            yield [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def pieces_of(batches: Iterable[pa.RecordBatch], name: str, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose values of ``name`` (strings or bytes) reach ``size`` bytes at most, or hold one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            past = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, past - at)
            at = past


def give_back() -> None:
    """Returns freed memory to the machine where the C library can: a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


class WordHashes(dict):
    """64-bit hash of each word, remembered for words met before; bounded."""

    limit = 300_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _odd(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_set(text: str | None, known: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a text.

    Words are what ASCII white space separates, with A-Z in lower case. A
    shorter text is one shingle; a text without words, or null, has none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    factors = _FACTORS if width <= 64 else _odd(width)
    if n < width:
        total = np.uint64(n)
        for i in range(n):
            total = total + h[i : i + 1] * factors[i]
        return mixed(total)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += h[i : n - width + 1 + i] * factors[i]
    return np.unique(mixed(total))


_FACTORS = _odd(64)
