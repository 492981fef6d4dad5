"""Sets of 64-bit keys as bits of bounded size, to send to every task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tablefold.llm.common import mixed

#: Bits per key and most bits of a filter; a full one only lets more pass.
FILTER_BITS = 16
FILTER_MAX = 1 << 30
SLICES = 64


class KeyFilter:
    """Bits of a set of keys in slices of equal size; a key of the set always passes, another one seldom."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.slice_bits = bits, len(bits) * 8 // SLICES

    @staticmethod
    def places(keys: np.ndarray, slice_bits: int) -> list[np.ndarray]:
        return [(mixed(keys + np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(slice_bits)).astype(np.int64) for i in (1, 2, 3)]

    def passes(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64)
        base = _slice(keys).astype(np.int64) * self.slice_bits
        out = np.ones(len(keys), bool)
        for place in self.places(keys, self.slice_bits):
            at = base + place
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def _slice(keys: np.ndarray) -> np.ndarray:
    return mixed(keys) % np.uint64(SLICES)


def key_filter(keys: DataFrame) -> Broadcast:
    """A filter of the long column ``key``, sent to all tasks; at most ``FILTER_MAX`` bits, whatever the number of keys."""
    bits = 1 << 16
    n = keys.count()
    while bits < n * FILTER_BITS and bits < FILTER_MAX:
        bits *= 2
    slice_bits = bits // SLICES

    def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            yield pa.record_batch([pa.array(_slice(own).astype(np.int32)), batch.column(0)], ["slice", "key"])

    def built(table: pa.Table) -> pa.Table:
        out = np.zeros(slice_bits, bool)
        for place in KeyFilter.places(table.column("key").to_numpy().view(np.uint64), slice_bits):
            out[place] = True
        return pa.table({"slice": pa.array([table.column("slice")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())})

    found = keys.mapInArrow(sliced, "slice int, key bigint").groupBy("slice").applyInArrow(built, "slice int, bits binary").collect()
    parts = {r["slice"]: np.frombuffer(r["bits"], np.uint8) for r in found}
    empty = np.zeros(slice_bits // 8, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(np.concatenate([parts.get(i, empty) for i in range(SLICES)]))
