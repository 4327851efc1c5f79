"""Bloom filters of hashes, put together in the tasks and small enough for all of them to have.

A filter is no larger than 32 MB, whatever it holds. Where it says too much, more goes on than has to;
whoever uses one checks what goes on, so results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Bits for each member, and in all.
_MEMBER_BITS, _MOST_BITS, _BLOCK_BITS = 32, 28, 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key in a Bloom filter."""
    return keys >> np.uint64(64 - bits), (keys * _ODD) >> np.uint64(64 - bits)


@dataclass(frozen=True)
class Filter:
    """A Bloom filter of hashes, two bits for each."""

    bits: int
    held: np.ndarray

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        a, b = _places(keys, self.bits)
        one = np.uint64(7)
        found = (self.held[a >> np.uint64(3)] >> (a & one).astype(np.uint8)) & 1
        return (found & (self.held[b >> np.uint64(3)] >> (b & one).astype(np.uint8))).astype(bool)


def filter_of(keys: DataFrame) -> Filter:
    """The filter of the hashes in column ``key``, put together in the tasks, block by block."""
    bits = min(_MOST_BITS, max(_BLOCK_BITS, (keys.count() * _MEMBER_BITS).bit_length()))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(_places(hashes, bits))).astype(np.int64)
            yield pa.record_batch({"block": pa.array(at >> _BLOCK_BITS), "at": pa.array(at & ((1 << _BLOCK_BITS) - 1))})

    def filled(key: tuple, rows: pa.Table) -> pa.Table:
        block = np.zeros(1 << _BLOCK_BITS, dtype=np.uint8)
        block[rows.column("at").to_numpy()] = 1
        packed = np.packbits(block, bitorder="little").tobytes()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "held": pa.array([packed], pa.binary())})

    at = keys.select("key").mapInArrow(placed, "block bigint, at bigint")
    # At most 2^28 bits come to the driver, in blocks of 128 KB.
    held = np.zeros(1 << (bits - 3), dtype=np.uint8)
    size = 1 << (_BLOCK_BITS - 3)
    for row in at.groupBy("block").applyInArrow(filled, "block bigint, held binary").collect():
        held[row.block * size : (row.block + 1) * size] = np.frombuffer(row.held, dtype=np.uint8)
    return Filter(bits, held)
