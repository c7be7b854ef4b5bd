"""A bitmap of bounded size over keys: rows whose key is surely absent from a table go before a shuffle instead of after it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per key, and the most bits in all: 64 MB, beyond which more keys than there are pass by chance, with the same results.
PER_KEY = 16
MOST_BITS = 1 << 29
_BLOCK = 1 << 16


class Sieve:
    def __init__(self, held: Broadcast, bits: int):
        self.held, self.bits = held, bits

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """False where the key is surely not among those of the sieve."""
        slot = keys & np.int64(self.bits - 1)
        return (np.frombuffer(self.held.value, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)

    def tested(self, keys: pa.Array, inside: bool = True) -> pa.Array:
        """True where the sieve may hold the key, or with ``inside=False`` where not. A null key is never held."""
        found = self.may_hold(keys.fill_null(0).to_numpy()) & keys.is_valid().to_numpy(zero_copy_only=False)
        return pa.array(found == inside)

    def sift(self, df: DataFrame, key: str, inside: bool = True) -> DataFrame:
        """The rows of ``df`` whose ``key`` passes ``tested``."""
        at = df.columns.index(key)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(self.tested(b.column(at), inside))

        return df.mapInArrow(run, df.schema)


def sieve_of(keys: DataFrame, most_bits: int = MOST_BITS) -> Sieve:
    """A sieve of the one column of ``keys``, hashes of type long, read twice.

    The bitmap is made in tasks, a block of it in each; the driver joins the blocks, at most ``most_bits`` bits, and broadcasts them.
    """
    keys = keys.toDF("key").filter("key IS NOT NULL")
    bits = min(max(1 << (PER_KEY * keys.count()).bit_length(), _BLOCK), most_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for b in batches:
            slot = np.unique(b.column(0).to_numpy())
            of = slot // _BLOCK
            for block in np.unique(of):
                at = slot[of == block] % _BLOCK
                np.bitwise_or.at(blocks.setdefault(int(block), np.zeros(_BLOCK // 8, np.uint8)), at >> 3, (1 << (at & 7)).astype(np.uint8))
        for block, held in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([held.tobytes()])], ["block", "held"])

    slots = keys.select(F.col("key").bitwiseAND(F.lit(bits - 1)).alias("slot"))
    made = slots.repartition(F.floor(F.col("slot") / _BLOCK)).mapInArrow(run, "block long, held binary").toArrow()
    whole = np.zeros((bits // _BLOCK, _BLOCK // 8), np.uint8)
    for block, held in zip(made.column(0).to_pylist(), made.column(1).to_pylist(), strict=True):
        whole[block] = np.frombuffer(held, np.uint8)
    return Sieve(keys.sparkSession.sparkContext.broadcast(whole.tobytes()), bits)
