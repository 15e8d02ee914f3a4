"""A bit map of a fixed size that knows which hashes may occur in a set, whatever the size of the set."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAP_BITS = 25
_BUCKET = 1 << 15


def bit_map(hashes: DataFrame) -> bytes:
    """Two bits set for each hash in column ``h``; 4 MB for any number of hashes, built in parts on the executors."""
    h, mask = F.col("h"), (1 << MAP_BITS) - 1
    bits = (
        hashes.select(F.explode(F.array(h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask))).alias("bit"))
        .groupBy(F.expr(f"bit div {_BUCKET}").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("bit") % _BUCKET).alias("bits"))
    )
    whole = bytearray((1 << MAP_BITS) // 8)
    for row in bits.collect():  # bounded by the map; an iterator would start a job for every partition
        at = row.bucket * (_BUCKET // 8)
        whole[at : at + _BUCKET // 8] = row.bits
    return bytes(whole)


def probed(bits: bytes, h: np.ndarray) -> np.ndarray:
    """Places of the hashes (unsigned) that may be in the set: all that are, and few others while the map is thin."""
    known, mask = np.frombuffer(bits, np.uint8), np.uint64((1 << MAP_BITS) - 1)
    at = np.arange(len(h))
    for shift in (0, 32):
        bit = ((h[at] >> np.uint64(shift)) & mask).astype(np.int64)
        at = at[((known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)]
    return at
