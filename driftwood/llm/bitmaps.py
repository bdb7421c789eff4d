"""Sets of 64-bit hashes as bitmaps of bounded size, for tasks to look up."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_HASH = 16
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27             # 128 kB to 16 MB
_CHUNK = 32768


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap holds; a few others, too."""
    at = (hashes >> np.uint64(3)) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def broadcast_bitmap(hashes: DataFrame, column: str, least: int = LEAST_BITS, most: int = MOST_BITS):
    """The hashes in ``column`` (long) as a broadcast bitmap of bytes.

    At most ``most`` bits whatever the number of hashes: that bound is why it
    may pass through the driver.  A bitmap too full for its size admits more,
    and loses nothing.
    """
    bits, n = least, hashes.count()
    while bits < min(most, BITS_PER_HASH * n):
        bits *= 2
    place = F.shiftrightunsigned(column, 3).bitwiseAND(F.lit(bits - 1))
    rows = hashes.select(place.alias("p")) \
        .groupBy(F.shiftright("p", 15).alias("c")).agg(F.bitmap_construct_agg((F.col("p") % _CHUNK).cast("int")).alias("b")) \
        .collect()                                                # at most ``most`` / 32768 rows of 4 kB
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["b"]), np.uint8)
        at = out[r["c"] * (_CHUNK // 8):][:len(part)]
        at[:] = part[:len(at)]
    return hashes.sparkSession.sparkContext.broadcast(out.tobytes())
