"""Sets of 64-bit hashes as bitmaps of bounded size: a false bit lets more through, a set bit is never missed."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

MOST_BITS = 27              # log2 of the bits of the largest map (16 MB)
BITS_PER_KEY = 16


def bitmap(keys: DataFrame, column: str, most_bits: int = MOST_BITS) -> np.ndarray:
    """Words of a map of the hashes in ``column``, sized by their number up to ``most_bits``.

    Give a stored table. Spark folds the bits into 64-bit words, so at most 2^(most_bits - 6) rows reach the driver.
    """
    bits = min(most_bits, max(12, (BITS_PER_KEY * keys.count()).bit_length()))
    place = keys.select(F.shiftrightunsigned(F.col(column), 64 - bits).alias("place"))
    folded = place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("held")).toArrow()
    words = np.zeros(1 << bits - 6, np.int64)
    words[folded.column("word").to_numpy()] = folded.column("held").to_numpy()
    return words.view(np.uint64)


def hit(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the set."""
    place = hashes >> np.uint64(64 - (len(words).bit_length() + 5))
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
