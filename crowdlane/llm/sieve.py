"""A bitmap of fixed size that lets wanted keys pass, and few others."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: a prime; the bitmap takes one megabyte, whatever the number of keys
BITS = 8_388_593


class Sieve:
    """Rows whose key may be among those of ``keys``; a join behind it decides.

    Texts that a join would drop need not be shuffled for it. The bitmap is made by
    an aggregate of at most BITS / 64 rows and broadcast; with ever more keys it lets more
    rows pass, and is never wrong.
    """

    def __init__(self, keys: DataFrame, column: str) -> None:
        bit = keys.selectExpr(f"pmod({column}, {BITS}) as bit").where("bit is not null")
        words = bit.groupBy(F.expr("bit div 64").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("bits")
        )
        got = words.toArrow()
        table = np.zeros(BITS // 64 + 1, np.uint64)
        table[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
        self.table = keys.sparkSession.sparkContext.broadcast(table)

    def may(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key (long) may be wanted."""
        at = np.mod(keys, BITS)
        return ((self.table.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def pass_on(self, batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(column)
            keep = self.may(key.fill_null(0).to_numpy(zero_copy_only=False)) & key.is_valid().to_numpy(zero_copy_only=False)
            if keep.any():
                yield batch.filter(pa.array(keep))
