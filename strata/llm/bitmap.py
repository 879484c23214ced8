"""Bitmaps of fixed size over hashes, to send on only rows that can match.

A full bitmap lets everything through; rows it lets through are joined exactly.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import release
from strata.session import shuffles_go

BITS = 25


def bitmap(cells: DataFrame) -> np.ndarray:
    """Bits set at the low bits of column ``cell``, gathered as a table of fixed size."""
    low = F.col("cell").bitwiseAND((1 << BITS) - 1)
    with shuffles_go(cells.sparkSession):
        words = (cells.select(F.shiftright(low, 6).alias("w"), low.bitwiseAND(63).cast("int").alias("s"))
                 .groupBy("w").agg(F.expr("bit_or(shiftleft(1L, s))").alias("v")).toArrow())
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[words["w"].to_numpy()] = words["v"].to_numpy().view(np.uint64)
    return bits


def hit(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    low = cells.view(np.uint64) & np.uint64((1 << BITS) - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


def may_be_in(cells: DataFrame) -> Callable[[Column], Column]:
    """Whether a long, never null, may be one of column ``cell``: true for all that are, and for a few more."""
    shared = cells.sparkSession.sparkContext.broadcast(bitmap(cells))

    @F.arrow_udf("boolean")
    def found(cell: pa.Array) -> pa.Array:
        release()
        return pa.array(hit(shared.value, cell.to_numpy()))
    return found


__all__ = ["bitmap", "hit", "may_be_in"]
