"""Exact order statistics without sorting or shuffling the values.

A quantile sketch of a column (KLL) says between which two values a position
lies, up to the sketch's error. One scan then counts exactly how many values lie
below and between the two, and sketches what lies between for the next scan.
The interval shrinks by a factor of the sketch's error each time; when few
enough values are left, only these are opened and counted. Every scan serves all
columns and positions at once; tasks send a few counts and a sketch of fixed size, never values.

The sketch only chooses where to look: counts are exact, and a position outside
the chosen interval is looked for on the side where the counts put it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SKETCH_K = 400            # a sketch of some 10 KB
ERROR = 3 / SKETCH_K ** 0.9   # of a rank, as a share of the values, with room to spare
OPEN_VALUES = 200_000     # values that one task may sort at the end, for each position


@dataclass
class _Search:
    """A position that is looked for: the value lies strictly between ``low`` and ``high``."""
    column: str
    position: int                 # from 1, among all values of the column
    low: float | None = None
    high: float | None = None
    below: int = 0                # values at or under ``low``
    inside: int = 0               # values strictly between
    sketch: bytes | None = None   # of the values between
    value: float | None = None

    def between(self) -> Column:
        c, out = F.col(self.column), F.col(self.column).isNotNull()
        if self.low is not None:
            out = out & (c > F.lit(self.low))
        if self.high is not None:
            out = out & (c < F.lit(self.high))
        return out


def _sketch(c: Column) -> Column:
    return F.kll_sketch_agg_double(c, SKETCH_K)


def _chosen(spark: SparkSession, searches: Sequence[_Search]) -> list[tuple[float, float] | None]:
    """Two values around each position as its sketch has them (one small row)."""
    cols = []
    for i, s in enumerate(searches):
        if s.sketch is None:
            continue
        share = (s.position - s.below - 0.5) / s.inside
        for name, f in (("l", max(0.0, share - ERROR)), ("h", min(1.0, share + ERROR))):
            cols.append(F.kll_sketch_get_quantile_double(F.lit(bytearray(s.sketch)), F.lit(f)).alias(f"{name}{i}"))
    if not cols:
        return [None] * len(searches)
    row = spark.range(1).select(*cols).first()
    return [(row[f"l{i}"], row[f"h{i}"]) if s.sketch is not None else None for i, s in enumerate(searches)]


def _counts(i: int, s: _Search, two: tuple[float, float] | None) -> list[Column]:
    c = F.col(s.column)
    if two is None:
        return [F.count_if(s.between()).alias(f"n{i}"), _sketch(F.when(s.between(), c)).alias(f"k{i}")]
    low, high = map(F.lit, two)
    middle = (c > low) & (c < high)
    return [F.count_if(c < low).alias(f"b{i}"), F.count_if(c == low).alias(f"l{i}"), F.count_if(c == high).alias(f"h{i}"),
            F.count_if(middle).alias(f"n{i}"), _sketch(F.when(middle, c)).alias(f"k{i}")]


def _narrow(s: _Search, two: tuple[float, float] | None, i: int, row) -> None:
    if two is None:
        s.inside, s.sketch = row[f"n{i}"], row[f"k{i}"]
        return
    low, high = two
    b, at_low, at_high, n = (row[f"{x}{i}"] for x in "blhn")
    if low == high:
        at_high, n = 0, 0
    rank = s.position
    if rank <= b:
        s.high, s.inside, s.sketch = low, b - s.below, None
    elif rank <= b + at_low:
        s.value = low
    elif rank <= b + at_low + n:
        s.low, s.high, s.below, s.inside, s.sketch = low, high, b + at_low, n, row[f"k{i}"]
    elif rank <= b + at_low + n + at_high:
        s.value = high
    else:
        done = b + at_low + n + at_high
        s.inside, s.sketch = s.inside - (done - s.below), None
        s.low, s.below = high, done


def _open(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Counts the values left of each search and takes the one at its position."""
    tagged = F.array_compact(F.array(*[
        F.when(s.between(), F.struct(F.lit(i).alias("i"), F.lit(s.position - s.below).alias("p"), F.col(s.column).alias("v")))
        for i, s in enumerate(searches)]))
    counted = df.select(F.inline(tagged)).groupBy("i", "p", "v").agg(F.count(F.lit(1)).alias("w"))
    upto = F.sum("w").over(Window.partitionBy("i").orderBy("v"))     # OPEN_VALUES at most
    found = counted.withColumn("upto", upto).where((F.col("upto") >= F.col("p")) & (F.col("upto") - F.col("w") < F.col("p")))
    for r in found.collect():                                        # a row per search
        searches[r["i"]].value = r["v"]


def select_positions(df: DataFrame, columns: Mapping[str, Column], positions: Callable[[int], Sequence[int]]
                     ) -> dict[str, tuple[int, dict[int, float]]]:
    """For every column: how many values it has (neither null nor NaN, taken as double), and those
    at ``positions(count)`` (from 1, in ascending order).

    ``df`` is scanned once per round: two or three rounds for tables of any size met in
    practice, as each leaves about ``2 * ERROR`` of the values. Give a stored table."""
    spark, names = df.sparkSession, list(columns)
    values = df.select(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(columns.values())])
    first = values.agg(*[x for i in range(len(names)) for x in (F.count(f"v{i}").alias(f"n{i}"), _sketch(F.col(f"v{i}")).alias(f"k{i}"))]).first()
    searches: list[_Search] = []
    for i in range(len(names)):
        n = first[f"n{i}"]
        searches += [_Search(f"v{i}", p, inside=n, sketch=first[f"k{i}"]) for p in sorted(set(positions(n))) if n]
        if any(not 1 <= s.position <= n for s in searches if s.column == f"v{i}"):
            raise ValueError(f"{names[i]} has {n} values")
    while pending := [s for s in searches if s.value is None]:
        if all(s.inside <= OPEN_VALUES for s in pending):
            _open(values, pending)
            if any(s.value is None for s in pending):
                raise RuntimeError("the table changed while it was read")
            break
        large = [s for s in pending if s.inside > OPEN_VALUES]
        two = _chosen(spark, large)
        row = values.agg(*[x for i, (s, t) in enumerate(zip(large, two, strict=True)) for x in _counts(i, s, t)]).first()
        for i, (s, t) in enumerate(zip(large, two, strict=True)):
            _narrow(s, t, i, row)
    return {name: (first[f"n{i}"], {s.position: s.value for s in searches if s.column == f"v{i}"}) for i, name in enumerate(names)}


def exact_medians(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, float | None]:
    """Median of every column (the mean of the two middle values; null without values)."""
    found = select_positions(df, columns, lambda n: [(n - 1) // 2 + 1, n // 2 + 1] if n else [])
    return {name: (at[(n - 1) // 2 + 1] + at[n // 2 + 1]) / 2.0 if n else None for name, (n, at) in found.items()}


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Of every column the least value that at least each share of its values does not exceed."""
    import math

    def place(n: int, f: float) -> int:
        return min(n, max(1, math.ceil(f * n)))
    found = select_positions(df, columns, lambda n: [place(n, f) for f in shares] if n else [])
    return {name: [at[place(n, f)] if n else None for f in shares] for name, (n, at) in found.items()}


__all__ = ["select_positions", "exact_medians", "exact_quantiles"]
