"""Windows over a whole table in one order, without one task holding it.

``row_number``, ``rank``, a rolling mean or a running total without
``partitionBy`` send every row to one task. Here the order is cut into buckets
by bounds taken from a sample of the keys, so that the rows are shuffled once,
to the window over their bucket, and the buckets are put together afterwards:

* :func:`windowed` (lag, rolling rows): the first ``rows - 1`` rows of a bucket
  are computed again with a halo of the ``rows - 1`` rows before them;
* :func:`ranked`: a rank is the rank in the bucket plus the rows before it; a
  value that goes on over a bound keeps the rank it had;
* :func:`running` and :func:`positions`: plus the totals of earlier buckets.

An order is a list of column names, ``("name", False)`` for a descending one;
nulls come first when ascending and last when descending (Spark's defaults).
``tie`` names further columns that settle the order among equal keys; a heavy
value is spread over buckets by them. Rows equal in all of these columns share a
bucket and come in any order. Types: numbers, text, booleans, dates and timestamps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from strata.session import scratch_path

BUCKET_ROWS = 20_000      # rows between two bounds, on average
MOST_BUCKETS = 1 << 16    # bounds (and what is broadcast per bucket) never grow beyond this
_OVERSAMPLE = 8           # sampled keys per bound: buckets come out of similar size
_B, _N, _TO, _HEAD, _POS = "__ord_bucket", "__ord_n", "__ord_to", "__ord_head", "__ord_pos"

Order = Sequence[str | tuple[str, bool]]


def _pairs(order: Order) -> list[tuple[str, bool]]:
    return [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def _sorted_by(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in _pairs(order)]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: later steps
    and lost executors start from files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------ buckets

def _comparable(col: str, kind: T.DataType) -> tuple[Column, str]:
    """The key column as compared with bounds, and its type; the type's text form must
    read back as the same value whatever the session's time zone."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col), "bigint"
    if isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        return F.col(col), kind.simpleString()
    raise TypeError(f"cannot order by {col}: {kind.simpleString()}")


def bucketed(df: DataFrame, order: Order) -> DataFrame:
    """``df`` with a bucket number that rises along ``order``.

    Keys whose hash falls below a threshold are the sample (about eight a bound, at
    most some 500,000); every eighth of them, sorted, is a bound. The bounds go into the plan
    as one literal per key column and each row finds its bucket by bisection."""
    pairs = _pairs(order)
    names = [c for c, _ in pairs]
    n = df.count()
    wanted = max(1, min(MOST_BUCKETS, n // BUCKET_ROWS))
    keys = df.select(*names).where(F.pmod(F.xxhash64(*names), F.lit(max(n, 1))) < wanted * _OVERSAMPLE).distinct()
    bounds = (keys.withColumn(_N, F.row_number().over(Window.orderBy(*_sorted_by(order))))     # the sample only
                  .where(F.col(_N) % _OVERSAMPLE == 0).orderBy(_N))
    cols = {c: _comparable(c, df.schema[c].dataType) for c in names}
    rows = bounds.select(*[cols[c][0].cast("string").alias(f"c{i}") for i, c in enumerate(names)]).collect()
    if not rows:
        return df.withColumn(_B, F.lit(0))

    def literal(i: int, kind: str) -> Column:
        texts = F.from_json(F.lit(_json([r[i] for r in rows])), "array<string>")
        return texts.cast(f"array<{kind}>")

    arrays = [literal(i, cols[c][1]) for i, c in enumerate(names)]

    def not_after(k: Column) -> Column:
        """Bound k (from 1) stands at or before the row."""
        out = F.lit(True)
        for (c, up), array in reversed(list(zip(pairs, arrays, strict=True))):
            b, x = F.get(array, k - 1), cols[c][0]
            before = (b.isNull() & x.isNotNull()) | F.coalesce(b < x, F.lit(False)) if up else \
                (b.isNotNull() & x.isNull()) | F.coalesce(b > x, F.lit(False))
            out = before | (b.eqNullSafe(x) & out)
        return out

    steps = [1 << k for k in reversed(range(len(rows).bit_length()))]
    found = F.aggregate(F.lit(steps), F.lit(0), lambda p, s: F.when(
        (p + s <= len(rows)) & not_after(p + s), p + s).otherwise(p))
    return df.withColumn(_B, found)


def _json(texts: list[str | None]) -> str:
    import json
    return json.dumps(texts)


def _starts(placed: DataFrame) -> DataFrame:
    """``(bucket, size, start)``: rows of each bucket and rows before it; at most
    MOST_BUCKETS + 1 rows, so one task may sort them and each task may have them."""
    sizes = placed.groupBy(_B).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))


# ------------------------------------------------------------------ windows

def windowed(df: DataFrame, order: Order, tie: Sequence[str], rows: int,
             columns: Mapping[str, Callable[[WindowSpec], Column]]) -> DataFrame:
    """``df`` with window columns that look back over at most ``rows`` rows, the
    current one included.

    Each column is a function of a window in ``order``: ``lambda w:
    F.avg("x").over(w.rowsBetween(-6, 0))`` with ``rows=7``, or ``lambda w: F.lag("x").over(w)``
    with ``rows=2``. The rows computed again are ``rows - 1`` a bucket."""
    if rows < 1:
        raise ValueError("rows must be 1 or more")
    full = [*order, *tie]
    w = Window.partitionBy(_B).orderBy(*_sorted_by(full))
    first = stored(bucketed(df, full).withColumns(
        {_N: F.row_number().over(w)} | {name: fn(w) for name, fn in columns.items()}), "windowed")
    out = [*[c for c in df.columns if c not in columns], *columns]
    if rows == 1:
        return first.select(*out)
    spark = df.sparkSession
    spans = [(r[_B], r["size"], r["start"]) for r in _starts(first).orderBy(_B).collect()]
    # A bucket's first row looks back to position start + 2 - rows (from 1).
    edges = []
    for i, (to, _, start) in enumerate(spans):
        j = i - 1
        while j >= 0 and spans[j][2] + spans[j][1] >= start + 2 - rows:
            edges.append((spans[j][0], to))
            j -= 1
    where = F.broadcast(spark.createDataFrame(spans, f"{_B} int, size long, start long"))
    placed = first.drop(*columns).join(where, _B).withColumn(_POS, F.col("start") + F.col(_N))
    heads = placed.where(F.col(_N) < rows).select(*[c for c in df.columns if c not in columns], _POS,
                                                  F.col(_B).alias(_TO), F.lit(True).alias(_HEAD))
    tails = placed.where(F.col(_N) > F.col("size") - (rows - 1))
    halo = tails.join(F.broadcast(spark.createDataFrame(edges, f"{_B} int, {_TO} int")), _B).select(
        *[c for c in df.columns if c not in columns], _POS, _TO, F.lit(False).alias(_HEAD))
    w2 = Window.partitionBy(_TO).orderBy(_POS)
    again = heads.unionByName(halo).withColumns({name: fn(w2) for name, fn in columns.items()}).where(_HEAD)
    return first.where(F.col(_N) >= rows).select(*out).unionByName(again.select(*out))


def ranked(df: DataFrame, order: Order, tie: Sequence[str] = (), rank: str = "rank",
           dense: str | None = "dense_rank") -> DataFrame:
    """``df`` with the rank of every row by ``order`` (equal keys share it) and the dense rank.

    ``tie`` does not change a rank; it lets the rows of one heavy value go to several buckets."""
    names = [c for c, _ in _pairs(order)]
    w = Window.partitionBy(_B).orderBy(*_sorted_by(order))
    first = stored(bucketed(df, [*order, *tie]).withColumns(
        {_N: F.rank().over(w), _POS: F.dense_rank().over(w)}), "ranked")
    key = F.struct(*names)
    stats = first.groupBy(_B).agg(F.count(F.lit(1)).alias("size"), F.max(_POS).alias("values"), F.max(_N).alias("last_rank"),
                                  F.min_by(key, _POS).alias("least"), F.max_by(key, _POS).alias("most"))
    o = Window.orderBy(_B)                                   # a row per bucket
    before = o.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.col("least").eqNullSafe(F.lag("most").over(o)) & (F.row_number().over(o) > 1), F.lit(False))
    chain = stats.withColumns({"start": F.coalesce(F.sum("size").over(before), F.lit(0)), "goes_on": goes_on})
    # Where a bucket's last value begins in it, its rank is known; else it is that of the bucket before.
    chain = chain.withColumn("known", F.when(~(F.col("goes_on") & (F.col("values") == 1)), F.col("start") + F.col("last_rank")))
    chain = chain.withColumns({
        "first_rank": F.when(F.col("goes_on"), F.last("known", ignorenulls=True).over(before)).otherwise(F.col("start") + 1),
        "values_before": F.coalesce(F.sum("values").over(before), F.lit(0))
        - F.sum(F.col("goes_on").cast("int")).over(o.rowsBetween(Window.unboundedPreceding, 0))})
    both = first.join(F.broadcast(chain.select(_B, "start", "first_rank", "values_before")), _B)
    found = {rank: F.when(F.col(_POS) == 1, F.col("first_rank")).otherwise(F.col("start") + F.col(_N)).cast("long")}
    if dense:
        found[dense] = (F.col("values_before") + F.col(_POS)).cast("long")
    return both.select(*[c for c in df.columns if c not in found], *[c.alias(n) for n, c in found.items()])


def positions(df: DataFrame, order: Order, tie: Sequence[str] = (), col: str = "row_id") -> DataFrame:
    """``df`` with consecutive numbers from 1 in ``order`` (then ``tie``)."""
    w = Window.partitionBy(_B).orderBy(*_sorted_by([*order, *tie]))
    first = stored(bucketed(df, [*order, *tie]).withColumn(_N, F.row_number().over(w)), "positions")
    return (first.join(F.broadcast(_starts(first)), _B)
            .select(*[c for c in df.columns if c != col], (F.col("start") + F.col(_N)).cast("long").alias(col)))


def running(df: DataFrame, order: Order, tie: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """``df`` with running totals in ``order`` (then ``tie``), the current row included.

    Null values add nothing; a total is null until the first value. Give decimals
    where totals must not depend on the order of adding."""
    w = Window.partitionBy(_B).orderBy(*_sorted_by([*order, *tie])).rowsBetween(Window.unboundedPreceding, 0)
    parts = {f"__ord_s{i}": c for i, c in enumerate(sums.values())}
    first = stored(bucketed(df, [*order, *tie]).withColumns(parts).withColumns(
        {f"{p}_in": F.sum(p).over(w) for p in parts}), "running")
    totals = first.groupBy(_B).agg(*[F.sum(p).alias(f"{p}_all") for p in parts])
    before = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(_B, *[F.sum(f"{p}_all").over(before).alias(f"{p}_before") for p in parts])
    both = first.join(F.broadcast(earlier), _B)

    def total(p: str) -> Column:
        return F.when(F.col(f"{p}_before").isNull(), F.col(f"{p}_in")).when(
            F.col(f"{p}_in").isNull(), F.col(f"{p}_before")).otherwise(F.col(f"{p}_before") + F.col(f"{p}_in"))
    return both.select(*[c for c in df.columns if c not in sums], *[total(p).alias(n) for p, n in zip(parts, sums, strict=True)])


__all__ = ["bucketed", "windowed", "ranked", "positions", "running", "stored"]
