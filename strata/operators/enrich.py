"""Dimension joins (the "joiner" family).

Broadcasting is decided by the dimension's bytes: every task adds up the sizes of
its rows and one number per task reaches the sum, so the check never gathers rows in
one place, even when the "dimension" turns out to be large. The sum of a
dimension that is joined again is remembered. Past the bound the join is a shuffle,
and keys that hold a large share of the facts are told by a sample and salted: their facts are dealt
to several tasks and the dimension's few rows for them copied to each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a broadcast dimension may take in memory: a copy lives in every executor.
BROADCAST_BYTES = 64 << 20
SALTS = 16            # tasks that share a heavy key's facts
HEAVY = 1 / 200       # share of the sampled facts that makes a key heavy, so that there are 200 at most
SAMPLED = 100_000     # facts looked at for heavy keys, about

_known: dict[tuple, int] = {}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory: 8 for the row and for each column, and what text and nested values hold."""
    size = F.lit(8 + 8 * len(df.columns)).cast("long")
    for c, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("array", "map", "struct", "variant")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 2
        elif kind.startswith("decimal"):
            size = size + 16
    return size


def proven_bytes(df: DataFrame) -> int:
    """Bytes of all rows of ``df``, by a distributed sum.

    Remembered by the plan and the files it reads: the same dimension starts no second job."""
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), tuple(sorted(df.inputFiles())), tuple(df.columns))
    if key not in _known:
        _known[key] = df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]
    return _known[key]


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (a distributed count)."""
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"] <= max_rows


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if its rows are proven to take at most ``max_bytes``, else ``df``."""
    return F.broadcast(df) if proven_bytes(df) <= max_bytes else df


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that hold more than ``HEAVY`` of the rows: 200 at most, by a sample of about SAMPLED rows.

    The sample is taken row by row with a fixed seed and counted in the tasks; it decides
    where rows go, never which rows there are."""
    rows = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    share = min(1.0, SAMPLED / max(1, rows))
    looked = df.select(*keys).where(_rand(share))
    counts = looked.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > max(1.0, HEAVY * rows * share)).orderBy(F.col("__n").desc()).limit(int(1 / HEAVY)).select(*keys)


def _rand(share: float) -> Column:
    return F.lit(True) if share >= 1 else F.rand(17) < share


def salted_join(df: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "left", null_safe: bool = False,
                salts: int = SALTS) -> DataFrame:
    """Shuffle join of facts to ``right`` whose heavy keys are spread over ``salts`` tasks.

    ``on`` maps fact columns to columns of ``right``. Facts of a heavy key get a salt from their
    position in the task; rows of ``right`` with such a key are copied for every salt, all others
    stay single (salt 0), so there is one join and every pair meets once. Left and inner joins only."""
    if how not in ("left", "inner"):
        raise ValueError(f"a {how} join keeps rows of the right side, which are copied here")
    lk, rk = list(on), list(on.values())
    names = [f"__hk_{i}" for i in range(len(lk))]
    facts = df.select("*", *[F.col(c).alias(n) for c, n in zip(lk, names, strict=True)])
    # Fixed before the join: both sides must go by the same keys, also where a task runs again.
    found = heavy_keys(facts, names)
    heavy = F.broadcast(df.sparkSession.createDataFrame(found.collect(), found.schema).withColumn("__heavy", F.lit(True)))
    same = [facts[n].eqNullSafe(heavy[n]) for n in names]
    left = facts.join(heavy, same, "left").select(*[facts[c] for c in df.columns], F.when(
        F.col("__heavy"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0)).alias("__salt"))
    meet = [right[k].eqNullSafe(heavy[n]) for k, n in zip(rk, names, strict=True)]
    copies = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = right.join(heavy, meet, "left").select(*[right[c] for c in right.columns], F.explode(copies).alias("__copy"))
    cond = F.col("__salt") == F.col("__copy")
    for a, b in on.items():
        cond = cond & (left[a].eqNullSafe(spread[b]) if null_safe else left[a] == spread[b])
    return left.join(spread, cond, how).drop("__salt", "__copy")


def enrich(df: DataFrame, dim: DataFrame, left_on: str | Sequence[str],
           right_on: str | Sequence[str], columns: Mapping[str, str] | None = None,
           how: str = "left", null_safe: bool = False, keep_right_key: bool = False,
           broadcast_bytes: int | None = BROADCAST_BYTES, salt: bool = False) -> DataFrame:
    """Join ``df`` to a dimension on keys whose names differ on each side.

    ``columns`` maps dimension column -> output name; only those (and the key
    when ``keep_right_key``) are taken from the dimension, projected *before*
    the join so the shuffle / broadcast carries nothing else. ``null_safe``
    matches null keys to null keys (``<=>``), as pandas ``merge`` does.

    A dimension within ``broadcast_bytes`` is broadcast (None: Catalyst decides). Beyond
    it the join is a shuffle; with ``salt`` its heavy keys are spread (see :func:`salted_join`).
    """
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = [right_on] if isinstance(right_on, str) else list(right_on)
    columns = dict(columns or {})
    tmp = {k: f"__rk_{i}" for i, k in enumerate(rk)}
    proj = [F.col(k).alias(tmp[k]) for k in rk]
    proj += [F.col(src).alias(dst) for src, dst in columns.items()]
    right = dim.select(*proj)
    small = broadcast_bytes is not None and proven_bytes(right) <= broadcast_bytes
    if salt and not small:
        out = salted_join(df, right, {a: tmp[b] for a, b in zip(lk, rk, strict=True)}, how, null_safe)
    else:
        right = F.broadcast(right) if small else right
        cond = None
        for a, b in zip(lk, rk):
            c = df[a].eqNullSafe(right[tmp[b]]) if null_safe else (df[a] == right[tmp[b]])
            cond = c if cond is None else cond & c
        out = df.join(right, cond, how)
    if keep_right_key:
        return out.withColumnsRenamed({tmp[k]: k for k in rk})
    return out.drop(*tmp.values())


def match_count(df: DataFrame, col: str) -> DataFrame:
    """One row: rows and rows where ``col`` was matched (is not null)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count(F.col(col)).alias("matched_rows"))


def add_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds typed null columns (the fallback when a dimension is absent)."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})
