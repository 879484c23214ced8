"""Column builders for derived fields (the "expression" family).

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage code generation; nothing here runs Python per row.
Arguments that name columns accept a name or a ``Column``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F



def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# --------------------------------------------------------------------------
# rounding


def half_up(x, digits: int = 2, scale: int = 10) -> Column:
    """Round half-up through a decimal of ``scale`` digits, returned as double.

    Aggregates of doubles come out with last-bit noise that depends on how the
    rows were partitioned; passing through ``decimal(38, scale)`` first makes
    the rounded value independent of that order (and of the engine).
    """
    return F.round(_c(x).cast(f"decimal(38,{scale})"), digits).cast("double")


def stable(x, digits: int = 6) -> Column:
    """An aggregated double fixed at ``digits`` decimals (see :func:`half_up`):
    sums and means then come out the same whatever the partitioning."""
    return half_up(x, digits)


SUM_SCALE = 10  # decimals kept of each value in the gold and mart totals


def money_sum(x, scale: int) -> Column:
    """Exact sum of money amounts: each value is taken as a decimal with
    ``scale`` places (choose more than the values have) and summed in decimal
    arithmetic, so the total is the same in any order, on any engine, and a
    half-cent total rounds the same way every time."""
    return F.sum(_c(x).cast(f"decimal(38,{scale})"))


# --------------------------------------------------------------------------
# time


def duration_minutes(start, end, digits: int | None = 1, wall_clock: bool = False) -> Column:
    """Minutes from ``start`` to ``end``, counting whole-second boundaries.

    ``wall_clock=True`` is for TIMESTAMP_NTZ columns (local wall times): the
    difference is taken on the calendar (days, then seconds of the day), so
    it does not depend on the session time zone or its daylight-saving
    shifts. Otherwise the instants' epoch seconds are subtracted."""
    if wall_clock:
        secs = (F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("long") * 86400
                + _second_of_day(_c(end)) - _second_of_day(_c(start)))
    else:
        secs = F.unix_seconds(_c(end)) - F.unix_seconds(_c(start))
    minutes = secs / F.lit(60.0)
    return minutes if digits is None else half_up(minutes, digits)


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def is_wall_clock(df, col: str) -> bool:
    """True when ``col`` holds local wall times (TIMESTAMP_NTZ)."""
    return dict(df.dtypes).get(col) == "timestamp_ntz"


def weekday_number(ts, sunday: int = 1) -> Column:
    """Day of week with Sunday = ``sunday`` (1 gives Spark's 1..7, 0 gives 0..6)."""
    return F.dayofweek(_c(ts)) - F.lit(1 - sunday)


def is_weekend(ts) -> Column:
    """True on Saturday and Sunday; null for a null time."""
    return F.dayofweek(_c(ts)).isin(1, 7)


def day_name(d) -> Column:
    """English day name, e.g. ``Monday``."""
    return F.date_format(_c(d), "EEEE")


def hour_label(hour) -> Column:
    """``HH:00`` text for an hour number."""
    return F.concat(F.lpad(_c(hour).cast("string"), 2, "0"), F.lit(":00"))


def parse_timestamp(text, fmt: str | None = None) -> Column:
    """Text to timestamp; unparsable text becomes null instead of failing."""
    if fmt is None:
        return F.try_to_timestamp(_c(text))
    return F.try_to_timestamp(_c(text), F.lit(fmt))


# --------------------------------------------------------------------------
# arithmetic


def ratio(a, b, digits: int | None = 2) -> Column:
    """a / b rounded; b = 0 or null gives null (never a divide error)."""
    r = F.try_divide(_c(a), _c(b))
    return r if digits is None else half_up(r, digits)


def guarded_ratio(a, b) -> Column:
    """a / nullif(b, 0)."""
    return _c(a) / F.nullif(_c(b), F.lit(0))


def percent(part, whole, digits: int = 1) -> Column:
    """part / whole * 100, rounded; whole = 0 gives null."""
    return half_up(F.try_divide(_c(part).cast("double"), _c(whole)) * 100, digits)


def plus_default(a, b, default: float = 0.0) -> Column:
    """a + coalesce(b, default)."""
    return _c(a) + F.coalesce(_c(b), F.lit(default))


def scaled(x, factor: float, digits: int = 2) -> Column:
    """round(x * factor, digits), e.g. a tax multiplier."""
    return half_up(_c(x) * F.lit(factor), digits)


# --------------------------------------------------------------------------
# labels and tiers


def label(x, mapping: Mapping, default: str | None = "Unknown") -> Column:
    """CASE x WHEN k THEN v ... ELSE default END (a code -> text lookup)."""
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    k0, v0 = items[0]
    out = F.when(_c(x) == F.lit(k0), F.lit(v0))
    for k, v in items[1:]:
        out = out.when(_c(x) == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def tier(x, limits: Sequence[tuple[float, str]], default: str,
         above: bool = True) -> Column:
    """Threshold buckets, checked in the given order.

    ``above=True``: first limit with ``x > limit`` wins (demand tiers).
    ``above=False``: first limit with ``x < limit`` wins (short/medium/long).
    A null ``x`` falls through to ``default``.
    """
    out = None
    for limit, name in limits:
        cond = (_c(x) > F.lit(limit)) if above else (_c(x) < F.lit(limit))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def flag_label(flag, when_true: str, when_false: str) -> Column:
    """Text for a boolean; a null flag takes ``when_false``."""
    return F.when(_c(flag), F.lit(when_true)).otherwise(F.lit(when_false))


def lookup(x, mapping: Mapping) -> Column:
    """Dictionary lookup through a literal map; unknown keys give null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), _c(x)) if pairs else F.lit(None)


# --------------------------------------------------------------------------
# text


def money_text(x, symbol: str = "$") -> Column:
    """``$1,234.56``."""
    return F.concat(F.lit(symbol), F.format_number(_c(x), 2))


def count_text(x) -> Column:
    """``1,234``."""
    return F.format_number(_c(x), 0)


# --------------------------------------------------------------------------
# keys and hashes


def canonical_text(x, data_type: str | None = None, scale: int = 6) -> Column:
    """Engine-independent text for hashing.

    Doubles print differently between engines (``-0.0``, exponent forms), so
    fractional numbers go through ``decimal(38, scale)`` first; timestamps
    print as ``yyyy-MM-dd HH:mm:ss``.
    """
    c = _c(x)
    if data_type in ("double", "float"):
        return c.cast(f"decimal(38,{scale})").cast("string")
    if data_type in ("timestamp", "timestamp_ntz"):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("string")


def row_hash(cols: Iterable, sep: str = "|", null_marker: str | None = None) -> Column:
    """md5 over the columns joined by ``sep``.

    With ``null_marker=None`` nulls are skipped (so (1, null, 'a') and
    (null, 1, 'a') share a hash); pass a marker to keep positions apart.
    """
    parts = [_c(c).cast("string") for c in cols]
    if null_marker is not None:
        parts = [F.coalesce(p, F.lit(null_marker)) for p in parts]
    return F.md5(F.concat_ws(sep, *parts))


# Fixed value: the null placeholder and separator of the widely used dbt
# surrogate-key macro, kept so keys equal the ones that macro produces.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def surrogate_key(*cols) -> Column:
    """md5 of the columns as text, nulls replaced by a placeholder, '-' between."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def nan_to_null(x) -> Column:
    """NaN compares as the largest double in Spark; treat it as missing."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)
