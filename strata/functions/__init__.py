"""Column builders (derived columns, keys, labels, rounding, text)."""

from strata.functions.columns import (  # noqa: F401
    canonical_text, count_text, day_name, duration_minutes, flag_label,
    guarded_ratio, half_up, hour_label, is_wall_clock, is_weekend, label, lookup,
    money_sum,
    money_text, nan_to_null, parse_timestamp, percent, plus_default, ratio,
    row_hash, scaled, stable, surrogate_key, tier, weekday_number,
)
