"""DataFrame -> DataFrame operators."""

from strata.operators import aggregate, enrich, quality, rules, upsert, windows  # noqa: F401
