"""DataFrame operators: conform, keys, dimensions, facts, analysis, checks, filters."""

from starloom.operators.analysis import (
    date_multiplicity,
    fact_head,
    monthly_price_avg,
    monthly_price_avg_weighted,
    monthly_price_minmax,
    monthly_price_stats,
    monthly_sorted,
    monthly_sorted_text,
    preview,
    repeat_rows,
    same_time,
    same_time_from_matches,
    top_k,
)
from starloom.operators.conform import ConstraintError, conform, violation_report
from starloom.operators.dims import build_coin_dim, build_date_dim, build_date_dim_from_sources, date_rows
from starloom.operators.facts import (
    build_coin_stats_hist,
    build_coin_stats_hist_by_id,
    build_tweets_hist,
    coin_stats_matches,
    match_coins,
    tweets_matches,
)
from starloom.operators.filters import coin_subset, last_n_days, time_range
from starloom.operators.joins import fits, maybe_broadcast
from starloom.operators.keys import append_with_keys, next_key, with_surrogate_key
from starloom.operators.quality import (
    CheckFailed,
    NullKeyError,
    OrphanKeyError,
    check_foreign_keys,
    check_no_nulls,
    fk_orphan_report,
    fk_orphans,
    null_key_report,
    run_checks,
)

__all__ = [
    "CheckFailed", "ConstraintError", "NullKeyError", "OrphanKeyError",
    "append_with_keys", "build_coin_dim", "build_coin_stats_hist", "build_coin_stats_hist_by_id",
    "build_date_dim", "build_date_dim_from_sources", "build_tweets_hist", "check_foreign_keys",
    "check_no_nulls", "coin_stats_matches", "coin_subset", "conform", "date_multiplicity", "date_rows", "fact_head",
    "fits", "fk_orphan_report", "fk_orphans", "last_n_days", "match_coins", "maybe_broadcast",
    "monthly_price_avg", "monthly_price_avg_weighted", "monthly_price_minmax", "monthly_price_stats",
    "monthly_sorted", "monthly_sorted_text", "next_key", "null_key_report", "preview", "repeat_rows",
    "run_checks", "same_time", "same_time_from_matches", "time_range", "top_k", "tweets_matches",
    "violation_report", "with_surrogate_key",
]
