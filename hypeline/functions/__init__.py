"""Column -> Column scalar functions (all built-in Spark expressions)."""

from hypeline.functions.labels import post_type, travel_status, label_by_like
from hypeline.functions.parse import (
    local_to_utc,
    mmss_to_seconds,
    opponent,
    parse_date_any,
    season_label,
    try_ts,
    epoch_to_ts,
)
from hypeline.functions.text import clean_title, ngrams, ngrams_of, tokenize

__all__ = [
    "post_type", "travel_status", "label_by_like",
    "local_to_utc", "mmss_to_seconds", "opponent", "parse_date_any",
    "season_label", "try_ts", "epoch_to_ts",
    "clean_title", "ngrams", "ngrams_of", "tokenize",
]
