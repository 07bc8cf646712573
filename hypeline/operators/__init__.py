"""DataFrame -> DataFrame operators built from Spark's relational primitives."""

from hypeline.operators.conform import conform
from hypeline.operators.entities import match_entities, roster
from hypeline.operators.filters import rolling_lookback, since, where_date
from hypeline.operators.intervals import attribute_as_of, attribute_to_interval, with_next_start
from hypeline.operators.joins import broadcast_if_small, fits_broadcast
from hypeline.operators.membership import filter_words, may_contain, membership_words
from hypeline.operators.snapshot import latest_snapshot

__all__ = [
    "conform", "match_entities", "roster", "rolling_lookback", "since",
    "where_date", "attribute_as_of", "attribute_to_interval", "with_next_start",
    "broadcast_if_small", "fits_broadcast", "latest_snapshot",
    "filter_words", "may_contain", "membership_words",
]
