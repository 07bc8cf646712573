"""Declared sources, landing steps and the schedule-document flattener."""

from hypeline.sources.landing import (
    land_posts,
    stamp_loaded_at,
    union_batches,
    read_source,
    land_game_logs,
    read_fetched_posts,
    to_contract,
)
from hypeline.sources.schedule import flatten_schedule, has_key, land_schedule, read_schedule_docs
from hypeline.sources.schemas import RAW_SCHEMAS

__all__ = ["land_posts", "stamp_loaded_at", "union_batches", "read_source",
           "land_game_logs", "read_fetched_posts", "to_contract", "flatten_schedule", "has_key", "land_schedule",
           "read_schedule_docs", "RAW_SCHEMAS"]
