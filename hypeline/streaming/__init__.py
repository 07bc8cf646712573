"""Continuous landing and snapshots with Structured Streaming."""

from hypeline.streaming.landing import is_folder, land_stream
from hypeline.streaming.snapshots import keep_latest, newest_per_key

__all__ = ["is_folder", "land_stream", "keep_latest", "newest_per_key"]
