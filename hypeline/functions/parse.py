"""Parsing helpers for the landed sources: clock strings, dates, time zones.

Deliberate deviations from the reference are noted per function.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hypeline.constants import EASTERN_TZ, GAME_DATE_FORMATS, MATCHUP_MARKERS, SEASON_FLIP_MONTH
from hypeline.functions._util import as_col


def mmss_to_seconds(c: "Column | str") -> Column:
    """``"MM:SS"`` -> seconds as bigint; NULL -> 0.

    Under ANSI mode a value without a colon (index 1 out of bounds) or an
    empty part (cast error) raises, as the warehouse does.
    """
    parts = F.split(as_col(c), ":")
    secs = parts[0].cast("bigint") * F.lit(60) + parts[1].cast("bigint")
    return F.coalesce(secs, F.lit(0).cast("bigint"))


def opponent(matchup: "Column | str", team: "Column | str") -> Column:
    """Opponent code: drop every occurrence of the own team, ``vs.`` and
    ``@``, then trim spaces.  Replaces *every* occurrence, so an own code
    contained in the opponent's code damages it (kept on purpose)."""
    m = as_col(matchup)
    step = F.replace(m, as_col(team), F.lit(""))
    for marker in MATCHUP_MARKERS:
        step = F.replace(step, F.lit(marker), F.lit(""))
    return F.trim(step)


def parse_date_any(c: "Column | str", formats: Sequence[str] = GAME_DATE_FORMATS) -> Column:
    """First format that parses wins; NULL when none does (caller rejects).

    Deviation: the reference leaves a whole batch unparsed when one value
    fails; here only the failing rows are NULL and go to a reject table.
    """
    col = as_col(c)
    # last resort: an ISO-8601 date-time ("2025-11-09T19:30:00"), date kept
    iso = F.to_date(col.try_cast("timestamp_ntz"))
    return F.coalesce(*[F.try_to_date(col, f) for f in formats], iso)


def try_ts(c: "Column | str") -> Column:
    """Coercing ISO-8601 timestamp parse (``Z`` / offsets honoured); bad -> NULL."""
    return as_col(c).try_cast("timestamp")


def local_to_utc(c: "Column | str", tz: str = EASTERN_TZ,
                 ambiguous: str = "standard") -> Column:
    """Wall-clock string in ``tz`` (a misleading trailing ``Z`` is stripped)
    -> UTC timestamp.  Unparseable, or carrying an explicit offset -> NULL.

    In the repeated fall-back hour Spark picks the earlier (daylight)
    offset; the reference localises with standard time, one hour later.
    ``ambiguous="standard"`` reproduces the reference; ``"daylight"`` keeps
    Spark's choice.  Non-existent spring-forward times agree already.
    """
    text = F.replace(as_col(c), F.lit("Z"), F.lit(""))
    # A wall-clock string must be naive: one with an explicit UTC offset is
    # unusable (the reference cannot localise it), where Spark's NTZ cast
    # would silently drop the offset.
    has_offset = text.rlike(r"\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*[+-]\d{2}(:?\d{2})?$")
    local = F.when(~has_offset, text.try_cast("timestamp_ntz"))
    utc = F.to_utc_timestamp(local, tz)
    if ambiguous == "daylight":
        return utc
    later = utc + F.expr("INTERVAL 1 HOUR")
    is_ambiguous = F.from_utc_timestamp(later, tz) == F.from_utc_timestamp(utc, tz)
    return F.when(is_ambiguous, later).otherwise(utc)


def season_label(d: "Column | str") -> Column:
    """Season string flipping in October: 2025-10-22 -> ``2025-26``."""
    dc = as_col(d)
    y = F.year(dc)
    start = F.when(F.month(dc) >= SEASON_FLIP_MONTH, y).otherwise(y - 1)
    end = F.pmod(start + 1, F.lit(100))
    return F.concat(start.cast("string"), F.lit("-"), F.lpad(end.cast("string"), 2, "0"))


def epoch_to_ts(c: "Column | str") -> Column:
    """Epoch seconds -> timestamp (UTC session)."""
    return F.timestamp_seconds(as_col(c))
