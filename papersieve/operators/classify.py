"""Title markers and research tracks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions import text as X
from ..schema import DEFAULT_TRACK, TRACKS, text


def markers() -> tuple[str, ...]:
    """Core terms, then the extra markers, each once."""
    return tuple(dict.fromkeys((*V.CORE_TERMS, *V.EXTRA_MARKERS)))


def has_marker(title: Column, terms: Sequence[str] | None = None) -> Column:
    padded = F.concat(F.lit(" "), F.lower(title), F.lit(" "))
    return X.contains_any(padded, [m.lower() for m in terms or markers()])


def track_of_title(
    title: Column,
    compounds: Sequence[str] = V.KEY_COMPOUNDS,
    signals: Mapping[str, Sequence[str]] = V.METHOD_SIGNALS,
    priority: Sequence[str] = V.TRACK_PRIORITY,
) -> Column:
    """First track in priority order with a signal in the title; null without a marker.

    All tracks share the compound list, so a compound decides for the first
    track and the later tracks only need their own method words.
    """
    low = F.lower(title)
    first, *later = priority
    track = F.when(
        X.contains_any(low, [s.lower() for s in (*compounds, *signals[first])]), F.lit(first)
    )
    for name in later:
        track = track.when(X.contains_any(low, [s.lower() for s in signals[name]]), F.lit(name))
    return F.when(has_marker(title), track.otherwise(F.lit(DEFAULT_TRACK)))


def resolved_track(track: str = "track", category: str = "ai_category") -> Column:
    """Record track if valid, else the judged category if valid, else the default."""
    own = F.lower(X.strip(text(track)))
    judged = F.lower(X.strip(text(category)))
    return (
        F.when(own.isin(*TRACKS), own).when(judged.isin(*TRACKS), judged).otherwise(F.lit(DEFAULT_TRACK))
    )


def valid_track(track: str = "track") -> Column:
    own = F.lower(X.strip(text(track)))
    return F.when(own.isin(*TRACKS), own).otherwise(F.lit(""))
