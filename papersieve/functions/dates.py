"""Publication dates, years and fetch windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..vocabulary import MONTH_ABBREVIATIONS
from .text import strip

_YEAR = r"(?:20|19)\d{2}"
# The first year in the text, and behind it the month that follows that same
# year; the back-reference keeps the pattern a constant.
_YEAR_MONTH = (
    rf"(?s)^(?:(?!{_YEAR}).)*(?=({_YEAR})).*?\1[-/.](\d{{1,2}})"
)


def normalize_pub_date(pub_date: Column) -> Column:
    """``YYYY-MM`` where a month is known, else ``YYYY``, else the text in lower case.

    A month name counts wherever it occurs, the earliest month of the year
    first; a numeric month must follow the year and is not range-checked.
    """
    raw = strip(F.coalesce(pub_date, F.lit("")))
    lowered = F.lower(raw)
    year = F.regexp_extract(raw, f"({_YEAR})", 1)
    number = F.regexp_extract(raw, _YEAR_MONTH, 2)
    month = F.when(number != "", F.lpad(number, 2, "0"))
    for position in range(12, 0, -1):
        name = MONTH_ABBREVIATIONS[position - 1]
        month = F.when(F.contains(lowered, F.lit(name)), F.lit(f"{position:02d}")).otherwise(month)
    return (
        F.when(raw == "", F.lit(""))
        .when(year == "", lowered)
        .otherwise(F.concat_ws("-", year, month))
    )


def parse_year(value: Column) -> Column:
    """Number in the first four characters, truncated to an integer, else null."""
    head = F.substring(strip(value.cast("string")), 1, 4)
    numeric = F.when(head.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"), head)
    # A number beyond the integers still compares as beyond any bound.
    number = F.least(F.greatest(numeric.cast("double"), F.lit(-(2.0**31))), F.lit(2.0**31 - 1))
    return F.when(numeric.isNotNull(), number.cast("int"))


def leading_year(pub_date: Column) -> Column:
    """Year at the very start of the stripped text, else null."""
    found = F.regexp_extract(strip(F.coalesce(pub_date, F.lit(""))), r"^(\d{4})", 1)
    return F.when(found != "", found.cast("int"))


def _bound(value: str | None) -> int | None:
    try:
        return int(str(value)[:4]) if value else None
    except ValueError:
        return None


def year_in_range(year: Column, date_from: str | None, date_to: str | None) -> Column:
    """Inclusive year bounds; an unknown year passes, an unreadable bound is ignored."""
    keep = F.lit(True)
    low, high = _bound(date_from), _bound(date_to)
    if low is not None:
        keep = keep & (year >= low)
    if high is not None:
        keep = keep & (year <= high)
    return year.isNull() | keep


def join_date_parts(parts: Column) -> Column:
    """``[2024, 3, 0]`` -> ``2024-3``: unpadded, zero and null parts left out."""
    kept = F.filter(parts, lambda p: p.isNotNull() & (p != 0))
    return F.coalesce(F.array_join(F.transform(kept, lambda p: p.cast("string")), "-"), F.lit(""))


# --- fetch windows ---------------------------------------------------------------
#
# A window is a start and an end rule. A rule is a date expression over the columns
# date_from, date_to, min_date_from, last_run, rolling_days and lookback_days of a request.

_MONTH = "trunc(date_to, 'MM')"
WINDOW_RULES = {
    "explicit": ("date_from", "date_to"),
    "from_min_date": ("min_date_from", "date_to"),
    "rolling": ("least(date_sub(date_to, greatest(1, rolling_days)), min_date_from)", "date_to"),
    "this_month": (_MONTH, "date_to"),
    "prev_month": (f"add_months({_MONTH}, -1)", f"date_sub({_MONTH}, 1)"),
    "incremental": ("if(last_run IS NULL, date_sub(date_to, lookback_days), least(last_run, date_to))", "date_to"),
}
WINDOW_MODES = tuple(WINDOW_RULES)
WINDOW_ALIASES = {"previous_month": "prev_month", "last_month": "prev_month"}
# Columns a mode cannot do without.
_NEEDS = {"explicit": "date_from", "from_min_date": "min_date_from"}
_REQUEST = "mode string, date_from date, date_to date, min_date_from date, last_run date, rolling_days int, lookback_days int"


def fetch_windows(requests: DataFrame) -> DataFrame:
    """Add window_from and window_to to rows with the columns that the rules name; an unknown mode is incremental."""
    names = F.create_map(*[F.lit(x) for pair in WINDOW_ALIASES.items() for x in pair])
    mode = F.coalesce(F.element_at(names, F.col("mode")), F.col("mode"))
    out = requests
    for place, column in enumerate(("window_from", "window_to")):
        rule = F.expr(WINDOW_RULES["incremental"][place])
        for name in WINDOW_MODES[:-1]:
            rule = F.when(mode == name, F.expr(WINDOW_RULES[name][place])).otherwise(rule)
        out = out.withColumn(column, rule)
    return out


def window_mode(search: dict, period: str | None = None) -> str:
    """Which mode a run has: the command line's period before the configured one."""
    return next((str(m).strip().lower() for m in (period, search.get("date_range_mode")) if m), "explicit")


def _day(value) -> date | None:
    return date.fromisoformat(str(value).strip()) if value is not None and str(value).strip() else None


def run_window(
    spark: SparkSession,
    search: dict,
    *,
    last_run: str | None = None,
    date_from: date | None = None,
    date_to: date | None = None,
    period: str | None = None,
    lookback_days: int = 30,
) -> tuple[date, date]:
    """The window of one run: its settings as a request of one row. A start given by the caller stands."""
    mode = window_mode(search, period)
    try:
        last = _day(last_run)
    except ValueError:
        last = None
    request = {
        "mode": mode,
        "date_from": date_from or _day(search.get("date_from")),
        "date_to": date_to or _day(search.get("date_to")) or date.today(),
        "min_date_from": _day(search.get("min_date_from")),
        "last_run": last,
        "rolling_days": int(search.get("rolling_days", 730)),
        "lookback_days": lookback_days,
    }
    if date_from is not None:
        request["mode"] = "explicit"
    missing = _NEEDS.get(request["mode"])
    if missing and request[missing] is None:
        raise ValueError(f"a window of mode {mode} needs {missing}")
    found = fetch_windows(spark.createDataFrame([request], _REQUEST)).first()
    if mode == "explicit" and found["window_from"] > found["window_to"]:
        raise ValueError(f"the window begins {found['window_from']}, after its end {found['window_to']}")
    return found["window_from"], found["window_to"]
