"""Time expressions on timestamp_ntz columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ORIGIN = "timestamp_ntz'1970-01-01 00:00:00'"

# fixed values: the named text formats of a slot
TIME_FORMATS = {
    0: "yyyy-MM-dd'T'HH:mm:ss'.000Z'",
    1: "yyyy-MM-dd HH:mm:ss",
    2: "yyyyMMddHHmm",
    3: "yyyyMMdd",
    4: "yyyyMM",
    5: "yyyy-MM-dd HH:mm",
}


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970, without any time zone."""
    return F.timestamp_diff("SECOND", F.expr(_ORIGIN), ts)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr(_ORIGIN))


def shift(ts: Column, seconds: Column | int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds) if isinstance(seconds, int) else seconds, ts)


def step_interval(seconds: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def slot_of(ts: Column, step: int) -> Column:
    """Start of the slot of ``step`` seconds that holds ``ts``."""
    seconds = epoch(ts)
    return from_epoch(seconds - F.pmod(seconds, F.lit(step)))


def scoring_slots(now: Column, step: int = 300, delay: int = 1500) -> dict[str, Column]:
    """The slot to score at ``now`` and the two before it."""
    slot = shift(slot_of(now, step), -delay)
    return {"minId": slot, "minIdBefore1": shift(slot, -step), "minIdBefore2": shift(slot, -2 * step)}


def calendar_anchors(ts: Column, step: int = 300) -> dict[str, Column]:
    """Neighbouring slots and days, and the same day one and two months back.

    A day missing from the shorter month becomes that month's last day.
    """
    day = F.to_date(ts)
    seconds = epoch(ts) - epoch(day.cast("timestamp_ntz"))

    def months_back(n: int) -> Column:
        return shift(F.add_months(day, -n).cast("timestamp_ntz"), seconds)

    return {
        "nextSlot": shift(ts, step),
        "lastSlot": shift(ts, -step),
        "last2Slot": shift(ts, -2 * step),
        "lastDay": shift(ts, -86400),
        "nextDay": shift(ts, 86400),
        "lastMonth": months_back(1),
        "last2Month": months_back(2),
    }


def format_time(ts: Column, kind: int = 0) -> Column:
    """Text form number ``kind``; an unknown number means form 0."""
    return F.date_format(ts, TIME_FORMATS.get(kind, TIME_FORMATS[0]))
