"""Epoch conversions and calendar attributes.

Epoch values become TIMESTAMP_NTZ by interval arithmetic, so results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

# Day names by the three numbering conventions in use.
MONDAY_FIRST = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SUNDAY_FIRST = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def epoch_second(ms: str) -> Column:
    """Epoch ms to whole seconds, rounding down (also before 1970)."""
    return F.expr(f"CAST(({ms} - pmod({ms}, 1000)) div 1000 AS BIGINT)")


def timestamp_from_millis(ms: str) -> Column:
    return F.expr(f"{EPOCH} + {ms} * INTERVAL '0.001' SECOND")


def timestamp_from_seconds(ms: str) -> Column:
    """Epoch ms to a timestamp cut to the second."""
    return F.expr(f"{EPOCH} + (({ms} - pmod({ms}, 1000)) div 1000) * INTERVAL '1' SECOND")


def time_of_day(ts: str) -> Column:
    return F.date_format(ts, "HH:mm:ss.SSS")


def weekday(ts: str, convention: str = "sunday1") -> Column:
    """Day of week: 'monday0' (Mon=0), 'sunday0' (Sun=0) or 'sunday1' (Sun=1)."""
    if convention == "monday0":
        return F.weekday(ts)
    if convention == "sunday0":
        return F.dayofweek(ts) - 1
    if convention == "sunday1":
        return F.dayofweek(ts)
    raise ValueError(f"unknown weekday convention: {convention}")


def weekday_name(number: Column, convention: str = "sunday1") -> Column:
    """Label a weekday number by the convention it was made with."""
    names, base = {
        "monday0": (MONDAY_FIRST, 0),
        "sunday0": (SUNDAY_FIRST, 0),
        "sunday1": (SUNDAY_FIRST, 1),
    }[convention]
    return F.get(F.array(*[F.lit(n) for n in names]), number - F.lit(base))
