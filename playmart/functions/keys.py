"""Row keys that are the same on every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def md5_concat(*columns: Column) -> Column:
    """md5 of the plain concatenation; NULL if any part is NULL."""
    return F.md5(F.concat(*[c.cast("string") for c in columns]))


def session_second_key(session: str, start_time: str) -> Column:
    """md5(session || second). Two plays of one session in the same second share the key."""
    return md5_concat(F.col(session), F.date_format(start_time, "yyyy-MM-dd HH:mm:ss"))


def natural_key(*names: str) -> Column:
    """md5 over all columns that identify a row.

    They are written as JSON with names and NULLs, so different values never give the same text.
    """
    return F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))


def run_local_id() -> Column:
    """Cheap unique id without a shuffle; differs between runs, so never use it as a stored key."""
    return F.monotonically_increasing_id()
