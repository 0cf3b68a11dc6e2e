"""String helpers built from JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def device_token(user_agent: str) -> Column:
    """Text after the first '(' up to the next ';', ')' or blank; '' if there is none."""
    token = F.split_part(F.col(user_agent), F.lit("("), F.lit(2))
    for stop in (";", ")", " "):
        token = F.split_part(token, F.lit(stop), F.lit(1))
    return token


def empty_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Turn '' into NULL in the given (default: all) string columns."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({n: F.nullif(F.col(n), F.lit("")) for n in names})


def to_bigint(column: Column) -> Column:
    """Text to BIGINT; '8' and '8.0' give 8, '' and junk give NULL."""
    return F.coalesce(column.try_cast("bigint"), column.try_cast("double").try_cast("bigint"))
