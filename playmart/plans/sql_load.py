"""Filling catalog tables with SQL.

Queries name their sources and values as parameters, `:name` for a value and `IDENTIFIER(:name)` for a table, so
one query serves several tables and nothing is pasted into its text.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def script(spark: SparkSession, statements: Iterable[str], **parameters: Any) -> DataFrame | None:
    """Run statements one after the other; the result of the last one.

    DDL and inserts take effect at once. How long each took is logged with its first line.
    """
    result = None
    for number, statement in enumerate(statements, 1):
        began = time.monotonic()
        result = spark.sql(statement, args=parameters)
        head = statement.strip().partition("\n")[0]
        log.info("statement %d took %.1f s: %s", number, time.monotonic() - began, head)
    return result


def fill(rows: DataFrame, table: str, replace: bool = False) -> None:
    """Append rows to a catalog table, or put them in the place of what it holds.

    Columns are matched by name. Replacing is one statement: the old rows go when the new ones are written.
    """
    verb = "OVERWRITE" if replace else "INTO"
    rows.sparkSession.sql(f"INSERT {verb} {table} BY NAME SELECT * FROM {{rows}}", rows=rows)


def fill_from(
    spark: SparkSession, table: str, query: str, replace: bool = False, **parameters: Any
) -> None:
    """fill() with the result of a query: facts are appended to, dimensions as a rule replaced."""
    fill(spark.sql(query, args=parameters), table, replace)
