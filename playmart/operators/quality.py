"""Data-quality checks: expected results, NOT NULL, unique keys, foreign keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart.schemas import Table


class DataQualityError(ValueError):
    """A check did not give the expected result; the tables must not be published."""


@dataclass(frozen=True)
class Check:
    """The first row of `sql` has to equal `expected`."""

    name: str
    sql: str
    expected: tuple[Any, ...]


def pair_checks(queries: Sequence[str], expected: Sequence[tuple[Any, ...]]) -> list[Check]:
    """Checks from two parallel lists; lists of different length are an error."""
    if len(queries) != len(expected):
        raise ValueError(f"{len(queries)} queries but {len(expected)} expected results")
    return [Check(f"check_{i}", q, tuple(e)) for i, (q, e) in enumerate(zip(queries, expected, strict=True))]


def run_checks(spark: SparkSession, checks: Sequence[Check]) -> list[tuple[Check, tuple[Any, ...] | None]]:
    """Run every check, then raise if any failed. Only the first row of each result is fetched."""
    results = []
    for check in checks:
        row = spark.sql(check.sql).first()
        results.append((check, tuple(row) if row is not None else None))
    failed = [(c, got) for c, got in results if got != c.expected]
    if failed:
        lines = "; ".join(f"{c.name}: expected {c.expected}, got {got}" for c, got in failed)
        raise DataQualityError(f"data quality check failed: {lines}")
    return results


def _verdict(df: DataFrame, name: Column, actual: Column, expected: int) -> DataFrame:
    want, got = F.lit(expected).cast("bigint"), actual.cast("bigint")
    return df.select(
        name.alias("name"), want.alias("expected"), got.alias("actual"), got.eqNullSafe(want).alias("passed")
    )


def verdicts(df: DataFrame, name: str, actual: str, expected: int) -> DataFrame:
    """Rows of a name and a count as rows name, expected, actual, passed."""
    return _verdict(df, F.col(name), F.col(actual), expected)


def check_frame(checks: Sequence[tuple[str, DataFrame, int]]) -> DataFrame:
    """(name, one-row one-column count, expected) as rows name, expected, actual, passed; nothing raised."""
    rows = [_verdict(df, F.lit(name), F.col(df.columns[0]), expected) for name, df, expected in checks]
    return reduce(DataFrame.unionByName, rows)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one pass over the table, as rows column_name, null_count."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_count")


_ROWS = "row_count"
_NULLS = "nulls in "


def observed(df: DataFrame, columns: Sequence[str], observation: Observation) -> DataFrame:
    """df, which counts its rows and the NULLs of some columns while it is written; no scan of its own."""
    counts = [F.count_if(F.col(c).isNull()).alias(_NULLS + c) for c in columns]
    return df.observe(observation, F.count(F.lit(1)).alias(_ROWS), *counts)


def observed_counts(observation: Observation, columns: Sequence[str]) -> tuple[int, dict[str, int]] | None:
    """Rows, and NULLs per column, of a write that has ended; None if Spark left the counting out (no rows to write)."""
    found = observation.get
    if any(name not in found for name in (_ROWS, *[_NULLS + c for c in columns])):
        return None
    return found[_ROWS], {c: found[_NULLS + c] for c in columns}


def observed_verdicts(spark: SparkSession, table: str, nulls: Mapping[str, int]) -> DataFrame:
    """The NOT NULL verdicts of constraint_checks from counts taken by the write, a row for each column."""
    rows = [(f"{table}.{column} not null", 0, n, n == 0) for column, n in nulls.items()]
    return spark.createDataFrame(rows, "name STRING, expected BIGINT, actual BIGINT, passed BOOLEAN")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, NULLs included."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def orphan_counts(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]
) -> DataFrame:
    """References without a parent and the rows that hold them; NULL references are allowed.

    The child is counted per reference first, so the anti join sees each reference once.
    """
    per_key = child.dropna(subset=list(child_keys)).groupBy(*child_keys)
    held = per_key.agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(child_keys, parent_keys, strict=True)])
    return held.join(known.distinct(), list(child_keys), "left_anti")


def constraint_checks(
    tables: dict[str, DataFrame], specs: Sequence[Table], nulls: Mapping[str, Mapping[str, int]] | None = None
) -> DataFrame:
    """All declared constraints of a set of tables, one row per constraint with its number of violations.

    `nulls` gives the NULLs per column of tables that were counted as they were written; those are not read for it.
    """
    known = nulls or {}
    rows = F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
    parts: list[DataFrame] = []
    for spec in specs:
        df = tables[spec.name]
        if spec.not_null and spec.name in known:
            parts.append(observed_verdicts(df.sparkSession, spec.name, known[spec.name]))
        elif spec.not_null:
            counts = null_counts(df, spec.not_null)
            label = F.concat(F.lit(f"{spec.name}."), F.col("column_name"), F.lit(" not null"))
            parts.append(_verdict(counts, label, F.col("null_count"), 0))
        counted = []
        if spec.primary_key:
            counted.append((f"{spec.name} primary key", duplicate_keys(df, spec.primary_key).agg(rows), 0))
        for fk in spec.foreign_keys:
            if fk.parent in tables:
                orphans = orphan_counts(df, tables[fk.parent], fk.columns, fk.parent_columns)
                counted.append((f"{spec.name} -> {fk.parent}", orphans.agg(rows), 0))
        if counted:
            parts.append(check_frame(counted))
    return reduce(DataFrame.unionByName, parts)


def enforce(report: DataFrame) -> None:
    """Raise if a check_frame report has a failed row. The report has one row per check."""
    failed = report.where("NOT passed").collect()
    if failed:
        lines = "; ".join(f"{r.name}: expected {r.expected}, got {r.actual}" for r in failed)
        raise DataQualityError(f"data quality check failed: {lines}")
