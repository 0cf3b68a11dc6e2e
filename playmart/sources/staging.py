"""Bulk staging of JSON lines into a typed table, by field name or by an ordered path list."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StringType

from playmart.schemas import Table
from playmart.sources.feeds import CORRUPT, Paths, json_reader, path_list

_TOP_LEVEL = re.compile(r"^\$(?:\.(\w+)|\['([^'\]]+)'\])$")


def _typed(text: Column, kind: DataType) -> Column:
    """Text to the staging type; a value that does not fit becomes NULL, and checked loads report it."""
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, IntegralType):
        direct = text.try_cast(kind)
        return F.coalesce(direct, text.try_cast("double").try_cast(kind))
    if isinstance(kind, DecimalType):
        # DECIMAL input first, so that scientific notation and plain text round the same way (half up).
        return text.try_cast(DecimalType(38, 10)).try_cast(kind)
    return text.try_cast(kind)


def _fits(text: Column, typed: Column, kind: DataType) -> Column:
    """Whether a value was kept: it has the type, and a whole number has lost nothing."""
    if isinstance(kind, IntegralType):
        return typed.isNotNull() & (text.try_cast("double").isNull() | (text.try_cast("double") == typed.cast("double")))
    return typed.isNotNull()


def field_rejects(raw: dict[str, Column], table: Table) -> Column:
    """Array of (column, value, reason) of the fields that do not fit the table; empty for a good row."""
    found = []
    for field in table.schema.fields:
        text = raw[field.name]
        name, none = F.lit(field.name).alias("column"), F.lit(None).cast("string")
        misfit = text.isNotNull() & ~_fits(text, _typed(text, field.dataType), field.dataType)
        wrong = F.struct(name, text.alias("value"), F.lit(f"does not fit {field.dataType.simpleString()}").alias("reason"))
        case = F.when(misfit, wrong)
        if field.name in table.not_null:
            missing = F.struct(name, none.alias("value"), F.lit("missing, but may not be null").alias("reason"))
            case = case.when(text.isNull(), missing)
        found.append(case)
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def checked_fields(df: DataFrame, column: str, paths: Sequence[str], table: Table, keep: Sequence[str] = ()) -> DataFrame:
    """The columns `keep`, the typed columns of a JSON text column read by path list, and `rejects` (field_rejects).

    Text that is no JSON object is rejected as a whole, with no column. Everything comes from one pass.
    """
    fields = table.schema.fields
    if len(paths) != len(fields):
        raise ValueError(f"{len(paths)} paths for {len(fields)} columns of {table.name}")
    text = F.col(f"`{column}`")
    raw = {f.name: F.get_json_object(text, p) for f, p in zip(fields, paths, strict=True)}
    whole = F.struct(
        F.lit(None).cast("string").alias("column"), text.alias("value"), F.lit("is no JSON object").alias("reason")
    )
    rejects = F.when(F.json_object_keys(text).isNull(), F.array(whole)).otherwise(field_rejects(raw, table))
    typed = [_typed(raw[f.name], f.dataType).alias(f.name) for f in fields]
    return df.select(*keep, *typed, rejects.alias("rejects"))


class TooManyRejectsError(ValueError):
    """More lines were rejected than a load allows."""


def load_checked(
    spark: SparkSession, paths: Paths, table: Table, json_paths: Sequence[str], out: str, *, max_rejected: int = 0,
    recursive: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejects (file, line, column, value, reason), from one pass over JSON lines files.

    The pass writes rows and their rejects to `out`; both results read from there. Lines are numbered from 1 in
    their file: the rows of a part of a file are counted, and parts before it are added up, for files with rejects only.
    More than max_rejected lines with rejects end the load; what was found stays in `out`. Blank lines count as lines.
    """
    lines = json_reader(spark, recursive).text(path_list(paths)).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    staged = checked_fields(lines, "value", json_paths, table, keep=["_file", "_block", "_row", "value"])
    blank = F.trim("value") == ""
    staged = staged.withColumn("rejects", F.when(blank, F.array().cast(staged.schema["rejects"].dataType)).otherwise(F.col("rejects")))
    staged.withColumn("_blank", blank).drop("value").write.mode("overwrite").parquet(out)
    rows = spark.read.parquet(out)
    bad = rows.where(F.size("rejects") > 0)
    found = bad.count()
    parts = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first"))
    parts = parts.join(bad.select("_file").distinct(), "_file", "left_semi")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    line = (F.col("_row") - F.col("first") + F.col("ahead") + 1).alias("line")
    rejects = bad.join(parts, ["_file", "_block"]).select(F.col("_file").alias("file"), line, F.inline("rejects"))
    if found > max_rejected:
        raise TooManyRejectsError(f"{found} lines of {table.name} rejected, {max_rejected} allowed; see {out}")
    good = rows.where((F.size("rejects") == 0) & ~F.col("_blank")).select(*table.column_names)
    return good, rejects


def _read_lines(spark: SparkSession, paths: Paths, recursive: bool) -> DataFrame:
    return json_reader(spark, recursive).text(path_list(paths)).where(F.trim("value") != "")


def stage_by_name(
    spark: SparkSession,
    paths: Paths,
    table: Table,
    *,
    ignore_case: bool = False,
    recursive: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Match JSON fields to staging columns by exact name, or by name without regard to case.

    keep_corrupt=True (exact names) adds the text of lines that cannot be parsed.
    """
    schema = table.schema
    if not ignore_case:
        kept = [CORRUPT] if keep_corrupt else []
        strings = ", ".join(f"`{n}` STRING" for n in [*schema.fieldNames(), *kept])
        reader = json_reader(spark, recursive).option("columnNameOfCorruptRecord", CORRUPT).schema(strings)
        typed = [_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
        return reader.json(path_list(paths)).select(*kept, *typed)

    # Keys are lowered once per line; of keys that differ in case only the first counts.
    entries = _read_lines(spark, paths, recursive).select(F.from_json("value", "MAP<STRING, STRING>").alias("m"))
    raw = entries.select(F.transform(F.map_keys("m"), F.lower).alias("k"), F.map_values("m").alias("v"))
    at = {f.name: F.nullif(F.array_position("k", f.name.lower()), F.lit(0)) for f in schema.fields}
    return raw.select(*[_typed(F.get("v", at[f.name] - 1), f.dataType).alias(f.name) for f in schema.fields])


def extract_json_paths(
    df: DataFrame, column: str, paths: Sequence[str], table: Table, keep: Sequence[str] = ()
) -> DataFrame:
    """Path i of a JSON text column becomes staging column i; `keep` names columns carried along.

    Plain top-level paths are read with json_tuple, which parses each line once for all of them.
    """
    fields = table.schema.fields
    if len(paths) != len(fields):
        raise ValueError(f"{len(paths)} paths for {len(fields)} columns of {table.name}")
    names = [_TOP_LEVEL.match(p) for p in paths]
    if all(names):
        keys = [m.group(1) or m.group(2) for m in names]
        raw = df.select(*keep, F.json_tuple(column, *keys).alias(*[f"_{i}" for i in range(len(keys))]))
    else:
        raw = df.select(*keep, *[F.get_json_object(column, p).alias(f"_{i}") for i, p in enumerate(paths)])
    typed = [_typed(F.col(f"_{i}"), f.dataType).alias(f.name) for i, f in enumerate(fields)]
    return raw.select(*keep, *typed)


def read_path_list(spark: SparkSession, path: str) -> list[str]:
    """Paths of a {"jsonpaths": [...]} file, a small configuration file."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"empty path list: {path}")
    return json.loads(text.value)["jsonpaths"]


def stage_by_paths(
    spark: SparkSession,
    paths: Paths,
    table: Table,
    json_paths: Sequence[str],
    *,
    recursive: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Lines read by path list; keep_corrupt=True adds the text of lines that are no JSON objects."""
    lines = _read_lines(spark, paths, recursive)
    if not keep_corrupt:
        return extract_json_paths(lines, "value", json_paths, table)
    broken = F.when(F.json_object_keys("value").isNull(), F.col("value"))
    return extract_json_paths(lines.withColumn(CORRUPT, broken), "value", json_paths, table, keep=[CORRUPT])


def period_path(template: str, run_date: dt.date) -> str:
    """Fill {year} and {month} of a path from the run date."""
    return template.format(year=run_date.strftime("%Y"), month=run_date.strftime("%m"))


def stage_period(
    spark: SparkSession,
    template: str,
    run_date: dt.date,
    table: Table,
    *,
    json_paths: Sequence[str] | None = None,
    templated: bool = True,
    recursive: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Stage the files of one period, or of a fixed prefix when templated=False."""
    path = period_path(template, run_date) if templated else template
    if json_paths is None:
        return stage_by_name(spark, path, table, recursive=recursive, keep_corrupt=keep_corrupt)
    return stage_by_paths(spark, path, table, json_paths, recursive=recursive, keep_corrupt=keep_corrupt)
