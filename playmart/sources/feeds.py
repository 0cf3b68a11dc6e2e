"""Readers for the raw catalog, app-log and event-CSV feeds.

Schemas are always given, so no inference pass runs. Paths may be a string, a list of strings, or globs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from playmart import schemas
from playmart.functions.text import to_bigint

CORRUPT = "_corrupt_record"
Paths = str | Sequence[str]


def path_list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def json_reader(spark: SparkSession, recursive: bool = False) -> DataFrameReader:
    """A reader that, if asked to, looks for *.json files at any depth below its paths."""
    if not recursive:
        return spark.read
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")


def _json(spark: SparkSession, paths: Paths, schema: str, recursive: bool, keep_corrupt: bool) -> DataFrame:
    reader = json_reader(spark, recursive)
    if keep_corrupt:
        schema = f"{schema}, {CORRUPT} STRING"
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path_list(paths))


def _csv(spark: SparkSession, paths: Paths, schema: str) -> DataFrame:
    """Headered CSV as text columns. A file whose header differs in order or name is an error."""
    reader = spark.read.option("header", "true").option("enforceSchema", "false").option("escape", '"')
    return reader.schema(schema).csv(path_list(paths))


def _typed_csv_column(name: str) -> Column:
    kind = schemas.EVENT_CSV_TYPES.get(name)
    if kind is None:
        return F.col(name)
    return to_bigint(F.col(name)) if kind == "BIGINT" else F.col(name).try_cast(kind)


def read_song_data(
    spark: SparkSession, paths: Paths, *, recursive: bool = False, keep_corrupt: bool = False
) -> DataFrame:
    return _json(spark, paths, schemas.SONG_FEED, recursive, keep_corrupt)


def read_log_data(
    spark: SparkSession, paths: Paths, *, recursive: bool = False, keep_corrupt: bool = False
) -> DataFrame:
    """App log lines; user ids are kept as text because logged-out rows carry ''."""
    return _json(spark, paths, schemas.LOG_FEED, recursive, keep_corrupt)


def read_event_csv(spark: SparkSession, paths: Paths) -> DataFrame:
    """Headered event CSVs with typed columns."""
    text = _csv(spark, paths, schemas.EVENT_CSV_FEED)
    return text.select(*[_typed_csv_column(c).alias(c) for c in text.columns])


def consolidate_events(events: DataFrame) -> DataFrame:
    """Rows that name an artist, cut to the serving columns."""
    return events.where(F.col("artist").isNotNull()).select(*schemas.CONSOLIDATED_COLUMNS)


def read_consolidated_csv(spark: SparkSession, paths: Paths) -> DataFrame:
    """The consolidated CSV back with typed columns and lower-case names."""
    text = _csv(spark, paths, ", ".join(f"{c} STRING" for c in schemas.CONSOLIDATED_COLUMNS))
    return text.select(*[_typed_csv_column(c).alias(c.lower()) for c in text.columns])


def list_files(spark: SparkSession, root: Paths, pattern: str = "*.json") -> DataFrame:
    """Files below a root, found recursively; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path_list(root))
        .select("path", "length")
    )


def paths_from_prefix(prefix: str) -> str:
    """Glob for every object whose key starts with the prefix; read it with recursive=True."""
    return prefix + "*"


def paths_from_manifest(spark: SparkSession, manifest: str) -> list[str]:
    """URLs listed in a manifest file: {"entries": [{"url": ...}, ...]}.

    Parsed by Spark; only the URLs come to the driver, where a reader needs them as its arguments.
    """
    entries = spark.read.schema("entries ARRAY<STRUCT<url: STRING>>").json(manifest, multiLine=True)
    urls = [r.url for r in entries.select(F.explode("entries.url").alias("url")).collect()]
    if not urls:
        raise ValueError(f"manifest without entries: {manifest}")
    return urls


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, corrupt rows) of a feed read with keep_corrupt=True."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull())
