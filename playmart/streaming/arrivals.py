"""Pick-up of newly arrived files, each loaded once.

A run takes what has arrived since the last one, in batches of a bounded number of files, and ends. A batch is
written to a directory of its own and becomes current by one commit of the publication log, which holds the rows and
the paths of their files. A file whose path is published is never loaded again: not when it is delivered twice,
when a batch is repeated after a failure, nor when the checkpoint of the stream has been lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playmart import sinks
from playmart.schemas import Table

FILES = "file STRING, row_count BIGINT"
MAX_FILES = 1000  # of a batch


def _files_table(table: Table) -> Table:
    return Table(f"_{table.name}_files", FILES, ("file",))


def arrived(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """All published rows of a table that pick_up fills."""
    return sinks.read_runs(spark, root, sinks.current(spark, root).of(table.name), table)


def arrived_files(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Path (or name) and number of rows of every file that was loaded."""
    files = _files_table(table)
    return sinks.read_runs(spark, root, sinks.current(spark, root).of(files.name), files)


def _load(batch: DataFrame, batch_id: int, root: str, table: Table) -> None:
    spark = batch.sparkSession
    files = _files_table(table)
    # The id of the stream stays the same as long as its checkpoint is there.
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    period = f"{stream}-{batch_id:012d}"
    base = sinks.current(spark, root)
    if (table.name, period) in base.paths:
        return  # published before the stream could note it
    known = sinks.read_runs(spark, root, base.of(files.name), files).select("file")
    paths = {(t.name, period): sinks.run_path(root, t.name, period) for t in (table, files)}
    fresh = batch.withColumnsRenamed({"_file": "file"}).join(known, "file", "left_anti")
    if "_path" in fresh.columns:
        # Of files of one name that arrive together the first path counts.
        first = fresh.groupBy("file").agg(F.min("_path").alias("_path"))
        fresh = fresh.join(first, ["file", "_path"], "left_semi").drop("_path")
    # Rows are written once with the name of their file beside them; names and counts come from what was written.
    staged = f"{root}/arrivals/{table.name}/{period}"
    fresh.write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(StructType([*files.schema.fields[:1], *table.schema.fields])).parquet(staged)
    sinks.write_table(rows.drop("file"), paths[table.name, period], table)
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("row_count"))
    sinks.write_table(counts, paths[files.name, period], files)
    sinks.publish(spark, root, period, paths, base, reads=[files.name])


def pick_up(
    spark: SparkSession,
    source: str,
    root: str,
    table: Table,
    format: str = "json",
    *,
    max_files: int = MAX_FILES,
    recursive: bool = False,
    by_name: bool = False,
    checkpoint: str | None = None,
    **options: str,
) -> None:
    """Load the files that have arrived in a folder or glob since the last time, then end.

    Files are known by their path, with by_name=True by their name alone, for sources that deliver a file again into
    another folder. A file is complete when it appears (written elsewhere and moved). A file without rows is loaded as no rows and not listed. Two runs at once are refused by
    the stream's own checkpoint or, if they have different ones, by the publication log.
    """
    if "file" in (c.lower() for c in table.column_names):
        raise ValueError(f"{table.name}: a column named file stands in the way of the file's name")
    reader = spark.readStream.schema(table.schema).format(format).options(**options)
    reader = reader.option("maxFilesPerTrigger", max_files)
    reader = reader.option("fileNameOnly", str(by_name).lower())
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    names = {"_file": "file_name", "_path": "file_path"} if by_name else {"_file": "file_path"}
    marks = [F.col(f"_metadata.{field}").alias(mark) for mark, field in names.items()]
    rows = reader.load(source).select(*marks, *table.column_names)
    writer = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint or f"{root}/checkpoints/{table.name}")
    writer.foreachBatch(lambda batch, batch_id: _load(batch, batch_id, root, table)).start().awaitTermination()
