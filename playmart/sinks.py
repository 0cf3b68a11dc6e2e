"""Writers and table lifecycle.

Layouts never put a whole partition value into one task: rows are rebalanced, and adaptive execution
splits a partition value that is too big and joins those that are too small.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playmart.operators import quality
from playmart.operators.dedupe import insert_if_absent
from playmart.schemas import ServingTable, Table, load_order

# Upper bound for one file; a very large partition value becomes several files.
MAX_RECORDS_PER_FILE = 50_000_000


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The table's columns in order and of its types; a missing column or a lossy type is an error."""
    missing = [c for c in table.column_names if c not in df.columns]
    if missing:
        raise ValueError(f"{table.name}: missing columns {missing}")
    return df.select(*table.column_names).to(table.schema)


def laid_out(df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    order = [*partition_by, *sort_by]
    return df.sortWithinPartitions(*order) if order else df


def write_table(
    df: DataFrame, path: str, table: Table, mode: str = "overwrite", observation: Observation | None = None
) -> None:
    """Write one registry table as Parquet, partitioned and sorted as the registry says.

    With an observation the write itself counts the rows and the NULLs of the columns that may not hold any.
    """
    rows = laid_out(conform(df, table), table.partition_by, table.sort_by)
    if observation is not None:
        # Last, in the tasks that write: Spark counts each of them once, however often it is tried.
        rows = quality.observed(rows, table.not_null, observation)
    writer = rows.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    return spark.read.schema(table.schema).parquet(path).select(*table.column_names)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Overwrite only the partitions that occur in df."""
    rows = laid_out(df, partition_by, sort_by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def read_or_empty(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The stored table, or no rows if nothing has been stored yet."""
    try:
        return read_table(spark, path, table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], table.schema)


def append_absent(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    table: Table,
    order: Sequence[str] = (),
    where: str | None = None,
    unique: bool = False,
) -> None:
    """Append the rows whose primary key the stored table lacks; running it again appends nothing.

    `where` limits the stored rows compared with, for instance to the one period being loaded, so that
    only its directories are read. unique=True says that df already has one row per key.
    """
    stored = read_or_empty(spark, path, table)
    if where:
        stored = stored.where(where)
    fresh = insert_if_absent(df, stored, table.primary_key, order, unique)
    write_table(fresh, path, table, mode="append")


def write_serving(
    df: DataFrame, path: str, table: ServingTable, mode: str = "overwrite", row_group_bytes: int = 16 << 20
) -> None:
    """Write a serving table range-partitioned and sorted by its whole key.

    The whole key is unique, so even a partition key that owns a third of the rows spreads over many
    files, and file and row-group statistics still lead a look-up by the first key columns to few of them. Later
    key columns are spread over all row groups; their Bloom filters, as large as the row group's distinct
    values need, rule out those that do not hold a value.
    """
    keys = table.primary_key
    writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode)
    writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.bloom.filter.adaptive.enabled", "true")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)


def read_serving(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored serving table; filters on its key columns reach the reader."""
    return spark.read.schema(schema).parquet(path)


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Rank buckets of some number or time columns with their bits interleaved; NULLs are in the first bucket.

    A bucket holds about an equal share of the rows. The driver gets 2**bits - 1 boundaries a column.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    numbers = {c: F.col(c).cast("timestamp") if "timestamp" in t or t == "date" else F.col(c) for c, t in df.dtypes}
    values = {c: numbers[c].cast("double") for c in columns}
    cuts = df.agg(*[F.percentile_approx(values[c], shares).alias(c) for c in columns]).first()
    z = F.lit(0).cast("bigint")
    for place, c in enumerate(columns):
        bucket = F.lit(0)
        for cut in sorted(set(cuts[c] or [])):
            bucket = bucket + F.coalesce((values[c] > cut).cast("int"), F.lit(0))
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(columns) + place))
    return z


def write_z_ordered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6, mode: str = "overwrite") -> None:
    """Write files of rows that are near each other in all of some columns, so that a filter on any of them, or on
    several, is answered by few files. A value that owns many rows is spread by the other columns."""
    rows = df.withColumn("_z", z_value(df, columns, bits))
    rows = rows.repartitionByRange(files, "_z", *columns).sortWithinPartitions("_z", *columns)
    rows.drop("_z").write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV without an index; one file per task, each with the header."""
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)


def key_shares(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n most frequent keys with their rows and share of all rows: what to look at before bucketing."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    share = F.col("row_count") / F.lit(df.count())
    return per_key.orderBy(F.desc("row_count"), key).limit(n).withColumn("share", share)


def save_bucketed(df: DataFrame, name: str, buckets: int, key: str, sort_by: Sequence[str] = ()) -> None:
    """Catalog table bucketed by a key: two tables with equal buckets join on it without a shuffle.

    A bucket is read by one task and cannot be split; key_shares shows whether a key is too frequent for it.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)


# Catalog tables -------------------------------------------------------------------------------------


def create_tables(
    spark: SparkSession, tables: Sequence[Table], database: str = "default", location: str | None = None
) -> None:
    """Create the tables that do not exist yet, parents first."""
    for table in load_order(list(tables)):
        parts = f" PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
        place = f" LOCATION '{location}/{table.name}'" if location else ""
        name = f"{database}.{table.name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({table.columns}) USING parquet{parts}{place}")


def drop_tables(spark: SparkSession, tables: Sequence[Table], database: str = "default") -> None:
    """Drop the tables, dependents first."""
    for table in reversed(load_order(list(tables))):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table.name}")


# Publication ----------------------------------------------------------------------------------------

PUBLICATION = "seq BIGINT, run_id STRING, table_name STRING, period STRING, path STRING"
WHOLE = ""  # period of a table that one run writes as a whole


class StaleRunError(RuntimeError):
    """Another run was published after this one had read the current tables."""


@dataclass(frozen=True)
class Current:
    """What is published: the last sequence number, and the path of every (table, period)."""

    seq: int
    paths: dict[tuple[str, str], str]

    def of(self, table: str, without: Sequence[str] = ()) -> list[str]:
        """Paths of a table, without those of some periods."""
        return [p for (name, period), p in sorted(self.paths.items()) if name == table and period not in without]


def run_path(root: str, table: str, run_id: str) -> str:
    """Where a run writes a table: all runs of a table lie side by side, so several can be read as one."""
    return f"{root}/tables/{table}/run={run_id}"


def read_runs(spark: SparkSession, root: str, paths: Sequence[str], table: Table) -> DataFrame:
    """Several run paths of a table as one; no rows if there are none."""
    if not paths:
        return spark.createDataFrame([], table.schema)
    reader = spark.read.schema(table.schema).option("basePath", f"{root}/tables/{table.name}")
    return reader.parquet(*paths).select(*table.column_names)


def current(spark: SparkSession, root: str) -> Current:
    """The published state (one row per table and period is fetched).

    A whole table takes the place of all periods published before it.
    """
    try:
        log = spark.read.schema(PUBLICATION).json(f"{root}/publications")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Current(0, {})
    latest = log.groupBy("table_name", "period").agg(F.max("seq").alias("seq"), F.max_by("path", "seq").alias("path"))
    rows = latest.collect()
    whole = {r.table_name: r.seq for r in rows if r.period == WHOLE}
    valid = [r for r in rows if r.period == WHOLE or r.seq > whole.get(r.table_name, 0)]
    return Current(max((r.seq for r in rows), default=0), {(r.table_name, r.period): r.path for r in valid})


def _create(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Create a file with its whole content, or give False because it is there already. Readers never see a part."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    hidden = f"_{uuid.uuid4().hex}"  # readers of a folder leave out such names
    if files.getScheme() == "file":
        place = path.toUri().getPath()
        draft = os.path.join(os.path.dirname(place), hidden)
        with open(draft, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, place)  # fails if the name is taken, in one step
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    # A distributed file system renames in one step, and refuses to rename onto a file.
    draft = jvm.org.apache.hadoop.fs.Path(path.getParent(), hidden)
    out = files.create(draft, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if files.rename(draft, path):
        return True
    files.delete(draft, False)
    return False


def publish(
    spark: SparkSession,
    root: str,
    run_id: str,
    paths: Mapping[tuple[str, str], str],
    base: Current,
    reads: Sequence[str] = (),
) -> int:
    """Make the tables of a run current, all in one commit; returns its sequence number.

    Tables are written to new directories and only become visible here, so readers never see a half
    loaded set, and a table is never overwritten while it is read. A commit is one file named by its sequence
    number, created only if there is none of that name, so of two runs that race for a number one gets it and the
    other looks again. `base` is what the run was built on. If another run has since published the same period of
    a table, the whole of a table this one writes a period of (or the other way round), or anything of the tables in
    `reads`, this one is refused; other commits do not matter.
    """
    names = {name for name, _ in paths}
    whole = {name for name, period in paths if period == WHOLE}
    while True:
        now = current(spark, root)
        if now.seq > base.seq:
            log = spark.read.schema(PUBLICATION).json(f"{root}/publications")
            for r in log.where(F.col("seq") > base.seq).select("run_id", "table_name", "period").distinct().collect():
                same = (r.table_name, r.period) in paths or r.table_name in whole
                if same or r.table_name in reads or (r.period == WHOLE and r.table_name in names):
                    raise StaleRunError(f"{root}: {r.run_id} published {r.table_name} since {run_id} began; load again")
        seq = now.seq + 1
        rows = [
            {"seq": seq, "run_id": run_id, "table_name": name, "period": period, "path": path}
            for (name, period), path in paths.items()
        ]
        if _create(spark, f"{root}/publications", f"{seq:020d}.json", "".join(json.dumps(r) + "\n" for r in rows)):
            return seq
