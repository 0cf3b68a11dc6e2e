"""What the operators share: input columns, rolling hashes, word spans, streamed groups.

Every operator reads only the columns it names, so further columns, whatever they are called, change
nothing. A null text counts as empty unless the operator says otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.shared import saved, shared_folder  # noqa: F401

U64 = np.uint64

SEGMENT = 1 << 20  # bytes of a text for which 64-bit arrays are held at a time

# An odd multiplier and its inverse modulo 2**64: a prefix sum of byte * MULTIPLIER**position then gives the
# hash of any byte range by one subtraction and one multiplication.
MULTIPLIER = 0xD1342543DE82EF95
_INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text, a null text as ''."""
    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, of which a reader takes the columns it needs."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def free_names(columns: list[str], *names: str) -> list[str]:
    """Names that none of the columns has, whatever their case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


# Rolling hashes --------------------------------------------------------------------------------------


class _Powers:
    """Powers of the multiplier and of its inverse, grown as longer texts come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, factor in (("up", MULTIPLIER), ("down", _INVERSE)):
                steps = np.full(size, factor, U64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the finishing steps of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which range_hash reads the hash of any range of data (bytes or 64-bit values)."""
    out = np.zeros(len(data) + 1, U64)
    up, _ = _powers.upto(len(data) + 1)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Karp-Rabin hash of data[start:end] for arrays of ranges; equal content of equal length, equal hash."""
    _, down = _powers.upto(len(prefix))
    raw = (prefix[end] - prefix[start]) * down[start]
    return mix(raw ^ ((end - start).astype(U64) * U64(0x9E3779B97F4A7C15)))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every word, some megabytes of text at a time."""
    out = np.zeros(len(starts), U64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SEGMENT)))
        base = starts[first]
        prefix = prefix_hash(data[base : ends[last - 1]])
        out[first:last] = range_hash(prefix, starts[first:last] - base, ends[first:last] - base)
        first = last
    return out


def byte_set(*members: int | range) -> np.ndarray:
    """A look-up table over the 256 byte values."""
    out = np.zeros(256, bool)
    for m in members:
        out[list(m) if isinstance(m, range) else m] = True
    return out


SPACES = byte_set(0x20, range(0x09, 0x0E))


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate(([0] * bool(inside[0]), edges, [len(inside)] * bool(inside[-1]))).astype(np.int64)
    return edges[::2], edges[1::2]


# Arrow batches ---------------------------------------------------------------------------------------

BATCH_BYTES = 1 << 20  # of rows that go to a Python worker at once


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run within send rows to Python in batches of about BATCH_BYTES; the session's own bound holds again after.

    By default a batch is 10,000 rows up to 64 MB. An executor holds one of texts several times over: as Arrow
    buffers on either side of the pipe, in both directions, and as Python's bytes.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], target: int = 1 << 18
) -> Iterator[pa.Table]:
    """Cut sorted rows into tables of about `target` rows that never divide a group of equal keys.

    The rows of a task have to be sorted so that equal keys are neighbours.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < target:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        new = _starts(whole, keys)
        cut = int(new[-1]) if len(new) else 0
        if cut:
            yield whole.slice(0, cut)
        rest = whole.slice(cut).combine_chunks()
        held, rows = rest.to_batches(), rest.num_rows
        target = max(target, 2 * rows) if not cut else target
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    changed = np.zeros(max(0, rows.num_rows - 1), bool)
    for key in keys:
        values = rows.column(key).to_numpy()
        changed |= values[1:] != values[:-1]
    return np.flatnonzero(changed) + 1


def group_bounds(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which groups start, and the row count at the end."""
    return np.concatenate(([0], _starts(rows, keys), [rows.num_rows])).astype(np.int64)
