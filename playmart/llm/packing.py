"""Best-fit packing after Martello-Toth dominance reduction.

Documents are tokenised and cut into pieces of at most `capacity` tokens; only longer documents are cut.
Piece lengths are whole numbers up to the capacity, so the packing problem is a histogram of `capacity`
counts, however many documents there are. That histogram is what the driver solves:

1. Reduction. For the longest remaining length a, the sets that could share its sequence are looked at. If
   one of them dominates, it is fixed, for as many sequences as the counts allow, and the instance shrinks:
   {a} if nothing fits beside it; {a, b} if b fills the rest exactly, or b is the longest that fits and no two
   remaining pieces fit beside a; {a, b, c} if they fill the sequence exactly, no three fit beside a, b is the
   longest that fits and no two pieces longer than c fit (so any pair beside a is matched by b and c in turn).
2. Best fit for what no set dominates: from the longest length down, each sequence takes the piece that
   leaves the least room, until nothing fits.

Both steps give patterns (lengths in a sequence) with a multiplicity. The pieces of each length are numbered
in Spark (per hash class, with offsets from class sizes, so a very common length is not one task) and take
their sequence and place from the pattern table, whose size is bounded by the capacity.

Defined cases: a null or empty text is a single piece, the end id alone. Every input row is packed, also if
rows repeat or ids are null; rows are told apart by a number given before they are saved. An empty table
gives no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.llm.common import doc_texts, saved
from playmart.llm.pieces import vocabulary

CAPACITY = 4096
END_ID = 1

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: its ids, then end_id, cut every `capacity` tokens."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = vocab.encode(text) + end
                for n, begin in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[begin : begin + 4 * capacity]
                    rows.append((doc_id, n, begin // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    return doc_texts(docs).mapInArrow(run, PIECES)


@dataclass(frozen=True)
class Pattern:
    """`times` sequences, each of (length, how many of it) in this order."""

    runs: tuple[tuple[int, int], ...]
    times: int
    fixed: bool  # by dominance, not by best fit


class _Counts:
    """Remaining pieces by length, with the remaining lengths in order."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.of = {k: v for k, v in counts.items() if v}
        self.lengths = sorted(self.of)

    def take(self, length: int, n: int) -> None:
        self.of[length] -= n
        if not self.of[length]:
            del self.of[length]
            self.lengths.pop(bisect_right(self.lengths, length) - 1)

    def longest_upto(self, room: int) -> int | None:
        k = bisect_right(self.lengths, room)
        return self.lengths[k - 1] if k else None


def _dominating(counts: _Counts, capacity: int) -> tuple[int, ...] | None:
    """A set with the longest remaining length that no other set with it beats, or None."""
    a = counts.lengths[-1]
    counts.take(a, 1)  # what remains beside one piece of length a
    try:
        room = capacity - a
        b = counts.longest_upto(room)
        if b is None:
            return (a,)
        if b == room:
            return (a, b)
        small = _smallest(counts, 3)
        if len(small) < 2 or small[0] + small[1] > room:
            return (a, b)
        if len(small) < 3 or sum(small) > room:
            counts.take(b, 1)
            try:
                c = counts.longest_upto(room - b)
                if c is not None and a + b + c == capacity:
                    longer = sorted([*_smallest(counts, 2, above=c), b])  # b was taken out for the moment
                    if b == c or len(longer) < 2 or longer[0] + longer[1] > room:
                        return (a, b, c)
            finally:
                _put(counts, b)
        return None
    finally:
        _put(counts, a)


def _put(counts: _Counts, length: int) -> None:
    if length not in counts.of:
        counts.of[length] = 0
        counts.lengths.insert(bisect_right(counts.lengths, length), length)
    counts.of[length] += 1


def _smallest(counts: _Counts, n: int, above: int = 0) -> list[int]:
    """The n smallest remaining pieces longer than `above`."""
    out: list[int] = []
    for k in range(bisect_right(counts.lengths, above), len(counts.lengths)):
        length = counts.lengths[k]
        out += [length] * min(n - len(out), counts.of[length])
        if len(out) == n:
            break
    return out


def _runs(lengths: tuple[int, ...]) -> tuple[tuple[int, int], ...]:
    return tuple((k, lengths.count(k)) for k in sorted(set(lengths), reverse=True))


def _best_fit_set(counts: _Counts, capacity: int) -> tuple[tuple[int, int], ...]:
    """Longest piece first, then always the one that leaves the least room."""
    room, runs = capacity, []
    while (length := counts.longest_upto(room)) is not None:
        used = sum(n for k, n in runs if k == length)
        n = min(counts.of[length] - used, room // length)
        if not n:  # all pieces of this length are in the sequence already
            k = bisect_right(counts.lengths, length) - 1
            while k >= 0 and any(counts.lengths[k] == r for r, _ in runs):
                k -= 1
            if k < 0:
                break
            length = counts.lengths[k]
            n = min(counts.of[length], room // length)
        runs.append((length, n))
        room -= n * length
    return tuple(runs)


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every piece exactly once."""
    counts = _Counts(histogram)
    out: list[Pattern] = []
    while counts.lengths:
        chosen = _dominating(counts, capacity)
        runs = _runs(chosen) if chosen else _best_fit_set(counts, capacity)
        times = min(counts.of[length] // n for length, n in runs)
        for length, n in runs:
            counts.take(length, n * times)
        out.append(Pattern(runs, times, chosen is not None))
    return out


def _layout(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """length -> arrays over its index ranges: first index, first sequence, pieces per sequence, first place."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        place = 0
        for length, n in p.runs:
            rows.setdefault(length, []).append((used.get(length, 0), sequence, n, place))
            used[length] = used.get(length, 0) + n * p.times
            place += n * length
        sequence += p.times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in rows.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """PIECES with sequence_id, offset and fixed (true if dominance fixed the piece's sequence)."""
    spark = pieces.sparkSession
    classes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    rows = saved(pieces.withColumn("class", F.pmod(key, F.lit(classes)).cast("int")))
    sizes = rows.groupBy("length", "class").count()
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    patterns = solve(histogram, capacity)
    layout = _layout(patterns)
    fixed = np.cumsum([0, *(p.times for p in patterns)]), np.array([p.fixed for p in patterns], bool)

    # Number the pieces of each length: class offsets (a table of lengths x classes), then rows in the class.
    before = F.coalesce(
        F.sum("count").over(Window.partitionBy("length").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    offsets = sizes.select("length", "class", before.alias("before"))
    within = Window.partitionBy("length", "class").orderBy("doc_id", "piece", "ids_crc32")
    numbered = rows.withColumn("nth", F.row_number().over(within) - 1).join(offsets, ["length", "class"])
    names = [c.split()[0] for c in PIECES.split(", ")]
    numbered = numbered.select(*names, (F.col("before") + F.col("nth")).cast("bigint").alias("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            sequence, offset = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            for length in np.unique(lengths):
                here = np.flatnonzero(lengths == length)
                first, base, per, start = layout[int(length)]
                k = np.searchsorted(first, nth[here], side="right") - 1
                at = nth[here] - first[k]
                sequence[here] = base[k] + at // per[k]
                offset[here] = start[k] + at % per[k] * length
            by_dominance = fixed[1][np.searchsorted(fixed[0], sequence, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset), pa.array(by_dominance)],
                [*names, "sequence_id", "offset", "fixed"],
            )

    return numbered.mapInArrow(place, f"{PIECES}, sequence_id bigint, offset bigint, fixed boolean")


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, vocabulary_path, capacity), capacity)
