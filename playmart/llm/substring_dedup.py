"""Exact removal of repeated byte strings by threshold-bounded interval expansion.

A byte goes if a string of MIN_BYTES that covers it also starts earlier. A suffix array and a Burrows-Wheeler
transform of all text would be one sorted object; here both are sparse. In every document a few positions are
taken as anchors, chosen by content alone: the smallest hash of GRAM bytes in every window of MIN_BYTES. Equal
strings of MIN_BYTES therefore hold an anchor at the same place, and it is enough to sort the suffixes that
begin at anchors and to extend those to the left.

1. Anchors are dealt out by the hash of their GRAM bytes. An anchor whose whole surroundings (all strings of
   MIN_BYTES through it) stand equally around an earlier anchor is covered with them. Within an Arrow batch
   that is settled before the shuffle, so copies reach it once per batch, not once per document.
2. What is left of each gram are the first of each kind of surroundings. Only where there is more than one
   kind, their bytes are fetched from the documents.
3. Interval expansion. The surroundings of the anchors of a gram are aligned at it. From the last byte of the
   surroundings backwards, all intervals are extended by one byte at once: sorted by the byte to their left
   (their Burrows-Wheeler column), rows that stay together in an interval share one byte more. Common prefixes
   so arise by increasing value and are followed up to MIN_BYTES; nothing is compared directly. What is an
   interval of MIN_BYTES r bytes before the anchor is one string there: all but its first member are repeated.
   Rows that no longer share the gram and what was passed since with any other take no further step.
4. Covered ranges are put together per document and cut out.

Defined cases: a null or empty text has no bytes; texts shorter than MIN_BYTES lose nothing. Rows that repeat
a doc_id are documents of their own, ordered by the hash of their text, so of wholly repeated rows one stays
whole. Rows without a doc_id come before all others, ordered by that hash. Strings are judged on the input,
overlapping ones too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.llm.common import (
    SEGMENT, U64, doc_texts, mix, prefix_hash, range_hash, whole_groups,
)

MIN_BYTES = 100
GRAM = 32
SIDE = MIN_BYTES - GRAM  # bytes that a string through an anchor may reach to either side of its gram
WINDOWS = SIDE + 1  # strings of MIN_BYTES through an anchor
DOCS = 512  # documents of an Arrow batch that are worked on, and sent on, at a time
SENT = 1 << 15  # anchors sent on at a time


def _sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """pick (minimum or maximum) over every window, by doubling."""
    size, out = 1, values
    while 2 * size <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    n = len(values) - width + 1
    return pick(out[:n], out[width - size : width - size + n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, gram hash and hash of the surroundings (with their extent) of all anchors of a text.

    A segment of a long text is looked at with what its windows reach on both sides; an anchor of windows of
    two segments is found in both and counts once.
    """
    n = len(data)
    if n < MIN_BYTES:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    found = []
    for first in range(0, n - MIN_BYTES + 1, SEGMENT):
        last = min(first + SEGMENT, n - MIN_BYTES + 1)  # windows that begin from first to last
        low, high = max(0, first - SIDE), min(n, last + 2 * MIN_BYTES)
        part = _anchors_of_part(data[low:high], first - low, last - low)
        found.append((part[0] + low, *part[1:]))
    pos, gram, around = (np.concatenate(x) for x in zip(*found))
    pos, once = np.unique(pos, return_index=True)
    return pos, gram[once], around[once]


def _anchors_of_part(data: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows that begin in data from first to last (exclusive)."""
    n = len(data)
    prefix = prefix_hash(data)
    at = np.arange(first, last + SIDE)
    grams = range_hash(prefix, at, at + GRAM)
    least = _sliding(grams, WINDOWS, np.minimum)
    pad = np.zeros(SIDE, U64)
    chosen = np.flatnonzero(_sliding(np.concatenate((pad, least, pad)), WINDOWS, np.maximum) == grams)
    gram = grams[chosen]
    chosen = chosen + first
    low, high = np.maximum(chosen - SIDE, 0), np.minimum(chosen + MIN_BYTES, n)
    around = mix(range_hash(prefix, low, high) + (chosen - low).astype(U64))
    return chosen, gram, around


KEYED = "gram bigint, around bigint, doc bigint, sub int, pos int"
_KEYED = [c.split()[0] for c in KEYED.split(", ")]
SETTLED = 0  # value of `around` for anchors that are settled already; no hash is kept at it


def _batch(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that hold all values of a binary column, not copied, and the places where each begins and the last ends."""
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    bounds = places[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8), bounds


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """KEYED rows. Anchors with an equal one earlier in the batch go on as settled, under a spread key."""
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, sub = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        data, bounds = _flat(batch.column(2))
        # In the order of documents and, in each, of places: the first of equal anchors is the one that leads.
        in_order = np.lexsort((sub, doc))
        found = [anchors(data[bounds[k] : bounds[k + 1]]) for k in in_order.tolist()]
        row = np.repeat(in_order.astype(np.int32), [len(f[0]) for f in found])
        if not len(row):
            continue
        pos = np.concatenate([f[0].astype(np.int32) for f in found])
        gram, around = (np.concatenate([f[k] for f in found]) for k in (1, 2))
        del found
        around[around == SETTLED] = 1
        order = np.lexsort((around, gram))
        same = (gram[order[1:]] == gram[order[:-1]]) & (around[order[1:]] == around[order[:-1]])
        settled = order[1:][same]
        del order, same
        around[settled] = SETTLED
        gram[settled] = mix(doc[row[settled]].astype(U64) ^ mix(pos[settled].astype(U64)))
        for k in range(0, len(row), SENT):
            part = slice(k, k + SENT)
            of = row[part]
            yield _batch([gram[part].view(np.int64), around[part].view(np.int64), doc[of], sub[of], pos[part]], _KEYED)


REQUESTS = "doc bigint, sub int, pos int, gram bigint, whole boolean"
_REQUESTS = [c.split()[0] for c in REQUESTS.split(", ")]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors covered with all their surroundings, and those still to be compared.

    Rows come sorted by gram, surroundings and place, so the first row of each kind of surroundings leads it. Only
    that first row of a gram waits for a second kind; a gram of any size passes without being held.
    """
    last: tuple[int, int] | None = None  # gram and surroundings of the row before
    waiting: list[np.ndarray] | None = None  # the first row of a gram with one kind so far
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in _KEYED]
        done = columns[1] == SETTLED
        gram, _, doc, sub, pos = (c[done] for c in columns)
        if len(gram):
            yield _batch([doc, sub, pos, gram, np.ones(len(gram), bool)], _REQUESTS)
        rows = [c[~done] for c in columns]
        if not len(rows[0]):
            continue
        before = [np.concatenate(([0 if last is None else last[k]], rows[k][:-1])) for k in (0, 1)]
        same_gram = rows[0] == before[0]
        if last is None:
            same_gram[0] = False
        same = same_gram & (rows[1] == before[1])
        last = (int(rows[0][-1]), int(rows[1][-1]))
        # The first rows of all kinds; they are to be compared if their gram has another kind.
        leads = [c[~same] for c in rows]
        starts = ~same_gram[~same]
        if waiting is not None:
            leads = [np.concatenate(x) for x in zip(waiting, leads)]
            starts = np.concatenate(([True], starts))
        next_starts = np.append(starts[1:], True)
        compared = ~starts | ~next_starts
        waiting = [c[-1:] for c in leads] if len(starts) and starts[-1] else None
        whole = [c[same] for c in rows]
        gram, _, doc, sub, pos = (np.concatenate((w, c[compared])) for w, c in zip(whole, leads))
        if len(gram):
            yield _batch([doc, sub, pos, gram, np.arange(len(gram)) < len(whole[0])], _REQUESTS)


PARTS = "gram bigint, doc bigint, sub int, pos int, low int, high int, bytes binary"
_PARTS = [c.split()[0] for c in PARTS.split(", ")]


def _merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges covered by the given ones."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(end)) - 1]


def _listed(column: pa.Array, *names: str) -> list[np.ndarray]:
    """The fields of all structs in a column of lists (null: none), after the row that each belongs to."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = column.flatten()
    row = np.repeat(np.arange(len(counts)), counts)
    return [row, *(flat.field(n).to_numpy(zero_copy_only=False) for n in names)]


ROW = 33  # bits of a place within a text, in numbers that hold a row too


def _merge_rows(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """_merge for the ranges of many rows."""
    low, high = _merge(row << ROW | low, row << ROW | high)
    return low >> ROW, low & ((1 << ROW) - 1), high & ((1 << ROW) - 1)


def _parts(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """data[begin:end] for many ranges, as a binary column."""
    bounds = np.concatenate(([0], np.cumsum(end - begin)))
    at = np.arange(bounds[-1]) + np.repeat(begin - bounds[:-1], end - begin)
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data[at])]
    return pa.Array.from_buffers(pa.binary(), len(begin), buffers)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PARTS rows: the ranges covered so far (no bytes, spread key), and the surroundings of open anchors."""
    for batch in (b.slice(k, DOCS) for b in batches for k in range(0, b.num_rows, DOCS)):
        doc, sub = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        data, bounds = _flat(batch.column(2))
        row, pos, gram, whole = _listed(batch.column(3), "pos", "gram", "whole")
        pos = pos.astype(np.int64)
        low, high = np.maximum(pos - SIDE, 0), np.minimum(pos + MIN_BYTES, np.diff(bounds)[row])
        of, begin, end = _merge_rows(row[whole], low[whole], high[whole]) if whole.any() else [np.zeros(0, np.int64)] * 3
        row, pos, gram, low, high = (x[~whole] for x in (row, pos, gram, low, high))
        key = mix(doc.astype(U64)).view(np.int64)
        both = np.concatenate((of, row))
        columns = [
            np.concatenate((key[of], gram)), doc[both], sub[both],
            *(np.concatenate(x).astype(np.int32) for x in ((np.full(len(of), -1), pos), (begin, low), (end, high))),
        ]
        for k in range(0, len(both), SENT):
            known = max(0, min(len(of) - k, SENT))  # of the rows sent, those that are covered
            mine = slice(k + known - len(of), k + SENT - len(of)) if k + SENT > len(of) else slice(0, 0)
            texts = _parts(data, bounds[row[mine]] + low[mine], bounds[row[mine]] + high[mine])
            sent = [pa.array(c[k : k + SENT]) for c in columns]
            yield pa.RecordBatch.from_arrays([*sent, pa.concat_arrays([pa.nulls(known, pa.binary()), texts])], _PARTS)


COVERED = "doc bigint, sub int, low int, high int"
_COVERED = [c.split()[0] for c in COVERED.split(", ")]


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first..last], last included, for many ranges."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    for k in np.unique(level):
        of = level == k
        out[of] = np.minimum(table[k][first[of]], table[k][last[of] - (1 << k) + 1])
    return out


def _extended(order: np.ndarray, common: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One backward step for all intervals at once.

    order: rows sorted by what stands from some column on; common: common prefix of each with the one before;
    symbols: one more than the byte before that column, 0 where there is none, in that order. The stable sort by it (the mapping of last
    to first column) gives the order one column earlier. Neighbours with one symbol were an interval before,
    whose common prefix is the least within it: theirs is one more, at most MIN_BYTES.
    """
    moved = np.argsort(symbols, kind="stable")
    sorted_column = symbols[moved]
    longer = np.zeros(len(order), np.uint8)
    same = np.flatnonzero((sorted_column[1:] == sorted_column[:-1]) & (sorted_column[1:] > 0)) + 1
    if len(same):
        longer[same] = np.minimum(_least(common, moved[same - 1] + 1, moved[same]), MIN_BYTES - 1) + 1
    return order[moved], longer


def repeated_windows(around: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Interval expansion over the surroundings of anchors, given in their order of place.

    around: rows of SIDE + GRAM + SIDE bytes with the gram in the middle; left, right: bytes of the text that stand
    before and after the gram. Returns, for every row and every number r of bytes, whether the string of MIN_BYTES
    that begins r bytes before the anchor is also in an earlier row. Such a string holds the whole gram, so rows of
    different grams have none in common and may be given together.
    """
    n, width = around.shape
    repeated = np.zeros((n, WINDOWS), bool)
    order, common = np.arange(n), np.zeros(n, np.uint8)
    for column in range(width - 1, -1, -1):
        inside = (left[order] >= SIDE - column) & (right[order] > column - SIDE - GRAM)
        symbols = np.where(inside, around[order, column].astype(np.uint16) + np.uint16(1), np.uint16(0))
        order, common = _extended(order, common, symbols)
        r = SIDE - column
        if r < 0:
            continue
        starts = np.flatnonzero(common < MIN_BYTES)
        later = np.ones(len(order), bool)
        first = np.minimum.reduceat(order, starts)
        later[order == np.repeat(first, np.diff(np.append(starts, len(order))))] = False
        repeated[order[later], r] = True
        # A row that shares less than its gram and what was passed since with both neighbours is done.
        near = np.maximum(common, np.append(common[1:], 0))
        kept = np.flatnonzero(near >= GRAM + r)
        if not len(kept):
            break
        order, common = order[kept], np.minimum.reduceat(common[: kept[-1] + 1], np.append(0, kept[:-1] + 1))
    return repeated


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """COVERED rows from PARTS sorted by gram."""
    for rows in whole_groups(batches, ["gram"], SENT):
        doc, sub, pos, low, high = (rows.column(c).to_numpy() for c in _PARTS[1:6])
        known = pos < 0
        if known.any():
            yield _batch([doc[known], sub[known], low[known], high[known]], _COVERED)
        there = np.flatnonzero(~known)
        there = there[np.lexsort((pos[there], sub[there], doc[there]))]
        if not len(there):
            continue
        doc, sub, pos, low, high = (x[there] for x in (doc, sub, pos, low, high))
        data, bounds = _flat(rows.column("bytes").combine_chunks())
        around = np.zeros((len(there), SIDE + MIN_BYTES), np.uint8)
        begin = SIDE - (pos - low)
        for k, (b, e, at) in enumerate(zip(begin.tolist(), (begin + high - low).tolist(), bounds[there].tolist())):
            around[k, b:e] = data[at : at + e - b]
        repeated = repeated_windows(around, pos - low, high - pos - GRAM)
        # Consecutive steps r cover one range of bytes.
        edge = np.diff(np.pad(repeated.view(np.int8), ((0, 0), (1, 1))), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        if len(row):
            begin = (pos[row] - last).astype(np.int32)
            end = (pos[row] - first + MIN_BYTES).astype(np.int32)
            yield _batch([doc[row], sub[row], begin, end], _COVERED)


REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(k, DOCS) for b in batches for k in range(0, b.num_rows, DOCS)):
        doc, sub = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        data, bounds = _flat(batch.column(2))
        data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
        row, low, high = _listed(batch.column(3), "low", "high")
        if len(row):
            row, low, high = _merge_rows(row, low.astype(np.int64), high.astype(np.int64))
        kept = np.ones(len(data), bool)
        for a, b in zip((bounds[row] + low).tolist(), (bounds[row] + high).tolist()):
            kept[a:b] = False
        count = np.bincount(row, minlength=len(doc))
        removed = np.bincount(row, high - low, len(doc)).astype(np.int64)
        n = np.diff(bounds)
        ends = np.concatenate(([0], np.cumsum(n - removed))).astype(np.int32)
        texts = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(data[kept])])
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, mask=sub & 1 == 0), pa.array(n), pa.array(removed), pa.array(count), texts],
            [c.split()[0] for c in REMOVED.split(", ")],
        )


def _with(base: DataFrame, more: DataFrame, how: str) -> DataFrame:
    """Rows of base with what `more` has of the same document."""
    more = more.withColumnsRenamed({"doc": "_doc", "sub": "_sub"})
    same = (F.col("doc") == F.col("_doc")) & (F.col("sub") - F.col("_sub") == 0)
    return base.join(more, same, how).drop("_doc", "_sub")


def remove_repeated(docs: DataFrame) -> DataFrame:
    """REMOVED for every row: kept holds the remaining bytes."""
    # Inside the operator a row without a doc_id has one below -2**62, by its text.
    no_id = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(-(1 << 63))
    text = doc_texts(docs).select(
        F.coalesce("doc_id", no_id).alias("doc"), F.col("doc_id").isNotNull().alias("named"),
        F.col("text").cast("binary").alias("text"),
    )
    # Dealt out by document once: the anchors, the fetched bytes and the cut texts all read this exchange. The
    # joins below are on doc alone for that, and all three ask for the same columns; sub only tells rows of one doc_id
    # apart, and its last bit says whether the row has one.
    row = F.row_number().over(Window.partitionBy("doc").orderBy(F.xxhash64("text"))) - 1
    sub = (row * 2 + F.col("named").cast("int")).cast("int")
    base = text.withColumn("sub", sub).select("doc", "sub", "text")
    found = base.mapInArrow(_find_anchors, KEYED).repartition("gram").sortWithinPartitions(*_KEYED)
    wanted = found.mapInArrow(_settle, REQUESTS).repartition("doc").groupBy("doc", "sub").agg(
        F.collect_list(F.struct("pos", "gram", "whole")).alias("wanted")  # of one document
    )
    parts = _with(base, wanted, "inner").select("doc", "sub", "text", "wanted").mapInArrow(_fetch, PARTS)
    ranges = parts.repartition("gram").sortWithinPartitions("gram").mapInArrow(_expand, COVERED)
    covered = ranges.repartition("doc").groupBy("doc", "sub").agg(
        F.collect_list(F.struct("low", "high")).alias("covered")
    )
    return _with(base, covered, "left").select("doc", "sub", "text", "covered").mapInArrow(_cut, REMOVED)

