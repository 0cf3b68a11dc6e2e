"""Benchmark decontamination by greedy string tiling.

Words of documents and benchmark items are compared as sequences. Karp-Rabin hashes of every run of
SEED_WORDS words are the seeds; documents are joined to items where they share one. A pair's seeds make up
its matches (consecutive seeds on one diagonal). The longest match is marked as a tile, what overlaps it is
cut, and so on until no unmarked match of SEED_WORDS words is left. Tiles count wherever they stand, so a
passage with its parts in another order is caught. A document is contaminated by an item if the tiles cover
at least COVERAGE of the item's words.

What is broadcast is a bit filter of fixed size over the items' seeds. It only saves shuffling seeds that no
item has; false hits go away in the join, which also compares the words themselves.

Defined cases: null or empty texts, and items of fewer than SEED_WORDS words, match nothing. Rows that repeat
doc_id and text count once; so do repeated items. A null doc_id or item_id is an id like any other. Of equally
long matches the first in the item, then in the document, is tiled first.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import (
    U64, byte_set, free_names, group_bounds, mix, prefix_hash, range_hash, saved, spans, whole_groups, word_hashes,
)

SEED_WORDS = 5
COVERAGE = 0.5
FILTER_BITS = 1 << 23  # one megabyte
FILTER_HASHES = 3

_WORD = byte_set(range(ord("0"), ord("9") + 1), range(ord("a"), ord("z") + 1), range(0x80, 0x100))

SEEDS = "key bigint, id bigint, place int, hash bigint, words string, n_words int"


def _seeds_of(text: str) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts and ends, and the seed hash at every word that begins one."""
    data = text.lower().encode()
    starts, ends = spans(_WORD[np.frombuffer(data, np.uint8)])
    if len(starts) < SEED_WORDS:
        return data, starts, ends, np.zeros(0, U64)
    words = prefix_hash(word_hashes(np.frombuffer(data, np.uint8), starts, ends))
    at = np.arange(len(starts) - SEED_WORDS + 1)
    return data, starts, ends, range_hash(words, at, at + SEED_WORDS)


def _filter_bits(hashes: np.ndarray) -> list[np.ndarray]:
    return [(mix(hashes + U64(k)) & U64(FILTER_BITS - 1)).astype(np.int64) for k in range(FILTER_HASHES)]


def seeds(table: DataFrame, id_column: str, among: np.ndarray | None = None) -> DataFrame:
    """Seeds of every text; with `among` (a bit filter) only those that may be in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, ident, text in zip(*(c.to_pylist() for c in batch.columns)):
                data, starts, ends, hashes = _seeds_of(text)
                at = np.arange(len(hashes))
                if among is not None:
                    for bits in _filter_bits(hashes):
                        hit = among[bits[at]]
                        at = at[hit]
                for p in at.tolist():
                    words = b" ".join(data[starts[i] : ends[i]] for i in range(p, p + SEED_WORDS))
                    rows.append((key, ident, p, int(hashes[p].view(np.int64)), words.decode(), len(starts)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SEEDS.split(", ")])

    ident, text = F.col(id_column).cast("bigint"), F.coalesce("text", F.lit(""))
    return table.select(F.xxhash64(ident, text).alias("key"), ident.alias("id"), text).mapInArrow(run, SEEDS)


def seed_filter(item_seeds: DataFrame) -> np.ndarray:
    """Bits set for all seed hashes; built in Spark, FILTER_BITS / 64 rows at most reach the driver."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_filter_bits(batch.column(0).to_numpy().view(U64))))
            words, first = np.unique(at >> 6, return_index=True)
            masks = np.bitwise_or.reduceat(U64(1) << (at & 63).astype(U64), first) if len(at) else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(masks.view(np.int64))], ["word", "mask"])

    made = item_seeds.select("hash").mapInArrow(bits, "word bigint, mask bigint")
    rows = made.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[rows["word"]] = rows["mask"]
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def matches(p: np.ndarray, q: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal matches (place in the document, in the item, words) from the places of shared seeds."""
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] - q[1:] != p[:-1] - q[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(p))) + SEED_WORDS - 1
    return list(zip(p[first].tolist(), q[first].tolist(), size.tolist()))


def tile(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Greedy tiling: longest unmarked match first; a match that meets marked words is cut and looked at again."""
    heap = [(-n, q, p) for p, q, n in found]
    heapq.heapify(heap)
    marked_p: set[int] = set()
    marked_q: set[int] = set()
    tiles = []
    while heap:
        n, q, p = heapq.heappop(heap)
        n = -n
        free = [p + i not in marked_p and q + i not in marked_q for i in range(n)]
        if all(free):
            tiles.append((p, q, n))
            marked_p.update(range(p, p + n))
            marked_q.update(range(q, q + n))
            continue
        starts, ends = spans(np.array(free))
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s >= SEED_WORDS:
                heapq.heappush(heap, (s - e, q + s, p + s))
    return tiles


PAIRS = (
    "doc_key bigint, doc_id bigint, item_id bigint, item_words int, covered_words int, n_tiles int, "
    "tiles array<struct<doc_word:int,item_word:int,words:int>>"
)
_TILE = pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())]))


def _tilings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["doc_key", "item_key"]
    for rows in whole_groups(batches, keys):
        p, q = rows.column("p").to_numpy(), rows.column("q").to_numpy()
        bounds = group_bounds(rows, keys)
        tiles = [tile(matches(p[a:b], q[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]
        first = rows.take(pa.array(bounds[:-1]))
        yield pa.RecordBatch.from_arrays(
            [
                *(first.column(c).combine_chunks() for c in ("doc_key", "doc_id", "item_id", "item_words")),
                pa.array([sum(t[2] for t in ts) for ts in tiles], pa.int32()),
                pa.array([len(ts) for ts in tiles], pa.int32()),
                pa.array([[dict(zip(("doc_word", "item_word", "words"), t)) for t in ts] for ts in tiles], _TILE),
            ],
            ["doc_key", "doc_id", "item_id", "item_words", "covered_words", "n_tiles", "tiles"],
        )


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """PAIRS with coverage, for the documents and items where the tiles cover enough of the item."""
    items = saved(seeds(benchmark.select("item_id", "text").distinct(), "item_id"))
    items = items.select(
        F.col("key").alias("item_key"), F.col("id").alias("item_id"), F.col("place").alias("q"),
        F.col("n_words").alias("item_words"), "hash", "words",
    )
    found = seeds(docs.select("doc_id", "text"), "doc_id", seed_filter(items)).select(
        F.col("key").alias("doc_key"), F.col("id").alias("doc_id"), F.col("place").alias("p"), "hash", "words"
    )
    # Repeated rows give repeated seeds, which are one here.
    shared = found.join(items, ["hash", "words"]).drop("hash", "words").distinct()
    keys = ["doc_key", "item_key"]
    tiled = shared.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_tilings, PAIRS)
    covered = F.col("covered_words") / F.col("item_words")
    return tiled.withColumn("coverage", covered).where(F.col("coverage") >= coverage)


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that no item contaminates."""
    (bad,) = free_names(docs.columns, "bad")
    found = contaminated_pairs(docs, benchmark, coverage).select(F.col("doc_key").alias(bad)).distinct()
    key = F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")))
    return docs.join(found, key == F.col(bad), "left_anti")
