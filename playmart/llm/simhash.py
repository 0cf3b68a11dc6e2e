"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two fingerprints of 64 bits that differ in at most 4 have at least 4 of their 8 bytes in common, place by
place. The index has postings of bytes with their positions; three positions are taken together per posting,
which keeps posting lists short as the data grows. The 20 position triples are chosen so that any 4 shared
positions hold one of them, so no pair that can reach the minimum is missed. Within a posting list the shared
positional bytes of a pair are tallied, pairs with at least 4 are kept, and only the bits of
those are compared; most pairs of a list share just its three. Both fingerprints of a pair stand in the list, so
its one tally counts all eight positions, and no pair is shuffled to be tallied over several lists.

Equal fingerprints are one node. Of each posting list only links that connect it are given on (a spanning
forest), not all pairs. Lists longer than BLOCK are cut into blocks by hash and every pair of blocks is
compared in a task of its own, so no task holds a whole hot list and no link is lost.

Defined cases: a null or empty text has fingerprint zero and is linked like any other. Rows with the same
doc_id are kept as rows in near_duplicates; a null doc_id takes part and counts as larger than all others when
the smallest id of a component is taken. first_of_groups judges rows, not ids: one row of a group
stays, one of the smallest id, or one without an id where no row has one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import U64, doc_texts, free_names, group_bounds, saved, utf8, whole_groups
from playmart.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BYTES = 8
MIN_SHARED = BYTES - MAX_BITS  # bytes two linked fingerprints share at least
BLOCK = 20_000  # most members of a posting list compared in one task


def triples() -> list[tuple[int, int, int]]:
    """Positions per posting: of any four positions, one triple is among them.

    The positions form three groups in a ring. A triple is taken if it lies in one group, or has two
    positions in one group and one in the next.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]

    def taken(t: tuple[int, int, int]) -> bool:
        g = [group[i] for i in t]
        return len(set(g)) == 1 or any(g.count(k) == 2 and g.count((k + 1) % 3) == 1 for k in range(3))

    return [t for t in combinations(range(BYTES), 3) if taken(t)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the XXH64 bits of all word shingles, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    step = 1 << 16
    for k in range(0, n, step):
        cuts = zip(starts[k : min(n, k + step)].tolist(), last[k : min(n, k + step)].tolist())
        hashed = b"".join([digest(joined[s:e], SEED) for s, e in cuts])
        bits = np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _printed(rows: DataFrame, shingle: int) -> DataFrame:
    """fp (the 64 bits as a signed number) in place of text, the last column; the others are bigint."""
    names = [*rows.columns[:-1], "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in utf8(batch.columns[-1])], U64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names)

    return rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed number) of every row."""
    return _printed(doc_texts(docs), shingle)


def tally(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared positional bytes of every pair."""
    differ = a ^ b
    marks = differ | (differ >> U64(4))
    marks |= marks >> U64(2)
    marks |= marks >> U64(1)
    return BYTES - np.bitwise_count(marks & U64(0x0101010101010101))


def linked(a: np.ndarray, b: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Tally the shared positional bytes, keep the pairs with enough of them, verify the bits of those; a is an array."""
    kept = tally(a, b) >= BYTES - max_bits
    at = np.flatnonzero(kept)
    kept[at] = np.bitwise_count(a[at] ^ (b[at] if np.ndim(b) else b)) <= max_bits
    return kept


def _forest(f: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is linked within one posting list, by search from unvisited members."""
    out = []
    left = np.arange(len(f))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            hit = linked(f[left], f[u], max_bits)
            if hit.any():
                near = left[hit]
                out.append((np.full(len(near), f[u]), f[near]))
                queue.extend(near)
                left = left[~hit]
    return out


def _contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node to the smallest it is connected to by the given ones."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _links(max_bits: int, contract: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["t", "bytes", "part"]
        for rows in whole_groups(batches, keys):
            f = rows.column("fp").to_numpy().view(U64)
            bounds = group_bounds(rows, keys)
            size = np.diff(bounds)
            found = []
            # Short lists together: every member with the one k places on, as long as that is in its list.
            group = np.repeat(np.arange(len(size)), size)
            short = size[group] <= 64
            for k in range(1, int(size[size <= 64].max(initial=0))):
                i = np.flatnonzero((group[k:] == group[:-k]) & short[k:])
                hit = linked(f[i], f[i + k], max_bits)
                found.append((f[i[hit]], f[i[hit] + k]))
            for g in np.flatnonzero(size > 64):
                found += _forest(f[bounds[g] : bounds[g + 1]], max_bits)
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                if contract:
                    a, b = _contract(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, contract: bool = False) -> DataFrame:
    """Links a, b that connect all distinct fp at most max_bits apart; max_bits is 4 at most.

    With contract=True a task replaces the links it has found by links to the smallest connected node, which
    need not be near itself: fewer links and steps where only the components are wanted.
    """
    masks = []
    for n, t in enumerate(triples()):
        mask = sum(0xFF << (8 * i) for i in t)
        mask -= (mask >> 63) << 64
        masks.append(F.struct(F.lit(n).alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bytes")))
    postings = nodes.select("fp", F.inline(F.array(*masks)))
    sizes = postings.groupBy("t", "bytes").count().where("count > 1")
    blocks = sizes.select("t", "bytes", F.ceil(F.col("count") / block).cast("int").alias("n"))
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("n")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - 2, F.lit(0)))).alias("other")
    # With n blocks a member goes to the n - 1 pairs it is part of; a single block is its own pair.
    rows = postings.join(blocks, ["t", "bytes"]).select("t", "bytes", "fp", "n", mine.alias("mine"), other)
    partner = F.col("other") + F.when(F.col("other") >= F.col("mine"), 1).otherwise(0)
    part = F.when(F.col("n") == 1, 0).otherwise(
        F.least("mine", partner) * F.col("n") + F.greatest("mine", partner)
    )
    keys = ["t", "bytes", "part"]
    dealt = rows.select("t", "bytes", part.cast("int").alias("part"), "fp").repartition(*keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(_links(max_bits, contract), "a bigint, b bigint")


def _check(max_bits: int) -> None:
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits is between 0 and {MAX_BITS}")


def _labelled(nodes: DataFrame, max_bits: int) -> DataFrame:
    """nodes (distinct fp, any other columns) with root, the same for all of a component."""
    found = components(links(nodes.select("fp"), max_bits, contract=True)).withColumnRenamed("node", "fp")
    return saved(nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (smallest doc_id that can be reached) of every row."""
    _check(max_bits)
    rows = saved(fingerprints(docs, shingle))
    labelled = _labelled(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), max_bits)
    # Saved, so that the join is on a plain shuffle, where Spark splits a component of very many fingerprints.
    smallest = saved(labelled.groupBy("root").agg(F.min("first").alias("component_id")))
    by_fp = labelled.join(smallest, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(by_fp, "fp").select("doc_id", hexed, "component_id")


def first_of_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Of every component one row: the first of the smallest id, or of those without an id if none has one."""
    _check(max_bits)
    # Written with a key of its own for every row, which stays the same however often it is read.
    (row,) = free_names([*docs.columns, "fp", "root", "first"], "row")
    keyed = saved(docs.withColumn(row, F.monotonically_increasing_id()))
    texts = keyed.select(F.col("doc_id").cast("bigint"), F.col(row).alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    rows = saved(_printed(texts, shingle))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")).alias("first")
    labelled = _labelled(rows.groupBy("fp").agg(least), max_bits)
    first = labelled.groupBy("root").agg(F.min("first")["_row"].alias("stays"))
    by_fp = labelled.select("fp", "root").join(saved(first), "root").drop("root")
    later = rows.join(by_fp, "fp").where(F.col("_row") != F.col("stays")).select(F.col("_row").alias(row))
    return keyed.join(later, row, "left_anti").select(*docs.columns)
