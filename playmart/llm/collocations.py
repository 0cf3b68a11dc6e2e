"""Phrases whose words keep company, mined as Toivonen does: a sample proposes, a full pass counts.

A text falls into pieces and those into words; a phrase is a run of up to MAX_WORDS words of a piece. A phrase is
frequent if it occurs MIN_COUNT times in its language, and then so is every phrase within it.

A share of the pieces, drawn by hash, is mined for phrases that are frequent in it at a lowered bound: the proposal.
One pass over all rows then counts the proposal and its negative border. The border is what the proposal lacks while
it has all phrases within it that are one word shorter: words that were not proposed, and longer phrases whose first
and last parts were. A border phrase that turns out to be frequent is a failure of the sample, and another pass
counts whatever holds a failure. That closes the search: a frequent phrase that the first pass left out holds a
shortest phrase that was not proposed, which was in the border, is frequent, and so is a failure. The result is that of
counting everything, whatever was drawn.

Phrases of the result are told apart exactly, never by hash: tasks number them by their words and count per chunk of
text, Spark sums by the phrase itself. Border phrases, most of which are rare, are counted under a hash of HASH_BITS bits:
those that share one can only seem more frequent than they are, and every failure is counted again by its words.

Tasks know the proposal as a bit set of FILTER_BITS bits over hashes of phrases, which is all that is broadcast and
all that the driver gets. A false hit counts a phrase that could have been left out, which changes nothing. Where a
proposal is far larger than the set, the passes leave less out and the counts stay exact.

Counts are combined in the map tasks, so a hot language, source or phrase is no hot group anywhere.
Sub-phrases and cuts are joined by phrase, and the final ranking keeps the best rows of each task before the shuffle.

Defined cases: a null text has no words, a null language is `und`. Every row counts, repeated or without an id.
Words keep all bytes but blanks; A-Z are lower-cased. An empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmart.llm.common import U64, byte_set, mix, spans, utf8, word_hashes
from playmart.shared import saved

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000  # phrases of each language that are returned
PARTS = 64  # into which the phrases of a language are dealt for the ranking
WITHIN_PERCENT = 100  # a phrase goes if a longer one has this share of its count
SAMPLE_SHARE = 8  # one piece in so many is drawn
LOWERED = 0.7  # part of MIN_COUNT, in proportion to the share, from which the sample proposes
FILTER_BITS = 1 << 25  # four megabytes
CHUNK = 1 << 21  # bytes of text whose phrases are counted together
ROWS = 256  # rows turned into Python objects at a time

BLANKS = byte_set(0x20, 0x09)
BREAKS = byte_set(*b".,;:!?", range(0x0A, 0x0E))
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

HASH_BITS = 40  # of a phrase's hash that are kept; above them stands its number of words

COUNTS = "key bigint, name string, n bigint"  # name: language, tab, phrase; none for a phrase counted by hash


class Chunk:
    """The words of some texts: their dictionary, the piece and language that each is in, hashes of phrases."""

    def __init__(self, langs: list[str], texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join(texts).translate(_LOWER), np.uint8)
        breaks = BREAKS[data]
        inside = ~(BLANKS[data] | breaks)
        starts, ends = spans(inside)
        self.size = len(starts)
        self.piece = np.searchsorted(np.flatnonzero(breaks), starts)
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(text_ends, starts, side="right")
        self.names, lang_of_text = np.unique(np.array(langs, object), return_inverse=True)
        self.lang = lang_of_text[self.text]

        offsets = np.concatenate(([0], np.cumsum(ends - starts)))
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside].tobytes())]
        encoded = pa.Array.from_buffers(pa.large_binary(), self.size, buffers).dictionary_encode()
        self.dictionary = encoded.dictionary
        self.words = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.n_words = max(1, len(self.dictionary))

        _, edges, content = (b and np.frombuffer(b, np.uint8) for b in self.dictionary.buffers())
        edges = edges.view(np.int64)[: len(self.dictionary) + 1]
        self._word_hash = word_hashes(content, edges[:-1], edges[1:])[self.words]
        names = [n.encode() for n in self.names]
        edges = np.concatenate(([0], np.cumsum([len(n) for n in names]))).astype(np.int64)
        of_lang = word_hashes(np.frombuffer(b"".join(names), np.uint8), edges[:-1], edges[1:])
        self._hashes = [mix(self._word_hash ^ mix(of_lang[self.lang] + U64(1)))] if self.size else [np.zeros(0, U64)]

    def whole(self, k: int) -> np.ndarray:
        """Whether the k words from each word stand in one piece."""
        count = max(0, self.size - k + 1)
        return self.piece[:count] == self.piece[self.size - count :]

    def hashes(self, k: int) -> np.ndarray:
        """Hash of the phrase of k words from every word that has k - 1 others behind it."""
        while len(self._hashes) < k:
            last = self._hashes[-1][:-1]
            added = self._word_hash[len(self._hashes) :]
            self._hashes.append(mix(last * U64(0x9E3779B97F4A7C15) + added + U64(1)))
        return self._hashes[k - 1]

    def phrases(self, at: np.ndarray, k: int) -> pa.RecordBatch:
        """Distinct phrases of k words among those that begin at some words, with their counts."""
        code = self.lang[at] * self.n_words + self.words[at]
        for j in range(1, k):
            code = pd.factorize(code)[0] * self.n_words + self.words[at + j]
        code, found = pd.factorize(code)
        first = np.empty(len(found), np.int64)
        first[code[::-1]] = at[::-1]
        parts = [self.dictionary.take(pa.array(self.words[first + j])) for j in range(k)]
        joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if k > 1 else parts[0]
        names = pa.array(self.names[self.lang[first]], pa.large_binary())
        named = pc.binary_join_element_wise(names, joined, pa.scalar(b"\t", pa.large_binary()))
        counts = np.bincount(code, minlength=len(found))
        return _rows(_keys(self.hashes(k)[first], k), named.cast(pa.large_string()).cast(pa.string()), counts)

    def hashed(self, at: np.ndarray, k: int) -> pa.RecordBatch:
        """Hashes of the phrases of k words that begin at some words, with their counts."""
        code, found = pd.factorize(_keys(self.hashes(k)[at], k))
        return _rows(found, pa.nulls(len(found), pa.string()), np.bincount(code, minlength=len(found)))

    def totals(self) -> pa.RecordBatch:
        """Words of each language, as the phrase of no words."""
        names = pa.array([f"{n}\t" for n in self.names], pa.string())
        return _rows(np.zeros(len(names), np.int64), names, np.bincount(self.lang, minlength=len(names)))


def _keys(hashes: np.ndarray, k: int) -> np.ndarray:
    return (hashes & U64((1 << HASH_BITS) - 1) | U64(k << HASH_BITS)).view(np.int64)


def _rows(keys: np.ndarray, names: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), names, pa.array(counts.astype(np.int64))], ["key", "name", "n"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, so that no whole batch is held as Python objects."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def _chunks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[Chunk]:
    """Chunks of at least so many bytes; a text is never divided."""
    langs: list[str] = []
    texts: list[bytes] = []
    size = 0
    for rows in _slices(batches):
        for lang, text in zip(rows.column(0).to_pylist(), utf8(rows.column(1))):
            langs.append(lang)
            texts.append(text)
            size += len(text)
            if size >= least:
                yield Chunk(langs, texts)
                langs, texts, size = [], [], 0
    if texts:
        yield Chunk(langs, texts)


# Bit sets ----------------------------------------------------------------------------------------------


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & U64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _bits_of(hashes: DataFrame, size: int) -> np.ndarray:
    """The bit set, of size bits, of the hashes in a column of keys. That is all the driver gets."""
    at = F.col("key").bitwiseAND(F.lit(size - 1).cast("bigint"))
    bit = F.expr("shiftleft(1L, CAST(key & 63 AS INT))").alias("bit")
    words = hashes.select(F.shiftright(at, 6).alias("word"), bit).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toPandas()
    bits = np.zeros(size // 64, np.int64)
    bits[found["word"]] = found["bits"]
    return bits.view(np.uint8)


def _all_parts(known: np.ndarray, count: int, shifts: int) -> np.ndarray:
    """Whether a phrase from each word has all of its parts in a set; shifts: parts that a phrase has."""
    out = known[:count].copy()
    for shift in range(1, shifts):
        out &= known[shift : shift + count]
    return out


class Proposal:
    """A bit set, broadcast once, of proposed phrases of up to so many words."""

    def __init__(self, context: SparkContext, bits: np.ndarray, length: int) -> None:
        self.shared, self.length = context.broadcast(bits), length

    def has(self, chunk: Chunk, k: int) -> np.ndarray:
        """Whether each phrase of k words is proposed."""
        return _has(self.shared.value, chunk.hashes(k))

    def covers(self, chunk: Chunk, k: int) -> np.ndarray:
        """Whether all parts of each phrase of k words are proposed: those one word shorter, or the longest known."""
        part, count = min(k - 1, self.length), max(0, chunk.size - k + 1)
        return _all_parts(self.has(chunk, part), count, k - part + 1) if part else np.ones(count, bool)


# Passes ------------------------------------------------------------------------------------------------


def _drawn(rows: DataFrame, share: int) -> DataFrame:
    """lang and text of one piece in `share`, drawn by a hash of its row and its number in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches):
            draws = rows.column(2).to_numpy().view(U64)
            yield draw(rows.column(0).to_pylist(), utf8(rows.column(1)), draws)

    def draw(langs: list[str], texts: list[bytes], draws: np.ndarray) -> pa.RecordBatch:
        data = np.frombuffer(b"".join([t + b"\n" for t in texts]), np.uint8)
        ends = np.flatnonzero(BREAKS[data]) + 1
        starts = np.concatenate(([0], ends[:-1]))
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
        number = np.arange(len(starts)) - np.searchsorted(text, text)
        keep = mix(draws[text] + number.astype(U64)) % U64(share) == 0
        names, lang = np.unique(np.array(langs, object), return_inverse=True)
        kept = []
        for k in range(len(names)):
            kept.append(data[np.repeat(keep & (lang[text] == k), ends - starts)].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kept).cast(pa.string())], ["lang", "text"])

    return rows.select("lang", "text", F.xxhash64("doc_id", "text").alias("draw")).mapInArrow(run, "lang string, text string")


def _sampled(sample: DataFrame, least: int, max_words: int, size: int) -> np.ndarray:
    """Bits of what is frequent in the sample: words and pairs first, then what is made of such pairs."""

    def frequent(sizes: Sequence[int], proposal: Proposal | None) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in _chunks(batches, CHUNK):
                for k in sizes:
                    wanted = chunk.whole(k)
                    if proposal is not None:
                        wanted &= proposal.covers(chunk, k)
                    yield chunk.hashed(np.flatnonzero(wanted), k).select(["key", "n"])

        counts = sample.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
        return _bits_of(counts.where(F.col("n") >= least), size)

    low = frequent(range(1, min(2, max_words) + 1), None)
    pairs = Proposal(sample.sparkSession.sparkContext, low, 2)
    high = frequent(range(3, max_words + 1), pairs)
    pairs.shared.unpersist()
    return low | high


def _first_pass(rows: DataFrame, max_words: int, proposal: Proposal, chunk_bytes: int) -> DataFrame:
    """Counts of the proposal by phrase, of its border by hash, and of the words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            yield chunk.totals()
            for k in range(1, max_words + 1):
                wanted, proposed = chunk.whole(k) & proposal.covers(chunk, k), proposal.has(chunk, k)
                yield chunk.phrases(np.flatnonzero(wanted & proposed), k)
                yield chunk.hashed(np.flatnonzero(wanted & ~proposed), k)

    counts = rows.select("lang", "text").mapInArrow(run, COUNTS)
    return counts.groupBy("key", "name").agg(F.sum("n").alias("n")).withColumn("k", F.shiftright("key", HASH_BITS).cast("int"))


def _second_pass(
    rows: DataFrame, max_words: int, proposal: Proposal, words: Proposal, failed: Proposal, chunk_bytes: int
) -> DataFrame:
    """Counts of the phrases of frequent words that hold a failure and that the first pass did not count by phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            frequent = words.has(chunk, 1)
            held = np.zeros(chunk.size + 1, bool)
            for k in range(1, max_words + 1):
                count = max(0, chunk.size - k + 1)
                held = (held[:count] | held[1 : count + 1]) | failed.has(chunk, k)
                wanted = chunk.whole(k) & held & _all_parts(frequent, count, k)
                if wanted.any():
                    wanted &= ~(proposal.covers(chunk, k) & proposal.has(chunk, k))
                    yield chunk.phrases(np.flatnonzero(wanted), k)

    counts = rows.select("lang", "text").mapInArrow(run, COUNTS)
    return counts.groupBy("key", "name").agg(F.sum("n").alias("n")).withColumn("k", F.shiftright("key", HASH_BITS).cast("int"))


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    share: int = SAMPLE_SHARE,
    filter_bits: int = FILTER_BITS,
    chunk_bytes: int = CHUNK,
) -> DataFrame:
    """lang, phrase, k and n of all frequent phrases, words included, and the words of each language as k = 0."""
    context = docs.sparkSession.sparkContext
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text, "doc_id")
    least = max(2, int(min_count * LOWERED / share))
    bits = _sampled(saved(_drawn(rows, share)), least, max_words, filter_bits)
    proposal = Proposal(context, bits, max_words)

    wanted = (F.col("n") >= min_count) | (F.col("k") == 0)
    counted = saved(_first_pass(rows, max_words, proposal, chunk_bytes).where(wanted))
    # A phrase has no tab.
    phrase = F.substring_index("name", "\t", -1).alias("phrase")
    lang = F.expr("left(name, char_length(name) - char_length(substring_index(name, '\t', -1)) - 1)").alias("lang")
    columns = [lang, phrase, F.col("k"), F.col("n")]
    found = counted.where("name IS NOT NULL").select(*columns)
    failures = counted.where("name IS NULL")
    if not failures.isEmpty():
        words = Proposal(context, _bits_of(counted.where("k = 1"), filter_bits), 1)
        failed = Proposal(context, _bits_of(failures, filter_bits), max_words)
        more = saved(_second_pass(rows, max_words, proposal, words, failed, chunk_bytes).where(wanted))
        found = found.union(more.select(*columns))
        for one in (words, failed):
            one.shared.unpersist()
    proposal.shared.unpersist()
    return found


# Scores ------------------------------------------------------------------------------------------------


def _joined(words, start, size):
    return F.array_join(F.slice(words, start, size), " ")


def _scored(found: DataFrame) -> DataFrame:
    """Frequent phrases of two words and more with their weakest cut: lang, phrase, k, words, a, cut, l, r, n, score."""
    totals = found.where("k = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    counts = found.where("k > 0").select(F.col("lang").alias("in_lang"), F.col("phrase").alias("part"), F.col("n").alias("f"))
    phrases = found.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    words = F.split("phrase", " ")
    cuts = cuts.select(
        "lang", "phrase", "k", "a", "cut",
        _joined(words, F.lit(1), F.col("cut")).alias("left"),
        _joined(words, F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        on = (F.col("lang") == F.col("in_lang")) & (F.col(side) == F.col("part"))
        cuts = cuts.join(counts, on).drop("in_lang", "part", side).withColumnRenamed("f", name)
    cuts = cuts.join(totals.withColumnRenamed("lang", "in_lang"), F.col("lang") == F.col("in_lang")).drop("in_lang")
    # Whole numbers of up to 38 digits; Spark raises an error beyond, and never rounds.
    up = (F.col("a").cast("decimal(16,0)") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(20,0)") * F.col("total").cast("decimal(17,0)")
    down = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(18,0)")
    cuts = cuts.withColumn("up", up).withColumn("down", down).withColumn("score", F.expr("up div down"))
    weakest = F.min(F.struct("score", "cut", "l", "r", F.col("total").alias("n"))).alias("weakest")
    return cuts.groupBy("lang", "phrase", "k", "a").agg(weakest).select("lang", "phrase", "k", "a", "weakest.*")


def _covered(found: DataFrame, percent: int) -> DataFrame:
    """Frequent phrases (lang, phrase) that stand in a longer one with that share of their count."""
    longer = found.where("k > 2").select("lang", "k", F.split("phrase", " ").alias("words"), F.col("n").alias("f"))
    sized = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    placed = sized.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    parts = placed.select("lang", _joined(F.col("words"), F.col("start"), F.col("size")).alias("phrase"), "f")
    most = parts.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    counted = found.where("k > 1").select("lang", "phrase", F.col("n").alias("a"))
    return counted.join(most, ["lang", "phrase"]).where(100 * F.col("f") >= percent * F.col("a")).select("lang", "phrase")


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, **mining) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found = frequent_phrases(docs, min_count, max_words, **mining)
    scored = _scored(found).join(_covered(found, WITHIN_PERCENT), ["lang", "phrase"], "left_anti")
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    # First among some parts of a language, so that the last task of a language ranks PARTS * top rows at most.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    scored = scored.withColumn("part", part)
    parts = Window.partitionBy("lang", "part").orderBy(*order)
    scored = scored.withColumn("place", F.row_number().over(parts)).where(F.col("place") <= top)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
