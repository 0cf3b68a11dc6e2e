"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Every text is a bag of hashed byte n-grams. Two multinomials over the hash buckets are estimated, one from
trusted documents (a bounded sample of those labelled good) and one from the whole corpus. A document's
score is the log-likelihood ratio of the two over its n-grams, divided by their number. Documents below a
fixed threshold go; the threshold follows from the labelled documents by a deterministic rule.

Defined cases: a null or empty text has no words, fails the base rule and scores 0. Rows are scored one by
one, so repeated rows give repeated results. Labels that are null or not of a document are ignored; of
several labels of a document every row counts. Without trusted documents the ratio is 0 for all and the
base rule alone decides. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from playmart.llm.common import (
    SEGMENT, SPACES, U64, byte_set, doc_texts, free_names, mix, prefix_hash, range_hash, saved, spans, utf8,
    word_hashes, written,
)

GRAM = 4  # bytes of an n-gram
BUCKETS = 1 << 16
SMOOTHING = 0.5  # count added to every bucket
TRUSTED_ROWS = 4_000  # most labelled documents the trusted multinomial is estimated from
KEEP_TRUSTED = 0.998  # share of the trusted documents that the threshold may not cut below
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SYMBOLS = byte_set(*b"[#*$%&|<>]"[1:-1])
_LEAD = ~byte_set(range(0x80, 0xC0))  # bytes that begin a code point

FEATURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, score double"
)


def gram_buckets(data: np.ndarray) -> Iterator[np.ndarray]:
    """Hash buckets of all byte n-grams, a segment at a time; a text shorter than one n-gram has none."""
    for begin in range(0, len(data) - GRAM + 1, SEGMENT):
        n = min(SEGMENT, len(data) - GRAM + 1 - begin)
        packed = np.zeros(n, U64)
        for k in range(GRAM):
            packed |= data[begin + k : begin + k + n].astype(U64) << U64(8 * k)
        yield (mix(packed) >> U64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def _score(data: np.ndarray, ratio: np.ndarray) -> float:
    """Mean log ratio over the n-grams; 0 if there are none."""
    total = sum(float(ratio[found].sum()) for found in gram_buckets(data))
    return total / max(1, len(data) - GRAM + 1)


def _repeat_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> int:
    """Words inside 3-word windows that are found at least twice."""
    if len(starts) < 4:
        return 0
    words = word_hashes(data, starts, ends)
    places = np.arange(len(words) - 2)
    windows = range_hash(prefix_hash(words), places, places + 3)
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    repeated = np.zeros(len(windows), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= repeated
    return int(covered.sum())


def _dup_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line.strip():  # bytes.strip() takes the six ASCII blanks
            found += line in seen
            seen.add(line)
    return found


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = np.frombuffer(text, np.uint8)
    inside = ~SPACES[data]
    starts, ends = spans(inside)
    chars = int(np.count_nonzero(inside & _LEAD[data]))
    symbols = int(np.count_nonzero(SYMBOLS[data]))
    return len(starts), chars, symbols, _dup_lines(text), _repeat_words(data, starts, ends)


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most `rows` ids of documents labelled good and not toxic, drawn by a hash of the id."""
    good = labels.where("quality = 1 AND NOT coalesce(toxic, 0) = 1 AND doc_id IS NOT NULL")
    drawn = good.select(F.col("doc_id").cast("bigint")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return drawn.distinct().withColumn("trusted", F.lit(True))


def log_ratio(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """log(trusted share / corpus share) of every hash bucket, from counts over all documents.

    Counts are summed in each task and by Spark, so the driver gets one row per bucket. The ids that are
    broadcast number TRUSTED_ROWS at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, good in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                for buckets in gram_buckets(np.frombuffer(text, np.uint8)):
                    found = np.bincount(buckets, minlength=BUCKETS)
                    raw += found
                    if good:
                        trusted += found
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(raw[at]), pa.array(trusted[at])], ["bucket", "raw", "trusted"]
        )

    marked = doc_texts(docs).join(F.broadcast(trusted_ids(labels)), "doc_id", "left").select("text", "trusted")
    counted = marked.mapInArrow(count, "bucket bigint, raw bigint, trusted bigint")
    sums = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toPandas()
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[sums["bucket"]], trusted[sums["bucket"]] = sums["raw"], sums["trusted"]
    if not trusted.sum():
        return np.zeros(BUCKETS)
    share = [(c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS) for c in (trusted, raw)]
    return np.log(share[0]) - np.log(share[1])


def features(docs: DataFrame, ratio: np.ndarray, name: str = "quality") -> DataFrame:
    """docs with a struct of base counts and the length-normalised ratio of every document."""
    columns, at = docs.columns, docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, scores = [], []
            for text in utf8(batch.column(at)):
                rows.append(base_counts(text or b""))
                scores.append(_score(np.frombuffer(text or b"", np.uint8), ratio))
            counts = np.array(rows, np.int64).reshape(-1, 5)
            fields = [*(pa.array(counts[:, k]) for k in range(5)), pa.array(scores, pa.float64())]
            struct = pa.StructArray.from_arrays(fields, [f.split()[0] for f in FEATURES.split(", ")])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*columns, name])

    added = StructField(name, StructType.fromDDL(FEATURES))
    return docs.mapInArrow(score, StructType([*docs.schema.fields, added]))


def _base_failed() -> F.Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


# Scores are counted in fixed steps, so the driver gets few rows.
STEP = 0.002


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """The lowest score that is kept.

    Cuts below which no more than 1 - KEEP_TRUSTED of the good documents lie are compared by the share of bad
    documents below less the share of good ones. Of equally good neighbouring cuts the middle is taken, so
    that unseen documents of either kind have the same margin. Without bad documents nothing is cut.
    """
    usable = scored.where(~_base_failed()).select("doc_id", F.floor(F.col("score") / STEP).alias("step"))
    known = labels.where("quality IS NOT NULL").select(F.col("doc_id").cast("bigint"), "quality")
    rows = usable.join(known, "doc_id").groupBy("step").agg(
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")
    )
    steps = sorted((r.step, r.good, r.bad) for r in rows.collect())
    goods, bads = sum(s[1] for s in steps), sum(s[2] for s in steps)
    best, cut, good, bad = 0.0, float("-inf"), 0, 0
    for k, (step, g, b) in enumerate(steps):
        good, bad = good + g, bad + b
        if not bads or good > (1 - KEEP_TRUSTED) * goods:
            break
        gain = bad / bads - good / max(1, goods)
        if gain > best:
            above = steps[k + 1][0] if k + 1 < len(steps) else step + 1
            best, cut = gain, (step + 1 + above) / 2 * STEP
    return cut


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, FEATURES, base_failed and kept of every document."""
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    scored = saved(features(texts, log_ratio(docs, labels)).select("doc_id", "quality.*"))
    cut = threshold(scored, labels)
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(cut))
    return scored.withColumn("base_failed", _base_failed()).withColumn("kept", kept)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that quality_rules keeps, with the columns of docs.

    Every text is scored once. Those that pass the base rule are written with their score; the threshold is
    read from the scores alone, the result from the whole. No text is shuffled.
    """
    (name,) = free_names(docs.columns, "quality")
    scored = features(docs, log_ratio(docs, labels), name)
    inner = {f.split()[0]: F.col(f"{name}.{f.split()[0]}") for f in FEATURES.split(", ")}
    failed = (inner["n_words"] < MIN_WORDS) | (
        100 * inner["n_repeat_words"] > MAX_REPEAT_PERCENT * inner["n_words"]
    )
    passed = written(scored.where(~failed), "quality")
    cut = threshold(passed.select(F.col("doc_id").cast("bigint"), f"{name}.*"), labels)
    return passed.where(inner["score"] >= F.lit(cut)).select(*docs.columns)
