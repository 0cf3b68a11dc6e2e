"""Repeated line runs, by prefix doubling over the suffixes of line-id sequences.

A document is the sequence of its lines that hold a word; a line's id is the 128-bit hash of its bytes. A run
of consecutive lines counts if it holds MIN_WORDS words, or if it is a line that stands in LINE_DOCUMENTS documents. A
line goes if a run it is in, of that size, also begins earlier: in a document of smaller id, or in the same
document. So of every maximal repeated run, however long, the first copy stays and the others go whole.

Suffixes are named by their first 1, 2, 4, ... lines: the name for twice the lines is made of the names of
both halves. Equal names are the intervals of the suffix array with that common prefix; suffixes alone in
their interval cannot repeat and leave before the next doubling. A run of any length up to twice the name's is
named by the two names that overlap in it, and its interval's earliest suffix is the copy that stays.

A maximal run is found through the shortest long enough runs in it: those that begin at each of its lines, those
that end at each, and pairs of lines that are long enough each. Every line of the run is in one of them, and they
repeat where the run does, so together they make up the run. No line is without a word, so none of them has more
than MIN_WORDS lines, and doubling beyond that would name nothing more.

Intervals are only counted and reduced to their smallest member, which Spark combines before the shuffle; the
members of an interval are never brought together, so a line that is in a third of the documents is no hot
group. The reduced intervals are saved before they are joined back: a join on plain shuffles is one that Spark
splits where a name is frequent, a join on an aggregate is not.

Defined cases: a null or empty text has no lines and stays as it is. Rows that repeat doc_id and text are one
document and stay or change together. A null doc_id counts as smaller than all others. Equal documents of one
doc_id are ordered by the hash of their text. Lines are compared as they are, blanks included; lines without
a word go if they stand between two deleted ones of a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from playmart.llm.common import doc_texts, free_names, saved, utf8

MIN_WORDS = 10
LINE_DOCUMENTS = 10  # documents from which on a line counts by itself, however short

LINES = "doc_id bigint, key bigint, pos int, line int, last int, need int, fresh int, n1 bigint, n2 bigint"
ENDS = "doc_id bigint, key bigint, pos int, line int, last int, need int"


def _lines(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in LINES.split(", ")]
        for batch in batches:
            docs: list[np.ndarray] = []
            rows: list[np.ndarray] = []
            hashes: list[bytes] = []
            for row, text in enumerate(utf8(batch.column(2))):
                lines = text.split(b"\n")
                words = np.array([len(x.split()) for x in lines], np.int64)
                at = np.flatnonzero(words)
                if not len(at):
                    continue
                hashes += [xxhash.xxh3_128_digest(lines[i]) for i in at.tolist()]
                total = np.concatenate(([0], np.cumsum(words[at])))
                # The shortest run from each line; none where the document ends too soon.
                end = np.searchsorted(total, total[:-1] + min_words)
                enough = end < len(total)
                need = np.where(enough, end - np.arange(len(at)), 0)
                last = at[np.where(enough, end, 1) - 1]
                own = hashes[len(hashes) - len(at) :]
                fresh = np.zeros(len(at), np.int64)  # the line's first place in the document
                fresh[list({h: k for k, h in zip(range(len(at) - 1, -1, -1), reversed(own))}.values())] = 1
                rows.append(np.stack([np.arange(len(at)), at, last, need, fresh]))
                docs.append(np.full(len(at), row))
            if not docs:
                continue
            where = pa.array(np.concatenate(docs))
            ids = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            numbers = np.concatenate(rows, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(where), batch.column(1).take(where), *map(pa.array, numbers),
                 pa.array(ids[:, 0].copy()), pa.array(ids[:, 1].copy())],
                names,
            )

    return run


def _ends(min_words: int):
    """The shortest run up to each line, where it is not the shortest from its first line; pairs of long lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ENDS.split(", ")]
        for batch in batches:
            docs: list[np.ndarray] = []
            rows: list[np.ndarray] = []
            for row, text in enumerate(utf8(batch.column(2))):
                words = np.array([len(x.split()) for x in text.split(b"\n")], np.int64)
                at = np.flatnonzero(words)
                total = np.concatenate(([0], np.cumsum(words[at])))
                end = np.flatnonzero(total >= min_words)  # lines up to there
                begin = np.searchsorted(total, total[end] - min_words, side="right") - 1
                other = total[end - 1] - total[begin] >= min_words
                long = words[at] >= min_words
                pair = np.flatnonzero(long[1:] & long[:-1])
                begin, end = np.concatenate((begin[other], pair)), np.concatenate((end[other], pair + 2))
                rows.append(np.stack([begin, at[begin], at[end - 1], end - begin]))
                docs.append(np.full(len(begin), row))
            if not docs:
                continue
            where = pa.array(np.concatenate(docs))
            numbers = np.concatenate(rows, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(where), batch.column(1).take(where), *map(pa.array, numbers)], names
            )

    return run


def _key() -> Column:
    return F.xxhash64("text")


def _in_interval(suffixes: DataFrame) -> DataFrame:
    """The suffixes whose name is not theirs alone, from saved ones."""
    shared = saved(suffixes.groupBy("n1", "n2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return saved(suffixes.join(shared, ["n1", "n2"], "left_semi"))


def _begun(ends: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Runs up to a line with the name of the suffix that they begin, as rows of suffixes."""
    right = suffixes.select(
        F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("pos").alias("begin"), "n1", "n2"
    )
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("pos") == F.col("begin"))
    return ends.join(right, on).drop("d", "k", "begin")


def _beside(starts: DataFrame, suffixes: DataFrame, ahead: Column, keep: Column) -> DataFrame:
    """Starts with the name found `ahead` lines further on in the same document, as m1 and m2."""
    place = ["doc_id", "key", "pos"]
    left = starts.where(keep).withColumn("to", F.col("pos") + ahead)
    right = suffixes.select(
        F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("pos").alias("to_pos"),
        F.col("n1").alias("m1"), F.col("n2").alias("m2"),
    )
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("to") == F.col("to_pos"))
    return left.join(right, on).drop("d", "k", "to", "to_pos").select(*place, "line", "last", "need", "n1", "n2", "m1", "m2")


def _frequent_lines(suffixes: DataFrame, least: int) -> DataFrame:
    """doc_id, key, line and last of every place but the first of lines that stand in so many documents."""
    at = F.struct("doc_id", "key", "pos")
    lines = suffixes.groupBy("n1", "n2").agg(F.sum("fresh").alias("documents"), F.min(at).alias("first"))
    lines = saved(lines.where(F.col("documents") >= least).drop("documents"))
    later = suffixes.join(lines, ["n1", "n2"]).where(~at.eqNullSafe(F.col("first")))
    return later.select("doc_id", "key", "line", F.col("line").alias("last"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, line_documents: int = LINE_DOCUMENTS) -> DataFrame:
    """doc_id, key, line and last of runs that also begin earlier; together they are all lines that go."""
    rows = doc_texts(docs).select("doc_id", _key().alias("key"), "text")
    # Rows that repeat doc_id and text give the same lines, which count once.
    lines = saved(rows.mapInArrow(_lines(min_words), LINES).distinct())
    frequent = _frequent_lines(lines, line_documents)
    suffixes = _in_interval(lines.drop("fresh"))
    ends = saved(rows.mapInArrow(_ends(min_words), ENDS).distinct())
    named = []
    length = 1
    while True:
        here = F.col("need").between(length, 2 * length - 1)
        named.append(_beside(suffixes, suffixes, F.col("need") - length, here))
        named.append(_beside(_begun(ends.where(here), suffixes), suffixes, F.col("need") - length, F.lit(True)))
        if 2 * length > max(min_words, 2):  # every line has a word, so no shortest run has more lines than words
            break
        doubled = _beside(suffixes, suffixes, F.lit(length), F.lit(True))
        names = [F.xxhash64(F.lit(s), "n1", "n2", "m1", "m2").alias(f"n{s}") for s in (1, 2)]
        suffixes = _in_interval(saved(doubled.select("doc_id", "key", "pos", "line", "last", "need", *names)))
        length *= 2
    runs = named[0]
    for more in named[1:]:
        runs = runs.union(more)
    runs = saved(runs.withColumn("at", F.struct("doc_id", "key", "pos")))
    name = ["need", "n1", "n2", "m1", "m2"]
    first = runs.groupBy(*name).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = runs.join(saved(first.drop("n")), name).where(~F.col("at").eqNullSafe(F.col("first")))
    return later.select("doc_id", "key", "line", "last").union(frequent)


def _without(names: list[str], counts: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            deleted, total = [], []
            for row, gone in enumerate(batch.column(len(names)).to_pylist()):
                lines = (texts[row] or "").split("\n")
                total.append(sum(bool(x.encode().split()) for x in lines))
                deleted.append(0)
                if not gone:
                    continue
                out = np.zeros(len(lines) + 1, np.int64)
                for span in gone:
                    out[span["line"]] += 1
                    out[span["last"] + 1] -= 1
                stay = np.cumsum(out[:-1]) == 0
                texts[row] = "\n".join([x for x, s in zip(lines, stay.tolist()) if s])
                deleted[row] = sum(bool(x.encode().split()) for x, s in zip(lines, stay.tolist()) if not s)
            columns = list(batch.columns[: len(names)])
            columns[names.index("text")] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(deleted, pa.int64())], [*names, *counts]
            )

    return run


def delete_repeated_runs(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    line_documents: int = LINE_DOCUMENTS,
    counts: tuple[str, str] = ("_lines", "_deleted"),
) -> DataFrame:
    """docs with the later copies deleted from text, and two counts: lines with a word before, and those deleted."""
    doc, key, gone = free_names([*docs.columns, *counts], "doc", "key", "gone")
    spans = repeated_runs(docs, min_words, line_documents).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("line", "last")).alias(gone)  # of one document
    )
    spans = spans.select(F.col("doc_id").alias(doc), F.col("key").alias(key), gone)
    text = F.coalesce("text", F.lit(""))
    on = F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(key))
    joined = docs.join(spans, on, "left").select(*docs.columns, gone)
    fields = [*docs.schema.fields, *(StructField(c, LongType()) for c in counts)]
    return joined.mapInArrow(_without(docs.columns, counts), StructType(fields))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, line_documents: int = LINE_DOCUMENTS) -> DataFrame:
    """docs without the later copies. Documents of which no line with a word is left go; n_chars follows."""
    lines, deleted = free_names(docs.columns, "lines", "deleted")
    out = delete_repeated_runs(docs, min_words, line_documents, (lines, deleted))
    out = out.where((F.col(deleted) == 0) | (F.col(deleted) < F.col(lines)))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(deleted) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
