"""Token counts without token ids: pieces per distinct pre-token, joined to per-document frequencies.

1. Every Arrow batch of documents becomes one row per distinct pre-token of the batch, with the documents it
   is in and how often (a short array). A pre-token that is in every document is one row per batch, not per
   document. Those in HOT documents of a batch are dealt out by batch too, to SALTS tasks, so that no task gets all
   the entries of one.
2. These rows are dealt out by pre-token once. Both the distinct pre-tokens, whose pieces are counted once
   each, and the join back to the frequencies use that exchange.
3. Frequency times pieces is summed per document, first within each task.

Defined cases: a null or empty text has no bytes and no tokens. Every row of the input gives one row, also
if rows repeat or ids are null or repeat: documents are told apart by a row number within their task, which
needs an input that is read the same way again after a lost executor, as files and tables are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import U64, doc_texts, mix
from playmart.llm.pieces import vocabulary

# slot 0 to SALTS holds pre-tokens; the batch's document list is a row of its own, told apart by its slot. An entry is a
# document's place in the batch and a frequency; a larger one is divided over several entries. Most pre-tokens
# have a single entry, which is a plain number in place of an array.
FREQUENCIES = (
    "piece string, slot bigint, first bigint, entry int, found array<int>, doc_ids array<bigint>, bytes array<bigint>"
)
PLACES = 1 << 16  # documents in a batch at most
HOT = 64  # documents of a batch from which on a pre-token is dealt out by batch as well
SALTS = 64  # tasks that share a frequent pre-token, each counting its pieces once
MOST = (1 << 15) - 1  # frequency in an entry at most
SPECIAL = "\0special"  # a special token found in a text: one token; no pre-token looks like this


def _entries(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs repeated where the frequency needs more than one entry, and the frequency of each entry."""
    parts = -(-times // MOST)
    repeated = np.repeat(pairs, parts)
    left = np.full(len(repeated), MOST)
    left[np.cumsum(parts) - 1] = times - (parts - 1) * MOST
    return repeated, left


def _frequencies(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in (b.slice(k, PLACES) for b in batches for k in range(0, b.num_rows, PLACES)):
            names: dict[str, int] = {}
            codes: list[np.ndarray] = []
            for text in batch.column(2).to_pylist():
                parts = vocab.pre_tokens(text) if vocab.plain(text) else [
                    SPECIAL if p is None else p for p in vocab.library_parts(text)
                ]
                codes.append(np.array([names.setdefault(p, len(names)) for p in parts], np.int32))
            n_docs = len(codes)
            rows = np.repeat(np.arange(n_docs), [len(c) for c in codes])
            pairs = np.concatenate(codes).astype(np.int64) * n_docs + rows
            pairs, times = _entries(*np.unique(pairs, return_counts=True))
            ends = np.searchsorted(pairs, np.arange(len(names) + 1) * n_docs)
            # After the pre-tokens one row with the documents themselves.
            ends = np.append(ends, len(pairs) + n_docs).astype(np.int32)
            found = np.concatenate((pairs % n_docs + times * PLACES, np.arange(n_docs))).astype(np.int32)
            single = np.diff(ends) == 1
            hot = np.diff(ends)[:-1] >= HOT
            salt = int(mix(np.array([batch.column(0)[0].as_py()], U64))[0]) % SALTS
            single[-1] = False
            entry = np.append(found, np.int32(0))[ends[:-1]]
            first = batch.column(0)[0].as_py()
            only_last = np.append(np.zeros(len(names) + 1, np.int32), np.int32(n_docs))
            nothing = pa.array(np.append(np.ones(len(names), bool), False))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*names, ""], pa.string()),
                    pa.array(np.append(np.where(hot, 1 + salt, 0), first + 1)),
                    pa.array(np.full(len(names) + 1, first, np.int64)),
                    pa.array(entry, mask=~single),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(found), mask=pa.array(single)),
                    pa.ListArray.from_arrays(pa.array(only_last), batch.column(1), mask=nothing),
                    pa.ListArray.from_arrays(pa.array(only_last), batch.column(3), mask=nothing),
                ],
                [c.split()[0] for c in FREQUENCIES.split(", ")],
            )

    return run


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row."""
    rows = doc_texts(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
    )
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    found = rows.mapInArrow(_frequencies(vocabulary_path), FREQUENCIES).repartition(int(parts), "piece", "slot")

    @F.pandas_udf("int")
    def pieces(pre_tokens: pd.Series) -> pd.Series:
        vocab = vocabulary(vocabulary_path)
        return pre_tokens.map(lambda p: int(p == SPECIAL) or vocab.count_of(p))

    # The aggregate over the arrays makes this side ask for the same columns as the other, so that Spark
    # deals the rows out once for both.
    whole = F.max(F.hash("first", "entry", "found", "doc_ids", "bytes")).alias("seen")
    distinct = found.groupBy("piece", "slot").agg(whole).where("seen IS NOT NULL").select("piece", "slot")
    counted = distinct.withColumn("pieces", pieces("piece"))
    joined = found.join(counted, ["piece", "slot"])
    # The outer form adds no filter of its own to this side of the join, so that both sides stay one exchange.
    every = F.coalesce("found", F.array("entry"))
    entries = F.posexplode_outer(every).alias("at", "entry")
    per_doc = joined.select("pieces", "first", "doc_ids", "bytes", entries).select(
        (F.col("first") + F.col("entry") % PLACES).alias("row"),
        (F.col("pieces").cast("bigint") * F.shiftright("entry", PLACES.bit_length() - 1)).alias("n"),
        F.col("doc_ids")[F.col("at")].alias("doc_id"),
        F.col("bytes")[F.col("at")].alias("n_bytes"),
    )
    sums = per_doc.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens")
    )
    return sums.drop("row")
