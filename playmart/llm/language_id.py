"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is the average of the embeddings of its subwords (byte n-grams inside words, word ends included),
each found by its hash bucket. A linear layer and a softmax give the languages. Embeddings and layer are
trained by stochastic gradient descent in numpy on a bounded sample of labelled rows. A part of the sample
is held back to fit the temperature of the softmax and the score below which a prediction is rejected.

Scoring needs one number per bucket and language (embedding times layer), which is what the tasks get.

Defined cases: a null text or one without a letter is `und` with score 0 and not accepted. Rows are
predicted one by one, so repeated rows give repeated results. Without labelled rows everything is `und`.
A single label is predicted for every text that has a letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.llm.common import SEGMENT, byte_set

BUCKETS = 1 << 13
DIM = 16
GRAMS = (2, 3, 4)
ROWS_PER_LANGUAGE = 300  # bound of the training sample, for each language
MAX_LANGUAGES = 500  # with the above, the bound of what the driver holds; more is an error
EPOCHS = 12
BATCH = 32
RATE = 8.0
HELD_BACK = 0.25  # share of the sample used for calibration
TARGET_ACCURACY = 0.99  # of accepted predictions, on the rows held back
UNDETERMINED = "und"

_SIGN = re.compile(r"[^\W\d_]")  # letters, and number signs such as fractions
_KEPT = byte_set(range(ord("a"), ord("z") + 1), range(0x80, 0x100))
_SPACE = np.uint8(0x20)


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _SIGN.finditer(text))


def subword_counts(text: str) -> np.ndarray:
    """Counts of the hash buckets of all subwords of a whole text."""
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    whole = np.concatenate(([_SPACE], np.where(_KEPT[raw], raw, _SPACE), [_SPACE]))
    counts = np.zeros(BUCKETS, np.int64)
    for begin in range(0, len(whole), SEGMENT):
        _count_subwords(whole[begin : begin + SEGMENT + max(GRAMS) - 1].astype(np.uint32), counts)
    return counts


def _count_subwords(data: np.ndarray, counts: np.ndarray) -> None:
    """Add the subwords that begin in the first SEGMENT bytes of data."""
    blank = data == _SPACE
    for n in GRAMS:
        places = min(len(data) - n + 1, SEGMENT)
        if places <= 0:
            continue
        packed = np.full(places, n, np.uint32)
        inner = np.zeros(places, bool)
        for k in range(n):
            packed = packed * np.uint32(0x01000193) + data[k : k + places]
            if 0 < k < n - 1:
                inner |= blank[k : k + places]
        if n == 2:
            inner = blank[:places] & blank[1 : 1 + places]
        buckets = (packed * np.uint32(0x9E3779B1)) >> np.uint32(32 - (BUCKETS.bit_length() - 1))
        counts += np.bincount(buckets[~inner], minlength=BUCKETS)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # bucket x language: embedding times linear layer
    bias: np.ndarray
    temperature: float
    accept_from: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not text or not has_letter(text):
            return UNDETERMINED, 0.0, False
        counts = subword_counts(text)
        logits = counts @ self.weights / max(1, counts.sum()) + self.bias
        shares = _softmax(logits[None, :] / self.temperature)[0]
        best = int(shares.argmax())
        return self.languages[best], float(shares[best]), bool(shares[best] >= self.accept_from)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 42) -> Model:
    """rows: language, buckets, their counts. Plain SGD on the cross entropy."""
    names = tuple(sorted({r[0] for r in rows}))
    if not names:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    labels = np.array([names.index(r[0]) for r in rows])
    held = int(len(rows) * HELD_BACK)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM))
    layer = rng.normal(0, 0.1, (DIM, len(names)))
    bias = np.zeros(len(names))
    train = np.arange(held, len(rows))
    steps = EPOCHS * -(-len(train) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(train)
        for begin in range(0, len(order), BATCH):
            some = order[begin : begin + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            at = np.concatenate([rows[i][1] for i in some])
            share = np.concatenate([rows[i][2] / rows[i][2].sum() for i in some])
            first = np.concatenate(([0], np.cumsum([len(rows[i][1]) for i in some])[:-1]))
            hidden = np.add.reduceat(embed[at] * share[:, None], first, axis=0)
            error = _softmax(hidden @ layer + bias)
            error[np.arange(len(some)), labels[some]] -= 1
            error /= len(some)
            back = error @ layer.T
            layer -= rate * hidden.T @ error
            bias -= rate * error.sum(axis=0)
            size = np.diff(np.concatenate((first, [len(at)])))
            np.subtract.at(embed, at, rate * share[:, None] * np.repeat(back, size, axis=0))
    weights = embed @ layer
    check = range(held) if held else range(len(rows))
    logits = np.array([r[2] @ weights[r[1]] / r[2].sum() + bias for r in (rows[i] for i in check)])
    temperature, accept = _calibrate(logits, labels[list(check)])
    return Model(names, weights, bias, temperature, accept)


def _calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Temperature of least cross entropy, and the lowest score whose acceptance keeps the target accuracy."""
    rows = np.arange(len(labels))

    def loss(t: float) -> float:
        return float(-np.log(_softmax(logits / t)[rows, labels] + 1e-12).mean())

    temperature = min((float(t) for t in np.geomspace(0.5, 20, 60)), key=loss)
    shares = _softmax(logits / temperature)
    scores, right = shares.max(axis=1), shares.argmax(axis=1) == labels
    order = np.argsort(-scores)
    accuracy = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(accuracy >= TARGET_ACCURACY)
    accept = float(scores[order][enough[-1]]) if len(enough) else 1.0
    return temperature, min(accept, 1.0)


def training_rows(docs: DataFrame, usable: Column) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Subword counts of at most ROWS_PER_LANGUAGE rows of each language, those of the lowest hashes.

    Rows of one language that agree in id and text count once, so rows that repeat or have no id fill no sample.
    Only the limiting hash of each language goes through the driver before the counts of the chosen rows.
    """
    drawn = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    drawn = drawn.select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    limits = drawn.select("lang", "draw").distinct().withColumn("n", ranked).where(f"n <= {ROWS_PER_LANGUAGE}")
    limits = limits.groupBy("lang").agg(F.max("draw").alias("last")).limit(MAX_LANGUAGES + 1).collect()
    if not limits:
        return []
    if len(limits) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    last = F.create_map(*[F.lit(v) for r in limits for v in (r["lang"], r["last"])])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [subword_counts(t) for t in batch.column(1).to_pylist()]
            at = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at, pa.list_(pa.int64())),
                 pa.array([c[i] for c, i in zip(found, at)], pa.list_(pa.int64()))],
                ["lang", "buckets", "counts"],
            )

    chosen = drawn.where(F.col("draw") <= last[F.col("lang")])
    chosen = chosen.groupBy("lang", "draw").agg(F.min("text").alias("text")).select("lang", "text")
    counted = chosen.mapInArrow(count, "lang string, buckets array<bigint>, counts array<bigint>").toPandas()
    rows = [(r.lang, np.asarray(r.buckets), np.asarray(r.counts)) for r in counted.itertuples() if len(r.buckets)]
    return sorted(rows, key=lambda r: (r[0], r[1].tolist(), r[2].tolist()))


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The named columns of docs with lang_pred, score and accepted; only the text is looked at."""
    held = docs.select(*keep, "text")
    schema = ", ".join(f"`{n}` {t}" for n, t in held.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.predict(t) for t in batch.column(len(keep)).to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *columns], [*keep, "lang_pred", "score", "accepted"]
            )

    return held.mapInArrow(run, f"{schema}, lang_pred string, score double, accepted boolean")


def identify_language(docs: DataFrame, usable: Column) -> DataFrame:
    """Train on the rows where `usable` holds and predict all rows."""
    return predict(docs, fit(training_rows(docs, usable)), "doc_id")
