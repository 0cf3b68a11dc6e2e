"""Operators that judge one document at a time, against plain versions of their rules."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.llm import (
    chat, common, decontaminate, language_id, licenses, pieces, quality, substring_dedup, token_counts,
)
from playmart.llm.queries import BYTE_VOCABULARY, ORACLE, QUERIES, WORD_VOCABULARY
from tests.compare import assert_same, connect
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD, prose

SF = f"{TESTDATA}/sf0.001"


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_segments_of_long_texts_change_nothing(rng, monkeypatch):
    text = prose(rng, 4000)
    data = np.frombuffer(text.encode(), np.uint8)
    ratio = np.random.default_rng(1).normal(size=quality.BUCKETS)

    def all_of_it():
        return (
            round(quality._score(data, ratio), 9), quality.base_counts(text.encode()),
            language_id.subword_counts(text).tolist(), [x.tolist() for x in substring_dedup.anchors(data)],
            decontaminate._seeds_of(text)[3].tolist(),
        )

    whole = all_of_it()
    for size in (100, 4099):
        for module in (common, quality, language_id, substring_dedup):
            monkeypatch.setattr(module, "SEGMENT", size)
        assert all_of_it() == whole


# Quality ---------------------------------------------------------------------------------------------


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_base_counts(rng):
    texts = [t or "" for t in ODD] + [prose(rng, rng.randrange(1, 200)) for _ in range(30)]
    texts += ["a b c a b c", "a a a a", "x\nx\n x\nx", "[#*$%&|<>]"]
    for text in texts:
        assert quality.base_counts(text.encode()) == plain_counts(text), text[:60]


def test_quality_rules_keep_good_documents(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality_rules(docs, labels)
    assert found.count() == docs.count()
    known = found.join(labels, "doc_id").where("NOT base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")
    )
    kept = {r.quality: r.kept for r in known.collect()}
    assert kept[1] >= 0.995 and kept[0] <= 0.05
    rows = found.where("base_failed").agg(F.max("n_words"), F.count_if("kept")).first()
    assert rows[1] == 0
    again = quality.keep_good(docs, labels)
    assert again.columns == docs.columns
    assert {r.doc_id for r in again.select("doc_id").collect()} == {
        r.doc_id for r in found.where("kept").select("doc_id").collect()
    }


def plain_buckets(text, memo):
    """How often every bucket is hit by the byte 4-grams of a text, in plain integers."""
    found = {}
    for k in range(len(text) - quality.GRAM + 1):
        gram = text[k : k + quality.GRAM]
        if gram not in memo:
            x = int.from_bytes(gram, "little")
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ x >> shift) * factor % 2**64
            memo[gram] = (x ^ x >> 31) * quality.BUCKETS >> 64
        found[memo[gram]] = found.get(memo[gram], 0) + 1
    return found


def plain_verdicts(docs, labels):
    """Score of every document, the cut, and both from counts over all documents, without numpy or Spark."""
    memo = {}
    bags = [plain_buckets((t or "").encode(), memo) for _, t in docs]
    good = {i for i, q, toxic in labels if q == 1 and toxic != 1}
    shares = []
    for chosen in ([b for (i, _), b in zip(docs, bags) if i in good], bags):
        total = {}
        for bag in chosen:
            for bucket, n in bag.items():
                total[bucket] = total.get(bucket, 0) + n
        size = sum(total.values()) + quality.SMOOTHING * quality.BUCKETS
        shares.append(lambda b, total=total, size=size: math.log((total.get(b, 0) + quality.SMOOTHING) / size))
    scores = [
        sum(n * (shares[0](b) - shares[1](b)) for b, n in bag.items()) / max(1, sum(bag.values())) for bag in bags
    ]
    failed = []
    for _, t in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        repeated = plain_counts(t or "")[4]
        failed.append(len(words) < 50 or 100 * repeated > 50 * len(words))
    quality_of = {}
    for i, q, _ in labels:
        quality_of.setdefault(i, []).append(q)
    known = [
        (math.floor(s / quality.STEP), q)
        for (i, _), s, f in zip(docs, scores, failed) if not f for q in quality_of.get(i, []) if q is not None
    ]
    steps = sorted({s for s, _ in known})
    goods, bads = (sum(q == k for _, q in known) for k in (1, 0))
    best, cut = 0.0, -math.inf
    for k, step in enumerate(steps):
        good_below, bad_below = (sum(q == j for s, q in known if s <= step) for j in (1, 0))
        if not bads or good_below > (1 - quality.KEEP_TRUSTED) * goods:
            break
        if bad_below / bads - good_below / goods > best:
            best = bad_below / bads - good_below / goods
            cut = (step + 1 + (steps[k + 1] if k + 1 < len(steps) else step + 1)) / 2 * quality.STEP
    return scores, cut, [not f and s >= cut for s, f in zip(scores, failed)]


def test_quality_verdicts_equal_a_plain_version(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    scores, cut, kept = plain_verdicts(rows, marks)
    found = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    assert len(found) == len(rows) and -math.inf < cut < max(scores)
    for (doc, _), score, keep in zip(rows, scores, kept):
        assert abs(found[doc].score - score) < 1e-9, doc
        assert found[doc].kept == keep or abs(score - cut) < 1e-9, doc


def test_quality_rules_odd_input(spark, frame, rng):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = frame([*enumerate(ODD), (None, prose(rng, 80)), (7, prose(rng, 80)), (7, prose(rng, 80))])
    found = quality.quality_rules(docs, none).collect()
    assert len(found) == len(ODD) + 3 and all(r.score == 0 for r in found)
    assert all(r.kept != r.base_failed for r in found)
    labels = spark.createDataFrame([(7, 1, None), (None, 0, 0), (3, None, None), (99, 1, 0)], none.schema)
    assert quality.quality_rules(docs, labels).count() == len(ODD) + 3
    assert quality.quality_rules(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


# Language --------------------------------------------------------------------------------------------


def test_language_accuracy_on_held_out_rows(spark):
    found = QUERIES["op1_language_id"](spark, f"{TESTDATA}/sf0.01")
    truth = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    right = [r.lang == r.lang_pred for r in rows]
    assert len(rows) > 100 and np.mean(right) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    accepted = [ok for ok, r in zip(right, rows) if r.accepted]
    assert np.mean(accepted) > 0.98 and len(accepted) > 0.9 * len(rows)


def test_language_odd_input(spark, frame):
    schema = "doc_id bigint, lang string, text string, score string"
    rows = [(i, "en", "the cat and the dog", "s") for i in range(5)] + [(9, None, "le chat", "s"), (None, "fr", "le", "")]
    docs = spark.createDataFrame(rows + [(20 + i, "fr", t, "") for i, t in enumerate(ODD)], schema)
    found = by_id(language_id.identify_language(docs, F.lit(True)))
    assert len(found) == docs.count()
    letterless = [20 + i for i, t in enumerate(ODD) if not t or not any(c.isalpha() for c in t)]
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in letterless)
    assert all(found[i].lang_pred in ("en", "fr") for i in found if i not in letterless)
    nothing = language_id.identify_language(docs, F.lit(False)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language_id.identify_language(docs.limit(0), F.lit(True)).count() == 0


def test_language_sample_is_bounded(spark, monkeypatch):
    """Rows that share an id or have none, repeated or not, never fill the driver."""
    words = ["le", "chat", "noir", "est", "ici"]
    rows = [(None, "fr", f"le chat {k}") for k in range(2500)] + [(7, "fr", f"le chien {k}") for k in range(2500)]
    rows += [(None, "fr", "le chat noir")] * 2000 + [(k, "en", "the " + words[k % 5]) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(5)
    sample = language_id.training_rows(docs, F.lit(True))
    counts = {lang: sum(r[0] == lang for r in sample) for lang in ("fr", "en")}
    assert counts == {"fr": language_id.ROWS_PER_LANGUAGE, "en": 10}


def test_number_signs_are_no_letters(spark):
    signs = ["½ 3", "²", "①", "Ⅷ", "१२", "_", "a½"]
    docs = spark.createDataFrame([(k, "en", t) for k, t in enumerate(signs)] + [(50, "fr", "le")], "doc_id bigint, lang string, text string")
    found = by_id(language_id.identify_language(docs, F.lit(True)))
    for k, text in enumerate(signs):
        assert (found[k].lang_pred == "und") == (not any(c.isalpha() for c in text)), text


# Tokens ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("path", [BYTE_VOCABULARY, WORD_VOCABULARY])
def test_pieces_equal_the_library(rng, path):
    vocab = pieces.vocabulary(path)
    letters = list("ab cSs'TdreveLLmM\n\t  12²½ª€ñßŒİŉſ!?.,$é\r") + ["'s", "'re", " 've"]
    odd = letters + list("　\x85 \x1c中ΣςÁ́ẞ﻿😀") + ["<|endoftext|>", "<|startoftext|>"]
    texts = [t for t in ODD if t is not None]
    texts += ["".join(rng.choice(odd if n % 2 else letters) for _ in range(rng.randrange(40))) for n in range(2000)]
    for text in texts:
        ids = vocab.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(vocab.encode(text), "<u4").tolist() == ids, text
        parts = vocab.library_parts(text)
        assert sum(1 if p is None else vocab.count_of(p) for p in parts) == len(ids), text
        assert not vocab.plain(text) or vocab.pre_tokens(text) == parts, text


def test_token_counts(spark, frame, rng):
    texts = [*ODD, *[prose(rng, rng.randrange(300)) for _ in range(40)], prose(rng, 20_000)]
    rows = [(None if i == 3 else i, t) for i, t in enumerate(texts)] + [(5, texts[20]), (6, texts[21]), (6, texts[21])]
    found = token_counts.count_tokens(frame(rows, 3), BYTE_VOCABULARY).collect()
    library = pieces.vocabulary(BYTE_VOCABULARY).library
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.n_bytes, r.n_tokens)) for r in found)
    assert token_counts.count_tokens(frame([]), BYTE_VOCABULARY).count() == 0


# Chats -----------------------------------------------------------------------------------------------


def plain_chats(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in chats.items()}


def test_chat_round_trip(spark, rng):
    bits = ["</s>", "<s>", "[INST]", "[/INST]", " [/INST]", "[INST] ", "\\", "a", " ", "\n", "<", "[", "é", "$1", "/INST]"]
    roles = ["user", "assistant", "system", None, "", "[INST] x", "</s>", "a\\"]
    rows = [
        (rng.randrange(40), rng.choice([None, *range(5)]), rng.choice(roles), "".join(rng.choices(bits, k=rng.randrange(6))))
        for _ in range(400)
    ] + [(None, 1, "user", None), (50, 0, "user", "x" * 100_000), (50, 0, "user", "x" * 100_000)]
    said = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = chat.format_chats(said.withColumn("formatted", F.lit(1))).collect()
    expected = plain_chats(rows)
    assert {r.conv_id for r in found} == set(expected)
    for r in found:
        assert r.round_trip
        assert [(t.role, t.text) for t in r.turns] == expected[r.conv_id]
        # The only control strings are those of the template.
        for mark in chat.CONTROL:
            assert r.formatted.count(mark) == len(r.turns)
        for t in r.turns:
            raw = r.formatted[t["at"] : t["at"] + t["size"]]
            assert re.sub(r"(?s)\\(.)", r"\1", raw) == t.text
    assert chat.format_chats(said.limit(0)).count() == 0


def test_chat_of_very_many_turns(spark):
    """Work in proportion to the turns: arrays copied turn by turn would take hours here."""
    n = 100_000
    said = spark.range(n).selectExpr(
        "1 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
        "concat(repeat('é', int(id % 7)), if(id % 5 = 0, '</s>[INST]', ''), id) AS text",
    )
    chats = chat.format_chats(said)
    (r,) = chats.withColumn("learned", chat.learned_text(F.col("formatted"), F.col("turns"))).collect()
    texts = ["é" * (i % 7) + "</s>[INST]" * (i % 5 == 0) + str(i) for i in range(n)]
    assert r.round_trip and [t.text for t in r.turns] == texts
    assert r.learned == "".join(texts[1::2])
    for t, text in zip(r.turns[:: n // 100], texts[:: n // 100]):
        raw = r.formatted[t["at"] : t["at"] + t["size"]]
        assert re.sub(r"(?s)\\(.)", r"\1", raw) == text


def test_chat_query(spark):
    found = {r.conv_id: r for r in QUERIES["op9_chat_formatting"](spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, n, role, "</s>[INST] ok [/INST]") for n, role in enumerate(("user", "assistant"))]
    for conv, turns in plain_chats(rows).items():
        learned = "".join(t for role, t in turns if role == "assistant")
        all_ = "".join(f"{role}\n{t}\n" for role, t in turns)
        r = found[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learned))
        assert r.turns_sha256 == hashlib.sha256(all_.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


# Licenses --------------------------------------------------------------------------------------------


def plain_base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [
        (i, label) for phrase, label in licenses.BASE for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [p for p, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_license_scan(spark, frame, rng):
    notices = ["MIT License", "Apache-License", "the GNU General Public\nLicense", "CC BY 4.0", "gnu general license public"]
    texts = [*ODD, "mit", "mit license mit license", "cc by by cc by cc"]
    texts += [" ".join(rng.choice([prose(rng, 8), rng.choice(notices)]) for _ in range(6)) for _ in range(60)]
    texts += ["Permission is hereby granted, free of all charge, to any person obtaining a copy of it"]
    rows = [(None if i == 4 else i, t) for i, t in enumerate(texts)] + [(9, "mit license"), (10, texts[10])]
    found = licenses.scan_licenses(frame(rows, 3)).collect()
    assert len(found) == len(rows)
    again = licenses.scan_licenses(frame([(1, "mit license")] * 3 + [(None, None)] * 2, 2)).collect()
    assert sorted((r.doc_id or 0, r.n_base) for r in again) == [(0, 0), (0, 0), (1, 1), (1, 1), (1, 1)]
    expected = {(i, plain_base(t)) for i, t in rows}
    assert {(r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in found} == expected
    for r in found:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    drifted = next(r for r in found if r.doc_id == len(texts) - 1)
    assert drifted.labels == "mit" and drifted.base_labels == ""
    assert licenses.scan_licenses(frame([])).count() == 0


# SQL twins -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    with connect(f"{TESTDATA}/sf0.01") as sql:
        assert_same(QUERIES[name](spark, f"{TESTDATA}/sf0.01").toPandas(), sql.execute(ORACLE[name]).df())
