"""Encoding and decoding against the sentencepiece library."""

import hashlib

import numpy as np
import pytest
import sentencepiece

from playmart.llm import sentencepieces
from playmart.llm.queries import PIECE_VOCABULARY, QUERIES
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD, prose

SF = f"{TESTDATA}/sf0.01"
HARD = [
    "  two  spaces ", "▁mark▁▁ ", "\t tab\n\n  x", "a" * 2000, "ab" * 900 + " ", " " * 333, "<s>[INST]</s><unk> <0x41>",
    "\U0001f600‍\U0001f525 zażółć ́é", "\x00\x01\x7f", "مرحبا עולם", "１２３ ﬁ ²", "..." * 70, "�﻿", "x y z",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)


def plain(library, text):
    ids = library.encode(text or "", add_eos=True)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
    return (len(ids), *digests)


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_sentencepiece"](spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {i: plain(library, t) for i, t in texts.items()}
    assert len(rows) == len(texts)


def random_texts(rng, n):
    signs = "ab  e\n\té中▁😀.,<>0́"
    return [prose(rng, rng.randrange(60)) if k % 2 else "".join(rng.choices(signs, k=rng.randrange(80))) for k in range(n)]


@pytest.mark.parametrize("divided", [True, False])
def test_agenda_equals_the_library(rng, library, divided):
    """By segments and over whole texts."""
    words = sentencepieces.Vocabulary(PIECE_VOCABULARY)
    assert words.divided
    for text in [t or "" for t in ODD] + HARD + random_texts(rng, 400):
        whole = words.library.normalize(text)
        segments = words.segments(whole) if divided else [whole]
        ids = [i for s in segments for i in words.agenda(s)]
        assert ids == library.encode(text)
        assert [i for one in words.agendas(segments) for i in one] == ids
        assert words.text(ids) == library.decode(ids)


def test_decoding_any_ids(rng, library):
    words = sentencepieces.Vocabulary(PIECE_VOCABULARY)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(len(words.text_of))]) for _ in range(rng.randrange(8))]
        assert words.text(ids) == library.decode(ids), ids


def test_odd_input(spark, frame, rng, library):
    """Null ids, repeated rows, an empty table, a memory that is emptied all the time."""
    texts = ODD + HARD + random_texts(rng, 30)
    rows = [(None if k % 7 == 0 else k, t) for k, t in enumerate(texts)] + [(3, "same")] * 3
    found = sentencepieces.encode_documents(frame(rows), PIECE_VOCABULARY, 10, 3).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(((i, *plain(library, t)) for i, t in rows), key=repr)
    assert sentencepieces.encode_documents(frame([], 1), PIECE_VOCABULARY).count() == 0


def test_ids_and_back(spark, frame, rng):
    rows = list(enumerate([t or "" for t in ODD] + HARD + random_texts(rng, 30)))
    back = sentencepieces.decode(sentencepieces.encode(frame(rows), PIECE_VOCABULARY), PIECE_VOCABULARY).collect()
    # The library's own space mark is read as a space.
    assert {r.doc_id: r.text for r in back} == {i: t.replace("▁", " ") for i, t in rows}


def test_a_difference_is_an_error(monkeypatch):
    words = sentencepieces.Vocabulary(PIECE_VOCABULARY)
    assert words.checked(["▁hello", "▁"])[1] == [" hello", " "]
    monkeypatch.setattr(words, "agendas", lambda segments: [[5]])
    with pytest.raises(ValueError, match="differ"):
        words.checked(["▁hello"])
    right = words.library.encode("hello")
    monkeypatch.setattr(words, "agendas", lambda segments: [right])
    monkeypatch.setattr(words, "inner", lambda ids: " hallo")
    with pytest.raises(ValueError, match="differ"):
        words.checked(["▁hello"])


def test_frequent_segments_outlast_a_full_memory(monkeypatch):
    """A segment met in every group of rows is encoded once, however often the memory fills up between."""
    words = sentencepieces.Vocabulary(PIECE_VOCABULARY)
    encoded = []
    plain_checked = words.checked
    monkeypatch.setattr(words, "checked", lambda segments: encoded.extend(segments) or plain_checked(segments))
    memory = sentencepieces.Memory(words, 400, 20)
    frequent = {"▁the", "▁of", "▁qzx\n"}
    for k in range(60):
        rare = {f"▁rare{k}x{n}" for n in range(12)} | {"▁" + "long" * 9 + str(k)}
        known = memory.of(frequent | rare)
        expected = {s: plain_checked([s]) for s in frequent | rare}
        assert {s: known[s] for s in frequent | rare} == {
            s: (len(ids), " ".join(map(str, ids)), text) for s, ([ids], [text]) in expected.items()
        }
        # Two halves and what one group of rows brings.
        assert len("".join([*memory.kept, *memory.older])) < 400 + 2 * len("".join(frequent | rare))
    assert all(encoded.count(s) == 1 for s in frequent)


def test_pairs_by_hash(rng):
    """Found exactly where there is a piece, also where keys meet in a slot; agendas with ties take the leftmost."""
    words = sentencepieces.Vocabulary(PIECE_VOCABULARY)
    left, right = words.pair_keys // words.n_symbols, words.pair_keys % words.n_symbols
    assert (words._pairs(left, right) == np.arange(len(left))).all()
    asked = np.array([rng.randrange(words.n_symbols) for _ in range(40000)]).reshape(2, -1)
    number = {k: n for n, k in enumerate(words.pair_keys.tolist())}
    keys = (asked[0] * words.n_symbols + asked[1]).tolist()
    assert words._pairs(*asked).tolist() == [number.get(k, len(number)) for k in keys]
    words._slots = lambda key: np.zeros(len(key), np.int64)  # all meet in one slot
    words.pair_keys, words.pair_ranks = words.pair_keys[:50], np.append(np.zeros(50, np.int32), sentencepieces.NONE)
    words._hash_pairs()
    assert words._pairs(left[:80], right[:80]).tolist() == [*range(50)] + [50] * 30
