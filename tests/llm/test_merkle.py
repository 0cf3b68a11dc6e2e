"""The Merkle manifest against a tree built by the book."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from playmart.llm import merkle
from playmart.llm.queries import QUERIES
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD

SF = f"{TESTDATA}/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank int, node string, row int, hash string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h(*values)


def tree(nodes):
    """Levels from the leaves to the top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def steps(levels, at):
    for level in levels[:-1]:
        first = at - at % 2
        yield level[first:at], level[at + 1 : first + 2]
        at //= 2


def plain_manifest(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by_lang = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = plain_leaf(doc_id, source, lang, n_chars, text)
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        now = plain_leaf(doc_id, source, lang, n_chars + 1, text) if bad else leaf
        by_lang[lang].append(((doc_id is not None, doc_id or 0), leaf, now))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort()
        trees[lang] = tree([leaf for _, leaf, _ in by_lang[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for n, lang in enumerate(langs):
        for k, ((known, doc_id), leaf, now) in enumerate(by_lang[lang]):
            path = [*steps(trees[lang], k), *steps(top, n)]
            for left, right in path:
                now = h(*left, now, *right)
            proof = h(*[x for left, right in path for x in [*left, *right]])
            root = top[-1][0]
            out.append((doc_id if known else None, leaf, trees[lang][-1][0], root, proof, now, now == root))
    return out


def found(df):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    out = merkle.manifest(df, tampered)
    root = merkle.folded(F.col("checked_leaf"), F.col("siblings"))
    rows = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("siblings")), root.alias("f"), F.col("root") == root)
    return sorted(map(tuple, rows.collect()), key=repr)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(parts)


def test_query_against_the_book(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    rows = QUERIES["op13_merkle_manifest"](spark, SF).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(plain_manifest([tuple(r) for r in docs]), key=repr)
    assert 0 < sum(not r.verified for r in rows) < len(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 8, 9, 65])
def test_small_trees(spark, size):
    rows = [(k, f"text {k}", "en", None, k) for k in range(size)]
    assert found(frame(spark, rows)) == sorted(plain_manifest(rows), key=repr)


def test_rounds_of_blocks(spark, monkeypatch):
    """Several rounds in the tree of a language and in that of the languages; a language with most rows."""
    monkeypatch.setattr(merkle, "DIGITS", 1)
    monkeypatch.setattr(merkle, "BLOCK", merkle.FAN)
    rows = [(k, f"t {k}", "en" if k % 3 else f"l{k}", "s", None if k % 5 == 0 else k) for k in range(150)]
    assert found(frame(spark, rows)) == sorted(plain_manifest(rows), key=repr)


def test_odd_rows(spark):
    """Nulls in every column, repeated ids, repeated rows, a null language beside an empty one, clashing names."""
    rows = [(k // 2, t, lang, None, len(t or "")) for k, (t, lang) in enumerate((t, la) for t in ODD for la in (None, "", "é"))]
    rows += [(None, None, None, None, None)] * 3 + [(7, "a", "z", "s", None)] * 4 + [(-5, "中", "~", "-", 1), (2**62, "", "Z", "1:x", 0)]
    assert found(frame(spark, rows)) == sorted(plain_manifest(rows), key=repr)


def test_empty_table(spark):
    assert found(frame(spark, [], 1)) == []
