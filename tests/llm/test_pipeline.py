"""The pipeline against its stages done by brute force, and on odd tables."""

import re
import uuid
import zlib

import numpy as np

import __spark_entry__ as spark_entry
import corpus_pipeline
from playmart.llm import common, decontaminate, pieces
from playmart.llm.queries import QUERIES, WORD_VOCABULARY
from tests.llm.conftest import ODD, prose
from tests.llm.test_corpus_operators import (
    SF, check_packed, plain_components, plain_fingerprint, plain_line_dedup, plain_tiles,
)


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())


def test_pipeline_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r.doc_id for r in QUERIES["op8_quality_rules"](spark, SF).where("kept").collect()}
    lines = plain_line_dedup([(i, t) for i, t in docs.items() if i in good])
    left = {i: t for i, t in lines.items() if t.split()}
    roots = plain_components({i: plain_fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if roots[i] == i}
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    k = decontaminate.SEED_WORDS

    def clean(text):
        have = words(text)
        grams = {tuple(have[j : j + k]) for j in range(len(have) - k + 1)}
        for item in items:
            if any(tuple(item[j : j + k]) in grams for j in range(len(item) - k + 1)):
                if sum(t[2] for t in plain_tiles(have, item, k)) >= decontaminate.COVERAGE * len(item):
                    return False
        return True

    left = {i: t for i, t in left.items() if clean(t)}
    library = pieces.vocabulary(WORD_VOCABULARY).library
    expected = []
    for i, text in left.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        expected += [(i, j, zlib.crc32(ids[a : a + 4096].tobytes())) for j, a in enumerate(range(0, len(ids), 4096))]
    found = spark_entry.queries()["pipeline"](spark, SF).collect()
    assert 0 < len(left) < len(docs)
    assert sorted(expected) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in found)
    check_packed(found, 4096)


def test_stages_on_odd_documents(spark, rng, tmp_path):
    """With extra columns of all names that the stages use inside; their values stay with their rows."""
    clash = ["key", "_quality", "_row", "_gone", "_doc", "_key", "_bad", "_lines", "_deleted", "gone", "DOC", "lines", "row"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} int" for c in clash)
    more = tuple(range(len(clash)))
    rows = [(i, t, None, "s", None, *more) for i, t in enumerate(ODD)]
    rows += [(None, prose(rng, 90), "en", None, 3, *more)] * 2 + [(40, prose(rng, 90), "en", "s", 3, *more)] * 2
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
            assert all(tuple(r)[5:] == more for r in out.collect()), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_texts_go_to_python_in_small_batches(spark, rng, tmp_path, monkeypatch):
    """No batch is much over the bound, where one task has many times as much; the session's bound stays its own."""
    texts = [prose(rng, 700) for _ in range(40)]
    rows = [(i, f"{texts[i % 40]} {prose(rng, 60)}", "en", "s", 3) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, int(i % 3 > 0), 0) for i in range(0, 1500, 2)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(rng, 20))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = tmp_path / "seen"
    plain = type(docs).mapInArrow

    def watched(self, func, *args, **more):
        def note(batches):
            for batch in batches:
                (seen / uuid.uuid4().hex).write_text(str(batch.nbytes))
                yield batch

        return plain(self, lambda batches: func(note(batches)), *args, **more)

    def largest():
        return max(int(f.read_text()) for f in seen.iterdir())

    monkeypatch.setattr(type(docs), "mapInArrow", watched)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    for run in (
        lambda: corpus_pipeline.quality_stage(spark, common.table(spark, str(tmp_path), "documents"), str(tmp_path)),
        lambda: corpus_pipeline.run(spark, str(tmp_path)),
    ):
        seen.mkdir(exist_ok=True)
        assert run().count() > 0
        assert largest() < 2 * common.BATCH_BYTES < sum(len(r[1]) for r in rows)
        assert spark.conf.get(key, None) == before
    for value in (before, "2m"):
        try:
            if value:
                spark.conf.set(key, value)
            with common.small_batches(spark):
                assert spark.conf.get(key) == str(common.BATCH_BYTES)
            assert spark.conf.get(key, None) == value
        finally:
            spark.conf.unset(key)
