"""The registered queries: SQL where there is some, and the pipeline by brute force."""

from __future__ import annotations

import pytest

import corpus_pipeline
from checks.compare import _rows, connect
from stopwise.llm.queries import ORACLES, QUERIES
from stopwise.llm.shared import stored
from tests.llm.test_documents import WORD, linked

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, name):
    found = QUERIES[name](spark, SMALL)
    connection = connect(SMALL)
    result = connection.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    theirs = result.fetchall()
    connection.close()
    assert sorted(names) == sorted(found.columns)
    assert _rows(found.columns, found.collect()) == _rows(names, theirs)


def test_all_operators_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} >= set(range(1, 14))
    assert "pipeline" in names and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_stages_one_by_one(spark):
    """Each stage against brute force on what the one before kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SMALL)))
    for frame in kept[:-1]:
        assert frame.columns == columns
    rows = [{r.doc_id: r for r in frame.collect()} for frame in kept[:-1]]
    # Language: every document that a language is predicted for stays, by plain decoding.
    assert set(rows[1]) == {r.doc_id for r in rows[0].values() if any(c.isalpha() for c in r.text or "")}
    # Near duplicates: the smallest id of each component.
    line = sorted((r.doc_id, r.text or "") for r in rows[1].values())
    assert set(rows[2]) == {component for _, _, component in linked(line, 5, 80)}
    # Passages of twenty words.
    seen, want = set(), {}
    for doc_id in sorted(rows[2]):
        text = rows[2][doc_id].text
        words = WORD.findall(text or "")
        gone = set()
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone.update(range(k, k + 20))
            seen.add(window)
        left = [w for k, w in enumerate(words) if k not in gone]
        if left or not words:
            want[doc_id] = " ".join(left) if gone else text
    assert {k: r.text for k, r in rows[3].items()} == want
    assert all(r.n_chars == len(r.text) for r in rows[3].values())
    # Benchmark windows.
    hit = {r.doc_id for r in QUERIES_hit(spark, kept[3])}
    assert set(rows[4]) == set(rows[3]) - hit
    # Packing takes every document that is left, whole.
    pieces = kept[5].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in pieces} == set(rows[4])
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces)


def QUERIES_hit(spark, docs):
    """Documents with a window of ten benchmark words, by plain Python."""
    import re
    from types import SimpleNamespace

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def windows(text, size=10):
        words = pattern.findall((text or "").translate(lower))
        size = min(size, len(words))
        return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()

    items = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        items |= windows(r.text)
    short = {w for w in items if len(w) < 10}
    for r in docs.collect():
        own = windows(r.text)
        for size in {len(w) for w in short}:
            own |= windows(r.text, size)
        if own & items:
            yield SimpleNamespace(doc_id=r.doc_id)


def test_run_is_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.count() > 0 and "sequence_id" in found.columns
    assert corpus_pipeline.ORACLE_SQL is None


AWKWARD = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, hash string, "
    "_id string, _hash long, prediction string, row long, bucket int, bits string"
)


def chained(spark, rows):
    docs = spark.createDataFrame(rows, AWKWARD)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL))
        assert docs.columns == [x.split()[0] for x in AWKWARD.split(", ")]
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)


def test_stages_with_clashing_columns_and_rows_that_repeat(spark):
    prose = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) > 600").orderBy("doc_id").limit(3)
    extra = (7, "h", "i", 8, "p", 9, 1, "b")
    rows = [(r.doc_id + 10, r.text, r.lang, r.source, r.n_chars, *extra) for r in prose.collect()]
    rows += [rows[0], (None, rows[1][1], *rows[1][2:]), (None, None, *[None] * 11), (5, "", *[None] * 11)]
    rows += [(900, "12 34 !", *[None] * 11)]
    docs, packed = chained(spark, rows)
    kept = sorted(docs.collect(), key=lambda r: r.doc_id)
    # Each text once, with its other columns as they were; no text without a letter.
    assert [(r.doc_id, r.prediction, r.id, r.hash, r._id, r._hash) for r in kept] == [
        (row[0], "p", 7, "h", "i", 8) for row in rows[:3]
    ]
    assert {r.doc_id for r in packed.collect()} == {row[0] for row in rows[:3]}


def test_stages_of_an_empty_table(spark):
    docs, packed = chained(spark, [])
    assert docs.count() == packed.count() == 0


def test_known_language_equals_plain_decoding(spark):
    """Ids and labels against one text at a time, and no clean document goes."""
    import numpy as np

    from stopwise.llm import language_id
    from stopwise.llm.shared import crc_remainder
    from stopwise.llm.textkit import chunks
    import pyarrow as pa
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(docs.where(crc_remainder(F.col("doc_id"), 4) != 2))
    want = {}
    for r in docs.collect():
        if not any(c.isalpha() for c in r.text or ""):
            continue
        (chunk,) = chunks(pa.array([r.text]))
        margins = model.margins(chunk)[0]
        losses = [
            sum(
                model.trust[k, b] * np.exp(-np.clip(language_id.SHARPNESS * margins[b], -30, 30) * model.codes[k, b])
                for b in range(model.codes.shape[1])
            )
            for k in range(len(model.langs))
        ]
        want[r.doc_id] = model.langs[int(np.argmin(losses))]
    found = language_id.predict(docs, model).where(F.col("prediction.lang") != language_id.UNKNOWN).collect()
    assert {r.doc_id: r.prediction.lang for r in found} == want
    kept = corpus_pipeline.known_language(spark, docs, SMALL)
    assert {r.doc_id for r in kept.collect()} == set(want)


def test_scratch_is_deleted(spark, tmp_path, monkeypatch):
    from stopwise.llm import shared

    monkeypatch.setattr(shared, "shared_base", lambda spark: str(tmp_path))
    found = corpus_pipeline.run(spark, SMALL)
    assert found.count() > 0
    # What the last stage reads is left, nothing of the stages before it.
    left = [x for x in tmp_path.iterdir() if x.name.startswith("llm-")]
    assert 0 < len(left) <= 4
