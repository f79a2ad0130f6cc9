"""Encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stopwise.llm import bpe
from stopwise.llm.queries import QUERIES, public_tokenizer
from tests.llm import samples

FILES = public_tokenizer()
VOCABULARY = bpe.vocabulary(FILES.path)


def library(special=True):
    found = Tokenizer.from_file(FILES.path)
    found.no_truncation()
    found.no_padding()
    found.encode_special_tokens = not special
    return found


LIBRARY = library()
SCHEMA = "doc_id long, text string, row long, ids string, part int"


def expected(texts, special=True):
    made = library(special)
    return [made.encode(t or "", add_special_tokens=False).ids for t in texts]


def encoded(spark, texts, **settings_):
    rows = [(k, t, 1, "x", 2) for k, t in enumerate(texts)]
    files = replace(FILES, **settings_)
    found = bpe.encode(spark.createDataFrame(rows, SCHEMA).repartition(3), files)
    by_id = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in found.collect()}
    return [by_id[k] for k in range(len(texts))]


def long_texts():
    rng = random.Random(5)
    return [
        "a" * 9000,
        "ab" * 5000 + " " + "the" * 4000,
        "".join(rng.choice("aeinrst") for _ in range(20_000)),
        " " * 7000 + "x" + "\u3000 " * 3000,
        "\u00a0 " * 4000 + "\x1c " * 4000 + "\x85\u2003" * 3000 + " a" * 3000,
        "".join(rng.choice("日本語漢字仮名") for _ in range(6000)),
        "12" * 5000 + "!?" * 5000 + "\n" * 5000,
        "word " * 3000 + "<|endoftext|>" + "z" * 5000 + "<|endoftext|><|endoftext|>" + "é" * 5000,
        "🙂" * 3000 + "'ll" + "l" * 5000,
    ]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeinrst\u00e9日🙂", min_size=2, max_size=60), st.data())
def test_join_is_exact(text, data):
    whole = text.encode()
    cut = data.draw(st.integers(1, len(whole) - 1))
    joined = bpe.join(VOCABULARY, VOCABULARY.piece(whole[:cut]), VOCABULARY.piece(whole[cut:]))
    assert joined.tolist() == VOCABULARY.piece(whole).tolist()


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=400), st.integers(1, 9))
def test_tree_is_exact_for_any_bytes(data, leaf):
    leaves = [VOCABULARY.piece(x) for x in bpe.halves(data, leaf)]
    assert bpe.concatenate(VOCABULARY, leaves).tolist() == VOCABULARY.piece(data).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_cut_and_decoding_equal_the_library(text):
    ids = [
        x
        for piece in VOCABULARY.pieces(text, True)
        for x in ([piece] if isinstance(piece, int) else VOCABULARY.short(piece))
    ]
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert VOCABULARY.decode(np.array(ids, np.uint32)) == LIBRARY.decode(ids, skip_special_tokens=False) == text


def test_whole_tables(spark):
    texts = samples.texts() + long_texts()
    assert encoded(spark, texts) == expected(texts)


@pytest.mark.parametrize("leaf", [4, 64])
def test_low_leaves(spark, leaf):
    texts = samples.texts() + [t[:3000] for t in long_texts()]
    assert encoded(spark, texts, leaf=leaf) == expected(texts)


def test_special_strings_as_text(spark):
    texts = long_texts()[-2:] + ["a<|endoftext|>b", "<|endoftext|>", "<|endof", ""]
    assert encoded(spark, texts, special=False) == expected(texts, special=False)
    assert encoded(spark, texts) == expected(texts)


def test_round_trip(spark):
    texts = [t for t in samples.texts() if t is not None] + long_texts()
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    back = bpe.decode(bpe.encode(docs, FILES), FILES).collect()
    assert {r["doc_id"]: r["text"] for r in back} == dict(enumerate(texts))


def test_repeated_and_missing_ids(spark):
    rows = [(None, "one"), (None, "one"), (1, "x" * 9000), (1, "x" * 9000), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["n_tokens"]) for r in bpe.digests(docs, FILES).collect())
    sizes = [len(x) for x in expected([t for _, t in rows])]
    assert got == sorted((i is None, n) for (i, _), n in zip(rows, sizes, strict=True))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, FILES).collect() == bpe.digests(docs, FILES).collect() == []


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    made = LIBRARY.encode_batch([r["text"] or "" for r in docs], add_special_tokens=False)
    want = {}
    for row, found in zip(docs, made, strict=True):
        text = LIBRARY.decode(found.ids, skip_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        want[row["doc_id"]] = (
            len(found.ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        )
    got = QUERIES["op12_bpe"](spark, folder).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
