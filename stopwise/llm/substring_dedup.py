"""Removal of repeated word passages by Rabin-Karp hashes of all fixed-length windows.

Every window of ``window`` consecutive words of every document is hashed. Spark
counts the hashes in buckets: of a hash that occurs more than once, the first
occurrence (smallest id, then place) stays and all others are repeated. Repeated
windows of a document merge into maximal intervals, which are removed.

Windows are compared by 64 bits of hash within a bucket chosen by a second,
independent hash, so two different ones meet only with equal 64 + log2(buckets) bits.

Defined cases: a null text counts as empty; a missing id counts as the smallest; rows that
share an id are taken in the order of their texts' hashes within a block and
of their blocks otherwise; rows that repeat are documents of their own, so the
later one is removed whole. Each row gets its own result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm import blocks as B
from stopwise.llm.textkit import (
    NOT_SPACE,
    Chunk,
    Hasher,
    Words,
    binary_array,
    chunks,
    covered,
    words,
)

WINDOW = 20
# Every window of a block is hashed twice and sorted, some 25 times its bytes.
BLOCK_BYTES = 2 << 20
_FIRST, _SECOND = Hasher(3), Hasher(4)
_RESULTS = ("_words", "_removed", "_spans", "_kept")


def _parsed(batch: pa.RecordBatch) -> Iterator[tuple[Chunk, Words]]:
    for chunk in chunks(batch.column("text")):
        yield chunk, words(chunk, NOT_SPACE)


def _windows(batch: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each window of a block in order, and the row it is of."""
    first, second, rows = [], [], []
    for chunk, found in _parsed(batch):
        whole = found.whole_runs(window)
        rows.append(chunk.first + found.rows[: len(whole)][whole])
        for hasher, out in ((_FIRST, first), (_SECOND, second)):
            values = hasher.spans(chunk.data, found.starts, found.ends)
            out.append(hasher.runs(values, window)[whole])
    return tuple(np.concatenate(x) if x else np.empty(0) for x in (first, second, rows))


def _sent(batch: pa.RecordBatch, window: int, count: int):
    """The keys a block sends, sorted out: hashes, rows, their windows, bucket bounds.

    A hash goes out with its first occurrence in the block; ``early`` is true there.
    """
    first, second, rows = _windows(batch, window)
    order = np.lexsort((first, second)) if len(first) else np.empty(0, np.int64)
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.diff(first[order]) != 0
    fresh[1:] |= np.diff(second[order]) != 0
    early = np.zeros(len(order), bool)
    early[order[fresh]] = True  # lexsort is stable: the first of equals is the earliest
    leader = np.empty(len(order), np.int64)
    leader[order] = order[fresh][np.cumsum(fresh) - 1] if len(order) else order
    del order, fresh
    kept = np.flatnonzero(early)
    buckets = (second[kept] % np.uint64(count)).astype(np.int64)
    del second
    by, bounds = B.by_bucket(buckets, count)
    return first, rows, kept[by], bounds, early, leader


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(B.ORDER).fill_null(-(1 << 63)).to_numpy()


def _send(window: int, count: int, block_id: int, batch: pa.RecordBatch):
    first, rows, kept, bounds, _, _ = _sent(batch, window, count)
    ids = _ids(batch)[rows[kept]] if len(kept) else np.empty(0, np.int64)
    used = np.flatnonzero(np.diff(bounds))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(used, pa.int64()),
            pa.array([block_id] * len(used), pa.int64()),
            binary_array([first[kept[bounds[b] : bounds[b + 1]]].tobytes() for b in used]),
            binary_array([B.pack_ints(ids[bounds[b] : bounds[b + 1]]) for b in used]),
        ],
        names=["bucket", "block_id", "hashes", "ids"],
    )


def _decide(table: pa.Table) -> pa.Table:
    """Of one bucket: which of each block's hashes occur earlier in another block."""
    hashes = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    sizes = np.array([len(x) for x in hashes])
    ids = np.concatenate([B.unpack_ints(x) for x in table.column("ids").to_pylist()])
    block = np.repeat(table.column("block_id").to_numpy(), sizes)
    hashes = np.concatenate(hashes)
    order = np.lexsort((block, ids, hashes))
    later = np.zeros(len(order), bool)
    later[order[1:]] = hashes[order[1:]] == hashes[order[:-1]]
    ends = np.cumsum(sizes)
    bits = [np.packbits(later[e - n : e]).tobytes() for n, e in zip(sizes, ends, strict=True)]
    return pa.table(
        {
            "block_id": table.column("block_id"),
            "bucket": table.column("bucket"),
            "bits": binary_array(bits),
        }
    )


def _remove(window: int, count: int, names, block_id: int, batch: pa.RecordBatch, answers: dict[int, bytes]):
    _, _, kept, bounds, early, leader = _sent(batch, window, count)
    later = np.zeros(len(early), bool)
    for bucket, bits in answers.items():
        own = kept[bounds[bucket] : bounds[bucket + 1]]
        later[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)
    # A window repeats if its hash occurs earlier in this block or in another one.
    repeated = ~early | later[leader]
    total, removed, spans, texts = [], [], [], []
    at = 0
    for chunk, found in _parsed(batch):
        whole = np.flatnonzero(found.whole_runs(window))
        own = repeated[at : at + len(whole)]
        at += len(whole)
        gone = covered(whole[own], window, len(found))
        begin = gone.copy()
        begin[1:] &= ~gone[:-1] | (found.rows[1:] != found.rows[:-1])
        n = len(chunk)
        total.append(found.counts())
        removed.append(np.bincount(found.rows[gone], minlength=n))
        spans.append(np.bincount(found.rows[begin], minlength=n))
        for row in range(n):
            low, high = found.first[row], found.first[row + 1]
            stay = low + np.flatnonzero(~gone[low:high])
            texts.append(
                b" ".join(
                    chunk.data[a:b].tobytes()
                    for a, b in zip(found.starts[stay].tolist(), found.ends[stay].tolist(), strict=True)
                )
            )
    counts = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (total, removed, spans)]
    plain = batch.drop_columns([B.ORDER, B.HASH])
    kept_texts = pa.array(texts, pa.binary()).cast(pa.string())
    yield pa.RecordBatch.from_arrays(
        [*plain.columns, *(pa.array(x) for x in counts), kept_texts],
        names=[*plain.schema.names, *names],
    )


def repeated_passages(
    docs: DataFrame, window: int = WINDOW, names: tuple[str, ...] = _RESULTS
) -> DataFrame:
    """The rows with _words, _removed, _spans (counts) and _kept (kept words, one space apart).

    ``names`` are other names for these; columns that have them are replaced.
    """
    docs = docs.drop(*names)
    stored = B.store_blocks(docs, BLOCK_BYTES)
    size = stored.agg(F.sum("bytes")).first()[0] or 0
    count = B.bucket_count(size // 6, stored)
    sent = B.map_blocks(
        stored,
        partial(_send, window, count),
        "bucket long, block_id long, hashes binary, ids binary",
    )
    answers = sent.groupBy("bucket").applyInArrow(
        lambda table: _decide(table), "block_id long, bucket long, bits binary"
    )
    fields = [
        T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType)
        for f in docs.schema
    ]
    results = [T.StructField(name, T.LongType()) for name in names[:3]]
    schema = T.StructType([*fields, *results, T.StructField(names[3], T.StringType())])
    return B.answer_blocks(stored, answers, partial(_remove, window, count, names), schema)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeated passages cut out; those left without a word go."""
    names = tuple(f"\u00b7{name}" for name in _RESULTS)
    found = repeated_passages(docs, window, names)
    total, removed, _, kept = (F.col(name) for name in names)
    stays = found.where((removed < total) | (total == 0))
    changed = stays.withColumn("text", F.when(removed > 0, kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return changed.select(*docs.columns)
