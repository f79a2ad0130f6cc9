"""Removal of repeated byte passages by bucket-pointer refinement of suffixes.

Every suffix of every text with at least ``window`` bytes is judged: those whose first
``window`` bytes also begin an earlier suffix repeat.

1. Each window of bytes names one q-gram inside it, the one of least hash. Equal
   windows name equal q-grams, so these are the initial buckets. Blocks exchange them;
   a bucket with one member is finished, as in any bucket sort of suffixes.
2. The other suffixes travel to their bucket, as the stretch of text that the
   windows naming one q-gram cover. There buckets are refined: two suffixes of a
   bucket of depth h are told apart by the bucket identifiers of the suffixes h
   further on, and sorting on these pairs makes buckets of depth 2h, whose
   identifiers serve the next round, up to the whole window. Texts are compared
   exactly.
3. Of each final bucket all suffixes but the earliest repeat, and the bytes
   their windows cover are removed.

A q-gram with more than ``heavy`` members could fill its bucket; its windows travel one by
one instead, each to a bucket of its own 128-bit fingerprint.
A stretch or fingerprint that occurs several times in a block travels once.

Defined cases: a null text counts as empty; a missing id counts as the smallest; rows
that share an id are taken in stored order. Each row gets its own result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm import blocks as B
from stopwise.llm.shared import stored
from stopwise.llm.textkit import Hasher, binary_array, chunks

WINDOW = 100
GRAM = 20
HEAVY = 20_000
_GRAMS, _FIRST, _SECOND = Hasher(7), Hasher(8), Hasher(9)
_U = np.uint64
_RESULTS = ("_bytes", "_removed", "_spans", "_kept")


@dataclass
class Stretches:
    """Runs of windows that name the same q-gram, in the order of a block's bytes."""

    keys: np.ndarray  # hash of the q-gram
    begin: np.ndarray  # first window of the run, as a place in the block
    count: np.ndarray  # windows of the run
    row: np.ndarray


def named_grams(batch: pa.RecordBatch, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, Stretches]:
    """Bytes and text bounds of a block, and its stretches."""
    data, bounds, at = [np.empty(0, np.uint8)], [np.zeros(1, np.int64)], 0
    out: list[list[np.ndarray]] = [[np.empty(0, _U)], *([np.empty(0, np.int64)] for _ in range(3))]
    span = window - gram + 1
    for chunk in chunks(batch.column("text")):
        data.append(chunk.data)
        bounds.append(chunk.offsets[1:] + at)
        hashes = _GRAMS.grams(chunk.data, gram)
        if len(hashes) >= span:
            # High bits of the hash, then the place: a plain minimum takes the leftmost tie.
            low = _U(int(len(hashes)).bit_length())
            best = (hashes >> low << low) | np.arange(len(hashes), dtype=_U)
            step = 1
            while 2 * step <= span:
                best = np.minimum(best[:-step], best[step:])
                step *= 2
            if span > step:
                best = np.minimum(best[: step - span], best[span - step :])
            best &= (_U(1) << low) - _U(1)
            size = np.diff(chunk.offsets)
            rows = np.flatnonzero(size >= window)
            full = size[rows] - window + 1
            place = np.arange(full.sum()) + np.repeat(chunk.offsets[rows] - np.cumsum(full) + full, full)
            named = best[place].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], named[1:] != named[:-1]]) if len(named) else [])
            out[0].append(hashes[named[first]])
            out[1].append(place[first] + at)
            out[2].append(np.diff(np.append(first, len(named))))
            out[3].append(np.repeat(rows, full)[first] + chunk.first)
        at += len(chunk.data)
    return np.concatenate(data), np.concatenate(bounds), Stretches(*(np.concatenate(x) for x in out))


def _send_grams(window: int, gram: int, count: int, block_id: int, batch: pa.RecordBatch):
    """Distinct q-grams of a block with how often they are named."""
    _, _, found = named_grams(batch, window, gram)
    some, _, often, bounds = B.distinct_keys(found.keys, count)
    used = np.flatnonzero(np.diff(bounds))
    cut = [slice(bounds[b], bounds[b + 1]) for b in used]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(used, pa.int64()),
            pa.array([block_id] * len(used), pa.int64()),
            binary_array([some[c].tobytes() for c in cut]),
            binary_array([B.pack_ints(np.cumsum(often[c])) for c in cut]),
        ],
        names=["bucket", "block_id", "keys", "often"],
    )


def _judge_grams(heavy: int, table: pa.Table) -> pa.Table:
    """Two bits per q-gram: whether it is named again, and whether too often for one task."""
    keys = [np.frombuffer(x, _U) for x in table.column("keys").to_pylist()]
    often = [np.diff(B.unpack_ints(x), prepend=0) for x in table.column("often").to_pylist()]
    _, number = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(number, np.concatenate(often))[number]
    bits, at = [], 0
    for part in keys:
        own = total[at : at + len(part)]
        at += len(part)
        bits.append(np.packbits(np.concatenate([own > 1, own > heavy])).tobytes())
    return pa.table(
        {
            "block_id": table.column("block_id"),
            "bucket": table.column("bucket"),
            "bits": binary_array(bits),
        }
    )


@dataclass
class Travel:
    """What a block sends of the suffixes not finished: stretches or single windows."""

    begin: np.ndarray
    count: np.ndarray  # windows each stands for
    leader: np.ndarray  # number of the first one in the block with the same content
    sent: np.ndarray  # numbers of those that travel, by bucket
    bounds: np.ndarray  # of the buckets in ``sent``
    single: np.ndarray  # travels as a fingerprint
    digest: np.ndarray  # two hashes of the content


def _travel(
    data: np.ndarray,
    found: Stretches,
    answers: dict[int, bytes],
    window: int,
    first_count: int,
    count: int,
) -> Travel:
    some, number, _, bounds = B.distinct_keys(found.keys, first_count)
    again, heavy = np.zeros(len(some), bool), np.zeros(len(some), bool)
    for bucket, bits in answers.items():
        if bucket < first_count:
            low, high = bounds[bucket], bounds[bucket + 1]
            own = np.unpackbits(np.frombuffer(bits, np.uint8), count=2 * int(high - low)).astype(bool)
            again[low:high], heavy[low:high] = own[: high - low], own[high - low :]
    light = again[number] & ~heavy[number]
    crowd = np.flatnonzero(heavy[number])
    each = found.count[crowd]
    single_at = np.arange(each.sum()) + np.repeat(found.begin[crowd] - np.cumsum(each) + each, each)
    begin = np.concatenate([found.begin[light], single_at])
    size = np.concatenate([found.count[light], np.ones(len(single_at), np.int64)])
    single = np.repeat([False, True], [int(light.sum()), len(single_at)])
    key = np.concatenate([found.keys[light], np.zeros(len(single_at), _U)])
    order = np.argsort(begin, kind="stable")
    begin, size, single, key = begin[order], size[order], single[order], key[order]
    # Hashes of each content, taken in parts of the block so that memory stays small.
    digest = np.empty((len(begin), 2), _U)
    at = 0
    while at < len(begin):
        stop = max(at + 1, int(np.searchsorted(begin, begin[at] + (1 << 20))))
        low, high = begin[at], int((begin[at:stop] + size[at:stop]).max()) + window - 1
        part = data[low:high]
        for k, hasher in enumerate((_FIRST, _SECOND)):
            digest[at:stop, k] = hasher.spans(
                part, begin[at:stop] - low, begin[at:stop] - low + size[at:stop] + window - 1
            )
        at = stop
    same = np.lexsort((digest[:, 1], digest[:, 0]))
    fresh = np.ones(len(begin), bool)
    fresh[1:] = (digest[same[1:]] != digest[same[:-1]]).any(axis=1)
    leader = np.empty(len(begin), np.int64)
    if len(begin):
        leader[same] = same[fresh][np.cumsum(fresh) - 1]
    own = np.flatnonzero(leader == np.arange(len(begin)))
    routed = np.where(single, digest[:, 1], key)[own]
    by, sorted_bounds = B.by_bucket((routed % _U(count)).astype(np.int64), count)
    return Travel(begin, size, leader, own[by], sorted_bounds, single, digest)


def _send_text(window: int, gram: int, first_count: int, count: int, block_id, batch, answers):
    """Stretches by bucket: their bytes one after the other, windows, ids, places."""
    data, bounds, found = named_grams(batch, window, gram)
    trip = _travel(data, found, answers, window, first_count, count)
    ids = batch.column(B.ORDER).fill_null(-(1 << 63)).to_numpy()
    row = np.searchsorted(bounds, trip.begin, "right") - 1
    squeeze = zstandard.ZstdCompressor(level=3)
    out: list[list] = [[] for _ in range(6)]
    for bucket in np.flatnonzero(np.diff(trip.bounds)).tolist():
        own = trip.sent[trip.bounds[bucket] : trip.bounds[bucket + 1]]
        wide, narrow = own[~trip.single[own]], own[trip.single[own]]
        length = trip.count[wide] + window - 1
        total = int(length.sum())
        place = np.arange(total) + np.repeat(trip.begin[wide] - np.cumsum(length) + length, length)
        mine = np.concatenate([wide, narrow])
        out[0].append(bucket)
        out[1].append(squeeze.compress(data[place].tobytes()))
        out[2].append(B.pack_ints(np.cumsum(trip.count[wide])))
        out[3].append(trip.digest[narrow].tobytes())
        out[4].append(B.pack_ints(ids[row[mine]]))
        out[5].append(B.pack_ints(trip.begin[mine]))
    block = pa.array([block_id] * len(out[0]), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array(out[0], pa.int64()), block, *(binary_array(x) for x in out[1:])],
        names=["bucket", "block_id", "text", "count", "digest", "ids", "place"],
    )


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Identifiers of pairs, in the order of the pairs."""
    return np.unique((left.astype(_U) << _U(32)) | right.astype(_U), return_inverse=True)[1]


def refine(text: np.ndarray, window: int) -> np.ndarray:
    """Bucket of each suffix by its first ``window`` bytes, by bucket-pointer refinement.

    The suffixes of the last ``window - 1`` bytes read zeros past the end.
    """
    size = len(text)
    padded = np.concatenate([text, np.zeros(2 * window, np.uint8)]).astype(_U)
    depth = min(8, window)
    value = np.zeros(size + window, _U)
    for k in range(depth):
        value = (value << _U(8)) | padded[k : k + size + window]
    bucket = np.unique(value, return_inverse=True)[1]
    while depth < window:
        ahead = min(depth, window - depth)
        later = np.concatenate([bucket[ahead:], np.zeros(ahead, bucket.dtype)])
        bucket = _pairs(bucket, later)
        depth += ahead
    return bucket[:size]


def _judge_text(window: int, table: pa.Table) -> pa.Table:
    """Of one bucket: a bit per window a block sent, whether it begins earlier elsewhere.

    Of stretches with the same bytes only the earliest is refined; the windows of
    the others repeat as they are.
    """
    expand = zstandard.ZstdDecompressor()
    stretches: list[bytes] = []
    parts: list[list[np.ndarray]] = [[] for _ in range(5)]
    for i, row in enumerate(table.select(["text", "count", "digest", "ids", "place"]).to_pylist()):
        text = expand.decompress(row["text"])
        count = np.diff(B.unpack_ints(row["count"]), prepend=0)
        digests = len(row["digest"]) // 16
        stops = np.cumsum(count + window - 1).tolist()
        stretches += [text[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        # A fingerprint is told from text by its length, which no stretch has.
        stretches += [row["digest"][16 * k : 16 * k + 16] for k in range(digests)]
        values = (
            np.concatenate([count, np.ones(digests, np.int64)]),
            B.unpack_ints(row["ids"]),
            B.unpack_ints(row["place"]),
            np.full(len(count) + digests, i),
            np.repeat([False, True], [len(count), digests]),
        )
        for part, value in zip(parts, values, strict=True):
            part.append(value)
    blocks = table.column("block_id").to_numpy()
    each, doc, place, row, single = (np.concatenate(part) for part in parts)
    order = np.lexsort((place, blocks[row], doc))
    seen: dict[bytes, int] = {}
    for k in order.tolist():
        seen.setdefault(stretches[k], k)
    first = np.zeros(len(each), bool)
    first[list(seen.values())] = True
    # Windows of all stretches in sent order; those of later copies repeat.
    base = np.cumsum(each) - each
    later = np.repeat(~first, each)
    own = np.flatnonzero(first & ~single)
    if len(own):
        text = np.frombuffer(b"".join([stretches[k] for k in own.tolist()]), np.uint8)
        count = each[own]
        length = count + window - 1
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        group = refine(text, window)[np.repeat(np.cumsum(length) - length, count) + step]
        at = np.repeat(base[own], count) + step
        begin = np.repeat(place[own], count) + step
        line = np.lexsort(
            (begin, np.repeat(blocks[row[own]], count), np.repeat(doc[own], count), group)
        )
        same = np.zeros(len(line), bool)
        same[line[1:]] = group[line[1:]] == group[line[:-1]]
        later[at] = same
    ends = np.searchsorted(row, np.arange(len(blocks) + 1))
    cuts = np.append(base, each.sum())[ends]
    bits = [np.packbits(later[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table(
        {
            "block_id": table.column("block_id"),
            "bucket": table.column("bucket"),
            "bits": binary_array(bits),
        }
    )


def _remove(window: int, gram: int, first_count: int, count: int, block_id, batch, answers):
    data, bounds, found = named_grams(batch, window, gram)
    trip = _travel(data, found, answers, window, first_count, count)
    base = np.cumsum(trip.count) - trip.count  # of each one's windows in ``repeated``
    repeated = np.ones(int(trip.count.sum()), bool)  # what did not travel is a later copy
    for bucket in np.flatnonzero(np.diff(trip.bounds)).tolist():
        own = trip.sent[trip.bounds[bucket] : trip.bounds[bucket + 1]]
        own = np.concatenate([own[~trip.single[own]], own[trip.single[own]]])
        each = trip.count[own]
        bits = np.unpackbits(
            np.frombuffer(answers[first_count + bucket], np.uint8), count=int(each.sum())
        )
        place = np.arange(each.sum()) + np.repeat(base[own] - np.cumsum(each) + each, each)
        repeated[place] = bits.astype(bool)
    each = trip.count
    window_at = np.arange(each.sum()) + np.repeat(trip.begin - np.cumsum(each) + each, each)
    starts = window_at[repeated]
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    gone = np.cumsum(change[:-1]) > 0
    begin = gone.copy()
    begin[1:] &= ~gone[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begin[edges] = gone[edges]
    upto = [np.concatenate([[0], np.cumsum(x)])[bounds] for x in (gone, begin)]
    kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    plain = batch.drop_columns([B.ORDER, B.HASH])
    yield pa.RecordBatch.from_arrays(
        [
            *plain.columns,
            pa.array(np.diff(bounds)),
            *(pa.array(np.diff(x).astype(np.int64)) for x in upto),
            binary_array(kept),
        ],
        names=[*plain.schema.names, *_RESULTS],
    )


def repeated_bytes(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, heavy: int = HEAVY
) -> DataFrame:
    """The rows with _bytes, _removed, _spans (counts) and _kept (bytes that stay)."""
    if not 16 < gram <= window:
        raise ValueError("a window holds at least one q-gram, of more than 16 bytes")
    docs = docs.drop(*_RESULTS)
    held = B.store_blocks(docs)
    size = held.agg(F.sum("bytes")).first()[0] or 0
    first_count = B.bucket_count(size // 40, held)
    # Refining holds several numbers per byte, so its buckets are small.
    count = B.bucket_count(size + size // 4, held)
    grams = B.map_blocks(
        held,
        partial(_send_grams, window, gram, first_count),
        "bucket long, block_id long, keys binary, often binary",
    )
    named = stored(
        grams.groupBy("bucket").applyInArrow(
            lambda table: _judge_grams(heavy, table), "block_id long, bucket long, bits binary"
        )
    )
    sent = B.answer_blocks(
        held,
        named,
        partial(_send_text, window, gram, first_count, count),
        "bucket long, block_id long, text binary, count binary, digest binary, ids binary, "
        "place binary",
    )
    judged = sent.groupBy("bucket").applyInArrow(
        lambda table: _judge_text(window, table), "block_id long, bucket long, bits binary"
    )
    answers = named.unionByName(judged.withColumn("bucket", F.col("bucket") + first_count))
    fields = [
        T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType)
        for f in docs.schema
    ]
    results = [T.StructField(name, T.LongType()) for name in _RESULTS[:3]]
    schema = T.StructType([*fields, *results, T.StructField("_kept", T.BinaryType())])
    return B.answer_blocks(
        held, answers, partial(_remove, window, gram, first_count, count), schema
    )
