"""Document fingerprints by winnowing.

The bytes of a text are hashed as rolling k-grams. Of every window of ``w``
consecutive hashes the smallest is selected, the rightmost where several are
smallest. Any run of ``w + k - 1`` bytes that two texts share therefore puts a
common hash into both fingerprints, and no common run of fewer than ``k``
bytes does. A fingerprint keeps each selected hash and its place.

As a string a fingerprint is base64 of 32-bit hashes followed by one byte per
hash, its distance from the one before (from -1 for the first). A text of fewer than ``k``
bytes is one gram; one with fewer than ``w`` grams is one window; the empty
text has the empty fingerprint.

Defined cases: null counts as empty; two empty fingerprints are wholly alike, an
empty and another one not at all. Rows are ranked by id and then by text, a
missing id last; rows that repeat are neighbours of each other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stopwise.llm.textkit import Chunk, Hasher, chunks, let_go

K, WINDOW = 12, 20
_HASHER = Hasher(2)
_BUCKET = 11  # ids of a bucket differ in the last so many bits only; a window holds 4096 rows in memory


def select(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
    """Places of the winnowed hashes; text i has hashes low[i] to high[i] - 1.

    A window never crosses texts; a text with fewer hashes than a window is one window.
    """
    count = high - low
    # Ranking by (hash, later place first) makes a plain minimum take the rightmost tie.
    # Minima over powers of two, then two of them that overlap.
    step, best = 1, np.arange(len(hashes))
    while 2 * step <= window:
        best = _smaller(hashes, best[:-step], best[step:])
        step *= 2
    rest = window - step
    if rest:
        best = _smaller(hashes, best[: len(best) - rest], best[rest:])
    full = count >= window
    mark = np.zeros(len(hashes), bool)
    if len(best):
        inside = np.zeros(len(hashes) + 1, np.int32)
        np.add.at(inside, low[full], 1)
        np.add.at(inside, high[full] - window + 1, -1)
        mark[best[np.cumsum(inside[: len(best)]) > 0]] = True
    for a, b in zip(low[(count > 0) & ~full].tolist(), high[(count > 0) & ~full].tolist(), strict=True):
        part = hashes[a:b][::-1]
        mark[b - 1 - int(part.argmin())] = True
    return np.flatnonzero(mark)


def _smaller(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.where(hashes[left] < hashes[right], left, right)


def fingerprint_chunk(chunk: Chunk, k: int, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) selected for each text of a chunk."""
    grams = (_HASHER.grams(chunk.data, k) >> np.uint64(32)).astype(np.uint32)
    low = chunk.offsets[:-1]
    high = np.maximum(low, chunk.offsets[1:] - k + 1)
    places = select(grams, np.minimum(low, len(grams)), np.minimum(high, len(grams)), window)
    first = np.searchsorted(places, low)
    last = np.searchsorted(places, high)
    out = []
    for row in range(len(chunk)):
        length = int(chunk.offsets[row + 1] - low[row])
        if 0 < length < k:
            whole = _HASHER.grams(chunk.data[low[row] : low[row] + length], length)
            out.append(((whole >> np.uint64(32)).astype(np.uint32), np.zeros(1, np.int64)))
        else:
            own = places[first[row] : last[row]]
            out.append((grams[own], own - low[row]))
    return out


def encode(hashes: np.ndarray, places: np.ndarray) -> str:
    gaps = np.diff(places, prepend=-1)
    return base64.b64encode(hashes.astype("<u4").tobytes() + _bytes(gaps)).decode("ascii")


def _bytes(gaps: np.ndarray) -> bytes:
    if len(gaps) and gaps.max() > 255:
        raise ValueError("windows of more than 255 grams do not fit a place's byte")
    return gaps.astype(np.uint8).tobytes()


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a fingerprint string."""
    packed = base64.b64decode(fingerprint)
    count = len(packed) // 5
    gaps = np.frombuffer(packed, np.uint8, count, 4 * count).astype(np.int64)
    return np.frombuffer(packed, "<u4", count), np.cumsum(gaps) - 1


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Twice the common hashes by all hashes of both, each hash counted once a text."""
    left, right = np.unique(left), np.unique(right)
    if not len(left) and not len(right):
        return 1.0
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 2 * common / (len(left) + len(right))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with ``next_text``: that of the next row in descending id.

    After the last row comes the first. Rows are cut into buckets of ids; the
    row that follows the last one of a bucket is sent there as well. Buckets are
    linked by their own few rows, in two levels.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("bucket", F.shiftright(F.coalesce("doc_id", F.lit(-(1 << 63))), _BUCKET))
    heads = rows.groupBy("bucket").agg(
        F.max_by("text", F.struct("doc_id", "text")).alias("text")
    )
    # The largest row of a bucket follows the bucket above it.
    names = rows.select("bucket").distinct().withColumn(
        "block", F.shiftright("bucket", _BUCKET)
    )
    blocks = names.groupBy("block").agg(
        F.min("bucket").alias("first"), F.max("bucket").alias("last")
    )
    # One row per 4 million ids: few enough for one task.
    around = W.partitionBy(F.lit(0))
    above = blocks.select(
        "block",
        F.coalesce(
            F.lead("first").over(around.orderBy("block")),
            F.min("first").over(around),
        ).alias("next_first"),
    )
    target = (
        names.join(above, "block")
        .withColumn("up", F.lead("bucket").over(W.partitionBy("block").orderBy("bucket")))
        .select("bucket", F.coalesce("up", "next_first").alias("target"))
    )
    halo = heads.join(target, "bucket").select(
        F.lit(None).cast("long").alias("doc_id"),
        "text",
        F.col("target").alias("bucket"),
        F.lit(True).alias("halo"),
    )
    order = W.partitionBy("bucket").orderBy(
        "halo", F.col("doc_id").desc_nulls_last(), F.desc("text")
    )
    return (
        rows.withColumn("halo", F.lit(False))
        .unionByName(halo)
        .withColumn("next_text", F.lead("text").over(order))
        .where(~F.col("halo"))
        .select("doc_id", "text", "next_text")
    )


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compared(rows: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, text, next_text) with the fingerprints of text and edited text, and likeness.

    The edited text has the last floor(n_chars / 2) characters replaced by the
    first as many (or all) of the next text. A batch is given back in pieces, a chunk of
    texts each, and no texts are held beside it.
    """
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [part.split(" ")[0] for part in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                ids, following = (
                    batch.column(name).slice(chunk.first, len(chunk)) for name in ("doc_id", "next_text")
                )
                found = _work(chunk, following.to_pylist(), k, window)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(x, kind) for x, kind in zip(found, kinds, strict=True))],
                    names=["doc_id", *names],
                )
            del batch
            let_go()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "next_text").mapInArrow(run, f"doc_id {kind}, {RESULT}")


def _work(chunk: Chunk, after: list[str | None], k: int, window: int) -> list[list]:
    """The columns of ``RESULT`` for the texts of a chunk and the texts that follow them."""
    out: list[list] = [[] for _ in range(6)]
    own = [chunk.text(row).decode("utf-8", "replace") for row in range(len(chunk))]
    edited = []
    for text, other in zip(own, after, strict=True):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + (other or "")[:half])
    packed = [text.encode("utf-8") for text in edited]
    prints = fingerprint_chunk(chunk, k, window)
    (changed,) = chunks(pa.array(packed, pa.large_binary()), 1 << 62)
    edits = fingerprint_chunk(changed, k, window)
    # The next text mostly is the next row's own.
    other = [row for row in range(len(own)) if row + 1 >= len(own) or after[row] != own[row + 1]]
    nexts = {row: prints[row + 1] for row in range(len(own) - 1)}
    spare = pa.array([(after[row] or "").encode("utf-8") for row in other], pa.large_binary())
    for part in chunks(spare):
        for i, found in enumerate(fingerprint_chunk(part, k, window)):
            nexts[other[part.first + i]] = found
    for row in range(len(own)):
        out[0].append(len(own[row]))
        out[1].append(hashlib.sha256(packed[row]).hexdigest())
        out[2].append(encode(*prints[row]))
        out[3].append(encode(*edits[row]))
        out[4].append(likeness(prints[row][0], edits[row][0]))
        out[5].append(likeness(prints[row][0], nexts[row][0]))
    return out
