"""Benchmark decontamination by a prefix-filtered join of shingles.

An item is cut into windows of ``window`` consecutive words (a shorter item is
one window). A document contains a window exactly when it contains all its
shingles in place, so with full containment the necessary prefix of a window,
its shingles ordered by rarity in the corpus, is the rarest one alone.

1. count the item shingles over all documents; a bitmap of fixed size keeps
   shingles of no item from leaving the scan;
2. order each window's shingles by rarity and keep its prefix; a window whose
   rarest shingle occurs nowhere cannot occur;
3. join the places of prefix shingles in documents with the windows, keep
   those where the window fits the text (bounds of length and position), and
   compare the words themselves.

Defined cases: a null or empty text has no words; rows equal in id and text are one
document; a null item id counts as the empty id; an item without words matches nothing;
repeated items are one item. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm.shared import stored
from stopwise.llm.textkit import (
    ALPHANUMERIC,
    LOWER,
    Chunk,
    Hasher,
    Words,
    chunks,
    words,
)

SHINGLE = 5
BITS = 24  # the bitmap has 2**24 bits (2 MB) whatever the size of the benchmark

_HASHER = Hasher(1)


def _parsed(chunk: Chunk) -> tuple[np.ndarray, Words, np.ndarray]:
    data = LOWER[chunk.data]
    found = words(Chunk(chunk.first, data, chunk.offsets), ALPHANUMERIC)
    return data, found, _HASHER.spans(data, found.starts, found.ends)


def _joined(data: np.ndarray, found: Words, low: int, high: int) -> str:
    return b" ".join(
        data[found.starts[i] : found.ends[i]].tobytes() for i in range(low, high)
    ).decode("utf-8", "replace")


def _item_windows(window: int, shingle: int):
    """Windows of each item: (item_id, words, size, shingles)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for chunk in chunks(batch.column("text")):
                data, found, values = _parsed(chunk)
                out = ([], [], [], [])
                for row, count in enumerate(found.counts()):
                    size = min(window, int(count))
                    part = min(shingle, size)
                    for low in range(found.first[row], found.first[row + 1] - size + 1):
                        if not size:
                            break
                        hashes = _HASHER.runs(values[low : low + size], part)
                        out[0].append(ids[chunk.first + row])
                        out[1].append(_joined(data, found, low, low + size))
                        out[2].append(size)
                        out[3].append(hashes.view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out[0], pa.string()),
                        pa.array(out[1], pa.string()),
                        pa.array(out[2], pa.int32()),
                        pa.array(out[3], pa.list_(pa.int64())),
                    ],
                    names=["item_id", "words", "size", "shingles"],
                )

    return run


def _bitmap(spark: SparkSession, hashes: DataFrame) -> Broadcast:
    """Bits of the hashes modulo 2**BITS: at most 512 rows of 4 KB reach the driver."""
    place = F.col("hash").bitwiseAND((1 << BITS) - 1) + 1
    rows = (
        hashes.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()
    )
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    for row in rows:
        low = (row["bucket"] - 1) * 4096
        bits[low : low + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return spark.sparkContext.broadcast(bits)


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _counts(bitmap: Broadcast, sizes: list[int]):
    """How often each shingle the bitmap knows occurs, summed per chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                _, found, values = _parsed(chunk)
                for size in sizes:
                    hashes = _HASHER.runs(values, size)[found.whole_runs(size)]
                    kept, count = np.unique(hashes[_known(bitmap.value, hashes)], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kept.view(np.int64)), pa.array(count.astype(np.int64))],
                        names=["hash", "n"],
                    )

    return run


def _places(bitmap: Broadcast, sizes: list[int], window: int):
    """A row per document, and one per place of a prefix shingle with the words around it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                data, found, values = _parsed(chunk)
                row, hashed, place, low, around = [], [], [], [], []
                for size in sizes:
                    hashes = _HASHER.runs(values, size)
                    at = np.flatnonzero(_known(bitmap.value, hashes) & found.whole_runs(size))
                    for i, r in zip(at.tolist(), found.rows[at].tolist(), strict=True):
                        begin, end = int(found.first[r]), int(found.first[r + 1])
                        left = max(begin, i - window + 1)
                        row.append(r)
                        hashed.append(int(hashes[i].view(np.int64)))
                        place.append(i - begin)
                        low.append(left - begin)
                        around.append(_joined(data, found, left, min(end, i + window)))
                rows = np.concatenate([np.arange(len(chunk)), np.array(row, np.int64)])
                missing = [None] * len(chunk)
                own = batch.slice(chunk.first, len(chunk)).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("doc_id"),
                        own.column("text_hash"),
                        pa.array(found.counts()[rows].astype(np.int64)),
                        pa.array(missing + hashed, pa.int64()),
                        pa.array(missing + place, pa.int64()),
                        pa.array(missing + low, pa.int64()),
                        pa.array(missing + around, pa.string()),
                    ],
                    names=["doc_id", "text_hash", "n_words", "hash", "place", "low", "around"],
                )

    return run


def _covered(spans: Column) -> Column:
    """Words covered by (start, size) spans that are sorted by start."""
    begin = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, span: Column) -> Column:
        stop = span["start"] + span["size"]
        fresh = F.greatest(F.lit(0).cast("long"), stop - F.greatest(acc["end"], span["start"]))
        return F.struct(F.greatest(acc["end"], stop).alias("end"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(spans, begin, step)["n"]


def item_windows(
    benchmark: DataFrame, window: int = 10, shingle: int = SHINGLE
) -> DataFrame:
    """Distinct windows: (words, size, shingles, items)."""
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(
        _item_windows(window, shingle),
        "item_id string, words string, size int, shingles array<long>",
    )
    return rows.groupBy("words").agg(
        F.first("size").alias("size"),
        F.first("shingles").alias("shingles"),
        F.collect_set("item_id").alias("items"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = SHINGLE
) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, items (sorted), spans (start, size)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"))
    windows = stored(item_windows(benchmark, window, shingle))
    parts = windows.select(
        "words", "size", F.posexplode("shingles").alias("offset", "hash")
    )
    # At most ``shingle`` different sizes exist.
    sizes = sorted(
        row[0] for row in windows.select(F.least("size", F.lit(shingle))).distinct().collect()
    )
    counts = (
        texts.mapInArrow(_counts(_bitmap(spark, parts), sizes), "hash long, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"))
    )
    # The rarest shingle is the prefix; the inner join leaves out what occurs nowhere.
    ordered = parts.join(counts, "hash", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("prefix")
    )
    prefixes = stored(
        ordered.where("prefix.n > 0")
        .join(windows, "words")
        .select("words", "size", "items", "prefix.hash", "prefix.offset")
    )
    keyed = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    places = keyed.mapInArrow(
        _places(_bitmap(spark, prefixes), sizes, window),
        "doc_id long, text_hash long, n_words long, hash long, place long, low long, around string",
    )
    # Documents without a place get a key of their own, so they do not meet in one task.
    left = places.withColumn("key", F.coalesce("hash", F.xxhash64("doc_id", "text_hash")))
    start = F.col("place") - F.col("offset")
    fits = (start >= F.col("low")) & (start + F.col("size") <= F.col("n_words"))
    there = F.slice(F.split("around", " "), (start - F.col("low") + 1).cast("int"), F.col("size"))
    # The slice is only taken where the bounds hold.
    same = F.when(fits, F.array_join(there, " ") == F.col("words")).otherwise(False)
    matched = left.join(prefixes.withColumnRenamed("hash", "key"), "key", "left").withColumn(
        "hit", F.coalesce(same & F.col("hash").isNotNull(), F.lit(False))
    )
    span = F.struct(start.alias("start"), F.col("size").cast("long").alias("size"))
    return (
        matched.groupBy("doc_id", "text_hash")
        .agg(
            F.max("n_words").alias("n_words"),
            F.sort_array(F.collect_set(F.when(F.col("hit"), span))).alias("spans"),
            F.sort_array(
                F.array_distinct(F.flatten(F.collect_set(F.when(F.col("hit"), F.col("items")))))
            ).alias("items"),
        )
        .select("doc_id", "text_hash", "n_words", _covered("spans").alias("n_hit"), "items", "spans")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents that contain no window of an item."""
    hit = (
        contamination(docs, benchmark, window)
        .where("n_hit > 0")
        # No table has such names.
        .select(F.col("doc_id").alias("\u00b7id"), F.col("text_hash").alias("\u00b7hash"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("\u00b7id")) & (F.xxhash64("text") == F.col("\u00b7hash"))
    return docs.join(hit, same, "left_anti")
