"""Documents stored in blocks, and an exchange of hashed keys between blocks.

A block is a row: some whole documents with all their columns, as a compressed
Arrow stream. It can be read any number of times with the same result, and
shuffled at the size of the compressed text.

In an exchange every block sends its keys, sorted out into buckets by hash and
packed, so that a (block, bucket) pair is one row. A key travels once per block,
however often it occurs there, which is what keeps a hot key from weighing on
its bucket. Each bucket answers every block with one bit per key, and where that is
set with the number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.shared import held_dealt, held_packed, partitions
from stopwise.llm.textkit import binary_array, let_go

BLOCK_BYTES = 8 << 20
# Columns of a block besides those of the documents; no table has such names.
ORDER, HASH = "\u00b7order", "\u00b7hash"
BUCKET_KEYS = 1 << 21


def write_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def read_block(packed: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(pa.py_buffer(packed)).read_all().combine_chunks()
    found = table.to_batches()
    return found[0] if found else pa.RecordBatch.from_pylist([], schema=table.schema)


def _pack(block_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            # Earlier documents first, so a block's first occurrence is its earliest.
            table = table.take(
                pa.compute.sort_indices(
                    table.select([ORDER, HASH]),
                    sort_keys=[(ORDER, "ascending"), (HASH, "ascending")],
                    null_placement="at_start",
                )
            )
            packed = write_table(table)
            return pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int64()), binary_array([packed])], names=["bytes", "block"]
            )

        for batch in batches:
            low = 0
            sizes = np.cumsum(
                pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(
                    zero_copy_only=False
                )
            )
            while low < batch.num_rows:
                done = int(sizes[low - 1]) if low else 0
                high = int(np.searchsorted(sizes, done + block_bytes - size)) + 1
                held.append(batch.slice(low, high - low))
                size += int(sizes[min(high, len(sizes)) - 1]) - done
                low = high
                if size >= block_bytes:
                    yield flushed()
                    held, size = [], 0
        if held:
            yield flushed()

    import pyarrow.compute  # noqa: F401 - makes pa.compute there

    return run


def store_blocks(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, *, dealt: int | None = None
) -> DataFrame:
    """(block_id, bytes, block): all documents, in blocks sorted by id and text hash.

    Blocks are dealt to ``dealt`` partitions by their number, if given: answers then come to
    them and they need not move again.
    """
    rows = docs.withColumn("text", F.col("text").cast("string"))
    rows = rows.withColumns(
        {ORDER: F.col("doc_id").cast("long"), HASH: F.xxhash64("text")}
    )
    packed = rows.mapInArrow(_pack(block_bytes), "bytes long, block binary")
    numbered = packed.withColumn("block_id", F.monotonically_increasing_id())
    return held_packed(numbered) if dealt is None else held_dealt(numbered, dealt, "block_id")


def bucket_count(keys: int, blocks: DataFrame) -> int:
    """Buckets that hold about BUCKET_KEYS keys each, and at least two per task."""
    return max(2 * partitions(blocks.sparkSession), -(-keys // BUCKET_KEYS))


def pack_ints(values: np.ndarray) -> bytes:
    """Sorted integers as compressed steps."""
    steps = np.diff(values, prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(steps.astype("<i8").tobytes())


def unpack_ints(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<i8"))


def by_bucket(buckets: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by bucket (stable), and where each bucket begins in it."""
    kind = np.uint16 if count <= 1 << 16 else np.int64
    order = np.argsort(buckets.astype(kind), kind="stable")
    return order, np.searchsorted(buckets[order], np.arange(count + 1))


def map_blocks(
    blocks: DataFrame, work: Callable[[int, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply a function to each block, one at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = read_block(batch.column("block")[i].as_buffer().to_pybytes())
                yield from work(batch.column("block_id")[i].as_py(), found)
                del found
                let_go()

    return blocks.select("block_id", "block").mapInArrow(run, schema)


def answer_blocks(
    blocks: DataFrame,
    answers: DataFrame,
    work: Callable[[int, pa.RecordBatch, dict[int, bytes]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Apply a function to each block's number, rows, and the answers (block_id, bucket, bits)
    it got, as bits by bucket."""
    got = answers.groupBy("block_id").agg(
        F.collect_list(F.struct("bucket", "bits")).alias("answers")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = read_block(batch.column("block")[i].as_buffer().to_pybytes())
                pairs = batch.column("answers")[i].as_py() or []
                bits = {x["bucket"]: x["bits"] for x in pairs}
                yield from work(batch.column("block_id")[i].as_py(), found, bits)
                del found, bits, pairs
                let_go()

    met = blocks.select("block_id", "block").join(got, "block_id", "left")
    return met.select("block_id", "block", "answers").mapInArrow(run, schema)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit keys, and each key's number among them; only they are sorted."""
    coded = pa.array(keys, pa.uint64()).dictionary_encode()
    some = coded.dictionary.to_numpy()
    order = np.argsort(some)
    place = np.empty(len(some), np.int64)
    place[order] = np.arange(len(some))
    return some[order], place[coded.indices.to_numpy()]


def distinct_keys(
    keys: np.ndarray, count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit keys, each key's number among them, how often each occurs, and
    where each of ``count`` buckets, ranges of keys, begins."""
    some, number = numbered(keys)
    often = np.bincount(number, minlength=len(some))
    bucket = ((some >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    return some, number, often, np.searchsorted(bucket, np.arange(count + 1))


def send_keys(block_id: int, keys: np.ndarray, count: int) -> pa.RecordBatch:
    """A block's distinct keys, a row per bucket."""
    some, _, _, bounds = distinct_keys(keys, count)
    used = np.flatnonzero(np.diff(bounds))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used, pa.int64()),
            pa.array([block_id] * len(used), pa.int64()),
            binary_array([some[bounds[b] : bounds[b + 1]].tobytes() for b in used]),
        ],
        names=["bucket", "block_id", "keys"],
    )


SENT_KEYS = "bucket long, block_id long, keys binary"


def _shared(table: pa.Table) -> pa.Table:
    each = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
    number = pa.array(np.concatenate(each), pa.uint64()).dictionary_encode().indices.to_numpy()
    spread = np.minimum(np.bincount(number), 0xFFFF).astype("<u2")[number]
    ends = np.cumsum([len(x) for x in each])
    answers = []
    for e, x in zip(ends, each, strict=True):
        own = spread[e - len(x) : e]
        answers.append(np.packbits(own > 1).tobytes() + own[own > 1].tobytes())
    return pa.table(
        {
            "block_id": table.column("block_id"),
            "bucket": table.column("bucket"),
            "bits": binary_array(answers),
        }
    )


def shared_keys(sent: DataFrame) -> DataFrame:
    """Answers to ``send_keys``: a bit per key, whether another block has it too, and then two bytes
    per key that others have, in how many blocks it is."""
    return sent.groupBy("bucket").applyInArrow(
        lambda table: _shared(table), "block_id long, bucket long, bits binary"
    )


def spread_of(keys: np.ndarray, count: int, answers: dict[int, bytes]) -> np.ndarray:
    """For each key of a block, how many blocks have it, 65535 at most; 0 if it occurs only once."""
    some, number, often, bounds = distinct_keys(keys, count)
    spread = (often > 1).astype(np.uint16)
    for bucket, told in answers.items():
        low, high = int(bounds[bucket]), int(bounds[bucket + 1])
        size = (high - low + 7) // 8
        elsewhere = np.unpackbits(np.frombuffer(told, np.uint8, size), count=high - low)
        spread[low + np.flatnonzero(elsewhere)] = np.frombuffer(told, "<u2", offset=size)
    return spread[number]
