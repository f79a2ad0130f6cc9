"""Packing of token streams into fixed windows with a controlled mixture.

Each source is a queue of documents. A window of ``width`` tokens is filled by
deficit round-robin: every source earns its target share of each window,
spends whole tokens, and carries what it could not spend into the next
window. Sources are cut freely, so a window is full. The targets are the
sources' shares of all tokens; at these no queue runs dry before the others.

For Spark, every queue is cut at the same fractions into parts of about
``part_windows`` windows. A part begins with the deficits that the fractions
of tokens cut off at its border leave, so the mixture goes on as if one task
had filled all windows. A part is bounded, whatever the size of a source. The last
window of a part is short by less than ``width``; it is divided into
sequences whose lengths are powers of two, so no sequence needs padding.

The text is tokenized once. Ids are stored by document; the plan is made of counts alone.

Defined cases: a null text is empty (its ids are the end id alone); null
sources form one queue; rows that repeat are packed each;
an empty table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stopwise.llm.shared import partitions, stored
from stopwise.llm.textkit import binary_array, chunks
from stopwise.llm.tokens import tokens

WIDTH = 1024
PART_WINDOWS = 4096
END = 0
_CHUNK = 1 << 22

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _tokenized(ranks_path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, source, text_hash, n, ids): ids as little-endian, two bytes where they fit."""
    for batch in batches:
        for chunk in chunks(batch.column("text"), _CHUNK):
            ids, begin = tokens(ranks_path).encode(chunk)
            packed = [
                _packed(ids[low:high])
                for low, high in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)
            ]
            own = batch.slice(chunk.first, len(chunk))
            yield pa.RecordBatch.from_arrays(
                [
                    own.column("doc_id"),
                    own.column("source"),
                    own.column("text_hash"),
                    pa.array(np.diff(begin) + 1),
                    binary_array(packed),
                ],
                names=["doc_id", "source", "text_hash", "n", "ids"],
            )


def _packed(ids: np.ndarray) -> bytes:
    if len(ids) and ids.max() > 0xFFFF:
        return b"4" + ids.astype("<u4").tobytes()
    return b"2" + ids.astype("<u2").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    kind = "<u2" if packed[:1] == b"2" else "<u4"
    return np.append(np.frombuffer(packed, kind, offset=1).astype("<u4"), np.uint32(END))


def fill_windows(
    sizes: np.ndarray, earned: np.ndarray, total: int, width: int = WIDTH
) -> np.ndarray:
    """Tokens each source gives to each window: deficit round-robin.

    ``sizes``: tokens each source has. ``earned``: deficits at the start, in
    ``total``-ths of a token. Exact integers; a column per source.
    """
    left = sizes.astype(np.int64).copy()
    whole = int(left.sum())
    share = left.copy()
    deficit = np.array(earned, float) / max(1, total)
    windows = []
    while whole > 0:
        room = min(width, whole)
        deficit += width * share / max(1, share.sum())
        take = np.minimum(np.floor(np.maximum(deficit, 0)).astype(np.int64), left)
        over = int(take.sum()) - room
        if over > 0:
            # Earlier windows spent less than they earned: the least owed gives back first.
            for source in np.argsort(deficit - take, kind="stable"):
                back = min(over, int(take[source]))
                take[source] -= back
                over -= back
                if not over:
                    break
        while over < 0:
            # What is left of the window goes round by what is owed most, a token a turn.
            open_ = np.flatnonzero(left > take)
            order = open_[np.argsort(take[open_] - deficit[open_], kind="stable")]
            turn = order[: min(len(order), -over)]
            if len(order) < -over:
                more = np.minimum(left[turn] - take[turn], max(1, -over // len(order)))
            else:
                more = np.ones(len(turn), np.int64)
            take[turn] += more
            over += int(more.sum())
        deficit -= take
        left -= take
        whole -= room
        windows.append(take)
    return np.array(windows, np.int64).reshape(-1, len(sizes))


def _sequences(total: int, width: int) -> np.ndarray:
    """Where the sequences of a part begin: full windows, then powers of two."""
    begins = list(range(0, total - total % width + 1, width))
    rest, at = total % width, total - total % width
    for power in range(width.bit_length(), -1, -1):
        if rest & (1 << power):
            at += 1 << power
            begins.append(at)
    return np.array(begins[:-1] if begins[-1] == total else begins, np.int64)


def _plan(width: int, table: pa.Table) -> pa.Table:
    """Pieces of one part: rows (source, x: place in the queue, doc, start, n) in, cuts out."""
    order = table.sort_by([("queue", "ascending"), ("x", "ascending")])
    part = order.column("part")[0].as_py()
    n = order.column("n").to_numpy()
    queue = order.column("queue").to_numpy()
    sources, first = np.unique(queue, return_index=True)
    sizes = np.add.reduceat(n, first)
    # A part's token counts are whole; the fractions they lack or exceed are owed.
    owed = order.column("owed").to_numpy()[first]
    given = fill_windows(sizes, owed, 1_000_000, width)
    # Where each source's share of each window begins, in its own queue and in the part.
    spent = np.vstack([np.zeros((1, len(sizes)), np.int64), np.cumsum(given, axis=0)])
    window_at = np.concatenate([[0], np.cumsum(given.sum(axis=1))])
    inside = np.cumsum(given, axis=1) - given
    begins = _sequences(int(window_at[-1]), width)
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    for s in range(len(sizes)):
        stop = first[s + 1] if s + 1 < len(first) else len(n)
        rows = np.arange(first[s], stop)
        local = np.concatenate([[0], np.cumsum(n[rows])])
        # Cuts in the queue: documents, windows, and sequences within the last window.
        place = window_at[:-1] + inside[:, s]
        last = begins[(begins > place[-1]) & (begins < place[-1] + given[-1, s])]
        cuts = np.unique(np.concatenate([local, spent[:, s], spent[-2, s] + last - place[-1]]))
        low, length = cuts[:-1], np.diff(cuts)
        row = np.searchsorted(local, low, "right") - 1
        window = np.searchsorted(spent[:, s], low, "right") - 1
        at = place[window] + low - spent[window, s]
        sequence = np.searchsorted(begins, at, "right") - 1
        out[0].append(rows[row])
        out[1].append(low - local[row])
        out[2].append(length)
        out[3].append(sequence)
        out[4].append(at - begins[sequence])
    row, start, length, sequence, offset = (np.concatenate(x) for x in out)
    row_order = np.argsort(row, kind="stable")
    row, start, length, sequence, offset = (
        x[row_order] for x in (row, start, length, sequence, offset)
    )
    start = start + order.column("start").to_numpy()[row]
    # One row per document of the part: its cuts, packed.
    some, begin = np.unique(row, return_index=True)
    ends = np.append(begin[1:], len(row))
    cuts = np.stack([start, length, sequence + (part << 24), offset], axis=1).astype("<i8")
    docs = order.take(pa.array(some))
    return pa.table(
        {
            "row": docs.column("row"),
            "cuts": binary_array([cuts[a:b].tobytes() for a, b in zip(begin, ends, strict=True)]),
        }
    )


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, count, checks, rows = [], [], [], []
        columns = (batch.column(x) for x in ("doc_id", "ids", "cuts"))
        for doc_id, ids, cuts in zip(*(x.to_pylist() for x in columns), strict=True):
            ids = _unpacked(ids)
            data = memoryview(ids.tobytes())
            cuts = np.frombuffer(cuts, "<i8").reshape(-1, 4)
            for start, length in cuts[:, :2].tolist():
                checks.append(zlib.crc32(data[4 * start : 4 * (start + length)]))
            doc.append(doc_id)
            count.append(len(ids))
            rows.append(cuts)
        if not rows:
            continue
        each = [len(x) for x in rows]
        cuts = np.concatenate(rows)
        owner = pa.array(np.repeat(np.arange(len(doc)), each))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc, pa.int64()).take(owner),
                pa.array(np.ascontiguousarray(cuts[:, 0])),
                pa.array(np.ascontiguousarray(cuts[:, 1])),
                pa.array(checks, pa.int64()),
                pa.array(count, pa.int64()).take(owner),
                pa.array(np.ascontiguousarray(cuts[:, 2])),
                pa.array(np.ascontiguousarray(cuts[:, 3])),
            ],
            names=[x.split()[0] for x in PIECES.split(", ")],
        )


def pack(
    docs: DataFrame, ranks_path: str, width: int = WIDTH, part_windows: int = PART_WINDOWS
) -> DataFrame:
    """One row per piece of a document (columns ``PIECES``)."""
    if width & (width - 1):
        raise ValueError("the width of a window must be a power of two")
    spark = docs.sparkSession
    # Stored rows are numbered, so rows that repeat can be told apart.
    ids = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.xxhash64("text").alias("text_hash"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).mapInArrow(
            partial(_tokenized, ranks_path),
            "doc_id long, source string, text_hash long, n long, ids binary",
        ).withColumn("row", F.monotonically_increasing_id())
    )
    counts = ids.select("doc_id", "source", "text_hash", "n", "row")
    # The place of each document in its source's queue: sums over buckets of the
    # queue first, then within a bucket, so a hot source is no single task.
    buckets = 16 * partitions(spark)
    queue = F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    counts = stored(
        counts.withColumn("queue", queue).withColumn(
            "bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets))
        )
    )
    sums = counts.groupBy("queue", "bucket").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("queue").agg(F.sum("n").alias("total"))
    everything = totals.agg(F.sum("total")).first()[0] or 0
    parts = max(1, -(-everything // (width * part_windows)))
    before = W.partitionBy("queue").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    inner = (
        W.partitionBy("queue", "bucket")
        .orderBy("doc_id", "text_hash", "row")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = sums.select(
        "queue", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    ).join(totals, "queue")
    placed = counts.join(offsets, ["queue", "bucket"]).withColumn(
        "x", F.col("base") + F.coalesce(F.sum("n").over(inner), F.lit(0))
    )
    # Part j has the tokens k of a queue with floor(k * parts / total) = j.
    whole = F.lit(parts).cast("decimal(18,0)")
    total = F.col("total").cast("decimal(19,0)")

    def part_of(token):
        return F.floor(token.cast("decimal(19,0)") * whole / total).cast("long")

    def begin_of(part):
        return F.ceil(part.cast("decimal(19,0)") * total / whole).cast("long")

    low = part_of(F.col("x"))
    high = part_of(F.col("x") + F.col("n") - 1)
    split = placed.withColumn("part", F.explode(F.sequence(low, high)))
    begin = F.greatest(F.col("x"), begin_of(F.col("part")))
    stop = F.least(F.col("x") + F.col("n"), begin_of(F.col("part") + 1))
    exact = F.col("part").cast("double") * F.col("total") / F.lit(float(parts))
    rows = split.select(
        "row",
        "queue",
        "part",
        begin.alias("x"),
        (begin - F.col("x")).alias("start"),
        (stop - begin).alias("n"),
        # Millionths of a token that this source had earned and not spent before the part.
        ((exact - begin_of(F.col("part"))) * 1_000_000).cast("long").alias("owed"),
    ).where("n > 0")
    # A stated number of partitions is not merged at run time: parts are few rows, but much work.
    dealt = rows.repartition(partitions(spark), "part")
    cuts = dealt.groupBy("part").applyInArrow(
        lambda part: _plan(width, part), "row long, cuts binary"
    )
    met = ids.select("row", "doc_id", "ids").join(cuts, "row")
    return met.select("doc_id", "ids", "cuts").mapInArrow(_pieces, PIECES)
