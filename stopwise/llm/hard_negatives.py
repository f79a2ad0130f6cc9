"""Hard negatives by Four-Russians scoring over packed bit planes.

The score of two rows is the inner product of their integer codes. Eight
dimensions form a group. A candidate stores, per group and bit of its codes, one
byte: that bit of the eight codes. An anchor has, per group, a table of the sums of
all 256 subsets of its eight codes. A byte looked up in the table is the product
of the anchor with that bit plane; planes are added from the highest down,
doubling in between, and the highest counts negative (two's complement), which
gives the whole exact score with no multiplication per pair.

* Rows are packed into blocks, dealt to strips. Every block of anchors is sent to every
  strip, which reads its candidates once and then takes one block of anchors after the
  other, so a task holds a strip (bounded) and the tables of one block.
* A first pass finds each anchor's best rows of its label. A second one, which knows their
  scores, keeps for each positive the best rows of other labels in its range.
* A strip answers with a few rows per anchor; ranks over all strips are limited before
  their exchange.

Defined cases: rows without vec_id or label, or with a null vector or a null or non-finite
component take no part. Shorter vectors count as padded by zeros; an empty vector scores 0.
Rows that repeat are rows of their own: each is an anchor if the first is, and the
others' positive. Rows alike in score and vec_id are taken in the order of their places in
the stored blocks. Anchors without positives and positives without negatives in range give
no row. Codes must fit 30 bits and scores 62, else a ValueError says so. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm.shared import held_packed, partitions
from stopwise.llm.textkit import binary_array

GROUP = 8
BLOCK_ROWS = 2048  # candidates scored at a time
ANCHOR_ROWS = 256  # anchors whose tables are held at a time
STRIP_ROWS = 1 << 18


@dataclass(frozen=True)
class Limits:
    """How many rows are taken, and which part of the positive's score (of ``den``) a
    negative's score lies in."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    den: int = 100


def codes_of(vector: Column, scale: int) -> Column:
    """Integer codes floor(scale * x), or null for a vector that takes no part."""
    usable = ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def bit_planes(codes: np.ndarray) -> np.ndarray:
    """Bytes [bit, group, row] of integer codes [row, dimension], lowest bit first."""
    rows, dims = codes.shape
    groups = -(-dims // GROUP)
    padded = np.zeros((rows, groups * GROUP), np.int64)
    padded[:, :dims] = codes
    low, high = int(padded.min(initial=0)), int(padded.max(initial=0))
    width = max(high.bit_length(), (~low).bit_length()) + 1
    if width > 31:
        raise ValueError("vector components are too large: codes must fit 30 bits")
    planes = np.empty((width, groups, rows), np.uint8)
    for bit in range(width):
        ones = ((padded >> bit) & 1).astype(np.uint8).reshape(rows, groups, GROUP)
        planes[bit] = np.packbits(ones, axis=2, bitorder="little")[:, :, 0].T
    return planes


def codes_from(planes: np.ndarray) -> np.ndarray:
    """The codes [row, dimension] of planes; the highest bit is the sign."""
    width, groups, rows = planes.shape
    out = np.zeros((rows, groups * GROUP), np.int64)
    for bit in range(width):
        ones = np.unpackbits(planes[bit].T[:, :, None], axis=2, bitorder="little")
        weight = -(1 << bit) if bit == width - 1 else 1 << bit
        out += weight * ones.reshape(rows, groups * GROUP).astype(np.int64)
    return out


def subset_sums(codes: np.ndarray) -> np.ndarray:
    """Tables [group, byte, anchor]: the sum of the codes whose bits are set in the byte."""
    anchors, dims = codes.shape
    by_group = codes.T.reshape(dims // GROUP, GROUP, anchors)
    tables = np.zeros((dims // GROUP, 1 << GROUP, anchors), np.int64)
    for k in range(GROUP):
        half = 1 << k
        tables[:, half : 2 * half] = tables[:, :half] + by_group[:, k, None, :]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products [row, anchor]: table lookups, added and doubled plane by plane."""
    width, groups, rows = planes.shape
    groups = min(groups, len(tables))  # dimensions that only one side has count as zeros
    largest = int(np.abs(tables).max(initial=0)) * max(1, groups)
    if largest.bit_length() + width > 62:
        raise ValueError("vector components are too large: scores must fit 62 bits")
    kind = np.int32 if largest.bit_length() + width <= 31 else np.int64
    narrow = tables[:groups].astype(kind, copy=False)
    total = np.zeros((rows, tables.shape[2]), kind)
    for bit in range(width - 1, -1, -1):
        if bit < width - 1:
            total += total
        add = np.subtract if bit == width - 1 else np.add
        for group in range(groups):
            add(total, narrow[group][planes[bit, group]], out=total)
    return total


# --- blocks --------------------------------------------------------------------------------

_BLOCK = "rows int, anchors int, width int, ids binary, labels binary, chosen binary, planes binary"


def _matrix(column: pa.ListArray) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), int(lengths.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _packed(table: pa.Table) -> pa.RecordBatch:
    table = table.combine_chunks().sort_by("vec_id")
    planes = bit_planes(_matrix(table.column("codes").combine_chunks()))
    chosen = table.column("anchor").to_numpy(zero_copy_only=False).astype(np.uint8)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([len(chosen)], pa.int32()),
            pa.array([int(chosen.sum())], pa.int32()),
            pa.array([len(planes)], pa.int32()),
            binary_array([table.column("vec_id").to_numpy().astype("<i8").tobytes()]),
            binary_array([table.column("label").to_numpy().astype("<i8").tobytes()]),
            binary_array([chosen.tobytes()]),
            binary_array([planes.tobytes()]),
        ],
        names=[x.split()[0] for x in _BLOCK.split(", ")],
    )


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK_ROWS):
            held.append(batch.slice(low, BLOCK_ROWS))
            if sum(len(x) for x in held) >= BLOCK_ROWS:
                yield _packed(pa.Table.from_batches(held))
                held = []
    if held:
        yield _packed(pa.Table.from_batches(held))


@dataclass
class _Rows:
    """Rows of one or more blocks: unique row numbers, ids, labels."""

    numbers: np.ndarray
    ids: np.ndarray
    labels: np.ndarray

    def where(self, some: np.ndarray) -> _Rows:
        return _Rows(self.numbers[some], self.ids[some], self.labels[some])


def _unpacked(block_id: int, row: dict) -> tuple[_Rows, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    # A block has at most twice BLOCK_ROWS rows.
    numbers = block_id * (2 * BLOCK_ROWS) + np.arange(len(ids))
    planes = np.frombuffer(row["planes"], np.uint8)
    planes = planes.reshape(row["width"], -1, len(ids)) if len(ids) else planes.reshape(1, 0, 0)
    return _Rows(numbers, ids, labels), planes, np.frombuffer(row["chosen"], np.uint8).astype(bool)


_ANCHORS = "part int, numbers binary, ids binary, labels binary, dims int, codes binary"


def _anchor_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of the blocks of a partition, ANCHOR_ROWS at most in a row."""
    held: list[tuple[_Rows, np.ndarray]] = []
    part = 0

    def flushed(found: list[tuple[_Rows, np.ndarray]], part: int) -> pa.RecordBatch:
        dims = max(c.shape[1] for _, c in found)
        codes = np.concatenate([np.pad(c, ((0, 0), (0, dims - c.shape[1]))) for _, c in found])
        each = [np.concatenate([getattr(r, x) for r, _ in found]) for x in ("numbers", "ids", "labels")]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                *(binary_array([x.astype("<i8").tobytes()]) for x in each),
                pa.array([dims], pa.int32()),
                binary_array([codes.astype("<i4").tobytes()]),
            ],
            names=[x.split()[0] for x in _ANCHORS.split(", ")],
        )

    for batch in batches:
        for row in batch.to_pylist():
            rows, planes, chosen = _unpacked(row["block_id"], row)
            codes = codes_from(np.ascontiguousarray(planes[:, :, chosen]))
            rows = rows.where(chosen)
            for low in range(0, len(codes), ANCHOR_ROWS):
                cut = slice(low, low + ANCHOR_ROWS)
                if sum(len(c) for _, c in held) + len(codes[cut]) > ANCHOR_ROWS:
                    yield flushed(held, part)
                    held, part = [], part + 1
                held.append((rows.where(cut), codes[cut]))
    if held:
        yield flushed(held, part)


# --- what a strip answers ------------------------------------------------------------------

_FOUND = "anchor long, anchor_id long, slot int, number long, vec_id long, score long"


class _Best:
    """The best rows of each (anchor, slot) over the candidate blocks of a strip."""

    def __init__(self, count: int) -> None:
        self._count = count
        self._parts: list[np.ndarray] = []

    def add(self, anchor: int, slot: int, rows: _Rows, some: np.ndarray, found: np.ndarray) -> None:
        """``some`` rows in order of score, best first; those beyond the count are let go."""
        some = some[: self._count]
        n = len(some)
        if n:
            out = np.empty((5, n), np.int64)
            out[0], out[1], out[2] = anchor, slot, rows.numbers[some]
            out[3], out[4] = rows.ids[some], found[some]
            self._parts.append(out)

    def batch(self, anchors: _Rows) -> Iterator[pa.RecordBatch]:
        if not self._parts:
            return
        anchor, slot, number, vec_id, score = np.concatenate(self._parts, axis=1)
        order = np.lexsort((number, vec_id, -score, slot, anchor))
        key = anchor[order] * (int(slot.max()) + 1) + slot[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        place = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
        kept = order[place < self._count]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchors.numbers[anchor[kept]]),
                pa.array(anchors.ids[anchor[kept]]),
                pa.array(slot[kept].astype(np.int32)),
                pa.array(number[kept]),
                pa.array(vec_id[kept]),
                pa.array(score[kept]),
            ],
            names=[x.split()[0] for x in _FOUND.split(", ")],
        )


def _positives(best: _Best, rows: _Rows, planes: np.ndarray, anchors: _Rows, codes: np.ndarray) -> None:
    """Of each anchor the best other rows of its label; only those are scored."""
    for label in np.unique(anchors.labels):
        mine = np.flatnonzero(anchors.labels == label)
        like = np.flatnonzero(rows.labels == label)
        if not len(like):
            continue
        alike = rows.where(like)
        found = scores(subset_sums(codes[mine]), np.ascontiguousarray(planes[:, :, like])).T
        for k, anchor in enumerate(mine.tolist()):
            order = np.argsort(-found[k].astype(np.int64), kind="stable")
            order = order[alike.numbers[order] != anchors.numbers[anchor]]
            best.add(anchor, 0, alike, order, found[k])


def _negatives(limits: Limits, wanted: np.ndarray):
    """``wanted``: scores of each anchor's positives by slot, and whether there is one."""

    def work(best: _Best, rows: _Rows, planes: np.ndarray, anchors: _Rows, codes: np.ndarray) -> None:
        found = scores(subset_sums(codes), planes).T
        for k in range(len(anchors.ids)):
            slots = np.flatnonzero(wanted[1, k])
            if not len(slots):
                continue
            limit = wanted[0, k]
            own = limits.den * found[k].astype(np.int64)
            inside = np.flatnonzero(
                (own >= limits.low * limit[slots].min())
                & (own <= limits.high * limit[slots].max())
                & (rows.labels != anchors.labels[k])
            )
            order = inside[np.argsort(-own[inside], kind="stable")]
            falling = -own[order]
            for slot in slots.tolist():
                low = np.searchsorted(falling, -limits.high * limit[slot], "left")
                high = np.searchsorted(falling, -limits.low * limit[slot], "right")
                best.add(k, slot, rows, order[low:high], found[k])

    return work


def _strips(limits: Limits, second: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by strip, candidates before anchors."""
        strip, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {x: batch.column(x)[i].as_py() for x in ("strip", "block_id", "candidates")}
                if row["strip"] != strip:
                    strip, held = row["strip"], []
                if row["candidates"] is not None:
                    held.append(_unpacked(row["block_id"], row["candidates"])[:2])
                    continue
                packed = batch.column("anchors")[i].as_py()
                ids, labels, numbers = (np.frombuffer(packed[x], "<i8") for x in ("ids", "labels", "numbers"))
                anchors = _Rows(numbers, ids, labels)
                codes = np.frombuffer(packed["codes"], "<i4").reshape(len(ids), -1).astype(np.int64)
                best = _Best(limits.negatives if second else limits.positives)
                work = _positives
                if second:
                    wanted = np.zeros((2, len(ids), limits.positives), np.int64)
                    place = {n: k for k, n in enumerate(numbers.tolist())}
                    for x in batch.column("wanted")[i].as_py() or []:
                        k = place[x["anchor"]]
                        wanted[:, k, x["slot"]] = x["score"], 1
                    work = _negatives(limits, wanted)
                for rows, planes in held:
                    work(best, rows, planes, anchors, codes)
                yield from best.batch(anchors)

    return run


# --- in Spark ------------------------------------------------------------------------------


def _met(blocks: DataFrame, anchors: DataFrame, strips: int, wanted: DataFrame | None) -> DataFrame:
    """Candidates and all anchor blocks of each strip, in one partition and that order."""
    candidate = F.struct(*(x.split()[0] for x in _BLOCK.split(", ")))
    sent = F.struct("numbers", "ids", "labels", "codes")
    if wanted is not None:
        anchors = anchors.join(wanted, "anchor_block", "inner")
    # Strips without candidates have nothing to meet.
    there = blocks.select("strip").distinct()
    kind = "array<struct<anchor:bigint,slot:int,score:bigint>>"
    met = anchors.join(
        anchors.select("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip")),
        "anchor_block",
    ).join(there, "strip", "left_semi")
    rows = blocks.select(
        "strip",
        "block_id",
        candidate.alias("candidates"),
        F.lit(None).cast(met.select(sent.alias("x")).schema[0].dataType).alias("anchors"),
        F.lit(None).cast(kind).alias("wanted"),
    ).unionByName(
        met.select(
            "strip",
            F.col("anchor_block").alias("block_id"),
            F.lit(None).cast(blocks.select(candidate.alias("x")).schema[0].dataType).alias("candidates"),
            sent.alias("anchors"),
            (F.lit(None) if wanted is None else F.col("wanted")).cast(kind).alias("wanted"),
        )
    )
    count = max(1, min(strips, 4 * partitions(blocks.sparkSession)))
    return rows.repartition(count, "strip").sortWithinPartitions(
        "strip", F.isnull("candidates"), "block_id"
    )


def _ranked(found: DataFrame, keys: tuple[str, ...], count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "number")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)


def mine(rows: DataFrame, scale: int = 256, limits: Limits = Limits()) -> DataFrame:
    """For rows (vec_id, label, embedding, anchor): per anchor and positive the best negatives
    as anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score."""
    coded = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(F.col("anchor"), F.lit(False)).alias("anchor"),
        codes_of(F.col("embedding"), scale).alias("codes"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND codes IS NOT NULL")
    blocks = held_packed(
        coded.mapInArrow(_pack, _BLOCK).withColumn("block_id", F.monotonically_increasing_id())
    )
    size = blocks.agg(F.sum("rows")).first()[0] or 0
    strips = max(2 * partitions(rows.sparkSession), -(-size // STRIP_ROWS))
    blocks = blocks.withColumn("strip", F.pmod(F.xxhash64("block_id"), F.lit(strips)).cast("int"))
    anchors = held_packed(
        blocks.where("anchors > 0").drop("strip").mapInArrow(_anchor_blocks, _ANCHORS)
        .withColumn("anchor_block", F.monotonically_increasing_id())
    )
    first = _met(blocks, anchors, strips, None).mapInArrow(_strips(limits, False), _FOUND)
    positives = held_packed(
        _ranked(first, ("anchor",), limits.positives).select(
            "anchor", "number", "vec_id", "score", (F.col("place") - 1).alias("slot")
        )
    )
    # An anchor block has at most ANCHOR_ROWS anchors with a few positives each.
    owner = anchors.mapInArrow(_owners, "anchor_block long, anchor long")
    wanted = (
        positives.join(owner, "anchor")
        .groupBy("anchor_block")
        .agg(F.collect_list(F.struct("anchor", F.col("slot").cast("int").alias("slot"), "score")).alias("wanted"))
    )
    second = _met(blocks, anchors, strips, wanted).mapInArrow(_strips(limits, True), _FOUND)
    chosen = _ranked(second, ("anchor", "slot"), limits.negatives)
    return chosen.join(
        positives.select(
            "anchor",
            "slot",
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        ["anchor", "slot"],
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("slot") + 1).alias("positive_rank"),
        F.col("place").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _owners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            numbers = np.frombuffer(batch.column("numbers")[i].as_py(), "<i8")
            block = batch.column("anchor_block")[i].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(numbers), block, np.int64)), pa.array(numbers)],
                names=["anchor_block", "anchor"],
            )
