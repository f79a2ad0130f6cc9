"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Rows of the incidence matrix are documents, columns the hashes of their
distinct word n-grams. Pairs of rows whose product is large enough are linked.

Size-derived bounds keep the product sparse. Two sets with a Jaccard likeness
of at least ``num / den`` differ in at most a tenth, say, of their union, so if
the columns are cut into one more block than they can differ in, one block is
equal in both. How many blocks that takes follows from the size of the smaller
set; sizes fall into classes such that linked sets are of one class or of
neighbouring ones. Per block the equal contents are a key:

1. blocks of documents exchange the keys of their column blocks and learn how common each
   is. Of a set's keys, those of as many blocks as may differ and one more are enough: linked
   sets share one of these in any order that all sets agree on. The rarest come first, so
   that common passages tie strangers only where little else is left; a document none of whose
   first keys occurs elsewhere is linked with nothing;
2. equal sets become one row; rows connected by keys form candidate groups;
3. a group larger than a tile, which chains of keys can still make of strangers, is first
   multiplied out on sketches, two bytes for each column block: sets that may differ in
   ``differ`` blocks have all others equal, so pairs with fewer equal ones are not linked,
   and what is left falls apart into small groups;
4. each group is multiplied out: overlap counts of one row against the others
   are accumulated over the columns they share, pairs below the bound that
   their sizes give are dropped, and rows found linked leave the columns. A
   group larger than a tile is cut into tiles, and tiles are multiplied in pairs;
5. links connect rows to components, and copies get the component of their set.

Only memberships leave a tile, at most one per row, never its pairs.

Defined cases: a null or empty text has no shingles and is linked with nothing; rows
of the same id are documents of their own; a missing id is no component's smallest
unless all are missing. Other columns are ignored. ``first_of_each`` decides per row: of
linked rows with the smallest id it keeps one, that of the smallest text hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm import blocks as B
from stopwise.llm.components import components
from stopwise.llm.shared import partitions, reclaim, stored
from stopwise.llm.textkit import (
    LOWER,
    NOT_SPACE,
    Chunk,
    Hasher,
    binary_array,
    chunks,
    let_go,
    mix,
    words,
)

NGRAM = 3
NUM, DEN = 90, 100
# Where copies are taken out: those with some words changed or added are linked as well.
STAGE_NGRAM = 5
STAGE_NUM, STAGE_DEN = 80, 100
TILE = 1 << 20  # shingles of a tile
SKETCH_TILE = 1 << 21  # shingles of a tile whose sets are sketched
_HASHER = Hasher(5)
_U = np.uint64


def _parts(size: int, differ: int) -> int:
    """Blocks for sets of at least ``size`` elements that may differ in ``differ`` ones: mostly so
    many that more than ``differ`` of them have two elements, or else one."""
    for scarce in (lambda mean: 1 + mean, lambda mean: 1.0):
        for parts in range(differ + 1, 2 * differ + 2):
            mean = size / parts
            weak = parts * float(np.exp(-mean)) * scarce(mean)
            if parts - weak - 2 * weak**0.5 >= differ + 1:
                return parts
    return differ + 1 + differ // 8


class SizeClasses:
    """Classes of set sizes, and the column blocks each class needs."""

    def __init__(self, num: int, den: int, largest: int) -> None:
        def differ(size: int) -> int:
            """Most elements in which a set of this size and a linked, larger one can differ."""
            union = size * den // num
            return union - -(-num * union // den)

        low = 1
        while not differ(low):
            low += 1
        lows = [low]
        while lows[-1] <= largest:
            lows.append(max(lows[-1] + 1, (lows[-1] - 1) * den // num + 1))
        lows.append(max(lows[-1] + 1, (lows[-1] - 1) * den // num + 1))
        self.lows = np.array(lows)
        self.differ = np.array([differ(high - 1) for high in lows[1:]])
        self.blocks = np.array([_parts(n, most) for n, most in zip(lows, self.differ, strict=False)])

    def of(self, sizes: np.ndarray) -> np.ndarray:
        """Class of each size; -1 where only equal sets are linked."""
        return np.searchsorted(self.lows, sizes, "right") - 1

    def count(self, level: np.ndarray) -> np.ndarray:
        """Column blocks of sets of each class."""
        return np.where(level >= 0, self.blocks[np.maximum(level, 0)], 0)

    def equal(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Blocks, at both levels, that linked sets of two classes have in common at least."""
        low = np.minimum(one, two)
        least = self.blocks[low] - self.differ[low]
        below = np.maximum(self.count(low - 1) - self.differ[low], 0)
        return np.where(one == two, least + below, least)


def shingle_sets(chunk: Chunk, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a chunk in order of (row, hash), and their rows."""
    data = LOWER[chunk.data]
    found = words(Chunk(chunk.first, data, chunk.offsets), NOT_SPACE)
    values = _HASHER.spans(data, found.starts, found.ends)
    whole = found.whole_runs(ngram)
    hashes = [_HASHER.runs(values, ngram)[whole]]
    rows = [found.rows[: len(whole)][whole]]
    counts = found.counts()
    short = np.flatnonzero((counts > 0) & (counts < ngram))
    for row in short.tolist():
        hashes.append(
            np.array([_HASHER.whole(values[found.first[row] : found.first[row + 1]])], _U)
        )
    rows.append(short)
    hashes, rows = np.concatenate(hashes), np.concatenate(rows)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[fresh], rows[fresh]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _block_hashes(
    hashes: np.ndarray, mixed: np.ndarray, rows: np.ndarray, level: np.ndarray, count: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of each column block of each set, the block's set, and its number of elements."""
    base = np.zeros(len(level) + 1, np.int64)
    np.cumsum(count, out=base[1:])
    # Sets without blocks are passed over; the rest is in order of row, hash and so block.
    used = count[rows] > 0
    part = ((hashes[used] >> _U(32)) * count[rows[used]].astype(_U)) >> _U(32)
    place = base[rows[used]] + part.astype(np.int64)
    bounds = np.searchsorted(place, np.arange(base[-1] + 1))
    sums = _sums(mixed[used], bounds)
    owner = np.repeat(np.arange(len(level)), count)
    number = np.arange(base[-1]) - base[owner]
    salt = level[owner].astype(_U) * _U(0x9E3779B97F4A7C15) + number.astype(_U)
    return mix(sums + mix(salt)), owner, np.diff(bounds)


def level_keys(
    hashes: np.ndarray, rows: np.ndarray, sizes: np.ndarray, num: int, den: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all column blocks of each set, for its own size class and the one below: key, owner
    (twice the row, one more below), number of elements; and by owner how many keys tell enough."""
    classes = SizeClasses(num, den, int(sizes.max(initial=0)))
    own = classes.of(sizes)
    mixed = mix(hashes + _U(1))
    found = []
    enough = np.zeros(2 * len(sizes), np.int64)
    for below, level in enumerate((own, own - 1)):
        key, owner, elements = _block_hashes(hashes, mixed, rows, level, classes.count(level))
        found.append((key, 2 * owner + below, elements))
        enough[below::2] = np.where(level >= 0, classes.differ[np.maximum(level, 0)] + 1, 0)
    keys, owners, elements = (np.concatenate(x) for x in zip(*found, strict=True))
    return keys, owners, elements, enough


def first_keys(
    keys: np.ndarray, owners: np.ndarray, elements: np.ndarray, enough: np.ndarray, spread: np.ndarray
) -> np.ndarray:
    """Places of the keys that come first of each owner's, as many as are enough.

    Sets that differ in at most ``differ`` of their blocks share a key among the first
    ``differ`` + 1 of each, in any order that depends on a block's content alone. ``spread`` is
    such a number, as everyone is told the same: rare keys come first. Of equally rare ones those
    of most elements do, as blocks of one or none say little and would tie strangers.
    """
    order = np.lexsort((keys, -elements, spread, owners))
    count = np.bincount(owners, minlength=len(enough))
    rank = np.arange(len(order)) - (np.cumsum(count) - count)[owners[order]]
    return order[rank < enough[owners[order]]]


def block_keys(
    hashes: np.ndarray, rows: np.ndarray, sizes: np.ndarray, num: int, den: int
) -> tuple[np.ndarray, np.ndarray]:
    """First keys of each set and its row, where all keys are equally rare."""
    keys, owners, elements, enough = level_keys(hashes, rows, sizes, num, den)
    told = first_keys(keys, owners, elements, enough, np.zeros(len(keys), np.uint16))
    return keys[told], owners[told] // 2


def sketches(
    hashes: np.ndarray, rows: np.ndarray, sizes: np.ndarray, num: int, den: int
) -> list[bytes]:
    """Two bytes of each column block's hash, for a set's own size class and then the one below."""
    classes = SizeClasses(num, den, int(sizes.max(initial=0)))
    own = classes.of(sizes)
    mixed = mix(hashes + _U(1))
    found = []
    for level in (own, own - 1):
        key, owner, _ = _block_hashes(hashes, mixed, rows, level, classes.count(level))
        short = (key & _U(0xFFFF)).astype("<u2")
        found.append(np.split(short, np.searchsorted(owner, np.arange(1, len(sizes)))))
    return [one.tobytes() + two.tobytes() for one, two in zip(*found, strict=True)]


def _sets(batch: pa.RecordBatch, ngram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for chunk in chunks(batch.column("text")):
        hashes, rows = shingle_sets(chunk, ngram)
        yield chunk.first, hashes, rows, np.bincount(rows, minlength=len(chunk))


def _all_keys(batch: pa.RecordBatch, ngram: int, num: int, den: int) -> tuple[np.ndarray, ...]:
    """As ``level_keys``, of all rows of a batch."""
    none = np.empty(0, np.int64)
    found = [(np.empty(0, _U), none, none, none)]
    for first, hashes, rows, sizes in _sets(batch, ngram):
        keys, owners, elements, enough = level_keys(hashes, rows, sizes, num, den)
        found.append((keys, owners + 2 * first, elements, enough))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _send(ngram: int, num: int, den: int, count: int, block_id: int, batch: pa.RecordBatch):
    yield B.send_keys(block_id, _all_keys(batch, ngram, num, den)[0], count)


def _rows(ngram: int, num: int, den: int, count: int, block_id: int, batch: pa.RecordBatch, answers: dict):
    """Per document: size, set fingerprint, its first keys that occur again, and its place in the block."""
    keys, owners, elements, enough = _all_keys(batch, ngram, num, den)
    spread = B.spread_of(keys, count, answers) if len(keys) else np.zeros(0, np.uint16)
    told = first_keys(keys, owners, elements, enough, spread)
    told = told[spread[told] > 0]
    keys, owners = keys[told], owners[told] // 2
    del elements, enough, spread, told
    order = np.argsort(owners, kind="stable")
    keys, bounds = keys[order], np.searchsorted(owners[order], np.arange(batch.num_rows + 1))
    n, one, two = [], [], []
    for _, hashes, _, sizes in _sets(batch, ngram):
        ends = np.concatenate([[0], np.cumsum(sizes)])
        n.append(sizes)
        one.append(_sums(mix(hashes + _U(11)), ends))
        two.append(_sums(mix(hashes ^ _U(0xA5A5A5A5A5A5A5A5)), ends))
    size, one, two = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (n, one, two))
    listed = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(keys.view(np.int64)))
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(B.ORDER),
            batch.column(B.HASH),
            pa.array(size.astype(np.int64)),
            pa.array(one.view(np.int64)),
            pa.array(two.view(np.int64)),
            listed,
            pa.array(np.full(batch.num_rows, block_id, np.int64)),
            pa.array(np.arange(batch.num_rows, dtype=np.int64)),
        ],
        names=["doc_id", "text_hash", "n", "one", "two", "keys", "block_id", "place"],
    )


_MEMBER = ("label", "node", "n", "own", "tiles")
_MEMBERS = "label long, node long, n long, own int, tiles int, packed binary"


def _packed_sets(hashes: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return [hashes[low:high].tobytes() for low, high in zip(ends[:-1], ends[1:], strict=True)]


def _member_sets(
    ngram: int, pack: Callable[..., list[bytes]], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Sets of the documents that are members of groups, read from their blocks once more."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = B.read_block(batch.column("block")[i].as_buffer().to_pybytes())
            members = batch.column("members")[i].values
            texts = block.column("text").take(members.field("place"))
            del block
            for first, hashes, rows, sizes in _sets(pa.record_batch([texts], ["text"]), ngram):
                some = members.slice(first, len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [*(some.field(name) for name in _MEMBER), binary_array(pack(hashes, rows, sizes))],
                    names=[*_MEMBER, "packed"],
                )
            del texts, members
            let_go()


def _reached(
    sets: list[np.ndarray], near: Callable[[int, np.ndarray, np.ndarray], np.ndarray]
) -> np.ndarray:
    """Component number of each set; ``near`` tells, for a row, others and their overlaps, which
    of them are linked.

    One row of the sparse product at a time, breadth first: a row that is
    reached is not compared again as a column, so copies cost little.
    """
    sizes = np.array([len(x) for x in sets])
    column = np.unique(np.concatenate(sets), return_inverse=True)[1]
    row = np.repeat(np.arange(len(sets)), sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    width = int(column.max(initial=-1)) + 1
    label = np.full(len(sets), -1)
    waiting = np.ones(len(sets), bool)
    by_column, starts, indexed = np.empty(0, np.int64), np.empty(0, np.int64), 0

    def index() -> None:
        """Rows not reached yet, by column."""
        nonlocal by_column, starts, indexed
        left = waiting[row]
        order = np.argsort(column[left], kind="stable")
        by_column = row[left][order]
        starts = np.searchsorted(column[left][order], np.arange(width + 1))
        indexed = remaining

    remaining = len(sets)
    index()
    for seed in range(len(sets)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        remaining -= 1
        label[seed] = seed
        queue = [seed]
        while queue:
            here = queue.pop()
            if 2 * remaining < indexed:
                index()
            own = column[ends[here] : ends[here + 1]]
            low, high = starts[own], starts[own + 1]
            length = high - low
            total = int(length.sum())
            place = np.arange(total) + np.repeat(low - np.cumsum(length) + length, length)
            touched = by_column[place]
            # Few touched rows are counted by sorting them, many in an array over all rows.
            if 16 * total < len(sets):
                others, overlap = np.unique(touched, return_counts=True)
            else:
                overlap = np.bincount(touched, minlength=len(sets))
                others = np.flatnonzero(overlap)
                overlap = overlap[others]
            reached = others[near(here, others, overlap) & waiting[others]]
            waiting[reached] = False
            remaining -= len(reached)
            label[reached] = seed
            queue.extend(reached.tolist())
    return label


def product_links(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Component number of each set, linked where num * union <= den * overlap."""
    sizes = np.array([len(x) for x in sets])
    return _reached(
        sets,
        lambda here, others, overlap: num * (sizes[others] + sizes[here] - overlap) <= den * overlap,
    )


def sketch_links(packed: list[bytes], sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Component number of each sketched set; linked sets are of one, others may be.

    Equal blocks have equal bytes, so what is counted is never less than the equal blocks.
    """
    classes = SizeClasses(num, den, int(sizes.max(initial=0)))
    own = classes.of(sizes)
    one, two = classes.count(own), classes.count(own - 1)
    sets = []
    for data, level, many, fewer in zip(packed, own.tolist(), one.tolist(), two.tolist(), strict=True):
        block = np.concatenate([np.arange(many), np.arange(fewer)])
        kind = np.repeat(np.array([level, level - 1]), [many, fewer])
        sets.append((kind << 48) | (block << 16) | np.frombuffer(data, "<u2").astype(np.int64))

    def near(here: int, others: np.ndarray, overlap: np.ndarray) -> np.ndarray:
        apart = np.abs(own[others] - own[here])
        small, large = np.minimum(sizes[others], sizes[here]), np.maximum(sizes[others], sizes[here])
        enough = overlap >= classes.equal(own[others], own[here])
        return (apart <= 1) & (num * large <= den * small) & enough

    return _reached(sets, near)


def _multiply(links: Callable[[list[bytes], np.ndarray], np.ndarray], table: pa.Table) -> pa.Table:
    """Links within each candidate group of a bin (or within a pair of tiles of one)."""
    table = table.sort_by([("label", "ascending"), ("node", "ascending")])
    label, node = table.column("label").to_numpy(), table.column("node").to_numpy()
    packed, sizes = table.column("packed").to_pylist(), table.column("n").to_numpy()
    begins = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
    out = node.copy()
    for low, high in zip(begins, np.append(begins[1:], len(label)), strict=True):
        out[low:high] = node[low:high][links(packed[low:high], sizes[low:high])]
    linked = out != node
    roots = np.isin(node, out[linked])
    some = linked | roots
    return pa.table({"node": pa.array(node[some]), "key": pa.array(out[some])})


def _whole_links(num: int, den: int, packed: list[bytes], sizes: np.ndarray) -> np.ndarray:
    return product_links([np.frombuffer(x, _U) for x in packed], num, den)


def _sketch_links(num: int, den: int, packed: list[bytes], sizes: np.ndarray) -> np.ndarray:
    return sketch_links(packed, sizes, num, den)


def _products(
    held: DataFrame,
    kept: DataFrame,
    groups: DataFrame,
    tile_size: int,
    making: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    links: Callable[[list[bytes], np.ndarray], np.ndarray],
) -> DataFrame:
    """(node, key) of nodes linked within groups (label, node), whose sets ``making`` packs.

    Small groups share a task; one of more than ``tile_size`` shingles is cut, each tile
    meeting each other.
    """
    bins = 4 * partitions(held.sparkSession)
    sums = (
        groups.join(kept.select("node", "n"), "node")
        .groupBy("label")
        .agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
        .where("rows > 1")
        .select("label", F.ceil(F.col("total") / F.lit(tile_size)).cast("int").alias("tiles"))
    )
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    # Where each node goes is settled on narrow rows; sets are moved once, after that.
    member = F.struct("place", "label", "node", "n", tile.alias("own"), "tiles")
    asked = (
        groups.join(sums, "label")
        .join(kept.select("node", "n", "block_id", "place"), "node")
        .groupBy("block_id")
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
    )
    sets = (
        held.select("block_id", "block")
        .join(asked, "block_id")
        .select("block", "members")
        .mapInArrow(making, _MEMBERS)
    )
    placed = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label",
        "node",
        "n",
        F.when(F.col("tiles") > 1, F.col("label"))
        .otherwise(F.pmod(F.xxhash64("label"), F.lit(bins)) - bins)
        .alias("bin"),
        F.least("own", "other").alias("a"),
        F.greatest("own", "other").alias("b"),
        "packed",
    )
    return placed.groupBy("bin", "a", "b").applyInArrow(
        lambda table: _multiply(links, table), "node long, key long"
    )


def _linked(docs: DataFrame, ngram: int, num: int, den: int) -> DataFrame:
    """Per document: doc_id, text_hash, n, and first, the (missing, doc_id, text_hash) that
    comes first of its component; null for a document without words."""
    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = B.store_blocks(only)
    size = held.agg(F.sum("bytes")).first()[0] or 0
    count = B.bucket_count(size // 12, held)
    sent = B.map_blocks(held, partial(_send, ngram, num, den, count), B.SENT_KEYS)
    rows = stored(
        B.answer_blocks(
            held,
            B.shared_keys(sent),
            partial(_rows, ngram, num, den, count),
            "doc_id long, text_hash long, n long, one long, two long, keys array<long>, "
            "block_id long, place long",
        ).withColumn("row", F.monotonically_increasing_id())
    )
    # What blocks sent is not needed any more. Sets are not kept: they weigh more than the
    # compressed texts, from which those of candidate groups are made again.
    del sent
    reclaim(docs.sparkSession)
    same = ("n", "one", "two")
    # Documents without words are not equal to each other.
    classes = stored(
        rows.where("n > 0").groupBy(*same).agg(
            F.min("row").alias("node"),
            F.min(F.struct(F.isnull("doc_id").alias("missing"), "doc_id", "text_hash")).alias("least"),
        )
    )
    kept = (
        rows.where(F.size("keys") > 0)
        .join(classes.select(F.col("node").alias("row")), "row", "left_semi")
        .select(F.col("row").alias("node"), "n", "keys", "block_id", "place")
    )
    groups = stored(components(kept.select("node", F.explode("keys").alias("key"))))
    reclaim(docs.sparkSession)
    wide = stored(
        groups.join(kept.select("node", "n"), "node")
        .groupBy("label")
        .agg(F.sum("n").alias("total"))
        .where(F.col("total") > TILE)
        .select("label")
    )
    making = partial(_member_sets, ngram, partial(sketches, num=num, den=den))
    nearer = components(
        _products(
            held, kept, groups.join(wide, "label", "left_semi"), SKETCH_TILE, making,
            partial(_sketch_links, num, den),
        )
    )
    groups = stored(
        groups.join(wide, "label", "left_anti").select("node", "label").unionByName(nearer)
    )
    reclaim(docs.sparkSession)
    making = partial(_member_sets, ngram, _packed_sets)
    links = _products(held, kept, groups, TILE, making, partial(_whole_links, num, den))
    found = components(links)
    labelled = classes.join(found, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    least = labelled.groupBy("label").agg(F.min("least").alias("first"))
    named = labelled.join(least, "label").select(*same, "first")
    return rows.join(named, list(same), "left").select("doc_id", "text_hash", "n", "first")


def linked_documents(docs: DataFrame, ngram: int = NGRAM, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id reachable by links."""
    return _linked(docs, ngram, num, den).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("first.doc_id", "doc_id").alias("component_id"),
    )


def first_of_each(
    docs: DataFrame, ngram: int = STAGE_NGRAM, num: int = STAGE_NUM, den: int = STAGE_DEN
) -> DataFrame:
    """One row of each component, with the smallest id, and all rows without words."""
    kinds = (
        _linked(docs, ngram, num, den)
        .where("first IS NOT NULL")
        .groupBy("doc_id", "text_hash")
        .agg(F.count("*").alias("times"), F.min("first").alias("first"))
        .withColumn(
            "gone",
            ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))),
        )
        .where("gone OR times > 1")
    )
    # Named as no column of a table is.
    key, digest, gone = "\u00b7id", B.HASH, "\u00b7gone"
    marked = stored(
        kinds.select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest), F.col("gone").alias(gone))
    )
    text_hash = F.xxhash64(docs["text"].cast("string"))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(key)) & (text_hash == F.col(digest))
    once = docs.join(marked, same, "left_anti").select(*docs.columns)
    # Of a row that repeats, one; the limit on the rank holds before the exchange as well.
    rank = F.row_number().over(
        Window.partitionBy(key, digest).orderBy(F.to_json(F.struct(*(docs[x] for x in docs.columns))))
    )
    repeated = docs.join(marked.where(~F.col(gone)), same).withColumn(B.ORDER, rank).where(F.col(B.ORDER) == 1)
    return once.unionByName(repeated.select(*(docs[x] for x in docs.columns)))
