"""Trie of conversation prefixes with subtree totals by depth-band rollup.

A node is a distinct sequence of first turns. It is named by its depth and a pair of polynomial
hashes of the sequence, which are sums over turns: the parent's name is the node's without
the last term, and names of a conversation's turns are running sums, so no conversation is ever
held as a whole.

* Turns are sorted over all partitions. Each partition sums its own rows; what a conversation
  brings along from earlier partitions is a row per partition (the only thing the driver reads).
* Nodes are counted from turns with partial aggregation, so a first turn that a third of
  all conversations share is one row per task.
* Depths are cut into bands of fixed height. A node explodes to its ancestors in its band only,
  found on the path of its smallest member, a band of which is one short array. The roots of
  bands form a trie of fewer levels, which is rolled up in the same way; then each band root adds its
  completed total to its ancestors in the band above. So the explosion is below the height,
  and rounds are the logarithm of the depth to that base.
* Ids of conversations that end at a node are packed into lists by ranges of ids and hashed as
  a stream, in order, a list at a time.

Defined cases: turns without conversation are ignored; a null role or text is empty; a null
turn comes first; turns that tie are taken in the order of hashes of role and text, and rows
that repeat are turns of their own. A table without conversations has no node, not even a
root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm.shared import held_packed, partitions
from stopwise.llm.textkit import Powers, binary_array

HEIGHT = 8
_U = np.uint64
_POWERS = (Powers(101), Powers(102))


def _powers(which: int, places: np.ndarray) -> np.ndarray:
    """The multiplier to the given powers, which may be large, few or negative."""
    if not len(places):
        return np.empty(0, _U)
    out = np.ones(len(places), _U)
    for back in (False, True):
        some = (places < 0) == back
        left = np.abs(places[some])
        base = (_POWERS[which].down if back else _POWERS[which].up)(2)[1:]
        value = np.ones(len(left), _U)
        while left.any():
            odd = (left & 1).astype(bool)
            value[odd] *= base
            left >>= 1
            base = base * base
        out[some] = value
    return out


# --- running sums over sorted turns --------------------------------------------------------

_SUMS = (
    "conv_id long, place long, one long, two long, last_one long, last_two long, chars long"
)


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().view(_U)


def _local(batch: pa.RecordBatch, carry: tuple) -> tuple[tuple, np.ndarray, np.ndarray, list]:
    """Conversation, place, both running sums and both terms of each row; ``carry`` is the last row's
    (conversation, place, sums)."""
    conv = batch.column("conv_id").to_numpy()
    n = len(conv)
    begin = np.ones(n, bool)
    begin[1:] = conv[1:] != conv[:-1]
    starts = np.flatnonzero(begin)
    run = np.cumsum(begin) - 1
    goes_on = carry[0] is not None and conv[0] == carry[0]
    place = np.arange(n) - starts[run]
    if goes_on:
        place[run == 0] += carry[1] + 1
    sums, terms = [], []
    for which, name in enumerate(("h1", "h2")):
        term = _unsigned(batch, name) * _powers(which, place)
        total = np.cumsum(term, dtype=_U)
        before = (total - term)[starts]
        own = total - before[run]
        if goes_on:
            own[run == 0] += _U(carry[2 + which])
        sums.append(own)
        terms.append(term)
    return (int(conv[-1]), int(place[-1]), int(sums[0][-1]), int(sums[1][-1])), conv, place, [*sums, *terms]


_EDGES = "part int, conv_id long, count long, one long, two long, first boolean"


def _edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition: rows and sums of its first conversation, and of its last one."""
    carry: tuple = (None, -1, 0, 0)
    part, first = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py()
        old = carry
        carry, conv, place, (one, two, *_) = _local(batch, carry)
        if first is None or first[0] == conv[0]:
            here = int(np.flatnonzero(conv == conv[0])[-1])
            if first is None or old[0] == first[0]:
                first = (int(conv[0]), int(place[here]), int(one[here]), int(two[here]))
    if first is None:
        return
    kept = [first] if first[0] == carry[0] else [first, carry]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(kept), pa.int32()),
            pa.array([x[0] for x in kept], pa.int64()),
            pa.array([x[1] + 1 for x in kept], pa.int64()),
            *(pa.array(np.array([x[k] for x in kept], _U).view(np.int64)) for k in (2, 3)),
            pa.array([x is first for x in kept]),
        ],
        names=[x.split()[0] for x in _EDGES.split(", ")],
    )


def _carried(edges: list) -> dict[int, tuple]:
    """What the first conversation of each partition brings along: the carry of its last row."""
    out: dict[int, tuple] = {}
    at: tuple = (None, -1, 0, 0)
    with np.errstate(over="ignore"):
        for row in sorted(edges, key=lambda r: (r["part"], not r["first"])):
            one, two = (np.array([row[x]], np.int64).view(_U) for x in ("one", "two"))
            if at[0] == row["conv_id"]:
                out[row["part"]] = at
                moved = np.array([at[1] + 1])
                at = (
                    at[0],
                    at[1] + row["count"],
                    int((_U(at[2]) + one * _powers(0, moved))[0]),
                    int((_U(at[3]) + two * _powers(1, moved))[0]),
                )
            else:
                at = (row["conv_id"], row["count"] - 1, int(one[0]), int(two[0]))
    return out


def _summed(shared, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    carry: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if carry is None:
            carry = shared.value.get(batch.column("part")[0].as_py(), (None, -1, 0, 0))
        carry, conv, place, values = _local(batch, carry)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(conv),
                pa.array(place),
                *(pa.array(x.view(np.int64)) for x in values),
                batch.column("chars"),
            ],
            names=[x.split()[0] for x in _SUMS.split(", ")],
        )


def prefix_sums(turns: DataFrame) -> DataFrame:
    """Each turn's place in its conversation (from 0), the names of the prefix that it ends (one, two),
    its own terms in them (last_one, last_two), and its code points."""
    spark = turns.sparkSession
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(2), text, role).alias("h2"),
        F.length(text).cast("long").alias("chars"),
    )
    order = ("conv_id", "turn", "h1", "h2")
    placed = rows.repartitionByRange(2 * partitions(spark), *order).sortWithinPartitions(*order)
    held = held_packed(
        placed.select("conv_id", "h1", "h2", "chars").withColumn("part", F.spark_partition_id())
    )
    # At most two rows per partition.
    carried = _carried(held.mapInArrow(_edges, _EDGES).collect())
    shared = spark.sparkContext.broadcast(carried)
    return held_packed(held.mapInArrow(partial(_summed, shared), _SUMS))


# --- conversations that begin with turns of others -----------------------------------------


def _moved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns after a head: names with the head's turns in place of the own first ones."""
    for batch in batches:
        skip, take = batch.column("skip").to_numpy(), batch.column("take").to_numpy()
        place = batch.column("place").to_numpy()
        out = []
        for which, name in enumerate(("one", "two")):
            by = _powers(which, take - skip)
            whole = _unsigned(batch, f"head_{name}") + by * (
                _unsigned(batch, name) - _unsigned(batch, f"cut_{name}")
            )
            out.append((whole, whole - by * _unsigned(batch, f"last_{name}")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                pa.array(place - skip + take + 1),
                *(pa.array(x[k].view(np.int64)) for k in (0, 1) for x in out),
                batch.column("chars"),
            ],
            names=[x.split()[0] for x in _PATHS.split(", ")],
        )


_PATHS = "conv_id long, depth long, one long, two long, up_one long, up_two long, chars long"


def _parents(sums: DataFrame) -> DataFrame:
    return sums.withColumns({"skip": F.lit(0).cast("long"), "take": F.lit(0).cast("long")}).withColumns(
        {f"{x}_{y}": F.lit(0).cast("long") for x in ("head", "cut") for y in ("one", "two")}
    )


def paths(sums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of conversations as they are: a row per turn, and per conversation (conv_id, length, one, two)."""
    ends = sums.groupBy("conv_id").agg(
        (F.max("place") + 1).alias("length"), F.max_by(F.struct("one", "two"), "place").alias("end")
    )
    return (
        _parents(sums).mapInArrow(_moved, _PATHS),
        ends.select("conv_id", "length", "end.one", "end.two"),
    )


def rebuilt_paths(sums: DataFrame, head: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """As ``paths``, of conversations rebuilt: the first ``head`` turns of conversation ``base`` (all, if
    fewer), then the own turns after the first ``head``. Both are columns over conv_id; ``head``
    is at most ``most``."""
    nothing = F.lit(0).cast("long")
    own = sums.withColumn("skip", head.cast("long"))
    cut = F.col("place") == F.col("skip") - 1
    convs = own.groupBy("conv_id").agg(
        F.max("skip").alias("skip"),
        (F.max("place") + 1).alias("count"),
        F.max_by(F.struct("one", "two"), "place").alias("end"),
        F.max(F.when(cut, F.struct("one", "two"))).alias("cut"),
    )
    # At most ``most`` rows per conversation.
    firsts = sums.where(F.col("place") < most).select(F.col("conv_id").alias("base"), *sums.columns[1:])
    wanted = convs.where("skip > 0").select("conv_id", "skip", base.cast("long").alias("base"))
    heads = held_packed(
        wanted.join(firsts, "base").where(F.col("place") < F.col("skip")).drop("base")
    )
    taken = heads.groupBy("conv_id").agg(
        (F.max("place") + 1).alias("take"), F.max_by(F.struct("one", "two"), "place").alias("head")
    )
    known = held_packed(
        convs.join(taken, "conv_id", "left").select(
            "conv_id",
            "skip",
            "count",
            F.coalesce("take", nothing).alias("take"),
            *(F.coalesce(f"head.{x}", nothing).alias(f"head_{x}") for x in ("one", "two")),
            *(F.coalesce(f"cut.{x}", nothing).alias(f"cut_{x}") for x in ("one", "two")),
            "end.one",
            "end.two",
        )
    )
    tails = own.drop("skip").join(known.drop("count", "one", "two"), "conv_id").where("place >= skip")
    columns = [x.split()[0] for x in _PATHS.split(", ")]
    rows = tails.mapInArrow(_moved, _PATHS).unionByName(
        _parents(heads.drop("skip")).mapInArrow(_moved, _PATHS)
    )
    # The last turn's name: of the whole conversation, or of the head where nothing follows.
    short = known.where("count <= skip").select("conv_id", F.col("take").alias("length"), "head_one", "head_two")
    zero = [nothing.alias(x) for x in ("last_one", "last_two", "chars")]
    long = known.where("count > skip").withColumn("place", F.col("count") - 1).select("*", *zero)
    ends = (
        long.mapInArrow(_moved, _PATHS)
        .select("conv_id", F.col("depth").alias("length"), "one", "two")
        .union(short)
    )
    return rows.select(*columns), ends


# --- nodes ---------------------------------------------------------------------------------


def _rollup(nodes: DataFrame, rows: DataFrame, deepest: int, values: tuple[str, ...], height: int) -> DataFrame:
    """(depth, one, two) of every node with the values summed over its subtree. ``nodes`` has also
    conv_id, a member; ``rows`` has (conv_id, depth, one, two) of all members."""
    key = ("depth", "one", "two")
    band = F.floor(F.col("depth") / height)
    # A band of a path is at most ``height`` nodes.
    bands = rows.groupBy("conv_id", band.alias("band")).agg(
        F.array_sort(F.collect_list(F.struct(*key))).alias("path")
    )

    def to_ancestors(some: DataFrame, which: Column) -> DataFrame:
        """Values of nodes at their ancestors in a band, themselves included if they are in it."""
        met = some.withColumn("band", which).withColumnRenamed("depth", "own_depth")
        met = met.select("conv_id", "band", "own_depth", *values).join(bands, ["conv_id", "band"])
        up = met.select("own_depth", F.explode("path").alias("up"), *values)
        return up.where(F.col("up.depth") <= F.col("own_depth")).select(
            *(F.col(f"up.{x}").alias(x) for x in key), *values
        )

    inside = (
        to_ancestors(nodes.select("conv_id", "depth", *values), band)
        .groupBy(*key)
        .agg(*(F.sum(x).alias(x) for x in values))
    )
    if deepest < height:
        return inside
    inside = held_packed(inside)
    # Band roots are a trie of their own, a band being one level.
    root = F.col("depth") % height == 0
    shrunk = (F.col("depth") / height).cast("long").alias("depth")
    roots = inside.where(root).join(nodes.select("conv_id", *key), list(key))
    totals = held_packed(
        _rollup(
            roots.select("conv_id", shrunk, "one", "two", *values),
            rows.where(root).select("conv_id", shrunk, "one", "two"),
            deepest // height,
            values,
            height,
        )
    )
    completed = totals.where("depth > 0").select(
        (F.col("depth") * height).alias("depth"), "one", "two", *values
    )
    passed = to_ancestors(
        completed.join(nodes.select("conv_id", *key), list(key)).select("conv_id", "depth", *values), band - 1
    )
    return (
        inside.unionByName(passed).groupBy(*key).agg(*(F.sum(x).alias(x) for x in values))
    )


def _lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conv_id: per node and batch its ids as text, comma-joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        depth, one, two, conv = (batch.column(x).to_numpy() for x in ("depth", "one", "two", "conv_id"))
        order = np.lexsort((conv, two, one, depth))
        change = np.ones(len(order), bool)
        a, b = order[1:], order[:-1]
        change[1:] = (depth[a] != depth[b]) | (one[a] != one[b]) | (two[a] != two[b])
        starts = np.flatnonzero(change)
        ids = conv[order].tolist()
        ends = np.append(starts[1:], len(ids)).tolist()
        some = order[starts]
        packed = [",".join(map(str, ids[x:y])).encode() for x, y in zip(starts.tolist(), ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[some]) for x in (depth, one, two, conv)] + [binary_array(packed)],
            names=["depth", "one", "two", "first", "ids"],
        )


_DIGESTS = "depth long, one long, two long, ends_sha256 string"


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists sorted by node and first id: a digest per node, fed list by list."""
    key, digest = None, None
    names = [x.split()[0] for x in _DIGESTS.split(", ")]

    def done() -> tuple:
        return (*key, digest.hexdigest())

    for batch in batches:
        out = []
        columns = [batch.column(x).to_pylist() for x in ("depth", "one", "two")]
        for row, here in enumerate(zip(*columns, strict=True)):
            if here != key:
                if key is not None:
                    out.append(done())
                key, digest = here, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(batch.column("ids")[row].as_buffer())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in done()], names=names)


def _ended(ends: DataFrame, spark: SparkSession) -> DataFrame:
    """Digest of the ascending ids that end at a node."""
    count = partitions(spark)
    last = ends.select(F.col("length").alias("depth"), "one", "two", "conv_id")
    by_id = last.repartitionByRange(count, "conv_id").sortWithinPartitions("conv_id")
    lists = by_id.mapInArrow(_lists, "depth long, one long, two long, first long, ids binary")
    key = ("depth", "one", "two")
    sorted_ = lists.repartition(count, *key).sortWithinPartitions(*key, "first")
    return sorted_.mapInArrow(_digests, _DIGESTS)


def trie(rows: DataFrame, ends: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (all turns of its subtree that sharing saves, in code points), ends_sha256."""
    spark = rows.sparkSession
    key = ("depth", "one", "two")
    nothing = F.lit(0).cast("long")
    rows = held_packed(rows)
    ends = held_packed(ends)
    # The root has every conversation; it is one row, made of partial counts.
    root = ends.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    nodes = rows.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("chars").alias("chars"),
        F.min("up_one").alias("up_one"),
        F.min("up_two").alias("up_two"),
    )
    nodes = held_packed(
        nodes.unionByName(
            root.select(
                *(nothing.alias(x) for x in key),
                "conv_id",
                "n_convs",
                nothing.alias("chars"),
                *(F.lit(None).cast("long").alias(x) for x in ("up_one", "up_two")),
            )
        )
    )
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_one").alias("one"), F.col("up_two").alias("two")
    ).agg(F.count("*").alias("n_children"))
    valued = held_packed(
        nodes.join(children, list(key), "left").select(
            *key,
            "conv_id",
            F.coalesce("n_children", nothing).alias("n_children"),
            F.isnull("n_children").cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        )
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    members = rows.select("conv_id", *key)
    tops = ends.select("conv_id", *(nothing.alias(x) for x in key))
    totals = _rollup(
        valued.select("conv_id", *key, "n_leaves", "saved_tokens"),
        # Only paths of smallest members are asked for.
        members.unionByName(tops).join(valued.select("conv_id").distinct(), "conv_id", "left_semi"),
        deepest,
        ("n_leaves", "saved_tokens"),
        height,
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("one").alias("up_one"),
        F.col("two").alias("up_two"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    # Child rows of a parent that many share are split by the runtime's skew join.
    named = nodes.join(parents, ["depth", "up_one", "up_two"], "left")
    return (
        named.join(valued.select(*key, "n_children"), list(key))
        .join(totals, list(key))
        .join(_ended(ends, spark), list(key), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
