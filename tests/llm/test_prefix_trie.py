"""The trie of prefixes against nested dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from stopwise.llm import prefix_trie as P
from stopwise.llm.queries import QUERIES, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, depth long, one long, n_convs string"
NAMES = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)


def conversations(rows):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            out[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [x[1] for x in sorted(v, key=lambda x: x[0])] for c, v in out.items()}


def rebuild(found):
    out = {}
    for c, own in found.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = found.get(c - c % 100, [])[:h] + own[h:]
    return out


def plain(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, own in members.items():
        ends = sorted(c for c in own if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r[x] for x in NAMES) for r in frame.select(*NAMES).collect()), key=repr)


def sample(seed, convs, longest=9, stock=3):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(longest)):
            text = "x" * rng.randrange(stock) + rng.choice(["", "é🙂"])
            rows.append((rng.choice([c, c + 95]), t, rng.choice(["user", "assistant"]), text, 1, 2, "n"))
    unique = {(r[0], r[1]): r for r in rows}
    rows = list(unique.values())
    rng.shuffle(rows)
    return rows


def test_plain_conversations(spark):
    rows = sample(1, 150)
    got = P.trie(*P.paths(P.prefix_sums(spark.createDataFrame(rows, SCHEMA))))
    assert found(got) == plain(conversations(rows))


def test_bands_lower_than_the_trie(spark):
    rows = sample(2, 40, longest=30, stock=1)
    sums = P.prefix_sums(spark.createDataFrame(rows, SCHEMA))
    for height in (2, 3):
        assert found(P.trie(*P.paths(sums), height=height)) == plain(conversations(rows))


def test_rebuilt_conversations(spark):
    rows = sample(3, 330)
    got = P.trie(*rebuilt(P.prefix_sums(spark.createDataFrame(rows, SCHEMA))))
    assert found(got) == plain(rebuild(conversations(rows)))


def test_one_long_conversation_over_many_partitions(spark):
    """A third of all rows are of one conversation, whose copies end inside it."""
    rows = sample(4, 60)
    rows += [(200, t, "user", "ab", None, None, None) for t in range(400)]
    rows += [(c, t, "user", "ab", None, None, None) for c in (201, 202, 2000) for t in range(c % 97)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    sums = P.prefix_sums(frame)
    assert found(P.trie(*P.paths(sums))) == plain(conversations(rows))
    assert found(P.trie(*rebuilt(sums))) == plain(rebuild(conversations(rows)))


def test_hot_prefix_and_copies(spark):
    rows = [(c, t, "user", f"turn {t}", None, None, None) for c in range(300) for t in range(3)]
    rows += [(c, 3, "assistant", f"own {c % 7}", None, None, None) for c in range(0, 300, 2)]
    got = P.trie(*P.paths(P.prefix_sums(spark.createDataFrame(rows, SCHEMA))))
    assert found(got) == plain(conversations(rows))


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "lost", None, None, None),
        (7, 1, None, None, None, None, None),
        (7, None, "user", "first", None, None, None),
        (8, None, "user", "first", 5, 6, "x"),
        (8, 1, "", "", None, None, None),
        (8, 2, "user", "u" * 200_000, None, None, None),
        (9, 5, "same", "same", None, None, None),
        (9, 5, "same", "same", None, None, None),
        (10, 0, "us", "er", None, None, None),
        (11, 0, "use", "r", None, None, None),
    ]
    got = P.trie(*P.paths(P.prefix_sums(spark.createDataFrame(rows, SCHEMA))))
    assert found(got) == plain(conversations(rows))


def test_ties_have_an_order(spark):
    rows = [(1, 0, "a", x, None, None, None) for x in "pqrs"]
    one = found(P.trie(*P.paths(P.prefix_sums(spark.createDataFrame(rows, SCHEMA)))))
    two = found(P.trie(*P.paths(P.prefix_sums(spark.createDataFrame(rows[::-1], SCHEMA)))))
    assert one == two and len(one) == 5


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(P.trie(*P.paths(P.prefix_sums(empty)))) == []
    assert found(P.trie(*rebuilt(P.prefix_sums(empty)))) == []


def test_turnless_rebuilt_conversation(spark):
    """Its own turns all go, and the conversation it begins with is absent."""
    c = next(c for c in range(150, 199) if zlib.crc32(str(c).encode()) % 6 == 3)
    rows = [(c, 0, "user", "gone", None, None, None)]
    got = found(P.trie(*rebuilt(P.prefix_sums(spark.createDataFrame(rows, SCHEMA)))))
    assert got == plain({c: []})


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", F.col("role"), "text"
    )
    expected = plain(rebuild(conversations([tuple(r) for r in rows.collect()])))
    assert found(QUERIES["op13_prefix_trie"](spark, folder)) == expected
