"""Hard negatives against a plain double loop."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopwise.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, anchor boolean, score long, number long, strip int"


def plain(rows, limits=H.Limits(), scale=256):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), sorted."""
    used = []
    for vec_id, label, vector, anchor, *_ in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        codes = [math.floor(scale * float(np.float32(x))) for x in vector]
        used.append((vec_id, label, codes, bool(anchor)))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))  # noqa: B905 - the shorter one decides

    out = []
    for i, (vec_id, label, codes, anchor) in enumerate(used):
        if not anchor:
            continue
        others = [(-score(codes, c), v, other == label) for j, (v, other, c, _) in enumerate(used) if j != i]
        others.sort(key=lambda x: x[:2])
        for low, positive_id, same in [x for x in others if x[2]][: limits.positives]:
            p = -low
            fit = [
                x for x in others
                if not x[2] and limits.low * p <= -limits.den * x[0] <= limits.high * p
            ]
            for rank, (n, negative_id, _) in enumerate(fit[: limits.negatives], 1):
                out.append((vec_id, positive_id, rank, negative_id, p, -n))
    return sorted(out)


def found(spark, rows, **settings_):
    table = H.mine(spark.createDataFrame(rows, SCHEMA), **settings_)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(row[x] for x in names) for row in table.collect())


def sample(seed, count, dims=19, labels=3):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for k in range(count):
        label = rng.randrange(labels)
        vector = [0.4 * c + rng.gauss(0, 0.3) for c in centre[label]]
        rows.append((k, label, vector, k % 10 == 0, 1, 2, 3))
    return rows


@settings(max_examples=40, deadline=None)
@given(
    st.lists(st.lists(st.integers(-5000, 5000), min_size=11, max_size=11), min_size=1, max_size=9),
    st.lists(st.lists(st.integers(-300, 300), min_size=11, max_size=11), min_size=1, max_size=9),
)
def test_lookups_equal_products(candidates, anchors):
    a, c = np.array(anchors), np.array(candidates)
    planes = H.bit_planes(c)
    assert (H.codes_from(planes)[:, :11] == c).all()
    padded = np.pad(a, ((0, 0), (0, 5)))
    assert (H.scores(H.subset_sums(padded), planes) == c @ a.T).all()


def test_large_codes_stay_exact():
    c = np.array([[2**29, -(2**29), 1], [-(2**30), 2**30 - 1, -1]])
    got = H.scores(H.subset_sums(H.codes_from(H.bit_planes(c[:1] >> 8))), H.bit_planes(c))
    assert (got[:, 0] == c @ (c[0] >> 8)).all()
    with pytest.raises(ValueError):
        H.bit_planes(np.array([[2**31]]))


def test_against_double_loop(spark, monkeypatch):
    rows = sample(1, 400)
    monkeypatch.setattr(H, "BLOCK_ROWS", 64)
    assert found(spark, rows) == plain(rows)


def test_hot_label_and_copies(spark):
    """A third of all rows are copies of one vector; ids decide among them."""
    rows = sample(2, 240)
    rows += [(1000 + k, 1, rows[10][2], k == 3, 0, 0, 0) for k in range(120)]
    assert found(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    rows = sample(3, 60)
    nan, inf = float("nan"), float("inf")
    good = rows[5][2]
    rows += [
        (None, 1, good, True, None, None, None),
        (500, None, good, True, None, None, None),
        (501, 1, None, True, None, None, None),
        (502, 1, [None, *good[1:]], True, None, None, None),
        (503, 1, [nan, *good[1:]], True, None, None, None),
        (504, 1, [*good[:-1], -inf], True, None, None, None),
        (505, 1, [], True, None, None, None),
        (506, 2, good[:7], True, None, None, None),
        (507, 0, good * 3, None, None, None, None),
    ]
    rows.append((*rows[20][:3], True, None, None, None))  # a row that repeats, its id an anchor's
    assert found(spark, rows) == plain(rows)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, 1, [0.5], True, 0, 0, 0)]) == []
    two = [(0, 1, [0.5], True, 0, 0, 0), (1, 1, [0.5], False, 0, 0, 0)]
    assert found(spark, two) == []
    three = [*two, (2, 2, [0.3], False, 0, 0, 0)]
    assert found(spark, three) == plain(three) != []


def test_negative_scores_have_no_range(spark):
    rows = [(0, 1, [1.0], True, 0, 0, 0), (1, 1, [-1.0], False, 0, 0, 0), (2, 2, [-0.5], False, 0, 0, 0)]
    assert found(spark, rows) == plain(rows) == []


def test_limits(spark):
    rows = sample(4, 200)
    limits = H.Limits(positives=2, negatives=3, low=10, high=70)
    assert found(spark, rows, limits=limits, scale=64) == plain(rows, limits, 64)


def test_registered_query(spark):
    from stopwise.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [
        (r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"], r["vec_id"] % 100 == 0)
        for r in table.where(F.col("label").isNotNull()).collect()
    ]
    got = QUERIES["op11_hard_negatives"](spark, folder).collect()
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r[x] for x in names) for r in got) == plain(rows)
