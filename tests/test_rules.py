"""Operational rules: alert life, bunching, stalled vehicles, against plain loops."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stopwise.operators import bunching, slices, stalled
from stopwise.streaming import alerts, windows

START = datetime(2026, 3, 7, 11, 30)


def at(seconds):
    return START + timedelta(seconds=seconds)


# Slices


def test_a_slice_knows_what_came_before(spark):
    rows = spark.createDataFrame([(at(k),) for k in range(0, 7200, 60)], "t timestamp")
    found = slices.sliced(rows, "t", 3600, 600).collect()
    own = [r for r in found if not r[slices.HALO]]
    assert len(own) == 120 and len({r.t for r in own}) == 120
    for r in found:
        if r[slices.HALO]:
            begins = r[slices.SLICE] * 3600
            assert 0 < begins - r.t.replace(tzinfo=timezone.utc).timestamp() <= 600
    with pytest.raises(ValueError):
        slices.sliced(rows, "t", 60, 61)


# Bunching


def plain_bunches(visits, threshold, needed, width):
    by_stop = defaultdict(set)
    for route, direction, stop, vehicle, when in visits:
        if None not in (stop, vehicle, when):
            by_stop[route, direction, stop].add((when, vehicle))
    pairs = defaultdict(list)
    for (route, direction, stop), found in by_stop.items():
        line = sorted(found)
        for (t0, leader), (t1, vehicle) in zip(line, line[1:], strict=False):
            gap = (t1 - t0).total_seconds()
            if leader != vehicle and gap <= width:
                pairs[route, direction, leader, vehicle].append((t1, stop, gap))
    out = []
    for pair, found in pairs.items():
        run = []
        for item in [*sorted(found), None]:
            if item is not None and item[2] < threshold:
                run.append(item)
                continue
            if len(run) >= needed:
                out.append((*pair, run[0][0], run[-1][0], len(run), min(x[2] for x in run)))
            run = []
    return sorted(out, key=repr)


VISITS = "route_id string, direction_id int, stop_id string, vehicle_id string, observed_at timestamp"


def bunches(spark, visits, *settings):
    found = bunching.bunched(spark.createDataFrame(visits, VISITS), *settings).collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_bunches_equal_a_loop(spark):
    rng = random.Random(3)
    visits = [
        (rng.choice(["1", "2", None]), rng.choice([0, 1, None]), f"s{rng.randrange(4)}", f"v{rng.randrange(4)}", at(rng.randrange(20_000)))
        for _ in range(900)
    ]
    visits += [("1", 0, None, "v1", at(5)), ("1", 0, "s1", None, at(5)), ("1", 0, "s1", "v1", None), visits[0], visits[0]]
    got = bunches(spark, visits, 120, 2, 3600)
    assert got == plain_bunches(visits, 120, 2, 3600) and got


def test_a_third_of_all_visits_at_one_stop(spark):
    rng = random.Random(4)
    visits = [("1", 0, "hub", f"v{rng.randrange(3)}", at(rng.randrange(90_000))) for _ in range(1500)]
    visits += [("1", 0, f"s{rng.randrange(9)}", f"v{rng.randrange(3)}", at(rng.randrange(90_000))) for _ in range(3000)]
    assert bunches(spark, visits, 60, 2, 900) == plain_bunches(visits, 60, 2, 900)


def test_limits_of_a_headway(spark):
    def pair(gap):
        return [("1", 0, s, v, at(t)) for s, base in (("a", 0), ("b", 500)) for v, t in (("x", base), ("y", base + gap))]

    assert len(bunches(spark, pair(119))) == 1
    assert bunches(spark, pair(120)) == []
    # A long headway between two short ones: no two in a row.
    three = pair(60)[:2] + [("1", 0, "c", "x", at(200)), ("1", 0, "c", "y", at(400))] + pair(60)[2:]
    assert bunches(spark, three) == []
    assert bunches(spark, []) == []


# Stalled vehicles


def plain_stalled(rows, metres, window, seen):
    tracks = defaultdict(list)
    for vehicle, trip, when, lat, lon in rows:
        if None not in (vehicle, trip, when, lat, lon):
            tracks[vehicle].append((when, lat, lon))
    out = []
    for vehicle, track in tracks.items():
        found = []
        for when, _, _ in track:
            inside = [x for x in track if 0 <= (when - x[0]).total_seconds() <= window]
            lats, lons = [x[1] for x in inside], [x[2] for x in inside]
            north = (max(lats) - min(lats)) * stalled.LATITUDE_METRES
            across = (max(lons) - min(lons)) * stalled.LONGITUDE_METRES * math.cos(math.radians((min(lats) + max(lats)) / 2))
            moved = math.hypot(north, across)
            back = max((when - x[0]).total_seconds() for x in inside)
            found.append((when, moved, moved <= metres and back >= seen * window))
        run = []
        for item in [*sorted(found), None]:
            if item is not None and item[2]:
                run.append(item)
                continue
            if run:
                out.append((vehicle, run[0][0], run[-1][0], len(run), round(max(x[1] for x in run), 6)))
            run = []
    return sorted(out)


POSITIONS = "vehicle_id string, trip_id string, event_timestamp timestamp, latitude double, longitude double"


def stalls(spark, rows, **settings):
    found = stalled.stalled(spark.createDataFrame(rows, POSITIONS), **settings).collect()
    return sorted((r.vehicle_id, r.first_at, r.last_at, r.observations, round(r.most_metres, 6)) for r in found)


def test_stalls_equal_a_loop(spark):
    rng = random.Random(5)
    rows = []
    for vehicle in ("a", "b", "c"):
        lat, lon, when = 42.3, -71.1, 0
        for _ in range(500):
            when += rng.choice([20, 30, 45])
            if rng.random() < (0.03 if when % 4000 < 2500 else 0.9):
                lat += rng.uniform(-1, 1) * 1e-3
                lon += rng.uniform(-1, 1) * 1e-3
            rows.append((vehicle, "t", at(when), lat, lon))
    rows += [(None, "t", at(1), 42.0, -71.0), ("a", None, at(2), 10.0, 10.0), ("a", "t", at(3), None, 1.0), ("a", "t", None, 1.0, 1.0)]
    want = plain_stalled(rows, 50.0, 600, 0.9)
    assert want and stalls(spark, rows) == want
    # Cut into short slices, the same.
    assert stalls(spark, rows, width=600) == want


def test_a_stall_needs_observations_of_the_whole_window(spark):
    def parked(upto):
        return [("a", "t", at(k), 42.3, -71.1) for k in range(0, upto, 30)]

    assert stalls(spark, parked(500)) == []
    assert [x[3] for x in stalls(spark, parked(700))] == [6]
    off = [(v, None, *rest) for v, _, *rest in parked(700)]
    assert stalls(spark, off) == []
    assert len(stalls(spark, off, on_trip=False)) == 1
    assert stalls(spark, []) == []


# Alert life

DETECTIONS = "alert_fingerprint string, detected_at timestamp, observed_value double"


def plain_life(rows, cooldown):
    tracks = defaultdict(list)
    for key, when, value in rows:
        if key is not None and when is not None:
            tracks[key].append((when, value))
    out = set()
    for key, found in tracks.items():
        run = []
        for item in [*sorted(found, key=lambda x: x[0]), None]:
            if run and (item is None or (item[0] - run[-1][0]).total_seconds() > cooldown):
                values = [x[1] for x in run if x[1] is not None]
                out.add((key, "active", run[0][0], run[0][0], None, None))
                out.add((key, "resolved", run[0][0], run[-1][0], len(run), max(values, default=None)))
                run = []
            if item is not None:
                run.append(item)
    return out


def streamed(spark, folder, batches, cooldown):
    """Each batch is a run of its own on one checkpoint."""
    query = None
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, DETECTIONS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(DETECTIONS).parquet(f"{folder}/in")
        query = (
            alerts.lifecycle(stream, cooldown)
            .writeStream.option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .format("parquet")
            .start(f"{folder}/out")
        )
        query.awaitTermination()
    return {tuple(r) for r in spark.read.parquet(f"{folder}/out").collect() if r.alert_fingerprint != "end"}


def test_life_of_alerts_over_runs(spark, tmp_path):
    """Detections out of order within the watermark, over four runs with a restart between each."""
    rng = random.Random(6)
    rows = [(f"f{rng.randrange(6)}", at(rng.randrange(30_000)), rng.choice([None, rng.random()])) for _ in range(300)]
    rows.sort(key=lambda r: r[1])
    rows = [x for k in range(0, 300, 4) for x in rng.sample(rows[k : k + 4], len(rows[k : k + 4]))]
    rows = [(None, at(1), 0.5), ("f1", None, 0.5), *rows]
    cuts = [rows[:120], rows[120:200], rows[200:], [("end", at(200_000), 0.0)]]
    span = max((b[1] - a[1]).total_seconds() for a, b in zip(rows[2:], rows[3:], strict=False))
    assert span < 10_000
    # No detection is further behind than the watermark allows.
    newest, behind = rows[2][1], 0
    for r in rows[2:]:
        newest = max(newest, r[1])
        behind = max(behind, (newest - r[1]).total_seconds())
    assert plain_life(rows, 600) and behind < 3600
    got = streamed_with(spark, tmp_path, cuts, 600)
    assert got == plain_life(rows, 600)
    table = spark.createDataFrame(rows, DETECTIONS)
    assert {tuple(r) for r in alerts.alerts_of(table, 600).collect()} == plain_life(rows, 600)


def streamed_with(spark, folder, batches, cooldown):
    before = alerts.lifecycle.__defaults__
    alerts.lifecycle.__defaults__ = (before[0], "3600 seconds")
    try:
        return streamed(spark, str(folder), batches, cooldown)
    finally:
        alerts.lifecycle.__defaults__ = before


def test_life_of_alerts_in_a_session_made_elsewhere(spark, tmp_path):
    """A session whose state store is Spark's default, which keeps no lists and timers."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, before.replace("RocksDBStateStoreProvider", "HDFSBackedStateStoreProvider"))
    try:
        rows = [("f1", at(1), 0.5), ("f1", at(90), None)]
        assert streamed(spark, str(tmp_path), [rows, [("end", at(200_000), 0.0)]], 600) == plain_life(rows, 600)
    finally:
        spark.conf.set(key, before)


def test_a_gap_of_the_cooldown_is_no_end(spark):
    rows = [("f", at(0), 1.0), ("f", at(600), 3.0), ("f", at(1201), 2.0), ("g", at(0), None)]
    table = spark.createDataFrame(rows, DETECTIONS)
    assert {tuple(r) for r in alerts.alerts_of(table).collect()} == plain_life(rows, 600)


def test_fingerprints_tell_missing_parts_apart(spark):
    rows = [("a", None), ("a", ""), (None, "a"), ("", "a"), ("a", "-"), ("a", None)]
    table = spark.createDataFrame(rows, "x string, y string")
    found = [r.f for r in table.select(alerts.fingerprint("x", "y").alias("f")).collect()]
    assert len(set(found)) == 5 and found[0] == found[5]
    assert table.where(F.lit(False)).count() == 0


# Windows and limits


def plain_p95(values):
    line = sorted(values)
    return line[math.ceil(len(line) * 0.95) - 1] if line else None


def some_records(seed, count, begin=0):
    rng = random.Random(seed)
    out = []
    for k in range(count):
        when = at(begin + rng.randint(0, 1799))
        late = rng.choice([None, -5, rng.randint(0, 200), rng.randint(0, 200_000)])
        out.append((
            when, None if late is None else when + timedelta(milliseconds=late),
            rng.choice([True, True, True, False, None]), rng.choice([False, None, True]),
            rng.choice(["r", None]),
        ))
    return out


RECORD = "event_at timestamp, arrived_at timestamp, is_valid boolean, is_dead_letter boolean, route_id string"


def test_a_latency_class_overstates_by_less_than_a_64th(spark):
    values = [0, 1, 127, 128, 129, 255, 256, 60_000, 86_400_000, 1 << 40]
    values += [random.Random(3).randint(0, 1 << 34) for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in [*values, -4, None]], "v long")
    for r in frame.select("v", windows.latency_class(F.col("v")).alias("c")).collect():
        if r.v is None:
            assert r.c is None
        elif r.v < 128:
            assert r.c == max(r.v, 0)
        else:
            assert r.v <= r.c < r.v * (1 + 1 / 64)


def test_windows_against_a_plain_loop(spark):
    rows = some_records(4, 700) + [(None, at(0), True, False, "r")]
    frame = spark.createDataFrame(rows, RECORD).repartition(5)
    found = {(r.window_seconds, r.window_start): r for r in windows.all_windows(windows.minutes(frame)).collect()}
    want = defaultdict(list)
    for row in rows[:-1]:
        for size in (60, 300, 900):
            second = int(row[0].replace(tzinfo=timezone.utc).timestamp())
            want[size, datetime.fromtimestamp(second - second % size, timezone.utc).replace(tzinfo=None)].append(row)
    assert set(found) == set(want)
    for key, group in want.items():
        got, n = found[key], len(group)
        assert got.records == n
        assert got.invalid_ratio == sum(not r[2] for r in group) / n
        assert got.dead_letters_ratio == sum(bool(r[3]) for r in group) / n
        assert got.missing_route_ratio == sum(r[4] is None for r in group) / n
        exact = plain_p95([max(round((r[1] - r[0]).total_seconds() * 1000), 0) for r in group if r[1]])
        if exact is None:
            assert got.p95_latency_ms is None
        else:
            assert exact <= got.p95_latency_ms <= exact * (1 + 1 / 64)
        bad = got.invalid_ratio > 0.01 or got.dead_letters_ratio > 0.005
        odd = got.missing_route_ratio > 0.02 or (got.p95_latency_ms or 0) > 60_000
        assert got.status == ("critical" if bad else "warning" if odd else "ok")


def test_counts_of_parts_merge_to_the_count_of_all(spark):
    one = spark.createDataFrame(some_records(5, 300), RECORD)
    two = spark.createDataFrame(some_records(6, 300, begin=900), RECORD)
    apart = windows.minutes(one).unionByName(windows.minutes(two))
    together = windows.minutes(one.unionByName(two))
    key = lambda r: tuple(r.asDict().items())
    for seconds in (300, 900):
        got = windows.figures(windows.rolled(apart, seconds)).collect()
        assert sorted(map(repr, map(key, got))) == sorted(
            repr(key(r)) for r in windows.figures(windows.rolled(together, seconds)).collect()
        )
    assert windows.all_windows(windows.minutes(one.where("false"))).count() == 0
    with pytest.raises(ValueError):
        windows.rolled(apart, 90)


def test_a_streams_minutes_and_its_late_rows(spark, tmp_path):
    rows = [r for r in some_records(7, 200)]
    end = (at(7200), None, True, False, "r")
    after = (at(14_400), None, True, False, "r")
    late = (at(10), at(10), True, False, "late")
    dropped = 0
    for part in ([*rows], [end], [late, after]):
        spark.createDataFrame(part, RECORD).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        query = (
            windows.minutes(spark.readStream.schema(RECORD).parquet(f"{tmp_path}/in"))
            .writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(availableNow=True).format("parquet").start(f"{tmp_path}/out")
        )
        query.awaitTermination()
        dropped += sum(
            s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
        )
    found = spark.read.parquet(f"{tmp_path}/out")
    known = spark.createDataFrame([*rows, end], RECORD)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, windows.minutes(known).collect()))
    assert dropped == 1


def test_states_of_lag(spark):
    frame = spark.createDataFrame([(0,), (9_999,), (10_000,), (100_000,), (None,)], "lag long")
    found = [r[0] for r in frame.select(windows.lag_status(F.col("lag"))).collect()]
    assert found == ["ok", "ok", "warning", "critical", None]
