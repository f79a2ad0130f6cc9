from datetime import datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from stopwise.functions import numbers, periods, text, times
from stopwise.plans import shaping

ZONE = "America/New_York"


def values(spark, rows, schema, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]


def stamp(value):
    return datetime.fromisoformat(value)


def test_repeated_hour_means_the_later_instant_and_a_skipped_one_moves_on(spark):
    cases = {
        "2026-11-01 01:30:00": "2026-11-01 06:30:00",
        "2026-11-01 00:59:59": "2026-11-01 04:59:59",
        "2026-11-01 02:00:00": "2026-11-01 07:00:00",
        "2026-03-08 02:30:00": "2026-03-08 07:30:00",
        "2026-03-08 01:59:59": "2026-03-08 06:59:59",
        "2026-07-01 12:00:00": "2026-07-01 16:00:00",
    }
    found = values(
        spark,
        [(stamp(local),) for local in cases],
        "at timestamp",
        times.to_instant(F.col("at"), ZONE),
    )
    assert [row[0] for row in found] == [stamp(instant) for instant in cases.values()]


def _nearest(prediction, seconds):
    """Brute force: of the days around, the scheduled local time closest to the prediction."""
    zone = ZoneInfo(ZONE)
    local = prediction.replace(tzinfo=ZoneInfo("UTC")).astimezone(zone).replace(tzinfo=None)
    midnight = local.replace(hour=0, minute=0, second=0, microsecond=0)
    from datetime import timedelta

    options = [midnight + timedelta(days=d, seconds=seconds % 86400) for d in (-1, 0, 1)]
    best = min(options, key=lambda option: abs((local - option).total_seconds()))
    aware = best.replace(tzinfo=zone, fold=1)
    return aware.astimezone(ZoneInfo("UTC")).replace(tzinfo=None)


def test_nearest_service_instant_matches_brute_force(spark):
    rows = []
    for day in ("2026-01-15", "2026-03-08", "2026-07-04", "2026-11-01", "2026-12-31"):
        for hour in range(0, 24, 3):
            for seconds in (0, 3_600, 5_400, 43_200, 82_800, 86_400, 90_600, 97_200):
                rows.append((stamp(f"{day} {hour:02d}:07:31"), seconds))
    found = values(
        spark,
        rows,
        "at timestamp, seconds int",
        "at",
        "seconds",
        times.nearest_service_instant(F.col("at"), F.col("seconds"), ZONE),
    )
    gap = [stamp("2026-03-08 07:00:00"), stamp("2026-03-08 07:59:59")]
    for at, seconds, instant in found:
        expected = _nearest(at, seconds)
        if not gap[0] <= instant <= gap[1]:
            assert instant == expected, (at, seconds)


def test_half_a_day_apart_means_the_earlier_instant(spark):
    # 16:00 local, scheduled at 04:00; 10:18:30 local, scheduled at 22:18:30.
    rows = [(stamp("2024-01-30 21:00:00"), 14_400), (stamp("2024-01-15 15:18:30"), 80_310)]
    rows += [(at.replace(second=at.second + 1), seconds) for at, seconds in rows]
    found = values(
        spark,
        rows,
        "at timestamp, seconds int",
        times.nearest_service_instant(F.col("at"), F.col("seconds"), ZONE),
    )
    assert [x for (x,) in found] == [
        stamp("2024-01-30 09:00:00"),
        stamp("2024-01-15 03:18:30"),
        stamp("2024-01-31 09:00:00"),
        stamp("2024-01-16 03:18:30"),
    ]


def test_buckets_start_at_their_origin(spark):
    at = [(stamp("2026-01-01 00:07:30"),), (stamp("1999-12-31 23:59:59.5"),)]
    found = values(
        spark,
        at,
        "at timestamp",
        times.bucket_start(F.col("at"), 5),
        times.bucket_start(F.col("at"), 7),
    )
    assert found[0][0] == stamp("2026-01-01 00:05:00")
    assert (found[0][1] - stamp("2000-01-01 00:00:00")).total_seconds() % 420 == 0
    assert found[1] == (stamp("1999-12-31 23:55:00"), stamp("1999-12-31 23:53:00"))


def test_service_seconds_and_ages(spark):
    rows = [("25:10:05",), (None,)]
    assert values(spark, rows, "t string", times.service_seconds(F.col("t"))) == [(90605,), (None,)]
    now = F.lit("2026-01-01 00:00:10").cast("timestamp")
    at = [(stamp("2026-01-01 00:00:08.5"),), (stamp("2026-01-01 00:01:00"),), (None,)]
    found = values(
        spark,
        at,
        "at timestamp",
        times.age_seconds(F.col("at"), now),
        times.within_seconds(F.col("at"), now, 1.5),
    )
    assert found == [(2, True), (0, True), (None, None)]


def test_rates_round_half_up(spark):
    rows = [(1, 3), (1, 16), (2, 3), (0, 5), (3, 0), (1, 800)]
    found = values(
        spark,
        rows,
        "n int, d int",
        numbers.percentage(F.col("n"), F.col("d"), 1),
        numbers.percentage(F.col("n"), F.col("d"), 2),
    )
    assert found == [
        (33.3, 33.33),
        (6.3, 6.25),
        (66.7, 66.67),
        (0.0, 0.0),
        (None, None),
        (0.1, 0.13),
    ]


def test_minutes(spark):
    rows = [(8397, 2), (0, 0)]
    mean = numbers.minutes_of_mean(F.col("s"), F.col("n"))
    assert values(spark, rows, "s int, n int", mean) == [(69.98,), (None,)]
    decile = [(60.3,), (59.7,), (0.0,), (None,)]
    found = values(
        spark,
        decile,
        "s double",
        numbers.minutes_of_decile(F.col("s"), 2),
        numbers.minutes_of_decile(F.col("s"), 1),
    )
    assert found == [(1.01, 1.0), (1.0, 1.0), (0.0, 0.0), (None, None)]


def test_display_rounding_is_that_of_the_exact_value(spark):
    rows = [(100 * part / whole,) for whole in range(1, 161) for part in range(whole + 1)]
    found = values(spark, rows, "x double", "x", numbers.nearest_tenth(F.col("x")))
    assert all(rounded == round(x, 1) for x, rounded in found)


def test_active_periods(spark):
    now = stamp("2026-01-01 12:00:00")
    before, after = stamp("2026-01-01 11:00:00"), stamp("2026-01-01 13:00:00")
    cases = [
        (None, True),
        ([], True),
        ([(None, None)], True),
        ([(before, None)], True),
        ([(None, before)], False),
        ([(after, None)], False),
        ([(before, now)], True),
        ([(now, after)], True),
        ([(None, before), (before, after)], True),
    ]
    found = values(
        spark,
        [(case,) for case, _ in cases],
        "p array<struct<start: timestamp, end: timestamp>>",
        periods.active_at(F.col("p"), F.lit(now)),
    )
    assert [row[0] for row in found] == [active for _, active in cases]


def test_texts(spark):
    rows = [("39", "39", "Forest Hills"), ("1", None, ""), ("2", "", None), ("3", "3", None)]
    label = text.route_label(F.col("id"), F.col("short"), F.col("long"))
    found = values(spark, rows, "id string, short string, long string", label)
    assert [row[0] for row in found] == ["39 · Forest Hills", "1", "2", "3"]
    statuses = [("MANY_SEATS_AVAILABLE",), ("FULL",), ("",), (None,)]
    found = values(spark, statuses, "s string", text.occupancy_label(F.col("s")))
    assert [row[0] for row in found] == ["Many seats available", "Full", "Unknown", "Unknown"]
    scopes = [(["1", "2"],), ([],), (None,)]
    found = values(spark, scopes, "r array<string>", text.scope_label(F.col("r")))
    assert [row[0] for row in found] == ["1, 2", "Route not specified", "Route not specified"]


@pytest.mark.parametrize(("search", "wanted"), [("Y1", ["y1863"]), ("%", []), ("  ", ["y1863", "7"])])
def test_search_is_literal(spark, search, wanted):
    vehicles = spark.createDataFrame([("y1863",), ("7",)], "vehicle_id string")
    assert [row[0] for row in shaping.found_vehicles(vehicles, search).collect()] == wanted
