from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stopwise.operators import expectations
from stopwise.plans import health, marts, serving, shaping
from stopwise.sources.tables import read_query, read_table, replace_table
from stopwise.streaming import progress

HEALTH = (
    "observation_bucket timestamp, route_id string, route_short_name string, direction_id int, "
    "observed_trip_count bigint, eligible_trip_count bigint, late_trip_count bigint"
)


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def buckets(spark):
    rows = [
        (at("2026-09-01 10:00:00"), "A", "1", 0, 2, 1, 1),
        (at("2026-09-01 10:05:00"), "A", "1", 1, 120, 99, 0),
        (at("2026-09-01 10:15:00"), "A", "1", 0, 3, 0, 0),
        (at("2026-09-01 10:15:00"), "B", None, 0, 4, 0, 0),
    ]
    return spark.createDataFrame(rows, HEALTH)


def test_rates_are_weighted(buckets):
    rows = {r.route_id: r for r in serving.route_comparison(buckets, "2026-09-01").collect()}
    assert rows["A"].predicted_late_percentage == 1.0
    assert rows["B"].predicted_late_percentage is None
    kept = serving.route_comparison(buckets, "2026-09-01", min_eligible=1).collect()
    assert [r.route_id for r in kept] == ["A"]
    with pytest.raises(ValueError, match="negative"):
        serving.route_comparison(buckets, "2026-09-01", min_eligible=-1)


def test_filters_are_optional_and_ranges_half_open(buckets):
    trend = serving.health_trend(buckets, "2026-09-01 10:00:00", until="2026-09-01 10:15:00")
    assert [r.observation_bucket.minute for r in trend.collect()] == [0, 5]
    assert serving.matching(buckets).count() == 4
    assert serving.matching(buckets, bucket="2026-09-01 10:15:00", route_id="B").count() == 1
    assert serving.latest_bucket(buckets, "A", 1).first()[0] == at("2026-09-01 10:05:00")
    assert serving.latest_bucket(buckets, "' OR '1'='1").first()[0] is None


def test_a_trend_of_one_route_and_direction(buckets):
    trend = serving.health_trend(buckets, "2026-09-01", "A", 0)
    assert [r.observed_trip_count for r in trend.collect()] == [2, 3]


def test_bound_parameters_are_never_text(spark, buckets):
    query = "SELECT count(*) AS n FROM {rows} WHERE route_id = :route"
    assert read_query(spark, query, {"route": "A' OR 1=1 --"}, rows=buckets).first().n == 0
    assert read_query(spark, query, {"route": "A"}, rows=buckets).first().n == 3


def test_gaps_are_filled_with_null(buckets):
    trend = serving.health_trend(buckets, "2026-09-01")
    rows = shaping.gap_filled(trend).orderBy("observation_bucket").collect()
    assert [r.eligible_trip_count for r in rows] == [1, 99, None, 0]
    assert rows[0].local_time == at("2026-09-01 06:00:00")
    assert shaping.gap_filled(trend.where("false")).count() == 0


def test_summary_of_nothing_is_null(buckets):
    empty = shaping.reliability_summary(buckets.where("false")).first()
    assert set(empty.asDict().values()) == {None}
    zero = shaping.reliability_summary(buckets.where("route_id = 'B'")).first()
    assert (zero.eligible, zero.late_percentage, zero.coverage_percentage) == (0, None, 0.0)


def test_changes_need_enough_samples(spark):
    def one(late, eligible):
        row = [(late, 50.0, None, eligible)]
        return spark.createDataFrame(
            row,
            "predicted_late_percentage double, metric_coverage_percentage double, "
            "p90_predicted_lateness_minutes double, eligible_trip_count bigint",
        )

    found = shaping.period_changes(one(12.3, 20), one(4.5, 20), 20).first()
    assert tuple(found) == (7.8, 0.0, None)
    assert set(shaping.period_changes(one(12.3, 20), one(4.5, 19), 20).first()) == {None}


@pytest.mark.parametrize("limit", [0, 2001])
def test_limits_are_checked(buckets, limit):
    for query in (serving.live_vehicles, serving.active_alerts):
        with pytest.raises(ValueError, match="limit"):
            query(buckets, limit=limit)
    with pytest.raises(ValueError, match="limit"):
        serving.trip_samples(buckets, "2026-01-01", limit=501 if limit else 0)
    with pytest.raises(ValueError, match="limit"):
        serving.routes_needing_attention(buckets, "2026-01-01", "2026-02-01", limit=51)
    with pytest.raises(ValueError, match="min_eligible"):
        serving.routes_needing_attention(buckets, "2026-01-01", "2026-02-01", min_eligible=0)
    with pytest.raises(ValueError, match="sort_by"):
        serving.trip_samples(buckets, "2026-01-01", sort_by="1; DROP TABLE x")


def test_date_spine_joins_calendar_and_local_event_days(spark):
    def day(value):
        return spark.sql(f"SELECT timestamp'{value} 12:00:00' AS event_timestamp")

    tables = {
        "calendar": spark.sql("SELECT date'2026-09-02' AS start_date, date'2026-09-02' AS end_date"),
        "vehicle_positions": day("2026-09-01"),
        "trip_stop_updates": day("2026-09-03"),
        "service_alert_entities": day("2026-09-02"),
    }
    days = marts.dim_dates(tables).orderBy("date_day").collect()
    assert [d.date_key for d in days] == [20260901, 20260902, 20260903]
    assert (days[0].day_name, days[0].iso_day_of_week, days[0].is_weekend) == ("Tuesday", 2, False)


def test_backlog(spark):
    marks = spark.createDataFrame(
        [("v", 0, 10, 130), ("v", 1, 10, 150), ("dead", 0, 4, 7)],
        "topic string, partition int, low bigint, high bigint",
    )
    reports = spark.createDataFrame(
        [("a", {"v": {"0": 100, "1": 120}})],
        "application_name string, source_offsets map<string, map<string, bigint>>",
    )
    rows = health.backlog(marks, health.processed_offsets(reports)).collect()
    assert {(r.topic, r.partition): r.backlog for r in rows} == {
        ("v", 0): 30,
        ("v", 1): 30,
        ("dead", 0): None,
    }
    assert health.retained_records(marks, "dead").first()[0] == 3
    assert health.retained_records(marks, "absent").first()[0] is None


def test_display_status_precedence(spark):
    now, recent, old = "2026-01-01 12:00:00", at("2026-01-01 11:59:30"), at("2026-01-01 11:55:00")
    cases = [
        (None, recent, "Unknown"),
        ("", recent, "Unknown"),
        ("running", None, "Unknown"),
        ("running", old, "Stale"),
        ("running", recent, "Running"),
        ("idle", recent, "Idle"),
        ("idle", old, "Stale"),
        ("FAILED", None, "Failed"),
        ("terminated", old, "Stopped"),
        ("running", at("2026-01-01 11:58:00"), "Running"),
    ]
    table = spark.createDataFrame([c[:2] for c in cases], "status string, seen timestamp")
    shown = health.display_status(F.col("status"), F.col("seen"), now)
    assert [r[0] for r in table.select(shown).collect()] == [c[2] for c in cases]


def test_progress_report(spark):
    report = (
        '{"id":"q","runId":"r","timestamp":"2026-09-01T10:00:00.000Z","batchId":12,'
        '"numInputRows":250,"durationMs":{"triggerExecution":1750},"sources":['
        '{"endOffset":"{\\"t\\":{\\"0\\":100,\\"1\\":120}}"},{"endOffset":"broken"},{}]}'
    )
    log = spark.createDataFrame(
        [("app", "progress", "q", "r", at("2026-09-01 10:00:01"), report, None)],
        "application_name string, kind string, query_id string, run_id string, "
        "recorded_at timestamp, progress string, error_message string",
    )
    row = progress.with_source_offsets(progress.progress_rows(log)).first()
    assert (row.batch_id, row.num_input_rows, row.batch_duration_ms) == (12, 250, 1750)
    assert row.input_rows_per_second == 0.0
    assert row.source_offsets == {"t": {"0": 100, "1": 120}}
    with pytest.raises(ValueError, match="positive"):
        progress.retained_progress(progress.progress_rows(log), 0)


def test_stale_run(spark):
    runs = spark.createDataFrame(
        [("a", "running", at("2026-01-01 11:00:00"), None, None, None)],
        "run_id string, status string, started_at timestamp, finished_at timestamp, "
        "duration_seconds double, error_message string",
    )
    late = health.latest_run(runs, "2026-01-01 11:20:01").first()
    assert (late.status, late.error_message) == ("stale", "Run did not reach a terminal state")
    assert health.latest_run(runs, "2026-01-01 11:20:00").first().status == "running"


def test_expectations(spark, buckets):
    assert expectations.not_null(buckets, "route_short_name").count() == 1
    assert expectations.unique(buckets, "route_short_name").first().row_count == 3
    assert expectations.accepted_values(buckets, "route_id", ["A"]).first().value == "B"
    parents = spark.createDataFrame([("A",)], "route_id string")
    found = expectations.relationships(buckets, "route_id", parents, "route_id").collect()
    assert [(r.value, r.row_count) for r in found] == [("B", 1)]
    broken = expectations.rows_not_preserved({"m": (buckets, buckets.limit(3))}).collect()
    assert [(r.expected_rows, r.actual_rows) for r in broken] == [(4, 3)]


def test_built_tables_equal_the_plans(spark, tmp_path):
    from checks.projections import Staged

    tables = Staged(spark, "/root/testdata/sf0.001")
    marts.build(tables, str(tmp_path))
    samples = read_table(spark, f"{tmp_path}/fct_trip_monitoring_samples")
    stored = read_table(spark, f"{tmp_path}/route_health_5m")
    assert expectations.differing_health(stored, marts.route_health(samples)).count() == 0
    assert expectations.inconsistent_samples(samples).count() == 0
    assert expectations.out_of_bounds_health(stored).count() == 0
    # The time bounds of served queries reach the partitions, and drop no row.
    low, high = "2024-01-10 03:00:00", "2024-01-12 21:00:00"
    served = {
        "health_trend": lambda rows: serving.health_trend(rows, low, until=high),
        "period_summary": lambda rows: serving.matching(rows, since=low, until=high),
    }
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")  # else the plan's text is cut
    for name, query in served.items():
        plan = query(stored)._jdf.queryExecution().executedPlan().toString()
        filters = next(x for x in plan.split("\n") if "PartitionFilters" in x)
        assert "(observation_local_date" in filters and ">= 2024-01-09" in filters, name
        assert "<= 2024-01-12" in filters, name
    plain = stored.withColumnRenamed("observation_local_date", "other_date")
    bounded = serving.matching(stored, since=low, until=high).count()
    assert bounded == serving.matching(plain, since=low, until=high).count() > 0
    recent = serving.matching(samples, since=low, time_column="event_timestamp").count()
    renamed = samples.withColumnRenamed("observation_local_date", "other_date")
    assert recent == serving.matching(renamed, since=low, time_column="event_timestamp").count()
    smaller = stored.limit(2)
    replace_table(stored, str(tmp_path / "copy"))
    replace_table(smaller, str(tmp_path / "copy"))
    assert read_table(spark, str(tmp_path / "copy")).count() == 2


def test_sampling_limits_rows_before_its_shuffle(spark):
    from checks.projections import Staged
    from stopwise.operators import sampling

    updates = Staged(spark, "/root/testdata/sf0.001")["trip_stop_updates"]
    plan = sampling.next_stops(sampling.upcoming_stops(updates))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")
