"""Data tests: each returns the rows that fail it, so an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions.times import elapsed_seconds
from stopwise.operators.flatten import periods_of
from stopwise.operators.integrity import orphans


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def unique(rows: DataFrame, *columns: str) -> DataFrame:
    """Keys held by more than one row; null keys are not compared."""
    filled = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])
    return duplicate_keys(rows.where(filled), *columns)


def duplicate_keys(rows: DataFrame, *columns: str) -> DataFrame:
    """Keys held by more than one row, null counted as a value."""
    counted = rows.groupBy(*columns).agg(F.count("*").alias("row_count"))
    return counted.where("row_count > 1")


def relationships(
    children: DataFrame, column: str, parents: DataFrame, parent_column: str
) -> DataFrame:
    """Values without a parent; null needs none."""
    return orphans(children.where(F.col(column).isNotNull()), column, parents, parent_column)


def accepted_values(rows: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their row counts; null is accepted."""
    wrong = rows.where(~F.col(column).isin(*values))
    return wrong.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))


def duplicate_grains(models: Mapping[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Duplicated keys of several models, each with its declared grain."""
    result = None
    for name, (rows, grain) in models.items():
        key = F.concat_ws(
            ":", *[F.coalesce(F.col(column).cast("string"), F.lit("none")) for column in grain]
        )
        found = duplicate_keys(rows, *grain).select(
            F.lit(name).alias("model_name"), key.alias("grain_key"), "row_count"
        )
        result = found if result is None else result.unionByName(found)
    return result


def row_count_changes(models: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Expected and actual row counts of (input, output) pairs."""
    result = None
    for name, (before, after) in models.items():
        expected = before.agg(F.count("*").alias("expected_rows"))
        actual = after.agg(F.count("*").alias("actual_rows"))
        pair = _side_by_side(expected, actual).select(
            F.lit(name).alias("model_name"), "expected_rows", "actual_rows"
        )
        result = pair if result is None else result.unionByName(pair)
    return result


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row results as one row."""
    key = F.lit(1).alias("_one")
    return left.select(key, "*").join(right.select(key, "*"), "_one").drop("_one")


def rows_not_preserved(models: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    return row_count_changes(models).where("expected_rows <> actual_rows")


def period_row_counts(alerts: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows the period expansion must have, and has."""
    length = F.greatest(F.coalesce(F.size(periods_of()), F.lit(1)), F.lit(1))
    expected = alerts.agg(F.coalesce(F.sum(length), F.lit(0)).alias("expected_rows"))
    actual = periods.agg(F.count("*").alias("actual_rows"))
    return _side_by_side(expected, actual)


def wrong_period_count(alerts: DataFrame, periods: DataFrame) -> DataFrame:
    return period_row_counts(alerts, periods).where("expected_rows <> actual_rows")


def inconsistent_samples(samples: DataFrame) -> DataFrame:
    """Samples that contradict how delays are defined."""
    delay, lateness = F.col("predicted_delay_seconds"), F.col("predicted_lateness_seconds")
    recomputed = elapsed_seconds(
        F.col("delay_prediction_timestamp"), F.col("scheduled_prediction_timestamp")
    ).cast("int")
    upcoming = F.col("next_prediction_timestamp") >= F.col("event_timestamp")
    measured = (
        F.col("delay_prediction_timestamp").isNotNull()
        & delay.eqNullSafe(recomputed)
        & delay.isNotNull()
        & F.coalesce(lateness >= 0, F.lit(False))
    )
    unmeasured = delay.isNull() & lateness.isNull() & F.col("is_predicted_late").isNull()
    consistent = F.when(F.col("delay_basis").isNull(), unmeasured).otherwise(measured)
    return samples.where(~(F.coalesce(upcoming, F.lit(False)) & consistent))


def out_of_bounds_health(health: DataFrame) -> DataFrame:
    """Route health whose counts or rates cannot be."""
    late = F.col("predicted_late_percentage")
    impossible = (
        (F.col("eligible_trip_count") > F.col("observed_trip_count"))
        | (F.col("late_trip_count") > F.col("eligible_trip_count"))
        | ~late.between(0, 100)
        | ((F.col("eligible_trip_count") == 0) != late.isNull())
        | (F.col("p90_predicted_lateness_minutes") < 0)
    )
    return health.where(F.coalesce(impossible, F.lit(False)))


def out_of_scope_health(health: DataFrame, route_type: int) -> DataFrame:
    return health.where(F.col("route_type") != route_type)


HEALTH_KEY = ["observation_bucket", "route_id", "direction_id"]
HEALTH_MEASURES = [
    "eligible_trip_count",
    "late_trip_count",
    "metric_coverage_percentage",
    "predicted_late_percentage",
    "average_predicted_lateness_minutes",
    "p90_predicted_lateness_minutes",
]


def differing_health(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Full comparison of two route-health results on their key."""
    left = actual.select(*HEALTH_KEY, *[F.col(m).alias(f"actual_{m}") for m in HEALTH_MEASURES])
    right = expected.select(
        *HEALTH_KEY, *[F.col(m).alias(f"expected_{m}") for m in HEALTH_MEASURES]
    )
    same = [F.col(f"actual_{m}").eqNullSafe(F.col(f"expected_{m}")) for m in HEALTH_MEASURES]
    return left.join(right, HEALTH_KEY, "full").where(~reduce(lambda a, b: a & b, same))


def outdated_alerts(snapshot: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alerts of a snapshot that is not the newest stored one."""
    newest = alerts.agg(F.max("feed_timestamp").alias("_newest"))
    current = F.col("feed_timestamp").eqNullSafe(F.col("_newest"))
    return snapshot.join(F.broadcast(newest), ~current, "inner").drop("_newest")
