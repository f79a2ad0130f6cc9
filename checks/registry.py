"""The list of checks: a Spark query, and mostly the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle
from checks.projections import Staged
from stopwise.settings import Settings

Query = Callable[[Staged], DataFrame]

# Hourly buckets, so that several events compete inside one; freshness wide
# enough for the end of the driver's events to count as live.
SETTINGS = Settings(bucket_minutes=oracle.BUCKET_MINUTES)
LIVE = Settings(
    bucket_minutes=oracle.BUCKET_MINUTES,
    vehicle_freshness_seconds=6 * 3600,
    alert_freshness_seconds=86_400,
)


@dataclass(frozen=True)
class Check:
    query: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


CHECKS: dict[str, Check] = {}


def _plain(rows: DataFrame, dates: Iterable[str], lists: Iterable[str]) -> DataFrame:
    """Dates and lists as text, so that both engines return the same types."""
    changed = {name: F.col(name).cast("string") for name in dates}
    changed |= {
        name: F.array_join(F.transform(name, lambda item: item.cast("string")), ",")
        for name in lists
    }
    return rows.withColumns(changed) if changed else rows


def _plain_sql(text: str, dates: Iterable[str], lists: Iterable[str]) -> str:
    changed = [f"cast({name} as varchar) AS {name}" for name in dates]
    changed += [
        f"array_to_string(list_transform({name}, lambda x: cast(x as varchar)), ',') AS {name}"
        for name in lists
    ]
    return f"SELECT * REPLACE ({', '.join(changed)}) FROM ({text}) q" if changed else text


def check(
    name: str,
    covers: str,
    sql: str | None = None,
    *,
    dates: Iterable[str] = (),
    lists: Iterable[str] = (),
) -> Callable[[Query], Query]:
    """Register a query; ``covers`` names the operators it exercises."""

    def register(query: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"check {name} exists")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain(query(Staged(spark, sf_dir)), dates, lists)

        text = None if sql is None else oracle.sql(_plain_sql(sql.strip(), dates, lists))
        CHECKS[name] = Check(run, text, tuple(covers.split()))
        return query

    return register
