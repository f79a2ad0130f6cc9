"""Plan shape."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Adding = Callable[[DataFrame, str, Column], DataFrame]


def projected(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is left out of the plan where nothing reads it."""
    return rows.withColumn(name, value)


def computed_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated exactly once per row.

    A filter on a plain column is pushed below it with the column's expression
    copied into every place that uses it, so a parsed document would be parsed
    again for each condition. A generated column is not copied.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def projected_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """As ``computed_once``, for values with lambdas.

    A generator with a lambda is interpreted as a whole; a projection compiles all but the lambda.
    """
    given = f"{name}_given"
    return computed_once(rows.select("*", value.alias(given)), name, F.col(given)).drop(given)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
