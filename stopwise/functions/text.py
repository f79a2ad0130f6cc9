"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_text(value: Column) -> Column:
    """True when present and not only blanks (never null)."""
    return F.coalesce(F.length(F.trim(value)) > 0, F.lit(False))


def empty_to_null(value: Column) -> Column:
    """An absent feed text and an empty one mean the same thing."""
    return F.nullif(value, F.lit(""))


def first_text(*values: Column) -> Column:
    """First non-empty text."""
    return F.coalesce(*[empty_to_null(value) for value in values])


def translated(value: Column) -> Column:
    """English translation if there is one, else the first, else null."""
    translations = value["translation"]
    english = F.filter(translations, lambda item: item["language"] == F.lit("en"))
    return (
        F.when(F.size(english) > 0, F.get(english, F.lit(0))["text"])
        .otherwise(F.get(translations, F.lit(0))["text"])
    )


def route_label(route_id: Column, short_name: Column, long_name: Column) -> Column:
    """``short · long``; the id stands in for a missing short name."""
    return F.concat_ws(" · ", first_text(short_name, route_id), empty_to_null(long_name))


def occupancy_label(status: Column) -> Column:
    """``MANY_SEATS_AVAILABLE`` becomes ``Many seats available``."""
    words = F.lower(F.regexp_replace(status, "_", " "))
    sentence = F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))
    return F.when(empty_to_null(status).isNull(), F.lit("Unknown")).otherwise(sentence)


def scope_label(route_ids: Column) -> Column:
    """Comma-separated routes of an alert."""
    return F.when(
        F.coalesce(F.size(route_ids) > 0, F.lit(False)), F.array_join(route_ids, ", ")
    ).otherwise(F.lit("Route not specified"))


def age_label(seconds: Column) -> Column:
    """``n seconds``, or ``Unknown`` for a missing age."""
    known = F.coalesce(seconds, F.lit(-1))
    return F.when(known < 0, F.lit("Unknown")).otherwise(
        F.concat(known.cast("string"), F.lit(" seconds"))
    )


def contains_ignoring_case(value: Column, needle: str) -> Column:
    """Literal substring search."""
    return F.contains(F.lower(value.cast("string")), F.lower(F.lit(needle.strip())))
