"""Queries over the driver's tables, and the SQL that checks them."""

from checks import batch, health, rules, serving, streams  # noqa: F401
from checks.registry import CHECKS

__all__ = ["CHECKS"]
