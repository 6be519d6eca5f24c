"""Arithmetic helpers used by the feature builder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divisor(games: Column) -> Column:
    """Games when positive, else 1.0, so a rate never divides by zero."""
    return F.when(games > 0, games).otherwise(F.lit(1.0))


def per_game(value: Column, games: Column) -> Column:
    return value / safe_divisor(games)


def square(value: Column) -> Column:
    """Null-preserving square."""
    return value * value
