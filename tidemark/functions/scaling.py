"""Scaling expressions and their inverses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def minmax_scale(x: Column, low: Column, high: Column) -> Column:
    """(x - min) / (max - min); 0.0 for a constant feature or missing statistics."""
    return F.when(high != low, (x - low) / (high - low)).otherwise(F.lit(0.0))


def minmax_restore(x: Column, low: Column, high: Column) -> Column:
    return x * (high - low) + low


def standard_scale(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std; NULL where the deviation is zero."""
    return F.try_divide(x - mean, std)


def standard_restore(x: Column, mean: Column, std: Column) -> Column:
    return x * std + mean
