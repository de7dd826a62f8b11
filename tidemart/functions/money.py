"""Amounts. Sums run on whole cents, so the order of addition never matters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(amount: Column, digits: int = 2) -> Column:
    """Nearest value with ties going up, also below zero (-0.125 becomes -0.12)."""
    scale = float(10 ** digits)
    return F.floor(amount * scale + 0.5) / F.lit(scale)


def to_cents(amount: Column) -> Column:
    return F.floor(amount * 100.0 + 0.5)


def from_cents(cents: Column) -> Column:
    return cents / F.lit(100.0)


def line_cents(price: Column, count: Column) -> Column:
    """Amount of one order line."""
    return to_cents(price * count)


def share_cents(paid: Column, line: Column, listed: Column) -> Column:
    """A line's rounded part of what was paid; 0 where the order lists nothing."""
    ratio = paid.cast("double") * line / F.nullif(listed, F.lit(0))
    return F.coalesce(F.floor(ratio + 0.5), F.lit(0))
