"""Readable sizes and durations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit labels, each 1024 times the one before.
UNITS = ("B", "KB", "MB", "GB", "TB")


def _largest_unit(size: Column, shown: Callable[[Column], Column]) -> Column:
    size = size.cast("double")
    out = None
    for power in range(len(UNITS) - 1, 0, -1):
        step = float(1024**power)
        text = F.format_string(f"%.3f {UNITS[power]}", shown(size / step))
        out = F.when(size >= step, text) if out is None else out.when(size >= step, text)
    return out.when(size.isNotNull(), F.format_string(f"%.3f {UNITS[0]}", shown(size)))


def format_bytes(size: Column) -> Column:
    """``size`` in the largest unit that leaves it >= 1, three decimals, ties up."""
    return _largest_unit(size, lambda v: v)


def format_mean_bytes(size: Column) -> Column:
    """As :func:`format_bytes` for a mean, which rounds ties to the even digit."""
    return _largest_unit(size, lambda v: F.rint(v * 1000) / 1000)


def format_millis(millis: Column) -> Column:
    """``HH:MM:SS.mmm``; hours grow beyond two digits when needed."""
    return F.format_string(
        "%02d:%02d:%02d.%03d",
        F.floor(millis / 3600000),
        F.floor(millis % 3600000 / 60000),
        F.floor(millis % 60000 / 1000),
        millis % 1000,
    )
