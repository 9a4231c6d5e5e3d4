"""Argument checks shared by operators and jobs."""

from __future__ import annotations


def at_least(name: str, value: int, minimum: int) -> int:
    """Return ``value`` if it is an integer >= ``minimum``, else raise ``ValueError``."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{name} must be an integer, got {value!r}")
    if value < minimum:
        raise ValueError(f"{name} must be >= {minimum}, got {value}")
    return value


def window_size(n: int) -> int:
    """Length of an n-gram: an integer of 2 or more."""
    return at_least("window", n, 2)
