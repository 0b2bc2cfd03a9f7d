"""Scalar column functions, all built from JVM-side expressions."""

from halfstar.functions.columns import (
    epoch_seconds,
    genre_array,
    release_year,
    round_half_even,
    split_hash,
    star_class,
    strip_year,
    title_parts,
    week_start,
)

__all__ = [
    "epoch_seconds",
    "genre_array",
    "release_year",
    "round_half_even",
    "split_hash",
    "star_class",
    "strip_year",
    "title_parts",
    "week_start",
]
