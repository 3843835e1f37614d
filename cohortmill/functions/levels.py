"""Level lists of a fine-to-coarse column hierarchy."""

from __future__ import annotations


def parent_level(columns: list[str]) -> list[str]:
    return columns[1:]


def fallback_levels(columns: list[str]) -> list[list[str]]:
    """Proper suffixes, finest first: ``[b..f], [c..f], ..., [f]``."""
    return [columns[start:] for start in range(1, len(columns))]


def coarse_first_levels(columns: list[str]) -> list[list[str]]:
    """Proper suffixes, coarsest first: ``[f], [e, f], ..., [b..f]``."""
    return fallback_levels(columns)[::-1]
