"""Parts of object-store paths and artifact addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_scheme(path: Column, scheme: str) -> Column:
    return path.startswith(scheme)


def strip_scheme(path: Column, scheme: str) -> Column:
    """The path after its scheme; a path without it stops the job."""
    complaint = F.concat(F.lit(f"path does not start with {scheme}: "), path)
    rest = F.substring(path, len(scheme) + 1, 2**31 - 1)
    return F.when(has_scheme(path, scheme) | path.isNull(), rest).otherwise(F.raise_error(complaint))


def bucket(path: Column, scheme: str) -> Column:
    return F.split(strip_scheme(path, scheme), "/", 2)[0]


def key(path: Column, scheme: str) -> Column:
    """What follows the first slash after the scheme; null if nothing does."""
    return F.try_element_at(F.split(strip_scheme(path, scheme), "/", 2), F.lit(2))


def part(path: Column, position: int) -> Column:
    """The n-th slash-separated part, from 1, or from the end when negative."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))
