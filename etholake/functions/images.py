"""Images as flat row-major arrays of pixels: all expressions stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _rows(pixels: Column, width: int) -> Column:
    last = (F.size(pixels) / width - 1).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(pixels, i * width + 1, F.lit(width)))


def flip_x(pixels: Column, width: int) -> Column:
    """Each row reversed."""
    return F.flatten(F.transform(_rows(pixels, width), F.reverse))


def flip_y(pixels: Column, width: int) -> Column:
    """Rows in reverse order."""
    return F.flatten(F.reverse(_rows(pixels, width)))


def flip_xy(pixels: Column) -> Column:
    """Turned by half a circle."""
    return F.reverse(pixels)


def subtract(background: Column, raw: Column) -> Column:
    return F.zip_with(background, raw, lambda a, b: a - b)


def masked(pixels: Column, mask: Column) -> Column:
    """Pixels outside the mask become 0."""
    return F.zip_with(pixels, mask, lambda p, m: F.when(m, p).otherwise(F.lit(0).cast("double")))


def clipped(pixels: Column, low: float, high: float) -> Column:
    """Pixels outside the range become 0."""
    return F.transform(pixels, lambda p: F.when(p.between(low, high), p).otherwise(F.lit(0).cast("double")))
