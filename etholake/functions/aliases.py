"""Names under which statistics are shown, chosen and drawn."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A choice as shown to the user, and its column.
SHOWN = {
    "usage": "usage",
    "duration": "duration",
    "distance to center": "dist_to_center_px_mean",
    "2d velocity": "velocity_2d_mm_mean",
    "3d velocity": "velocity_3d_mm_mean",
    "height": "height_ave_mm_mean",
    "difference": "difference",
    "KW & Dunn's": "kw",
    "Z-Test": "z_test",
    "T-Test": "t_test",
    "Mann-Whitney": "mw",
}
#: Names of a graph's scalars, and their columns.
SCALARS = {
    "duration": "duration",
    "speeds_2d": "velocity_2d_mm_mean",
    "speeds_3d": "velocity_3d_mm_mean",
    "heights": "height_ave_mm_mean",
    "dists": "dist_to_center_px_mean",
}
#: Names in drawn tables, and their columns.
DRAWN = {
    "usage": "usage",
    "duration": "duration",
    "speed_2d": "velocity_2d_mm_mean",
    "speed_3d": "velocity_3d_mm_mean",
    "height": "height_ave_mm_mean",
    "dist_to_center": "dist_to_center_px_mean",
}


def column_of(shown: str) -> str:
    """The column that a choice stands for."""
    if shown not in SHOWN:
        raise ValueError(f"{shown!r} is none of {list(SHOWN)}")
    return SHOWN[shown]


def aliased(stats: DataFrame, names: Mapping[str, str], *keep: str) -> DataFrame:
    """The columns kept, and those that the names stand for, under these names; columns that are missing are NULL."""
    have = set(stats.columns)
    return stats.select(*keep, *[(F.col(c) if c in have else F.lit(None).cast("double")).alias(n) for n, c in names.items()])
