"""A session's arena: its background image, the plane of its floor, and the mask of pixels that lie on the floor.

Images are rows (uuid, pixel, depth), pixel counting row-major from 0, so an image of any size is many small rows and a session's
image is never held whole. Planes are found by RANSAC: each try fits three pixels, all pixels vote by partial aggregation,
and the winner's voters fit the plane anew by merged co-moments. The pixels of a try follow from its number alone, so reruns
and tasks done twice agree. Masks are dilated and eroded by joins with the structuring element's offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import order

TRIES = 100
#: Multiplier of Fibonacci hashing (2**32 over the golden ratio): successive numbers are dealt evenly over an image.
_GOLDEN, _RANGE = 2654435761, 1 << 32


def background(frames: DataFrame) -> DataFrame:
    """uuid, pixel, depth: the median of each pixel over a session's frames (uuid, pixels); nulls and NaN are left out."""
    pixels = frames.select("uuid", F.posexplode("pixels").alias("pixel", "depth"))
    return order.percentiles(pixels, ["uuid", "pixel"], "depth", [0.5], many_keys=True).select("uuid", "pixel", F.col("value").alias("depth"))


def _located(image: DataFrame, width: int) -> DataFrame:
    depth = F.col("depth").cast("double")
    at = image.select("uuid", "pixel", (F.col("pixel") % width).cast("double").alias("x"), F.floor(F.col("pixel") / width).cast("double").alias("y"), depth.alias("depth"))
    return at.where(F.col("depth").isNotNull() & ~F.isnan("depth"))


def _off() -> Column:
    return F.abs(F.col("depth") - (F.col("a") * F.col("x") + F.col("b") * F.col("y") + F.col("d")))


def candidates(image: DataFrame, width: int, tries: int = TRIES) -> DataFrame:
    """uuid, try, a, b, d: planes depth = a x + b y + d through three pixels each; tries whose pixels lie in a line, or
    are unknown, give none."""
    sizes = image.groupBy("uuid").agg((F.max("pixel") + 1).cast("long").alias("_n"))
    number = F.col("try") * 3 + F.col("corner") + 1
    corners = sizes.select("uuid", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tries - 1).cast("long"))).alias("try"))
    corners = corners.select("*", F.explode(F.array(*[F.lit(j).cast("long") for j in range(3)])).alias("corner"))
    corners = corners.select("uuid", "try", "corner", F.shiftright((number * _GOLDEN) % _RANGE * F.col("_n"), 32).cast("int").alias("pixel"))
    of = lambda c, j: F.max(F.when(F.col("corner") == j, F.col(c))).alias(f"{c}{j}")
    k = corners.join(_located(image, width), ["uuid", "pixel"]).groupBy("uuid", "try").agg(*[of(c, j) for c in ("x", "y", "depth") for j in range(3)])
    dx1, dx2, dy1, dy2, dz1, dz2 = (F.col(f"{c}{j}") - F.col(f"{c}0") for c in ("x", "y", "depth") for j in (1, 2))
    k = k.withColumn("_det", dx1 * dy2 - dx2 * dy1).where("_det <> 0")
    k = k.withColumns({"a": (dz1 * dy2 - dz2 * dy1) / F.col("_det"), "b": (dx1 * dz2 - dx2 * dz1) / F.col("_det")})
    return k.select("uuid", "try", "a", "b", (F.col("depth0") - F.col("a") * F.col("x0") - F.col("b") * F.col("y0")).alias("d"))


def floors(image: DataFrame, width: int, tolerance: float, tries: int = TRIES) -> DataFrame:
    """uuid, a, b, d, votes: each session's plane with the most pixels within tolerance (of equal ones the earliest try), fitted to
    these by least squares."""
    at = _located(image, width)
    plane = F.struct("try", "a", "b", "d")
    # at most `tries` planes a session
    tried = candidates(image, width, tries).groupBy("uuid").agg(F.collect_list(plane).alias("_planes"))
    votes = at.join(tried, "uuid").select("uuid", "x", "y", "depth", F.explode("_planes").alias("_p")).select("*", "_p.*").where(_off() <= tolerance)
    votes = votes.groupBy("uuid", "try", "a", "b", "d").agg(F.count("*").alias("votes"))
    best = votes.groupBy("uuid").agg(F.max_by(F.struct("a", "b", "d", "votes"), F.struct("votes", -F.col("try"))).alias("_p")).select("uuid", "_p.*")
    voters = at.join(best, "uuid").where(_off() <= tolerance)
    co = lambda p, q: F.covar_pop(p, q).alias(f"_{p[0]}{q[0]}")
    fit = voters.groupBy("uuid").agg(
        co("x", "x"), co("x", "y"), co("y", "y"), co("x", "depth"), co("y", "depth"), *[F.avg(c).alias(f"_m{c[0]}") for c in ("x", "y", "depth")],
        *[F.first(c).alias(c) for c in ("a", "b", "d", "votes")],
    )
    det = F.col("_xx") * F.col("_yy") - F.col("_xy") * F.col("_xy")
    slope_x = (F.col("_xd") * F.col("_yy") - F.col("_yd") * F.col("_xy")) / F.col("_det")
    slope_y = (F.col("_yd") * F.col("_xx") - F.col("_xd") * F.col("_xy")) / F.col("_det")
    known = F.col("_det") > 1e-9  # voters in a line do not fix a plane: the three pixels' own stays
    fit = fit.withColumn("_det", det).withColumns({"_a": F.when(known, slope_x).otherwise(F.col("a")), "_b": F.when(known, slope_y).otherwise(F.col("b"))})
    level = F.when(known, F.col("_md") - F.col("_a") * F.col("_mx") - F.col("_b") * F.col("_my")).otherwise(F.col("d"))
    return fit.select("uuid", F.col("_a").alias("a"), F.col("_b").alias("b"), level.alias("d"), "votes")


def element(shape: str, size: tuple[int, int]) -> list[tuple[int, int]]:
    """Offsets (dx, dy) of a structuring element of (width, height): 'rect', or the 'ellipse' inscribed in it."""
    w, h = size
    cx, cy = w // 2, h // 2
    if shape == "rect":
        return [(x - cx, y - cy) for y in range(h) for x in range(w)]
    if shape != "ellipse":
        raise ValueError(f"shape must be 'rect' or 'ellipse', not {shape!r}")
    half = lambda dy: round(cx * max(0.0, 1 - (dy / cy) ** 2) ** 0.5) if cy else cx
    return [(x - cx, y - cy) for y in range(h) for x in range(w) if abs(y - cy) <= cy and abs(x - cx) <= half(y - cy)]


def dilated(mask: DataFrame, width: int, offsets: Sequence[tuple[int, int]]) -> DataFrame:
    """mask(uuid, pixel, inside) where a pixel is inside if it has one that is at any of the offsets from it."""
    steps = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets])).alias("_o")
    reached = mask.where("inside").select("uuid", "pixel", steps).select("uuid", (F.col("pixel") % width - F.col("_o.dx")).alias("_x"), (F.floor(F.col("pixel") / width) - F.col("_o.dy")).alias("_y"))
    reached = reached.where(F.col("_x").between(0, width - 1)).select("uuid", (F.col("_y") * width + F.col("_x")).cast("int").alias("pixel")).distinct()
    # what is reached beyond an image's edges finds no pixel
    return mask.select("uuid", "pixel").join(reached.withColumn("_in", F.lit(True)), ["uuid", "pixel"], "left").select("uuid", "pixel", F.col("_in").isNotNull().alias("inside"))


def eroded(mask: DataFrame, width: int, offsets: Sequence[tuple[int, int]]) -> DataFrame:
    """mask where a pixel stays inside if all at the offsets from it are, as far as the image goes."""
    flipped = lambda d: d.withColumn("inside", ~F.col("inside"))
    return flipped(dilated(flipped(mask), width, offsets))


def on_floor(image: DataFrame, width: int, planes: DataFrame, tolerance: float) -> DataFrame:
    """uuid, pixel, inside: whether a pixel lies within tolerance of its session's plane; those of unknown depth, and of
    sessions without a plane, do not."""
    located = image.select("uuid", "pixel", "depth", (F.col("pixel") % width).cast("double").alias("x"), F.floor(F.col("pixel") / width).cast("double").alias("y"))
    near = (_off() <= tolerance) & ~F.isnan("depth")
    return located.join(planes, "uuid", "left").select("uuid", "pixel", F.coalesce(near, F.lit(False)).alias("inside"))


def masks(image: DataFrame, width: int, tolerance: float, dilate: tuple[int, int] = (10, 10), erode: tuple[int, int] = (1, 1), shape: str = "ellipse", tries: int = TRIES) -> DataFrame:
    """uuid, pixel, inside for every pixel of image(uuid, pixel, depth): on the floor, then dilated and eroded."""
    flat = on_floor(image, width, floors(image, width, tolerance, tries), tolerance)
    return eroded(dilated(flat, width, element(shape, dilate)), width, element(shape, erode))


def as_arrays(mask: DataFrame) -> DataFrame:
    """uuid, mask: each session's mask as a flat row-major array, as functions over arrays of pixels take it."""
    pixels = F.sort_array(F.collect_list(F.struct("pixel", "inside")))
    return mask.groupBy("uuid").agg(F.transform(pixels, lambda p: p["inside"]).alias("mask"))
