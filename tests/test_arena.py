"""The floor's plane and the arena's mask against plain versions."""

import numpy as np
import pytest

from etholake.functions import images
from etholake.operators import arena

W, H = 12, 10


def table(spark, image, uuid=1):
    flat = np.asarray(image).ravel()
    return spark.createDataFrame([(uuid, i, None if x is None else float(x)) for i, x in enumerate(flat.tolist())], "uuid long, pixel int, depth double")


def picture(mask, height=H):
    got = {r["pixel"]: r["inside"] for r in mask.collect()}
    return np.array([got[i] for i in range(height * W)]).reshape(height, W)


@pytest.fixture(scope="module")
def scene():
    """A tilted floor with small noise; walls to the left and on top, a box in the middle."""
    rng = np.random.default_rng(1)
    y, x = np.mgrid[:H, :W]
    z = 700 + 0.5 * x - 0.8 * y + rng.uniform(-0.3, 0.3, (H, W))
    floor = np.ones((H, W), bool)
    floor[:, :2] = floor[:2] = floor[5:7, 6:8] = False
    z[~floor] -= rng.uniform(60, 200, (~floor).sum())
    return z, floor


def test_floor_is_found(spark, scene):
    z, floor = scene
    got = arena.floors(table(spark, z), W, 2.0).first()
    y, x = np.mgrid[:H, :W]
    a, b, d = np.linalg.lstsq(np.stack([x[floor], y[floor], np.ones(floor.sum())], axis=1), z[floor], rcond=None)[0]
    assert got["votes"] == floor.sum() and np.allclose([got["a"], got["b"], got["d"]], [a, b, d])
    m = arena.masks(table(spark, z), W, 2.0, dilate=(1, 1))
    assert (picture(m) == floor).all()
    assert arena.as_arrays(m).first()["mask"] == floor.ravel().tolist()


@pytest.mark.parametrize("shape, size", [("rect", (3, 3)), ("rect", (2, 4)), ("ellipse", (5, 3)), ("ellipse", (4, 4)), ("ellipse", (1, 1))])
def test_dilation_and_erosion(spark, scene, shape, size):
    rng = np.random.default_rng(2)
    floor, offsets = scene[1] ^ (rng.random((H, W)) < 0.2), arena.element(shape, size)
    mask = table(spark, floor.astype(float)).selectExpr("uuid", "pixel", "depth > 0 AS inside")
    around = lambda y, x: [floor[y + dy, x + dx] for dx, dy in offsets if 0 <= x + dx < W and 0 <= y + dy < H]
    for operator, rule in ((arena.dilated, any), (arena.eroded, all)):
        assert (picture(operator(mask, W, offsets)) == [[rule(around(y, x)) for x in range(W)] for y in range(H)]).all()


def test_elements():
    assert arena.element("ellipse", (3, 3)) == [(0, -1), (-1, 0), (0, 0), (1, 0), (0, 1)]
    assert len(arena.element("rect", (4, 2))) == 8
    with pytest.raises(ValueError):
        arena.element("star", (3, 3))


def test_background_is_the_median(spark):
    frames = spark.createDataFrame([(1, [1.0, 5.0]), (1, [2.0, float("nan")]), (1, [9.0, None]), (2, [4.0, 4.0]), (3, None)], "uuid long, pixels array<double>")
    got = sorted(tuple(r) for r in arena.background(frames).collect())
    assert got == [(1, 0, 2.0), (1, 1, 5.0), (2, 0, 4.0), (2, 1, 4.0)]


def test_images_without_a_plane(spark):
    """Of unknown depth, of one row (all pixels in a line), or none at all: nothing is floor, and nothing fails."""
    unknown = table(spark, np.array([[None] * W] * H, dtype=object))
    assert not picture(arena.masks(unknown, W, 1.0)).any()
    assert not picture(arena.masks(table(spark, np.arange(W)), W, 1.0), 1).any()
    assert arena.masks(unknown.limit(0), W, 1.0).count() == 0


def test_some_pixels_unknown(spark, scene):
    z, floor = scene
    holes = z.astype(object)
    holes[8, 3], holes[4, 4] = None, float("nan")
    expected = floor.copy()
    expected[8, 3] = expected[4, 4] = False
    assert (picture(arena.masks(table(spark, holes), W, 2.0, dilate=(1, 1))) == expected).all()


def test_mask_is_applied_to_pixels(spark):
    d = spark.createDataFrame([([1.0, 2.0, 3.0], [True, False, True])], "p array<double>, m array<boolean>")
    assert d.select(images.masked(d.p, d.m)).first()[0] == [1.0, 0.0, 3.0]
