"""Neighbourhood operators against brute force in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import focal, halo, resample, tiles

H, W = 37, 53


def pixels(spark, grid, name, skip=()):
    rows = [("s", x, y, float(grid[y, x])) for y in range(grid.shape[0]) for x in range(grid.shape[1]) if (y, x) not in skip]
    return spark.createDataFrame(rows, f"scene string, x int, y int, {name} double")


def grid_of(df, name, shape=(H, W), fill=np.nan):
    out = np.full(shape, fill)
    for r in df.select("x", "y", name).collect():
        out[r["y"], r["x"]] = np.nan if r[name] is None else float(r[name])
    return out


def random_grid(seed, share=None):
    rng = np.random.default_rng(seed)
    return (rng.random((H, W)) < share) if share else rng.random((H, W)) * 50


def horn(z, rx, ry):
    p = np.pad(z, 1, mode="edge")
    def at(dy, dx):
        return p[1 + dy:1 + dy + H, 1 + dx:1 + dx + W]
    gx = ((at(-1, 1) + 2 * at(0, 1) + at(1, 1)) - (at(-1, -1) + 2 * at(0, -1) + at(1, -1))) / (8 * rx)
    gy = ((at(1, -1) + 2 * at(1, 0) + at(1, 1)) - (at(-1, -1) + 2 * at(-1, 0) + at(-1, 1))) / (8 * ry)
    return np.sqrt(gx ** 2 + gy ** 2)


def closed(mask, square, n):
    offsets = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if square or a == 0 or b == 0]
    for pick in (np.max, np.min):
        for _ in range(n):
            p = np.pad(mask, 1)
            mask = pick([p[1 + a:1 + a + H, 1 + b:1 + b + W] for a, b in offsets], axis=0)
    return mask


@pytest.mark.parametrize("block", [8, 16, 512])
def test_horn_slope(spark, block):
    z = random_grid(1)
    df = focal.slope(pixels(spark, z, "dem"), "dem", 0.5, 2.0, block=block)
    assert df.columns == ["scene", "x", "y", "dem", "slope"]
    np.testing.assert_allclose(grid_of(df, "slope"), np.degrees(np.arctan(horn(z, 0.5, 2.0))), atol=1e-9)


def test_slope_formats_and_null_edge(spark):
    z = random_grid(2)
    rise = grid_of(focal.slope(pixels(spark, z, "dem"), fmt="rise_run", edge="null", block=16), "slope")
    inside = horn(z, 1, 1)[1:-1, 1:-1]
    np.testing.assert_allclose(rise[1:-1, 1:-1], inside, atol=1e-9)
    assert np.isnan(rise[0]).all() and np.isnan(rise[:, -1]).all()
    percent = grid_of(focal.slope(pixels(spark, z, "dem"), fmt="percent", block=16), "slope")
    np.testing.assert_allclose(percent[1:-1, 1:-1], 100 * inside, atol=1e-7)
    with pytest.raises(ValueError):
        focal.slope(pixels(spark, z, "dem"), fmt="gradians")


def test_gradient_slope(spark):
    z = random_grid(3)
    gy, gx = np.gradient(z)
    df = focal.slope(pixels(spark, z, "dem"), method="gradient", block=16)
    np.testing.assert_allclose(grid_of(df, "slope"), np.sqrt(gx ** 2 + gy ** 2), atol=1e-9)


@pytest.mark.parametrize("element", ["square", "cross"])
@pytest.mark.parametrize("iterations", [1, 2, 3])
@pytest.mark.parametrize("block", [8, 512])
def test_closing(spark, element, iterations, block):
    mask = random_grid(4, 0.3)
    df = focal.closing(pixels(spark, mask, "v").withColumn("m", F.col("v") == 1), "m", element, iterations, block=block)
    want = closed(mask, element == "square", iterations)
    assert (grid_of(df, "closed") == want).all()
    # Closing only adds cells, except in the ring the border eats.
    n = iterations
    assert (want[n:-n, n:-n] >= mask[n:-n, n:-n]).all()


def test_closing_ignores_partitioning(spark):
    mask = random_grid(5, 0.4)
    px = pixels(spark, mask, "v").withColumn("m", F.col("v") == 1)
    a = grid_of(focal.closing(px.repartition(1), "m", block=8), "closed")
    assert (a == grid_of(focal.closing(px.repartition(13), "m", block=16), "closed")).all()


def test_absent_cells_are_outside(spark):
    mask = np.ones((H, W), dtype=bool)
    df = focal.closing(pixels(spark, mask, "v", {(10, 10)}).withColumn("m", F.lit(True)), "m", block=8)
    got = grid_of(df, "closed", fill=-1)
    assert got[10, 10] == -1 and (got[9:12, 9:12] <= 0).all() and got[12, 12] == 1


def test_two_scenes_do_not_mix(spark):
    z = random_grid(6)
    a = pixels(spark, z, "dem")
    both = a.unionByName(pixels(spark, z * 3, "dem").withColumn("scene", F.lit("t")))
    df = focal.slope(both, block=16)
    np.testing.assert_allclose(grid_of(df.filter("scene = 's'"), "slope"), grid_of(focal.slope(a), "slope"), atol=1e-12)


@pytest.mark.parametrize("iterations", [1, 2])
def test_clean_classes_pixels_and_tiles(spark, iterations):
    rng = np.random.default_rng(7)
    classes = rng.integers(0, 4, (H, W))
    want = classes.copy()
    for k in (1, 2, 3):
        want[closed(classes == k, False, iterations)] = k
    px = pixels(spark, classes, "class")
    assert (grid_of(focal.clean_classes(px, iterations=iterations, block=8), "cleaned") == want).all()
    assert (grid_of(on_tiles(px, "class", lambda t: halo.clean_classes(t, 16, iterations)), "v") == want).all()


def on_tiles(px, name, fn, size=16):
    long = tiles.by_band(tiles.from_pixels(px, [name], size), [name])
    wide = fn(long).select("scene", "tx", "ty", F.lit(size).alias("w"), F.lit(size).alias("h"), F.col("data").alias("v"))
    return tiles.to_pixels(wide, ["v"], size).filter(F.col("v").isNotNull())


def test_closing_and_slope_on_tiles(spark):
    mask = random_grid(8, 0.35)
    df = on_tiles(pixels(spark, mask, "v"), "v", lambda t: halo.closing(t, 16))
    assert (grid_of(df, "v") == closed(mask, True, 1)).all()
    z = random_grid(9)
    df = on_tiles(pixels(spark, z, "v"), "v", lambda t: halo.slope(t, 16, 0.5, 2.0, "rise_run"))
    np.testing.assert_allclose(grid_of(df, "v"), horn(z, 0.5, 2.0), rtol=1e-4, atol=1e-4)


@pytest.mark.parametrize("distance, smoothing", [(3, 0), (6, 1), (10, 2)])
def test_fill_holes(spark, distance, smoothing):
    rng = np.random.default_rng(10)
    z = np.where(rng.random((H, W)) < 0.03, rng.random((H, W)) * 9 + 1, 0.0).astype(np.float32).astype(float)
    want, filled = z.copy(), np.zeros((H, W), dtype=bool)
    ys, xs = np.nonzero(z)
    for y in range(H):
        for x in range(W):
            if z[y, x]:
                continue
            best = {}
            for v, u in zip(ys, xs):
                dy, dx = v - y, u - x
                d = (dy * dy + dx * dx) ** 0.5
                if d > distance:
                    continue
                q = 0 if dx >= 0 and dy < 0 else 1 if dx > 0 else 2 if dx <= 0 and dy > 0 else 3
                best.setdefault(q, []).append((d, z[v, u]))
            if best:
                # Equally near cells of one quadrant may both be chosen; skip those below.
                near = [min(b) for b in best.values()]
                want[y, x] = sum(v / d for d, v in near) / sum(1 / d for d, _ in near)
                filled[y, x] = True
    df = on_tiles(pixels(spark, z, "v"), "v", lambda t: halo.fill_holes(t, 16, distance, smoothing))
    got = grid_of(df, "v")
    assert ((got != 0) == (filled | (z != 0))).all()
    assert (got[z != 0] == z[z != 0]).all()
    if smoothing == 0:
        ties = np.abs(got - want) > 1e-4
        assert ties.mean() < 0.1
    inside = got[filled]
    assert inside.min() >= z[z > 0].min() - 1e-4 and inside.max() <= z.max() + 1e-4


def test_halo_must_fit(spark):
    df = spark.createDataFrame([("s", "b", 0, 0, [1.0] * 4)], "scene string, band string, tx int, ty int, data array<float>")
    with pytest.raises(ValueError):
        halo.closing(df, 2, iterations=2)


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_resample_against_gather(spark, method):
    z = random_grid(11)
    ratio, tw, th, shift = 0.6, 80, 55, 0.3
    df = resample.to_grid(pixels(spark, z, "v"), ["v"], ratio, ratio, tw, th, method, shift, shift)
    got = grid_of(df, "v", (th, tw))
    for Y in range(th):
        for X in range(tw):
            u, v = (X + 0.5) * ratio - 0.5 + shift, (Y + 0.5) * ratio - 0.5 + shift
            if method == "nearest":
                i, j = int(np.floor(u + 0.5)), int(np.floor(v + 0.5))
                want = z[j, i] if i < W and j < H else np.nan
            else:
                i, j = int(np.floor(u)), int(np.floor(v))
                cells = [((1 - abs(u - a)) * (1 - abs(v - b)), z[b, a]) for a in (i, i + 1) for b in (j, j + 1)
                         if 0 <= a < W and 0 <= b < H and (1 - abs(u - a)) * (1 - abs(v - b)) > 1e-9]
                want = sum(w * q for w, q in cells) / sum(w for w, _ in cells) if cells else np.nan
            np.testing.assert_allclose(got[Y, X], want, atol=1e-9)


def test_resample_round_trip_keeps_constant(spark):
    df = resample.to_resolution(pixels(spark, np.full((H, W), 4.0), "v"), ["v"], 1.0, 0.3, W, H)
    row = df.agg(F.min("v"), F.max("v"), F.max("x"), F.max("y")).first()
    assert row[0] == pytest.approx(4) and row[1] == pytest.approx(4)
    assert (row[2] + 1, row[3] + 1) == (round(W / 0.3), round(H / 0.3))


def test_overview_levels():
    assert [resample.factor_for([2, 4], n) for n in range(4)] == [1, 2, 4, 4]
    assert resample.factor_for([], 3) == 1


def test_overview_drops_partial_cells(spark):
    z = random_grid(12)
    df = resample.overview(pixels(spark, z, "v"), ["v"], 4)
    got = grid_of(df, "v", (H // 4, W // 4))
    np.testing.assert_allclose(got, z[:H // 4 * 4, :W // 4 * 4].reshape(H // 4, 4, W // 4, 4).mean(axis=(1, 3)), atol=1e-9)
    assert df.count() == (H // 4) * (W // 4)
