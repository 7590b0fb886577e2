"""Resampling, overlays and pyramids on tiles against the pixel forms and numpy; window and level reads of files."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import regrid, resample, tiles as tile_ops
from terraloom.sources import listing, rasters
from terraloom.suite import tiffs

RNG = np.random.default_rng(11)


def tiles_of(spark, grids, size, transforms=None):
    """Wide tile rows of {scene: {band: 2-d array}}; edge tiles are full squares with NaN."""
    rows = []
    for scene, bands in grids.items():
        h, w = next(iter(bands.values())).shape
        for ty in range(-(-h // size)):
            for tx in range(-(-w // size)):
                out = []
                for data in bands.values():
                    cell = np.full((size, size), np.nan)
                    part = data[ty * size:(ty + 1) * size, tx * size:(tx + 1) * size]
                    cell[:part.shape[0], :part.shape[1]] = part
                    out.append(cell.ravel().tolist())
                rows.append((scene, tx, ty, size, size, (transforms or {}).get(scene), *out))
    names = list(next(iter(grids.values())))
    return spark.createDataFrame(rows, "scene string, tx int, ty int, w int, h int, transform array<double>, "
                                 + ", ".join(f"{n} array<double>" for n in names))


def grid_of(rows, band, size, shape):
    out = np.full((shape[0] + 2 * size, shape[1] + 2 * size), np.nan)
    for r in rows:
        out[r["ty"] * size:(r["ty"] + 1) * size, r["tx"] * size:(r["tx"] + 1) * size] = np.array(r[band]).reshape(size, size)
    assert np.isnan(out[shape[0]:]).all() and np.isnan(out[:, shape[1]:]).all()
    return out[:shape[0], :shape[1]]


def gaps(shape, share=0.1):
    data = RNG.normal(100, 20, shape)
    data[RNG.random(shape) < share] = np.nan
    return data


def resized(data, ratio_x, ratio_y, width, height, method, shift_x=0.0, shift_y=0.0):
    """Brute force, cell by cell."""
    out = np.full((height, width), np.nan)
    h, w = data.shape
    for Y in range(height):
        for X in range(width):
            if method == "nearest":
                x, y = int(np.floor((X + 0.5) * ratio_x + shift_x)), int(np.floor((Y + 0.5) * ratio_y + shift_y))
                near = [(x, y, 1.0)]
            elif method == "average":
                xs = [x for x in range(w) if np.floor((x + 0.5 - shift_x) / ratio_x) == X]
                ys = [y for y in range(h) if np.floor((y + 0.5 - shift_y) / ratio_y) == Y]
                near = [(x, y, 1.0) for x in xs for y in ys]
            else:
                u, v = (X + 0.5) * ratio_x - 0.5 + shift_x, (Y + 0.5) * ratio_y - 0.5 + shift_y
                near = [(x, y, (1 - abs(u - x)) * (1 - abs(v - y))) for x in (int(np.floor(u)), int(np.floor(u)) + 1) for y in (int(np.floor(v)), int(np.floor(v)) + 1)]
            total = weight = 0.0
            for x, y, k in near:
                if 0 <= x < w and 0 <= y < h and k > 1e-9 and not np.isnan(data[y, x]):
                    total, weight = total + k * data[y, x], weight + k
            if weight:
                out[Y, X] = total / weight
    return out


@pytest.mark.parametrize("method", regrid.METHODS)
@pytest.mark.parametrize("ratio,shift", [((2 / 3, 2 / 3), (0, 0)), ((2.5, 1.7), (0, 0)), ((0.4, 1.0), (3.2, -1.6)), ((9.0, 11.0), (0.5, 0.25))])
def test_every_method_equals_brute_force(spark, method, ratio, shift):
    data = {"a": {"u": gaps((21, 30)), "v": gaps((21, 30), 0)}, "b": {"u": gaps((13, 9)), "v": gaps((13, 9))}}
    size, width, height = 8, max(1, round(30 / ratio[0])), max(1, round(21 / ratio[1]))
    got = regrid.resize(tiles_of(spark, data, size), ["u", "v"], size, *ratio, width, height, method, *shift).collect()
    for scene, bands in data.items():
        for band, cells in bands.items():
            want = resized(cells, *ratio, width, height, method, *shift)
            np.testing.assert_allclose(grid_of([r for r in got if r["scene"] == scene], band, size, want.shape), want, rtol=1e-9)


def test_tiles_equal_the_pixel_form(spark):
    data = {"a": {"u": gaps((40, 24))}}
    wide = tiles_of(spark, data, 8)
    px = tile_ops.to_pixels(wide.drop("transform"), ["u"], 8)
    for method in regrid.METHODS:
        a = resample.to_resolution(px, ["u"], 1.0, 0.4, 24, 40, method).filter("u is not null").collect()
        b = tile_ops.to_pixels(regrid.to_resolution(wide, ["u"], 8, 1.0, 0.4, 24, 40, method), ["u"], 8).filter("u is not null").collect()
        assert {(r.scene, r.x, r.y): round(r.u, 9) for r in a} == {(r.scene, r.x, r.y): round(r.u, 9) for r in b}


@pytest.mark.parametrize("method", ["average", "nearest"])
def test_pyramid_equals_overviews(spark, method):
    data = {"a": {"u": gaps((37, 50)), "v": gaps((37, 50))}}
    wide = tiles_of(spark, data, 8)
    px = tile_ops.to_pixels(wide.drop("transform"), ["u", "v"], 8)
    levels = regrid.pyramid(wide, ["u", "v"], 8, [2, 3, 4, 8], 50, 37, method).cache()
    for n, factor in enumerate([2, 3, 4, 8], 1):
        want = resample.overview(px, ["u", "v"], factor, method, size=(50, 37)).filter("u is not null or v is not null").collect()
        some = levels.filter(F.col("level") == n)
        assert {r.factor for r in some.select("factor").collect()} == {factor}
        got = tile_ops.to_pixels(some.drop("level", "factor"), ["u", "v"], 8).filter("u is not null or v is not null").collect()
        key = lambda r: (r.x, r.y)
        rounded = lambda r: tuple(None if v is None else round(v, 9) for v in (r.u, r.v))
        assert {key(r): rounded(r) for r in got} == {key(r): rounded(r) for r in want}
    levels.unpersist()


def test_overlay_of_differing_grids(spark):
    """Two base scenes of different resolution over two other scenes that abut."""
    whole = gaps((60, 80), 0.05)
    other = {"left": {"dem": whole[:, :40]}, "right": {"dem": whole[:, 40:]}}
    others = tiles_of(spark, other, 8, {"left": [1000.0, 1.0, 0.0, 500.0, 0.0, -1.0], "right": [1040.0, 1.0, 0.0, 500.0, 0.0, -1.0]})
    base = {"p": {"red": gaps((32, 48), 0)}, "q": {"red": gaps((16, 16), 0)}}
    grids = {"p": [1020.0, 0.5, 0.0, 490.0, 0.0, -0.5], "q": [1030.3, 2.0, 0.0, 480.7, 0.0, -2.0]}
    for method in ("nearest", "bilinear"):
        got = regrid.overlay(tiles_of(spark, base, 8, grids), others, ["dem"], 8, method)
        rows = got.collect()
        for scene, bands in base.items():
            h, w = bands["red"].shape
            left, res, _, top, _, _ = grids[scene]
            want = resized(whole, res, res, w, h, method, left - 1000.0, 500.0 - top)
            mine = [r for r in rows if r["scene"] == scene]
            np.testing.assert_allclose(grid_of(mine, "dem", 8, (h, w)), want, rtol=1e-9)
            np.testing.assert_allclose(grid_of(mine, "red", 8, (h, w)), bands["red"])


def test_overlay_shuffles_no_cells_as_rows(spark, plan_of):
    data = {"a": {"u": gaps((16, 16))}}
    t = tiles_of(spark, data, 8, {"a": [0.0, 1.0, 0.0, 0.0, 0.0, -1.0]})
    plan = plan_of(regrid.overlay(t.select("scene", "tx", "ty", "w", "h", "transform", F.col("u").alias("v")), t, ["u"], 8, cell=8.0))
    assert "FlatMapGroupsInArrow" in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan and "posexplode" not in plan


# ---- window and level reads of files

SHAPE = (4, 70, 90)


@pytest.fixture(scope="module")
def archive(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    data = RNG.integers(0, 250, SHAPE).astype(np.uint8)
    half, fifth = data[:, 1::2, 1::2][:, :35, :45], data[:, 2::5, 2::5][:, :14, :18]
    cases = {
        "tiled": dict(tile=16, deflate=True, transform=(1000.0, 0.5, 2000.0, 0.5), overviews=[half, fifth]),
        "planar": dict(tile=16, planar=True, order=">", transform=(990.0, 1.0, 2010.0, 1.0), overviews=[fifth, half]),
        "strips": dict(rows_per_strip=9, transform=(1000.0, 0.25, 2000.0, 0.25), overview=True),
        "plain": dict(),
        "sparse": dict(tile=32, transform=(1000.0, 0.5, 2000.0, 0.5), sparse=[1, 8]),
    }
    for name, case in cases.items():
        with open(os.path.join(root, f"{name}.tif"), "wb") as f:
            f.write(tiffs.encode(data, epsg=2193, **case))
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/headers"
    rasters.headers(listing.objects(spark, root, suffixes=(".tif",))).write.parquet(path)
    return spark.read.parquet(path), data, half, fifth, {n: c.get("transform", (0.0, 1.0, 0.0, -1.0)) for n, c in cases.items()}


def name(col="path"):
    return F.regexp_extract(col, "([a-z]+).tif$", 1)


def arrays_of(blocks, shapes):
    out = {n: np.full(s, -1.0) for n, s in shapes.items()}
    for r in rasters.to_long(blocks).withColumn("name", name("scene")).collect():
        out[r["name"]][r["band"] - 1, r["y0"]:r["y0"] + r["h"], r["x0"]:r["x0"] + r["w"]] = np.array(r["data"]).reshape(r["h"], r["w"])
    return out


def test_levels_are_the_stored_overviews(archive):
    headers, data, half, fifth, _ = archive
    want = {1: {"tiled": half, "planar": half, "strips": data, "plain": data}, 2: {"tiled": fifth, "planar": fifth, "strips": data},
            7: {"tiled": fifth}}
    for level, files in want.items():
        some = headers.filter(name().isin(*files))
        got = arrays_of(rasters.blocks(some, level=level), {n: a.shape for n, a in files.items()})
        for n, a in files.items():
            np.testing.assert_array_equal(got[n], a)
    grid = {r["n"]: r for r in rasters.level_grid(headers, 2).withColumn("n", name()).collect()}
    assert (grid["tiled"]["factor"], grid["tiled"]["width"], grid["tiled"]["height"]) == (5, 18, 14)
    assert list(grid["tiled"]["transform"]) == [1000.0, 2.5, 0.0, 2000.0, 0.0, -2.5] and grid["plain"]["factor"] == 1


def test_a_window_reads_its_blocks_only(archive):
    headers, data, half, _, transforms = archive
    box = (1003.1, 1985.0, 1012.0, 1994.9)
    for level in (0, 1):
        plan = rasters.read_plan(headers, level, box).withColumn("n", name()).collect()
        got = rasters.blocks(headers, level=level, box=box)
        whole = {n: rasters.read_plan(headers.filter(name() == n), level).count() for n in transforms}
        cells = {(r.n, r.x, r.y) for r in rasters.to_long(got).withColumn("n", name("scene")).filter("band = 1").select(
            "n", "x0", "y0", "w", F.posexplode("data").alias("i", "v")).selectExpr("n", "x0 + i % w as x", "y0 + floor(i / w) as y").collect()}
        for n, (left, sx, top, sy) in transforms.items():
            f = 2 if level and n in ("tiled", "planar") else 1
            want = {(n, x, y) for x in range(90 // f) for y in range(70 // f)
                    if box[0] <= left + (x + 0.5) * sx * f <= box[2] and box[1] <= top - (y + 0.5) * sy * f <= box[3]}
            assert {c for c in cells if c[0] == n} == want
            mine = [r for r in plan if r["n"] == n]
            # Only blocks that hold a wanted cell are read.
            need = {(x // r["block_x"], y // r["block_y"]) for r in mine for _, x, y in want}
            planes = 4 if n == "planar" else 1
            assert len(mine) == len(need) * planes and (not want or n in ("strips", "sparse") or len(mine) < whole[n])
    assert rasters.read_plan(headers, 0, (0.0, 5000.0, 10.0, 5010.0)).count() == 0
    assert rasters.read_plan(headers, 0, (1e15, 5000.0, 1e16, 5010.0)).count() == 0
    assert rasters.read_plan(headers, 0, box, bands=[2, 4]).filter(name() == "planar").select("first_band").distinct().count() == 2


def test_box_from_columns(archive):
    headers, data, *_ = archive
    boxed = headers.withColumns({k: F.col("transform")[0] + d if k.endswith("x") else F.col("transform")[3] - d for k, d in
                                 (("minx", 2.0), ("maxx", 4.0), ("miny", 5.0), ("maxy", 3.0))}).filter(name() == "tiled")
    got = rasters.to_long(rasters.blocks(boxed, box=("minx", "miny", "maxx", "maxy"))).collect()
    cells = {(r["x0"] + i % r["w"], r["y0"] + i // r["w"]) for r in got for i in range(len(r["data"]))}
    assert cells == {(x, y) for x in range(4, 8) for y in range(6, 10)}


@pytest.mark.parametrize("size", [7, 16, 64])
def test_blocks_to_tiles(archive, size):
    """Both interleaves, strips, sparse blocks and ragged edges."""
    headers, data, *_ = archive
    bands = ["r", "g", "b", "n"]
    rows = rasters.to_tiles(rasters.blocks(headers), bands, size).withColumn("name", name("scene")).collect()
    for n in ("tiled", "planar", "strips", "plain", "sparse"):
        mine = [r for r in rows if r["name"] == n]
        want = data.astype(float)
        if n == "sparse":
            want = want.copy()
            want[:, :32, 32:64] = np.nan
            want[:, 64:, 64:] = np.nan
        assert len(mine) == -(-70 // size) * -(-90 // size)
        for k, band in enumerate(bands):
            np.testing.assert_array_equal(grid_of(mine, band, size, (70, 90)), want[k])
        assert {tuple(r["transform"]) for r in mine} == ({(0.0, 1.0, 0.0, 0.0, 0.0, 1.0)} if n == "plain" else {
            tuple(mine[0]["transform"])})


def test_a_level_and_window_to_tiles(archive):
    headers, _, half, _, _ = archive
    got = rasters.to_tiles(rasters.blocks(headers.filter(name() == "tiled"), level=1, box=(1005.0, 1980.0, 1020.0, 1990.0)), ["r"], 16).collect()
    cells = {(r["tx"] * 16 + i % 16, r["ty"] * 16 + i // 16): v for r in got for i, v in enumerate(r["r"]) if v == v}
    assert cells == {(x, y): half[0, y, x] for x in range(5, 20) for y in range(10, 20)}
    assert list(got[0]["transform"]) == [1000.0, 1.0, 0.0, 2000.0, 0.0, -1.0]


def test_rotated_files_have_no_window(spark, archive):
    headers = archive[0].filter(name() == "tiled").withColumn("transform", F.expr("array(0D, 1D, 0.2D, 0D, 0.2D, -1D)"))
    with pytest.raises(Exception, match="rotated"):
        rasters.read_plan(headers, 0, (0.0, 0.0, 5.0, 5.0)).collect()
    assert rasters.read_plan(headers).count() == 30
