"""Header inventory and ingest over TIFF bytes made here."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import inventory
from terraloom.sources import listing, rasters
from terraloom.suite import tiffs

RNG = np.random.default_rng(3)
CASES = {
    "plain.tif": dict(shape=(1, 20, 30), dtype=np.uint8),
    "big_endian.tif": dict(shape=(4, 20, 30), dtype=np.uint16, order=">"),
    "strips.tif": dict(shape=(4, 21, 30), dtype=np.uint8, rows_per_strip=8, deflate=True),
    "tiles.tif": dict(shape=(4, 35, 50), dtype=np.float32, tile=16, deflate=True, overview=True),
    "planar.tif": dict(shape=(3, 35, 50), dtype=np.float32, tile=16, planar=True, order=">"),
    "signed.tif": dict(shape=(1, 9, 9), dtype=np.int16, nodata="-7"),
}


@pytest.fixture(scope="module")
def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="module")
def arrays(root):
    out = {}
    for name, case in CASES.items():
        case = dict(case)
        shape, dtype = case.pop("shape"), case.pop("dtype")
        data = RNG.random(shape).astype(dtype) if dtype == np.float32 else RNG.integers(0, 100, shape).astype(dtype)
        if name == "signed.tif":
            data[0, 3, 4] = -7
        out[name] = data
        write(root, name, tiffs.encode(data, transform=(1000.0, 0.5, 2000.0, 0.25), epsg=2193, **case))
    write(root, "lzw.tif", tiffs.encode(out["plain.tif"], compression=5))
    write(root, "short.tif", tiffs.encode(out["plain.tif"])[:40])
    write(root, "text.tif", b"no raster here")
    return out


def write(root, name, body):
    with open(os.path.join(root, name), "wb") as f:
        f.write(body)


@pytest.fixture(scope="module")
def headers(spark, root, arrays):
    return rasters.headers(listing.objects(spark, root, suffixes=(".tif",)))


def name_of(col="path"):
    return F.substring_index(col, "/", -1)


def test_headers(headers, arrays):
    got = {r["name"]: r for r in inventory.georeference(headers).withColumn("name", name_of()).collect()}
    assert len(got) == len(CASES) + 3
    for name, data in arrays.items():
        r = got[name]
        assert (r["band_count"], r["height"], r["width"]) == data.shape and r["dtype"] == str(data.dtype)
        assert r["epsg"] == 2193 and list(r["transform"]) == [1000.0, 0.5, 0.0, 2000.0, 0.0, -0.25]
        assert (r["x_max"], r["y_min"]) == (1000 + data.shape[2] * 0.5, 2000 - data.shape[1] * 0.25)
    assert got["tiles.tif"]["overview_widths"] == [25] and got["plain.tif"]["overview_widths"] == []
    assert got["planar.tif"]["interleave"] == "BAND" and got["signed.tif"]["nodata"] == -7.0
    assert (got["strips.tif"]["block_x"], got["strips.tif"]["block_y"], got["strips.tif"]["tiled"]) == (30, 8, "NO")
    assert "not a TIFF" in got["text.tif"]["error"] and "ends early" in got["short.tif"]["error"]
    assert got["lzw.tif"]["error"] is None and got["lzw.tif"]["compression"] == "LZW"


def test_rejects(headers):
    got = {r["name"]: r["reason"] for r in rasters.rejects(headers).withColumn("name", name_of()).collect()}
    assert set(got) == {"lzw.tif", "short.tif", "text.tif"} and "LZW" in got["lzw.tif"]


def test_ingest_equals_arrays(headers, arrays):
    blocks = rasters.blocks(headers)
    assert blocks.filter("error is not null").count() == 0
    back = {n: np.full(a.shape, np.inf) for n, a in arrays.items()}
    for r in rasters.to_long(blocks).withColumn("name", name_of("scene")).collect():
        cells = np.array(r["data"]).reshape(r["h"], r["w"])
        back[r["name"]][r["band"] - 1, r["y0"]:r["y0"] + r["h"], r["x0"]:r["x0"] + r["w"]] = cells
    for name, data in arrays.items():
        want = data.astype(float)
        if name == "signed.tif":
            want[want == -7] = np.nan
        np.testing.assert_allclose(back[name], want)


def test_pixels_of_interleaved_files(headers, arrays):
    px = rasters.to_pixels(rasters.blocks(headers).filter(name_of("scene") == "tiles.tif"), ["red", "green", "blue", "nir"])
    rows = px.collect()
    data = arrays["tiles.tif"]
    assert len(rows) == data.shape[1] * data.shape[2]
    assert all(abs(r["nir"] - data[3, r["y"], r["x"]]) < 1e-6 for r in rows)


def test_describe_and_magic(spark, root, headers):
    got = {r["name"]: r for r in inventory.describe(headers).withColumn("name", name_of()).collect()}
    assert not got["text.tif"]["success"] and got["text.tif"]["bands"] is None
    tiles = got["tiles.tif"]
    assert tiles["success"] and tiles["is_cog_b"] and not tiles["is_cog_a"] and tiles["bands"][3]["overviews"] == [2]
    assert [b["color_interp"] for b in tiles["bands"]] == ["Red", "Green", "Blue", "Undefined"]
    magic = {os.path.basename(r["path"]): r["is_tiff"] for r in listing.headers(spark, root).collect()}
    assert magic["big_endian.tif"] and magic["plain.tif"] and not magic["text.tif"]


def test_overview_factors_round_half_to_even(spark):
    df = spark.createDataFrame([(10, [4, 0, 100])], "width int, ws array<int>")
    assert df.select(inventory.overview_factors(F.col("width"), F.col("ws"))).first()[0] == [2, 1]
