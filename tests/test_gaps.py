"""Raster files of a scene whose last tiles are not whole."""

import tempfile

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import check
from terraloom.suite import all_oracles, all_queries, tiffs

NAMES = ("k04_scenes q05_describe q05_describe_levels q06_batch_mixed s07_magic s07_magic_mixed s11_headers s12_ingest_tiles "
         "s12_to_tiles w07_files w07_scenes x01_from_files z10_file_grids z10_files z13_scenes").split()


def tables(vectors, missing=(25, 28, 31)):
    """``vectors`` rows of embeddings, four to a tile, those of ``missing`` null, and a few pages."""
    root, rng = tempfile.mkdtemp(prefix="run-", dir="/tmp"), np.random.default_rng(4)
    rows = [None if k in missing else (rng.normal(0, 0.3, 64) + 0.2).astype(np.float32) for k in range(vectors)]
    pq.write_table(pa.table({"vec_id": pa.array(range(vectors), pa.int64()), "embedding": pa.array(rows, pa.list_(pa.float32()))}), f"{root}/embeddings.parquet")
    pages = {"page_id": pa.array(range(120), pa.int64()), "url": [f"https://a.org/{k}" for k in range(120)], "html": [f"<html>{k}</html>" for k in range(120)]}
    pq.write_table(pa.table(pages), f"{root}/pages.parquet")
    con = duckdb.connect()
    for name in ("embeddings", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return root, con


@pytest.fixture(scope="module", params=[109])
def odd(request):
    return tables(request.param)


@pytest.mark.parametrize("name", NAMES)
def test_tiles_that_lack_bands(spark, odd, name):
    assert check.compare(all_queries()[name](spark, odd[0]), odd[1], all_oracles()[name]) == ""


@pytest.fixture(scope="module")
def corner():
    """The last file is one tile, which has red alone; tile 11 lacks red."""
    return tables(121, (44,))


@pytest.mark.parametrize("name", ["w07_files", "w07_scenes", "z10_file_grids", "z10_files"])
def test_last_file_of_one_band(spark, corner, name):
    assert check.compare(all_queries()[name](spark, corner[0]), corner[1], all_oracles()[name]) == ""


def test_tiles_that_lack_red_only(spark):
    """Tiles 0, 11 and 25 lack red, 15 and 29 nir; their other bands are there."""
    root, con = tables(140, (0, 44, 63, 100, 119))
    assert check.compare(all_queries()["x01_from_files"](spark, root), con, all_oracles()["x01_from_files"]) == ""


def test_missing_cells_take_a_free_number():
    data, nodata = tiffs.whole(np.array([0.0, 1.9, np.nan, 3.0]), "uint8")
    assert data.dtype == np.uint8 and data.tolist() == [0, 1, 2, 3] and nodata == "2"
    data, nodata = tiffs.whole(np.array([*range(256), np.nan]), "uint8")
    assert data.dtype == np.uint16 and data.tolist() == list(range(257)) and nodata == "256"
    assert tiffs.whole(np.array([5.0]), "uint8")[1] is None
