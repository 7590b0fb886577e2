"""Zone maps, sketches, composites and several kernels in one exchange."""

import tempfile
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.test_regrid import gaps, grid_of, tiles_of

from terraloom.operators import composite, halo, sketches, stats, tiles as tile_ops, zones
from terraloom.plans import workflows

RNG = np.random.default_rng(5)
SIZE = 8


@pytest.fixture(scope="module")
def scenes():
    ramp = np.add.outer(np.arange(40), np.arange(48)).astype(float)
    return {s: {"red": gaps((40, 48)) + k, "nir": np.abs(gaps((40, 48))) * (1 + k) + ramp, "blue": gaps((40, 48), 0.5), "dsm": ramp + 3 * RNG.random((40, 48)),
                "dem": ramp} for k, s in enumerate("pq")}


@pytest.fixture(scope="module")
def stored(spark, scenes):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/zones"
    zones.store(tiles_of(spark, scenes, SIZE).drop("transform"), list(scenes["p"]), root)
    return spark.read.parquet(root)


def test_zone_statistics(stored, scenes):
    got = {(r.scene, r.band): r for r in zones.bands(stored, ["red", "blue"]).collect()}
    for s, bands in scenes.items():
        for b in ("red", "blue"):
            v = bands[b][~np.isnan(bands[b])]
            r = got[s, b]
            assert r.cells == len(v)
            np.testing.assert_allclose([r.min, r.max, r.mean, r.std], [v.min(), v.max(), v.mean(), v.std()], rtol=1e-5)


def test_statistics_read_no_cells(stored, plan_of):
    plan = plan_of(zones.bands(stored, ["red"]))
    assert "red_n:bigint" in plan and "red:array" not in plan and "nir" not in plan


@pytest.mark.parametrize("value,greater", [(0.1, True), (-0.05, False), (0.6, True), (2.0, True)])
def test_skipped_tiles_hold_nothing(stored, scenes, plan_of, value, greater):
    got = zones.index_filter(stored, "nir", "red", value, greater)
    assert "red_low" in plan_of(got).split("PushedFilters")[1] or "GreaterThan(red_n,0)" in plan_of(got)
    rows = got.collect()
    for s, bands in scenes.items():
        total = bands["nir"] + bands["red"]
        with np.errstate(all="ignore"):
            index = np.where(total != 0, (bands["nir"] - bands["red"]) / total, np.nan).astype(np.float32)
            want = np.where((index > value) if greater else (index < value), index, np.nan)
        mine = [r for r in rows if r.scene == s]
        np.testing.assert_allclose(grid_of(mine, "index", SIZE, want.shape), want, rtol=1e-5)
        assert {(r.tx, r.ty) for r in mine} == {(x // SIZE, y // SIZE) for y, x in zip(*np.nonzero(~np.isnan(want)))}


def test_height_ranges_skip_tiles(spark, stored, scenes, plan_of):
    df = zones.height_filter(stored, 2.9, 3.0)
    want = {(s, x // SIZE, y // SIZE) for s, b in scenes.items() for y, x in zip(*np.nonzero((b["dsm"] - b["dem"] >= 2.9)))}
    assert {(r.scene, r.tx, r.ty) for r in df.collect()} == want
    # Ground and surface of a flat, low tile rule a height out before its cells are read.
    low = tiles_of(spark, {"a": {"dsm": np.full((8, 16), 5.0) + np.repeat([0, 9], 8), "dem": np.full((8, 16), 5.0)}}, SIZE)
    bounded = zones.zoned(low.drop("transform"), ["dsm", "dem"])
    assert bounded.filter(zones.height().may_lie_between(2.0)).count() == 1
    assert bounded.filter(zones.height().may_lie_between(2.0, 8.0)).count() == 0


def test_stretch_reads_the_cells_once(stored, scenes, plan_of):
    df = zones.stretch(stored, ("red", "nir", "blue"))
    scans = [part.split("\n\n")[0] for part in plan_of(df).split("ReadSchema: ")[1:]]
    assert sum("red:array" in s for s in scans) == 1
    rows = df.collect()
    for s, b in scenes.items():
        some = np.stack([b[n] for n in ("red", "nir", "blue")])
        low, high = np.nanmin(some), np.nanmax(some)
        np.testing.assert_allclose(grid_of([r for r in rows if r.scene == s], "red_01", SIZE, (40, 48)), np.clip((b["red"] - low) / (high - low), 0, 1), rtol=1e-4, atol=1e-5)


# Sketches

def test_rank_error_is_within_its_bound(spark):
    cells = {"a": RNG.normal(0, 1, (64, 320)), "b": np.round(RNG.exponential(3, (64, 320)))}
    rows = tiles_of(spark, {s: {"v": c} for s, c in cells.items()}, 32).repartition(7)
    for points in (16, 64, 4096):
        made = rows.select("scene", "tx", sketches.sketch("v", points).alias("sketch"))
        shares = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
        got = sketches.merge(made, ["scene"], points=points).withColumns({"q": sketches.quantiles("sketch", shares), "e": sketches.rank_error()}).collect()
        assert {r.scene for r in got} == {"a", "b"}
        for r in got:
            v = np.sort(cells[r.scene].ravel().astype(np.float64))
            assert r.sketch.n == len(v) and (r.sketch.low, r.sketch.high) == (v[0], v[-1]) and len(r.sketch["values"]) <= points
            assert sum(r.sketch["weights"]) == len(v)
            assert r.e <= 16 / points + 1e-9
            for share, q in zip(shares, r.q):
                first, last = np.searchsorted(v, q, "left") + 1, np.searchsorted(v, q, "right")
                want = max(1, np.ceil(share * len(v) - 1e-9))
                assert first - r.sketch.error <= want <= last + r.sketch.error
                if r.sketch.error == 0:
                    assert q == v[int(want) - 1]


def test_merging_stored_sketches_again(spark):
    """Per year and then of all, without the cells; tiles without cells count nothing."""
    cells = {"a": gaps((16, 64), 0.3), "b": np.full((16, 64), np.nan)}
    made = tiles_of(spark, {s: {"v": c} for s, c in cells.items()}, 8).select("scene", "ty", sketches.sketch("v", 8).alias("sketch"))
    year = sketches.merge(made, ["scene", "ty"], points=8)
    whole = sketches.merge(year, [], points=8).first().sketch
    v = np.sort(cells["a"][~np.isnan(cells["a"])])
    assert whole.n == len(v) and whole.low == v[0] and 0 < whole.error < len(v)
    got = {(r.scene, r.q is None) for r in year.withColumn("q", sketches.quantiles("sketch", [0.5])).collect()}
    assert got == {("a", False), ("b", True)}


def test_histograms(spark):
    v = gaps((32, 40), 0.2)
    made = tiles_of(spark, {"a": {"v": v}}, 8).select("scene", sketches.histogram("v", 40.0, 2.5, 30).alias("histogram"))
    got = {r.bin: r.cells for r in sketches.merge_histograms(made, ["scene"]).collect()}
    want, _ = np.histogram(v[~np.isnan(v)], bins=40.0 + 2.5 * np.arange(31))
    inside = v[(v >= 40) & (v < 115)]
    assert sum(got.values()) == len(inside) and all(got.get(k, 0) == n for k, n in enumerate(want[:-1]))


# Composites

def survey_rows(spark, surveys):
    out = None
    for (scene, year), cells in surveys.items():
        df = tiles_of(spark, {scene: {"v": cells, "u": cells * 2}}, SIZE).drop("transform").withColumn("year", F.lit(year))
        out = df if out is None else out.unionByName(df)
    return out.repartition(5)


@pytest.mark.parametrize("how", composite.HOW)
@pytest.mark.parametrize("cells", [40, 1 << 22])
def test_composites(spark, how, cells):
    surveys = {("a", 2003): gaps((16, 24), 0.6), ("b", 2001): gaps((16, 24), 0.6), ("c", 2010): gaps((16, 24), 0.6), ("d", 2010): gaps((16, 24), 0.6),
               ("e", None): gaps((16, 24), 0.6)}
    got = composite.composite(survey_rows(spark, surveys), ["v", "u"], SIZE, how, cells=cells).collect()
    order = sorted(surveys, key=lambda k: (k[1] is not None, k[1] or 0, k[0]))
    stack = np.stack([surveys[k] for k in order])
    with np.errstate(all="ignore"), warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # cells that no survey has
        want = {
            "latest": lambda s: np.apply_along_axis(lambda v: v[~np.isnan(v)][-1] if (~np.isnan(v)).any() else np.nan, 0, s),
            "earliest": lambda s: np.apply_along_axis(lambda v: v[~np.isnan(v)][0] if (~np.isnan(v)).any() else np.nan, 0, s),
            "mean": lambda s: np.nanmean(s, 0), "median": lambda s: np.nanmedian(s, 0), "count": lambda s: (~np.isnan(s)).sum(0).astype(float),
        }[how](stack)
    assert len(got) == 6 and {r.n_dates for r in got} == {5}
    shape = (16, 24)
    out = np.full(shape, np.nan)
    twice = np.full(shape, np.nan)
    for r in got:
        out[r.ty * SIZE:(r.ty + 1) * SIZE, r.tx * SIZE:(r.tx + 1) * SIZE] = np.reshape(r.v, (SIZE, SIZE))
        twice[r.ty * SIZE:(r.ty + 1) * SIZE, r.tx * SIZE:(r.tx + 1) * SIZE] = np.reshape(r.u, (SIZE, SIZE))
    np.testing.assert_allclose(out, want)
    np.testing.assert_allclose(twice, want * (1 if how == "count" else 2))


def test_a_deep_stack_streams(spark):
    """Two hundred dates of one tile: arrays pass one after another."""
    df = spark.range(200).select(
        F.lit("s").alias("scene"), F.lit(0).alias("tx"), F.lit(0).alias("ty"), F.col("id").alias("year"),
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when((i + F.col("id")) % 7 == 0, F.col("id").cast("double")).otherwise(F.lit(float("nan")))).alias("v"))
    latest = composite.composite(df, ["v"], SIZE, "latest").first()
    assert latest.n_dates == 200
    assert [int(v) for v in latest.v] == [max(y for y in range(200) if (i + y) % 7 == 0) for i in range(64)]
    median = composite.composite(df, ["v"], SIZE, "median", cells=1000).first()
    assert median.v == [float(np.median([y for y in range(200) if (i + y) % 7 == 0])) for i in range(64)]


def test_chosen_surveys(spark):
    df = survey_rows(spark, {("a", 2003): gaps((16, 24)), ("b", 2010): gaps((16, 24))})
    got = composite.chosen(df, SIZE, (9.0, 0.0, 12.0, 8.0), (2005, 2012)).collect()
    assert {(r.scene, r.tx, r.ty) for r in got} == {("b", 1, 0)}
    placed = df.withColumn("transform", F.expr("array(100D, 0.5D, 0D, 50D, 0D, -0.5D)"))
    got = composite.chosen(placed, SIZE, (103.0, 45.0, 105.0, 47.0)).collect()
    assert {(r.tx, r.ty) for r in got} == {(0, 0), (1, 0), (0, 1), (1, 1)}


# Several kernels in one exchange

def test_many_kernels_equal_one_at_a_time(spark, scenes):
    wide = tiles_of(spark, scenes, SIZE).withColumn("class", F.transform("nir", lambda v: F.when(F.isnan(v), v).otherwise(F.floor(v) % 3)))
    kernels = {"slope": (["dem"], *halo.slope_kernel()), "cleaned": (["class"], *halo.clean_kernel(2)),
               "sum": (["red", "dem"], 0, lambda a, b: a + b)}
    rows = halo.apply_many(wide, kernels, SIZE, carry=["blue"]).collect()
    for name, band, one in (("slope", "dem", halo.slope), ("cleaned", "class", halo.clean_classes)):
        long = tile_ops.by_band(wide.select("scene", "tx", "ty", F.col(band)), [band])
        want = {(r.scene, r.tx, r.ty): r.data for r in one(long, SIZE).collect()}
        assert len(rows) == len(want) == 60
        for r in rows:
            np.testing.assert_allclose(np.array(r[name], np.float32), want[r.scene, r.tx, r.ty], rtol=1e-4)
    for s, b in scenes.items():
        mine = [r for r in rows if r.scene == s]
        np.testing.assert_allclose(grid_of(mine, "sum", SIZE, (40, 48)), b["red"] + b["dem"])
        np.testing.assert_allclose(grid_of(mine, "blue", SIZE, (40, 48)), b["blue"])


def test_land_cover_is_one_exchange(spark, scenes, plan_of):
    wide = tiles_of(spark, scenes, SIZE)
    plan = plan_of(workflows.landcover_tiles(wide, SIZE))
    assert plan.split("\n\n")[0].count("FlatMapGroupsInArrow") == 1 and plan.split("\n\n")[0].count("Exchange") == 1
    assert {f.name for f in workflows.landcover_tiles(wide, SIZE).schema} == {"scene", "tx", "ty", "ndvi", "ndsm", "class", "cleaned", "slope", "slope_class"}
