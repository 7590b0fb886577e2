"""Salted joins, numbering and the box join under skew."""

import random

import pytest
from pyspark.sql import Window, functions as F

from terraloom.operators import joins, ranking, spatial


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def skewed(spark):
    """A third of the rows share one key, another part has none."""
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50).cast("int").alias("k"))
    right = spark.range(60).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_hot_equals_join(spark, how):
    left, right = skewed(spark)
    a, b, on = joins.split_hot(left, right, ["k"], F.col("id"), min_rows=100)
    assert rows(a.join(b, on, how).select("id", "k", "v")) == rows(left.join(right, "k", how).select("id", "k", "v"))
    assert a.filter("k = 7").select("_salt").distinct().count() > 5
    assert a.filter("k is null").select("_salt").distinct().count() > 5
    assert a.filter("k = 8").select("_salt").distinct().count() == 1


def test_split_hot_on_both_sides(spark):
    left, _ = skewed(spark)
    right = left.select(F.col("id").alias("rid"), "k").filter("rid % 5 = 0")
    a, b, on = joins.split_hot(left, right, ["k"], F.col("id"), F.col("rid"), min_rows=100)
    assert on == ["k", "_salt", "_salt2"]
    assert rows(a.join(b, on).select("id", "rid")) == rows(left.join(right, "k").select("id", "rid"))


@pytest.mark.parametrize("bound", [200_000, 0])
def test_lookup_with_and_without_broadcast(spark, monkeypatch, plan_of, bound):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", bound)
    left, right = skewed(spark)
    assert rows(joins.lookup(left, right, ["k"]).select("id", "v")) == rows(left.join(right, "k", "left").select("id", "v"))


def test_hot_keys_are_few(spark):
    df = spark.range(10_000).select((F.col("id") % 5000).alias("k"))
    assert joins.hot_keys(df, ["k"], min_rows=3).count() == 0
    assert 1 / joins.HOT_SHARE <= joins.BROADCAST_ROWS


def test_row_numbers(spark):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 != 0, "big").otherwise(F.concat(F.lit("t'"), (F.col("id") % 7).cast("string"))).alias("type"),
        F.when(F.col("id") % 4 == 0, "same").otherwise(F.hex("id")).alias("href"))
    w = Window.partitionBy("type")
    want = df.select("id", F.row_number().over(w.orderBy("href", "id")).alias("i"), F.count("*").over(w).alias("n"))
    got = ranking.row_numbers(df, "type", ["href", "id"], pieces=16)
    assert rows(got.select("id", "i", "n")) == rows(want)
    assert ranking.row_numbers(df.limit(0), "type", ["href", "id"]).count() == 0


def boxes(spark, n, seed, prefix, sizes, hot=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y, s = rng.uniform(-500, 500), rng.uniform(-500, 500), rng.choice(sizes)
        if i < hot:
            x, y, s = 1.0, 1.0, sizes[0]
        out.append((i, x, y, x + s, y + s * rng.uniform(0, 1)))
    out.append((n, 0.0, 0.0, 0.0, 0.0))
    return spark.createDataFrame(out, f"{prefix}id int, " + ", ".join(f"{prefix}{k} double" for k in ("minx", "miny", "maxx", "maxy"))), out


@pytest.mark.parametrize("sizes_a, sizes_b", [((5,), (5,)), ((3,), (200,)), ((1, 40, 900), (2, 60)), ((700,), (1,))])
def test_bbox_join_against_brute_force(spark, sizes_a, sizes_b):
    a, ra = boxes(spark, 300, 1, "a_", sizes_a, hot=100)
    b, rb = boxes(spark, 200, 2, "b_", sizes_b, hot=70)
    want = sorted((p[0], q[0]) for p in ra for q in rb if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    got = sorted(map(tuple, spatial.bbox_join(a, b, 10.0, min_rows=20).select("a_id", "b_id").collect()))
    assert got == want


def test_bbox_join_touching_and_null(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, None, 0.0, 1.0, 1.0)], "a_id int, a_minx double, a_miny double, a_maxx double, a_maxy double")
    b = spark.createDataFrame([(1, 10.0, 10.0, 20.0, 20.0), (2, 10.1, 0.0, 11.0, 1.0)], "b_id int, b_minx double, b_miny double, b_maxx double, b_maxy double")
    assert [tuple(r) for r in spatial.bbox_join(a, b, 5.0).select("a_id", "b_id").collect()] == [(1, 1)]


def test_bbox_join_is_an_equi_join(spark, plan_of):
    a, _ = boxes(spark, 10, 1, "a_", (5,))
    b, _ = boxes(spark, 10, 2, "b_", (5,))
    text = plan_of(spatial.bbox_join(a, b, 10.0))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("min_rows", [40, 200_000])
def test_counts_equal_the_join(spark, min_rows):
    def boxes(rows, prefix, seed):
        at = [F.floor(F.rand(seed + k) * 60).cast("double") for k in range(2)]
        side = F.when(F.col("id") % 7 == 0, 50.0).when(F.col("id") % 31 == 3, -2.0).otherwise(F.col("id") % 3)  # points and boxes the wrong way round as well
        low = F.when(F.col("id") % 11 != 5, at[0])
        return spark.range(rows).select((F.col("id") % 200).alias(f"{prefix}id"), "id", low.alias(f"{prefix}minx"), at[1].alias(f"{prefix}miny")).select(
            f"{prefix}id", f"{prefix}minx", f"{prefix}miny", (F.col(f"{prefix}minx") + side).alias(f"{prefix}maxx"), (F.col(f"{prefix}miny") + side).alias(f"{prefix}maxy")).localCheckpoint()

    a, b = boxes(900, "a_", 1), boxes(300, "b_", 5)
    counts = spatial.bbox_counts(a, b, 2.0, "b_id", min_rows=min_rows)
    plan = counts._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" in plan
    want = {r.b_id: r["count"] for r in spatial.bbox_join(a, b, 2.0).groupBy("b_id").count().collect()}
    assert {r.b_id: r.n for r in counts.collect()} == want and len(want) > 100


def test_tasks_follow_the_pairs_that_meet(spark, monkeypatch):
    """Few bytes that make many pairs are not merged into one task, with and without salts."""
    monkeypatch.setattr(spatial, "TASK_PAIRS", 10_000, raising=False)

    def side(p):
        x, y = (F.col("id") % 10).cast("double"), (F.floor(F.col("id") / 10) % 10).cast("double")
        return spark.range(4000).select(F.col("id").alias(f"{p}id"), *[
            (v * 10 + d).alias(f"{p}{n}") for n, v, d in (("minx", x, 1), ("miny", y, 1), ("maxx", x, 2), ("maxy", y, 2))])

    for min_rows in (20_000, 30):
        pairs = spatial.bbox_join(side("a_"), side("b_"), 10.0, min_rows=min_rows)
        told = pairs.groupBy(F.spark_partition_id()).count().collect()
        assert len(told) > 8 and sum(r["count"] for r in told) == 100 * 40 * 40


def sided(spark, rows, seed, prefix, sizes):
    """Boxes on whole numbers, so that many only touch; some are points, some end before they begin, some come twice."""
    rng = random.Random(seed)
    made = []
    for k in range(rows):
        x, y, side = rng.randint(-60, 60), rng.randint(-60, 60), rng.choice(sizes)
        made.append((k, float(x), float(y), float(x + side), float(y + rng.choice((side, 0, 1)))))
    made += [(rows + k, *r[1:]) for k, r in enumerate(made[:9])]
    return spark.createDataFrame(made, f"{prefix}id long, {prefix}minx double, {prefix}miny double, {prefix}maxx double, {prefix}maxy double"), made


def touching(left, right):
    return sorted((p[0], q[0]) for p in left for q in right if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])


def test_boxes_travel_once_for_all_levels(spark, plan_of, monkeypatch):
    """What the box join shuffles follows the boxes, not the levels on which they meet."""
    monkeypatch.setattr(spatial, "PLACES", 4, raising=False)
    a, ra = sided(spark, 600, 1, "a_", (1,))
    b, rb = sided(spark, 200, 2, "b_", (2, 4, 8, 16))
    df = spatial.bbox_join(a, b, 2.0)
    assert plan_of(df).split("===== Subqueries")[0].count("Exchange hashpartitioning") <= 1
    levels = spatial._levels(b, "b_", 2.0)
    assert sum(spatial._cells(a, "a_", 2.0, levels, above).count() for above in (0, 1)) > 4 * len(ra)
    level = spatial._place_level([(a, "a_"), (b, "b_")], 2.0, {0, *levels}, len(ra) + len(rb))
    assert level == 3 and spatial._placed(a, "a_", 2.0, level, levels).count() < 1.5 * len(ra)
    assert df.columns == a.columns + b.columns
    assert sorted((r.a_id, r.b_id) for r in df.collect()) == touching(ra, rb)


@pytest.mark.parametrize("level", [0, 2, 5])
def test_pairs_of_a_task_in_pieces(spark, monkeypatch, level):
    """Whatever a task takes, compares and hands on at once, and however far places are from the boxes' own levels."""
    a, ra = sided(spark, 300, 3, "a_", (0, 1, 2, 30, -3))
    b, rb = sided(spark, 200, 4, "b_", (0, 3, 9, 70, -1))
    (levels_a, _), (levels_b, _) = spatial._told(a, "a_", 2.0), spatial._told(b, "b_", 2.0)
    on, levels = ["_level", "_cx", "_cy"], sorted({*levels_a, *levels_b})
    none = F.lit(None).cast("long")
    both = spatial._placed(a, "a_", 2.0, level, levels_b).select(*on, F.lit(False).alias("_right"), "_own", *[F.col(f"a_{n}").alias(f"_{n}") for n in spatial.EDGES], "a_id", none.alias("b_id")).unionAll(
        spatial._placed(b, "b_", 2.0, level, levels_a).select(*on, F.lit(True), "_own", *[f"b_{n}" for n in spatial.EDGES], none, "b_id"))
    rows = both.orderBy(*on, F.desc("_right")).toArrow().combine_chunks()
    for chunk, matrix, compared, handed in ((100_000, 4096, 1 << 18, 1 << 16), (7, 1, 5, 3), (50, 1 << 40, 11, 20), (1, 9, 1 << 18, 1)):
        for name, value in (("CHUNK", chunk), ("MATRIX", matrix), ("COMPARED", compared), ("HANDED", handed)):
            monkeypatch.setattr(spatial, name, value)
        made = list(spatial._pairs(2.0, level, levels, on, ["a_id", "b_id"], {"b_id"})(rows.to_batches(max_chunksize=13)))
        assert all(m.num_rows <= max(handed, 1) for m in made)
        assert sorted((r["a_id"], r["b_id"]) for m in made for r in m.to_pylist()) == touching(ra, rb)


def test_bbox_join_of_other_numbers_and_columns(spark):
    """Decimals, infinite and very large numbers and types that Arrow does not carry take the equi-joins; other types go through."""
    a, ra = sided(spark, 80, 5, "a_", (1, 9))
    b, rb = sided(spark, 60, 6, "b_", (2, 30))
    want = touching(ra, rb)
    exact = a.select("a_id", *[F.col(f"a_{n}").cast("decimal(20,3)").alias(f"a_{n}") for n in spatial.EDGES])
    whole = a.select("a_id", *[F.col(f"a_{n}").cast("int").alias(f"a_{n}") for n in spatial.EDGES])
    odd = a.withColumn("a_time", F.expr("INTERVAL '1-2' YEAR TO MONTH"))
    wide = a.withColumns({"a_list": F.array(F.struct(F.col("a_id").alias("n"))), "a_at": F.lit("2020-01-02 03:04:05").cast("timestamp"), "a_none": F.lit(None).cast("binary")})
    for left in (exact, whole, odd, wide):
        df = spatial.bbox_join(left, b, 4.0)
        assert [f.dataType for f in df.schema] == [f.dataType for f in [*left.schema, *b.schema]]
        found = df.drop("a_time").collect()
        assert sorted((r.a_id, r.b_id) for r in found) == want
        if left is wide:
            assert all(r.a_list[0].n == r.a_id and r.a_at.minute == 4 and r.a_none is None for r in found)
    far = a.unionAll(spark.createDataFrame([(1000, 1e17, 1e17, 1e17 + 64, 1e17 + 64), (1001, float("nan"), 0.0, float("nan"), 1.0)], a.schema))
    assert sorted((r.a_id, r.b_id) for r in spatial.bbox_join(far, b, 4.0).collect()) == want
    assert spatial.bbox_join(a, b, 4.0, columns=["b_id", "a_minx"]).columns == ["a_minx", "b_id"]
    with pytest.raises(ValueError, match="no such columns"):
        spatial.bbox_join(a, b, 4.0, columns=["c"])


def test_crowded_places_are_salted_on_both_sides(spark):
    a, ra = sided(spark, 150, 7, "a_", (0, 1))
    b, rb = sided(spark, 90, 8, "b_", (1, 2))
    assert sorted((r.a_id, r.b_id) for r in spatial.bbox_join(a, b, 200.0, min_rows=10).collect()) == touching(ra, rb)
