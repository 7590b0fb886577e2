"""Neighbourhood operators on pixel rows.

Pixels are cut into square blocks; a pixel close to a block's edge is copied to
the neighbouring blocks (the halo).  One shuffle by block then serves every
following pass, because the windows of all passes are partitioned by block
plus a line of the block.  Groups are bounded by the block size, whatever the
shape of the raster or the share of one scene.

Cells must be unique per scene.  A cell without a row counts as outside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from terraloom.functions import indices

BLOCK = 512
SCENE = ("scene",)


def with_halo(px: DataFrame, halo: int, block: int = BLOCK, scene=SCENE) -> DataFrame:
    """Assign pixels to blocks (``_block``, ``_bx, _by``), copying ``halo`` border cells."""
    if halo > block:
        raise ValueError("halo must not exceed the block size")

    def targets(axis):
        return F.explode(F.sequence(
            F.floor((F.col(axis) - halo) / block), F.floor((F.col(axis) + halo) / block)
        ))

    # The shuffle key is one hash column: a constant scene column would be folded
    # away from the windows' keys but not from the shuffle's, and each pass would
    # shuffle again.
    return (
        px.withColumn("_bx", targets("x"))
        .withColumn("_by", targets("y"))
        .withColumn("_block", F.xxhash64(*scene, "_bx", "_by"))
        .repartition("_block")
    )


def core(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """Drop the halo copies."""
    return df.filter(
        (F.floor(F.col("x") / block) == F.col("_bx")) & (F.floor(F.col("y") / block) == F.col("_by"))
    ).drop("_block", "_bx", "_by")


def in_blocks(px: DataFrame, halo: int, *steps, block: int = BLOCK, scene=SCENE) -> DataFrame:
    """Run several neighbourhood steps on one shuffle.

    ``halo`` must cover the steps' reaches added up where one reads what an
    earlier one wrote, else the largest of them.
    """
    df = with_halo(px, halo, block, scene)
    for step in steps:
        df = step(df)
    return core(df, block)


class Line:
    """Previous and next cell along one axis of a block."""

    def __init__(self, axis: str, scene=SCENE):
        other = "y" if axis == "x" else "x"
        self.axis = axis
        self.window = Window.partitionBy("_block", *scene, "_bx", "_by", other).orderBy(axis)

    def _step(self, shift, name: str, offset: int) -> Column:
        adjacent = shift(self.axis, 1).over(self.window) == F.col(self.axis) + offset
        return F.when(adjacent, shift(name, 1).over(self.window))

    def before(self, name: str) -> Column:
        return self._step(F.lag, name, -1)

    def after(self, name: str) -> Column:
        return self._step(F.lead, name, 1)


def slope(px: DataFrame, value: str = "dem", res_x=1.0, res_y=1.0, fmt: str = "degrees",
          method: str = "horn", edge: str = "replicate", out: str = "slope",
          block: int = BLOCK, scene=SCENE) -> DataFrame:
    """Slope of a surface.

    ``method="horn"`` is the 3x3 Horn gradient in map units; ``"gradient"`` is
    the central difference in index units (one-sided at the edges).  ``fmt`` is
    ``degrees``, ``percent`` or ``rise_run``.  ``edge="null"`` leaves cells
    without eight neighbours empty instead of replicating the edge.
    """
    step = slope_step(value, res_x, res_y, fmt, method, edge, out, scene)
    return in_blocks(px, 1, step, block=block, scene=scene)


def slope_step(value="dem", res_x=1.0, res_y=1.0, fmt="degrees", method="horn", edge="replicate",
               out="slope", scene=SCENE):
    """The step behind ``slope``; reach 1."""
    if method not in ("horn", "gradient") or fmt not in ("degrees", "percent", "rise_run"):
        raise ValueError(f"unknown slope method {method!r} or format {fmt!r}")
    if edge not in ("replicate", "null"):
        raise ValueError(f"edge must be 'replicate' or 'null', not {edge!r}")
    return lambda df: _slope(df, value, res_x, res_y, fmt, method, edge, out, scene)


def _slope(df, value, res_x, res_y, fmt, method, edge, out, scene):
    kept = [c for c in df.columns if c != out]
    across, down = Line("x", scene), Line("y", scene)
    df = df.withColumn("_v", indices.known(F.col(value).cast("double")))
    df = df.withColumns({"_l": across.before("_v"), "_r": across.after("_v")})
    left, right = F.coalesce("_l", "_v"), F.coalesce("_r", "_v")
    if method == "horn":
        df = df.withColumns({
            "_dx": right - left,
            "_sx": left + 2 * F.col("_v") + right,
            "_full": F.col("_l").isNotNull() & F.col("_r").isNotNull(),
        })
        df = df.withColumns({
            f"_{side}{name}": step(f"_{name}")
            for side, step in (("u", down.before), ("d", down.after))
            for name in ("dx", "sx", "full")
        })
        gx = (F.coalesce("_udx", "_dx") + 2 * F.col("_dx") + F.coalesce("_ddx", "_dx")) / (8 * F.lit(res_x))
        gy = (F.coalesce("_dsx", "_sx") - F.coalesce("_usx", "_sx")) / (8 * F.lit(res_y))
        inside = indices.is_true(F.col("_full") & F.col("_ufull") & F.col("_dfull"))
    else:
        df = df.withColumns({"_u": down.before("_v"), "_d": down.after("_v")})

        def half(low, high):
            both = F.col(low).isNotNull() & F.col(high).isNotNull()
            return (F.coalesce(high, "_v") - F.coalesce(low, "_v")) / F.when(both, 2.0).otherwise(1.0)

        gx, gy = half("_l", "_r"), half("_u", "_d")
        inside = indices.is_true(
            F.col("_l").isNotNull() & F.col("_r").isNotNull()
            & F.col("_u").isNotNull() & F.col("_d").isNotNull()
        )
    run = F.sqrt(gx * gx + gy * gy)
    result = {"degrees": F.degrees(F.atan(run)), "percent": run * 100, "rise_run": run}[
        fmt if method == "horn" else "rise_run"
    ]
    if edge == "null":
        result = F.when(inside, result)
    return df.withColumn(out, result).select(*kept, out)


def classify_slope(px: DataFrame, threshold: float = 5.0, value: str = "slope",
                   out: str = "slope_class") -> DataFrame:
    return px.withColumn(out, indices.slope_class(F.col(value), threshold))


def _close_bits(df: DataFrame, bits: str, element: str, iterations: int, scene) -> DataFrame:
    """Binary closing of every bit of ``bits`` at once, inside the blocks.

    Dilation is OR over the element, erosion is AND with absent cells as 0, so
    one pass serves all classes of a class raster.
    """
    lines = {axis: Line(axis, scene) for axis in "xy"}
    zero = F.lit(0).cast("long")

    def around(axis):
        return [F.coalesce(step(bits), zero) for step in (lines[axis].before, lines[axis].after)]

    def along(df, axis, grow):
        a, b = around(axis)
        mine = F.col(bits)
        both = mine.bitwiseOR(a).bitwiseOR(b) if grow else mine.bitwiseAND(a).bitwiseAND(b)
        return df.withColumn("_next", both).withColumn(bits, F.col("_next")).drop("_next")

    def cross(df, first, second, grow):
        merge = Column.bitwiseOR if grow else Column.bitwiseAND
        a, b = around(first)
        df = df.withColumn("_side", merge(a, b))
        a, b = around(second)
        df = df.withColumn("_next", merge(merge(F.col(bits), F.col("_side")), merge(a, b)))
        return df.withColumn(bits, F.col("_next")).drop("_next", "_side")

    if element == "square":
        # Separable: x, y, y, x keeps one local sort between the two halves.
        for axis, grow in (("x", True), ("y", True), ("y", False), ("x", False)):
            for _ in range(iterations):
                df = along(df, axis, grow)
    elif element == "cross":
        order = ("x", "y")
        for grow in (True, False):
            for _ in range(iterations):
                df = cross(df, *order, grow)
                order = order[::-1]
    else:
        raise ValueError(f"element must be 'square' or 'cross', not {element!r}")
    return df


def closing(px: DataFrame, mask: str, element: str = "square", iterations: int = 1,
            out: str = "closed", block: int = BLOCK, scene=SCENE) -> DataFrame:
    """Binary closing of a boolean column; outside counts as 0 for both steps."""
    kept = [c for c in px.columns if c != out]
    df = px.withColumn("_bits", F.when(F.col(mask), 1).otherwise(0).cast("long"))
    df = with_halo(df, 2 * iterations, block, scene)
    df = core(_close_bits(df, "_bits", element, iterations, scene), block)
    return df.withColumn(out, F.col("_bits") == 1).select(*kept, out)


def clean_classes(px: DataFrame, value: str = "class", iterations: int = 2,
                  element: str = "cross", out: str = "cleaned",
                  block: int = BLOCK, scene=SCENE, codes=None) -> DataFrame:
    """Close each class; where closed classes overlap the higher wins.

    Codes from 1 to 62 need no list; with ``codes`` any positive ones may occur.
    A code that is neither raises an error, so none is ever mistaken for another.
    """
    step = clean_step(value, iterations, element, out, scene, codes)
    return in_blocks(px, 2 * iterations, step, block=block, scene=scene)


def clean_step(value="class", iterations=2, element="cross", out="cleaned", scene=SCENE, codes=None):
    """The step behind ``clean_classes``; reach ``2 * iterations``."""
    codes = sorted(codes or range(1, 63))
    known, kind = set(codes), "tinyint" if codes[-1] < 128 else "int"
    groups = [codes[i:i + 62] for i in range(0, len(codes), 62)]

    def step(df):
        kept = [c for c in df.columns if c != out]
        code = F.col(value).cast("int")
        allowed = (code <= 0) | code.isNull() | (
            code.isin(*known) if codes != list(range(1, 63)) else code <= 62)
        code = F.when(allowed, code).otherwise(F.raise_error(F.concat(F.lit("class not among the codes: "), code)))
        closed = code
        for group in groups:
            at = code if group == list(range(1, 63)) else F.array_position(F.lit(group), code)
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))
            df = df.withColumn("_bits", F.when((code > 0) & (at > 0), bit).otherwise(F.lit(0)).cast("long"))
            df = _close_bits(df, "_bits", element, iterations, scene)
            top = F.length(F.bin("_bits")) - 1
            name = f"_top{group[0]}"
            df = df.withColumn(name, F.when(F.col("_bits") > 0, top if at is code else F.element_at(F.lit(group), top)))
            closed = F.coalesce(F.col(name), closed)
        return df.withColumn(out, closed.cast(kind)).select(*kept, out)

    return step


def select_by_height(px: DataFrame, mask: str, min_height: float, max_height: float | None = None,
                     height: str = "ndsm", out: str = "selected",
                     block: int = BLOCK, scene=SCENE) -> DataFrame:
    """Mask cells inside the height range (both ends included), closed 3x3."""
    df = px.withColumn("_tall", indices.is_true(F.col(mask)) & indices.height_mask(F.col(height), min_height, max_height))
    return closing(df, "_tall", "square", 1, out, block, scene).drop("_tall")
