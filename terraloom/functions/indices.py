"""Pixel-local raster arithmetic as column expressions.

Each function works on scalar columns.  ``over_arrays`` lifts one of them to
tile arrays, so a tile never has to be exploded for pointwise work.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Thresholds and class codes of the classification rules.
VEGETATION_NDVI = 0.35
URBAN_NDVI = 0.2
URBAN_BRIGHTNESS = 1.0
CLASS_LABELS = {
    0: "Ground/Bare",
    1: "Non-vegetation objects",
    2: "Low vegetation",
    3: "High vegetation (trees)",
}
TWO_CLASS_LABELS = {0: "Non-vegetation", 1: "Vegetation"}


def known(value: Column) -> Column:
    """NaN becomes null: Spark sorts NaN above every number, rasters must not."""
    return F.when(~F.isnan(value), value)


def is_true(condition: Column) -> Column:
    """A comparison with missing data is false."""
    return F.coalesce(condition, F.lit(False))


def clip(value: Column, low: float = -1.0, high: float = 1.0) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def normalized_difference(a: Column, b: Column, zero: str = "null") -> Column:
    """(a - b) / (a + b).

    ``zero="null"`` leaves cells with a zero denominator empty;
    ``zero="zero"`` divides those by one and clips the result to [-1, 1].
    """
    a, b = known(a.cast("double")), known(b.cast("double"))
    total = a + b
    if zero == "null":
        return F.when(total != 0, (a - b) / total)
    if zero == "zero":
        return clip((a - b) / F.when(total == 0, F.lit(1.0)).otherwise(total))
    raise ValueError(f"zero must be 'null' or 'zero', not {zero!r}")


def ndvi(nir: Column, red: Column, zero: str = "null") -> Column:
    return normalized_difference(nir, red, zero)


def ndwi(green: Column, nir: Column, zero: str = "null") -> Column:
    return normalized_difference(green, nir, zero)


def brightness(red: Column, green: Column, blue: Column) -> Column:
    r, g, b = (known(c.cast("double")) for c in (red, green, blue))
    return F.sqrt(r * r + g * g + b * b)


def urban_index(index: Column, bright: Column) -> Column:
    return bright * (F.lit(1.0) - index)


def urban_mask(index: Column, bright: Column) -> Column:
    return is_true((index < URBAN_NDVI) & (bright > URBAN_BRIGHTNESS)).cast("tinyint")


def height_above_ground(dsm: Column, dem: Column) -> Column:
    """dsm - dem with negative heights set to zero; missing stays missing."""
    diff = known(dsm.cast("double")) - known(dem.cast("double"))
    return F.when(diff.isNotNull(), F.greatest(diff, F.lit(0.0)))


def threshold_mask(index: Column, value: float, greater: bool = True) -> Column:
    index = known(index)
    return is_true(index > value if greater else index < value)


def vegetation_mask(index: Column, value: float = VEGETATION_NDVI) -> Column:
    return threshold_mask(index, value)


def height_mask(height: Column, low: float, high: float | None = None) -> Column:
    """Both ends are inclusive."""
    height = known(height)
    inside = height >= low
    return is_true(inside if high is None else inside & (height <= high))


def landcover(index: Column, height: Column | None = None, index_value: float = 0.3,
              height_value: float = 3.5, max_height: float | None = None) -> Column:
    """Class codes of ``CLASS_LABELS``; without heights 1 is vegetation, 0 is not.

    Vegetation higher than ``max_height`` is class 0.
    """
    index = known(index)
    green = index > index_value
    if height is None:
        return F.when(green, 1).otherwise(0).cast("tinyint")
    height = known(height)
    tall = height > height_value
    tree = green & tall if max_height is None else green & tall & (height <= max_height)
    return (
        F.when(tree, 3)
        .when(green & (height <= height_value), 2)
        .when((index <= index_value) & tall, 1)
        .otherwise(0)
        .cast("tinyint")
    )


def slope_class(slope: Column, threshold: float = 5.0) -> Column:
    """0 flat, 1 sloped."""
    return F.when(known(slope) < threshold, 0).otherwise(1).cast("tinyint")


def stretch(value: Column, low: Column, high: Column) -> Column:
    span = high - low
    return clip(F.when(span != 0, (value - low) / span), 0.0, 1.0)


def hsv(red: Column, green: Column, blue: Column) -> tuple[Column, Column, Column]:
    """Hue 0..179, saturation and value 0..255 from 8-bit bands."""
    r, g, b = (c.cast("double") for c in (red, green, blue))
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = top - low
    degrees = (
        F.when(span == 0, F.lit(0.0))
        .when(top == r, 60 * (g - b) / F.nullif(span, F.lit(0.0)))
        .when(top == g, 120 + 60 * (b - r) / F.nullif(span, F.lit(0.0)))
        .otherwise(240 + 60 * (r - g) / F.nullif(span, F.lit(0.0)))
    )
    degrees = F.when(degrees < 0, degrees + 360).otherwise(degrees)
    hue = F.round(degrees / 2).cast("int") % 180
    saturation = F.when(top == 0, F.lit(0.0)).otherwise(255 * span / F.nullif(top, F.lit(0.0)))
    return hue, F.round(saturation).cast("int"), F.round(top).cast("int")


def over_arrays(fn, *arrays: Column) -> Column:
    """Apply a scalar column function element by element to equal-length arrays."""
    if len(arrays) == 1:
        return F.transform(arrays[0], lambda a: fn(a))
    if len(arrays) == 2:
        return F.zip_with(arrays[0], arrays[1], lambda a, b: fn(a, b))
    names = [f"a{i}" for i in range(len(arrays))]
    zipped = F.arrays_zip(*[a.alias(n) for a, n in zip(arrays, names)])
    return F.transform(zipped, lambda s: fn(*[s[n] for n in names]))

