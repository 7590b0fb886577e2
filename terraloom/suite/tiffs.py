"""A small TIFF writer, for fixtures only."""

from __future__ import annotations

import itertools
import struct
import zlib

import numpy as np

# Field types SHORT, LONG, DOUBLE, ASCII as (number, struct code).
SHORT, LONG, DOUBLE, ASCII = (3, "H"), (4, "I"), (12, "d"), (2, "s")
# Sample format by numpy kind.
FORMAT = {"u": 1, "i": 2, "f": 3}


def whole(data: np.ndarray, dtype: str) -> tuple[np.ndarray, str | None]:
    """Cells cut to whole numbers, and the number that stands for missing ones (NaN): the least that no cell has.

    The type grows where it has no number left.
    """
    gaps = np.isnan(data)
    if not gaps.any():
        return data.astype(dtype), None
    used = set(np.unique(data[~gaps]).astype(np.int64).tolist())
    free = next(n for n in itertools.count() if n not in used)
    return np.where(gaps, free, data).astype(np.promote_types(dtype, np.min_scalar_type(free))), str(free)


def encode(data: np.ndarray, order: str = "<", deflate: bool = False, tile: int = 0, rows_per_strip: int = 0,
           transform=None, epsg: int | None = None, nodata: str | None = None, overview: bool = False,
           planar: bool = False, compression: int | None = None, overviews=(), sparse=()) -> bytes:
    """``(band, row, column)`` as a TIFF with strips or square tiles.

    ``transform`` is (left, x size, top, y size); ``overviews`` are smaller arrays
    stored behind the image, ``overview`` is one without cells, and ``sparse``
    are block numbers of the image that are not stored.
    """
    layout = dict(order=order, deflate=deflate, tile=tile, rows_per_strip=rows_per_strip, planar=planar, compression=compression)
    tags, blocks = _image(data, **layout)
    blocks = [b"" if n in set(sparse) else b for n, b in enumerate(blocks)]
    if transform:
        left, sx, top, sy = transform
        tags[33550], tags[33922] = (DOUBLE, [sx, sy, 0.0]), (DOUBLE, [0.0, 0.0, 0.0, left, top, 0.0])
    if epsg:
        tags[34735] = (SHORT, [1, 1, 0, 1, 3072, 0, 1, epsg])
    if nodata is not None:
        tags[42113] = (ASCII, nodata.encode() + b"\0")
    images = [(tags, blocks)]
    if overview:
        images.append(({254: (LONG, [1]), 256: (LONG, [max(1, data.shape[2] // 2)]), 257: (LONG, [max(1, data.shape[1] // 2)])}, []))
    for smaller in overviews:
        tags, blocks = _image(smaller, **layout)
        images.append(({254: (LONG, [1]), **tags}, blocks))
    return _assemble(images, order)


def _image(data, order, deflate, tile, rows_per_strip, planar, compression):
    """Tags and blocks of one image; the places of the blocks come later."""
    bands, height, width = data.shape
    data = data.astype(data.dtype.newbyteorder(order))
    blocks = []
    for plane in ([data[b:b + 1] for b in range(bands)] if planar else [data]):
        step_y = tile or rows_per_strip or height
        step_x = tile or width
        for y in range(0, height, step_y):
            for x in range(0, width, step_x):
                part = plane[:, y:y + step_y, x:x + step_x]
                if tile:
                    full = np.zeros((plane.shape[0], tile, tile), dtype=data.dtype)
                    full[:, :part.shape[1], :part.shape[2]] = part
                    part = full
                raw = np.ascontiguousarray(part.transpose(1, 2, 0)).tobytes()
                blocks.append(zlib.compress(raw) if deflate else raw)
    tags = {
        256: (LONG, [width]), 257: (LONG, [height]), 258: (SHORT, [data.dtype.itemsize * 8] * bands),
        259: (SHORT, [compression or (8 if deflate else 1)]), 262: (SHORT, [2 if bands >= 3 else 1]),
        277: (SHORT, [bands]), 284: (SHORT, [2 if planar else 1]), 339: (SHORT, [FORMAT[data.dtype.kind]] * bands),
    }
    if tile:
        tags[322] = tags[323] = (LONG, [tile])
    else:
        tags[278] = (LONG, [rows_per_strip or height])
    return tags, blocks


def _assemble(images, order):
    """Header, all directories, then the blocks of all images in order."""

    def directories(places):
        out, at = b"", 8
        for n, ((tags, blocks), where) in enumerate(zip(images, places)):
            tags = dict(tags)
            if blocks:
                tiled = 322 in tags
                tags[324 if tiled else 273] = (LONG, where)
                tags[325 if tiled else 279] = (LONG, [len(b) for b in blocks])
            base = at + 2 + 12 * len(tags) + 4
            entries, extra = b"", b""
            for tag in sorted(tags):
                (kind, code), values = tags[tag]
                packed = values if code == "s" else struct.pack(f"{order}{len(values)}{code}", *values)
                value = packed.ljust(4, b"\0")
                if len(packed) > 4:
                    value = struct.pack(order + "I", base + len(extra))
                    extra += packed + b"\0" * (len(packed) % 2)
                entries += struct.pack(order + "HHI", tag, kind, len(values)) + value
            at = base + len(extra)
            out += struct.pack(order + "H", len(tags)) + entries + struct.pack(order + "I", at if n + 1 < len(images) else 0) + extra
        return out

    # The directories are as long whatever the places of the blocks.
    at = 8 + len(directories([[0] * len(blocks) for _, blocks in images]))
    places = []
    for _, blocks in images:
        places.append([])
        for block in blocks:
            places[-1].append(at if block else 0)
            at += len(block)
    head = {"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, 8)
    return head + directories(places) + b"".join(b for _, blocks in images for b in blocks)
