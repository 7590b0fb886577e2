"""Small TIFF helpers for tasks: read a header by ranges, decode one block."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# TIFF tag numbers.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, STRIP_ROWS, STRIP_COUNTS, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
SAMPLE_FORMAT, PIXEL_SCALE, TIEPOINT, MATRIX, GEO_KEYS = 339, 33550, 33922, 34264, 34735
METADATA, NODATA, SUBFILE = 42112, 42113, 254

# Field type -> (size, struct code).
FIELD = {
    1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 7: (1, "B"),
    8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 13: (4, "I"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q"),
}
# Names of compressions, sample types and colours.
COMPRESSIONS = {
    1: "NONE", 2: "CCITTRLE", 3: "CCITTFAX3", 4: "CCITTFAX4", 5: "LZW", 6: "OJPEG", 7: "JPEG",
    8: "DEFLATE", 32773: "PACKBITS", 32946: "DEFLATE", 34887: "LERC", 34925: "LZMA", 50000: "ZSTD", 50001: "WEBP",
}
KINDS = {1: "uint", 2: "int", 3: "float"}
GEO_PROJECTED, GEO_GEOGRAPHIC = 3072, 2048


def _read(file, offset: int, size: int) -> bytes:
    file.seek(offset)
    data = file.read(size)
    if len(data) < size:
        raise ValueError("file ends early")
    return data


def _directory(file, order: str, big: bool, at: int) -> tuple[dict, int]:
    """One image file directory: tag -> values, and the offset of the next one."""
    head, entry, word = (8, 20, "Q") if big else (2, 12, "I")
    (count,) = struct.unpack(order + ("Q" if big else "H"), _read(file, at, head))
    file.seek(0, 2)
    if at + head + count * entry > file.tell():
        raise ValueError("file ends early: directory too long")
    body = _read(file, at + head, count * entry + struct.calcsize(word))
    tags = {}
    for i in range(count):
        raw = body[i * entry:(i + 1) * entry]
        tag, kind = struct.unpack(order + "HH", raw[:4])
        (n,) = struct.unpack(order + word, raw[4:4 + struct.calcsize(word)])
        if kind not in FIELD:
            continue
        size, code = FIELD[kind]
        room = struct.calcsize(word)
        inline = raw[-room:]
        data = inline[:size * n] if size * n <= room else _read(
            file, struct.unpack(order + word, inline)[0], size * n)
        if kind == 2:
            tags[tag] = data.rstrip(b"\0").decode("latin-1")
        elif kind == 5:
            pair = struct.unpack(order + "II" * n, data)
            tags[tag] = [a / b if b else 0.0 for a, b in zip(pair[::2], pair[1::2])]
        else:
            tags[tag] = list(struct.unpack(f"{order}{n}{code}", data))
    (following,) = struct.unpack(order + word, body[count * entry:])
    return tags, following


def header(file) -> dict:
    """Layout, georeference and block index of a TIFF file."""
    start = _read(file, 0, 4)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    magic = struct.unpack(order + "H", start[2:])[0] if order else 0
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    at = struct.unpack(order + ("Q" if big else "I"), _read(file, 8 if big else 4, 8 if big else 4))[0]
    directories, visited = [], set()
    while at and at not in visited:
        visited.add(at)
        tags, at = _directory(file, order, big, at)
        directories.append(tags)
    main = directories[0]

    def one(tag, default=None):
        return main.get(tag, [default])[0]

    # GeoTIFF: an affine matrix, or a scale with a tie point.
    transform = None
    if MATRIX in main:
        m = main[MATRIX]
        transform = [m[3], m[0], m[1], m[7], m[4], m[5]]
    elif PIXEL_SCALE in main and TIEPOINT in main:
        sx, sy = main[PIXEL_SCALE][:2]
        i, j, _, x, y = main[TIEPOINT][:5]
        transform = [x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy]
    keys = main.get(GEO_KEYS, [])
    codes = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    try:
        nodata = float(main[NODATA])
    except (KeyError, ValueError):
        nodata = None
    reduced = [d for d in directories[1:] if WIDTH in d and d.get(SUBFILE, [0])[0] & 1 and not d.get(SUBFILE, [0])[0] & 4]
    return {
        "driver": "GTiff", **_layout(main), "photometric": one(PHOTOMETRIC, 1), "nodata": nodata,
        "epsg": codes.get(GEO_PROJECTED, codes.get(GEO_GEOGRAPHIC)), "transform": transform,
        "overview_widths": [d[WIDTH][0] for d in reduced],
        "metadata": main.get(METADATA), "byte_order": order,
        # Largest first; those that store no cells of their own are of no use to a reader.
        "overviews": sorted((_layout(d) for d in reduced if d.keys() & {TILE_OFFSETS, STRIP_OFFSETS}), key=lambda d: -d["width"]),
    }


def _layout(tags: dict) -> dict:
    """Size, sample layout and block index of one image in the file."""

    def one(tag, default=None):
        return tags.get(tag, [default])[0]

    width, height, tiled = one(WIDTH), one(HEIGHT), TILE_WIDTH in tags
    kind = KINDS.get(one(SAMPLE_FORMAT, 1), "complex")
    return {
        "width": width, "height": height, "band_count": one(SAMPLES, 1), "dtype": f"{kind}{one(BITS, 1)}",
        "compression": COMPRESSIONS.get(one(COMPRESSION, 1), f"OTHER-{one(COMPRESSION, 1)}"),
        "interleave": "BAND" if one(PLANAR, 1) == 2 else "PIXEL", "tiled": "YES" if tiled else "NO",
        "block_x": one(TILE_WIDTH) if tiled else width,
        "block_y": one(TILE_HEIGHT) if tiled else min(one(STRIP_ROWS, height), height),
        "predictor": one(PREDICTOR, 1),
        "offsets": tags.get(TILE_OFFSETS if tiled else STRIP_OFFSETS, []),
        "counts": tags.get(TILE_COUNTS if tiled else STRIP_COUNTS, []),
    }


def decode(raw: bytes, dtype: str, order: str, compression: str, predictor: int,
           rows: int, columns: int, planes: int) -> np.ndarray:
    """One block as float32 ``(planes, rows, columns)``."""
    if compression == "DEFLATE":
        raw = zlib.decompress(raw)
    elif compression != "NONE":
        raise ValueError(f"compression {compression} is not supported")
    if predictor not in (1, 2):
        raise ValueError(f"predictor {predictor} is not supported")
    kind = np.dtype(dtype).newbyteorder(order)
    flat = np.frombuffer(raw, dtype=kind, count=rows * columns * planes)
    block = flat.reshape(rows, columns, planes)
    if predictor == 2:
        block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
    return np.ascontiguousarray(block.transpose(2, 0, 1)).astype(np.float32)
