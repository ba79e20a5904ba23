"""Page images as grey arrays: columns, entries, binarisation, skew and noise, with numpy alone."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Window and sensitivity of the local threshold, its range of deviation, and the angles tried against skew.
WINDOW, SENSITIVITY, DEVIATION = 25, 0.15, 128.0
ANGLES = np.arange(-5.0, 5.01, 0.5)
#: Parts of a page above and below which nothing is read, and the least height of an entry.
TOP, BOTTOM, LEAST_HEIGHT = 0.1, 0.9, 20


def png(image: np.ndarray) -> bytes:
    """An 8-bit grey image as PNG."""
    height, width = image.shape
    rows = np.concatenate([np.zeros((height, 1), np.uint8), image.astype(np.uint8)], axis=1).tobytes()

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def unpng(data: bytes) -> np.ndarray:
    """The grey image of an 8-bit grey PNG without interlacing; other kinds raise ValueError."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, body, head = 8, b"", None
    while at < len(data):
        (size,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
        at += 12 + size
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit grey PNG")
    width, height = head[:2]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width + 1)
    if not raw[:, 0].any():  # no row is filtered
        return raw[:, 1:].copy()
    out = np.zeros((height, width), np.uint8)
    for y in range(height):
        kind, line = raw[y, 0], raw[y, 1:].astype(np.int32)
        up = out[y - 1].astype(np.int32) if y else np.zeros(width, np.int32)
        if kind == 0:
            out[y] = line
        elif kind == 1:
            out[y] = np.cumsum(line) & 255
        elif kind == 2:
            out[y] = line + up & 255
        else:  # average and Paeth depend on the pixel before
            left = corner = 0
            for x in range(width):
                if kind == 3:
                    guess = (left + up[x]) // 2
                else:
                    p = left + up[x] - corner
                    guess = min((left, up[x], corner), key=lambda v: abs(p - v))
                left = int(line[x] + guess) & 255
                corner = int(up[x])
                out[y, x] = left
    return out


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    """Start and end (exclusive) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def column_count(image: np.ndarray, share: float = 0.15) -> int:
    """Runs of columns whose ink exceeds ``share`` of the darkest column's; at least 1."""
    if image.size == 0:
        return 1
    ink = (255 - image.astype(np.int64)).sum(axis=0)
    return max(1, len(_runs(ink > ink.max() * share)))


@F.pandas_udf(T.IntegerType())
def column_counts(data: pd.Series) -> pd.Series:
    """:func:`column_count` of each PNG; 1 where there is none or it cannot be read."""

    def one(b: bytes | None) -> int:
        try:
            return column_count(unpng(bytes(b)))
        except Exception:  # noqa: BLE001 - an estimate never fails a page
            return 1

    return data.map(one).astype("int32")


@F.pandas_udf(T.LongType())
def ink_sums(data: pd.Series) -> pd.Series:
    """All ink of each PNG, 255 for a black pixel; null where there is none or it cannot be read."""

    def one(b: bytes | None) -> int | None:
        try:
            return int((255 - unpng(bytes(b)).astype(np.int64)).sum())
        except Exception:  # noqa: BLE001
            return None

    return pd.Series([one(b) for b in data], dtype="Int64")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("y1", T.IntegerType()), T.StructField("y2", T.IntegerType())])))
def bands(data: pd.Series) -> pd.Series:
    """:func:`entries` of each PNG; none where it cannot be read."""

    def one(b: bytes | None) -> list[dict]:
        try:
            return [{"y1": y1, "y2": y2} for y1, y2 in entries(unpng(bytes(b)))]
        except Exception:  # noqa: BLE001
            return []

    return pd.Series([one(b) for b in data], dtype=object)


@F.pandas_udf(T.DoubleType())
def skews(data: pd.Series) -> pd.Series:
    """:func:`skew` of each PNG; null where there is none or it cannot be read."""

    def one(b: bytes | None) -> float | None:
        try:
            return skew(unpng(bytes(b)))
        except Exception:  # noqa: BLE001
            return None

    return pd.Series([one(b) for b in data], dtype="float64")


def columns(image: np.ndarray, ink: bool = False) -> list[tuple[int, int]]:
    """Column bounds, split in the middle of wide runs of sums below the 20th percentile; a run that the edge ends is none.

    The sums are of grey values, so low ones are dark; with ``ink=True`` they are of ink, so low ones are gutters.
    """
    sums = (255 - image.astype(np.int64) if ink else image.astype(np.int64)).sum(axis=0)
    low = sums < np.percentile(sums, 20)
    wide = [(a, b) for a, b in _runs(low) if b < len(low) and b - a > image.shape[0] * 0.8]
    if not wide:
        return [(0, image.shape[1])]
    bounds = [0, *((a + b) // 2 for a, b in wide), image.shape[1]]
    return list(zip(bounds, bounds[1:]))


def entries(image: np.ndarray, ink: bool = False) -> list[tuple[int, int]]:
    """Row bounds of the bands between rows whose sum is below the 10th percentile; a closed band must be longer than 5 rows, the
    one at the end longer than 1. ``ink`` as in :func:`columns`."""
    sums = (255 - image.astype(np.int64) if ink else image.astype(np.int64)).sum(axis=1)
    gaps = np.flatnonzero(sums < np.percentile(sums, 10)).tolist()
    starts = [0, *(g + 1 for g in gaps)]
    found = [(a, b) for a, b in zip(starts, gaps) if b - a > 5]
    return found + ([(starts[-1], len(sums))] if starts[-1] < len(sums) - 1 else [])


def slices(image: np.ndarray, doc_id: str, page: int, ink: bool = False) -> list[dict]:
    """The page's entries, numbered column by column, header and footer cut off; entries under 20 rows are left out unnumbered."""
    top, bottom = int(TOP * image.shape[0]), int(BOTTOM * image.shape[0])
    body, out = image[top:bottom], []
    for x1, x2 in columns(body, ink):
        for y1, y2 in entries(body[:, x1:x2], ink):
            if y2 - y1 >= LEAST_HEIGHT:
                box = {"x1": x1, "y1": y1 + top, "x2": x2, "y2": y2 + top}
                out.append({"slice_id": f"{doc_id}_p{page}_e{len(out)}", "page_num": page, "entry_index": len(out), "bbox": box, "image_bytes": png(body[y1:y2, x1:x2])})
    return out


def binarise(image: np.ndarray, window: int = WINDOW, k: float = SENSITIVITY, white_text: bool = True) -> np.ndarray:
    """Local threshold ``mean * (1 + k * (deviation / 128 - 1))`` over mirrored windows; pixels above it become 0, others 255
    (the other way round with ``white_text=False``)."""
    half = window // 2
    wide = np.pad(image.astype(np.float64), half + 1, mode="reflect")[:-1, :-1] if min(image.shape) > half + 1 else np.pad(image.astype(np.float64), half + 1, mode="symmetric")[:-1, :-1]

    def means(a: np.ndarray) -> np.ndarray:
        total = a.cumsum(0).cumsum(1)
        return (total[window:, window:] - total[:-window, window:] - total[window:, :-window] + total[:-window, :-window]) / window**2

    mean, square = means(wide), means(wide**2)
    mean, square = mean[: image.shape[0], : image.shape[1]], square[: image.shape[0], : image.shape[1]]
    limit = mean * (1 + k * (np.sqrt(np.maximum(square - mean**2, 0)) / DEVIATION - 1))
    above = image > limit
    return np.where(above, 0, 255).astype(np.uint8) if white_text else np.where(above, 255, 0).astype(np.uint8)


def rotate(image: np.ndarray, degrees: float, expand: bool = False, fill: int = 255) -> np.ndarray:
    """Rotated counter-clockwise about the centre, nearest pixel."""
    t = np.deg2rad(degrees)
    h, w = image.shape
    c, s = np.cos(t), np.sin(t)
    oh, ow = (int(np.ceil(abs(h * c) + abs(w * s) - 1e-9)), int(np.ceil(abs(w * c) + abs(h * s) - 1e-9))) if expand else (h, w)
    y, x = np.mgrid[:oh, :ow]
    dx, dy = x - (ow - 1) / 2, y - (oh - 1) / 2
    sx, sy = np.rint(c * dx - s * dy + (w - 1) / 2).astype(int), np.rint(s * dx + c * dy + (h - 1) / 2).astype(int)
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = np.full((oh, ow), fill, np.uint8)
    out[inside] = image[sy[inside], sx[inside]]
    return out


def skew(image: np.ndarray) -> float:
    """The angle whose rotation makes the row sums of ink vary most; the first of equal ones."""
    variances = [float(np.var((255.0 - rotate(image, a)).sum(axis=1))) for a in ANGLES]
    return float(ANGLES[int(np.argmax(variances))])


def deskew(image: np.ndarray) -> np.ndarray:
    angle = skew(image)
    return rotate(image, angle, expand=True) if angle else image


def denoise(image: np.ndarray) -> np.ndarray:
    """Median of each pixel's 3 x 3 neighbourhood, edges repeated."""
    wide = np.pad(image, 1, mode="edge")
    return np.median(np.stack([wide[y : y + image.shape[0], x : x + image.shape[1]] for y in range(3) for x in range(3)]), axis=0).astype(np.uint8)


def prepare(df: DataFrame) -> DataFrame:
    """``slice_id, image_bytes, error`` of slices (``slice_id, image_bytes``), binarised, straightened and denoised. A missing or
    unreadable image gives an error; a failed straightening keeps the binarised image."""

    def one(data: bytes | None) -> tuple[bytes | None, str | None]:
        if not data:
            return None, "no image"
        try:
            flat = binarise(unpng(bytes(data)))
        except Exception as e:  # noqa: BLE001 - one bad image must not end the job
            return None, f"{type(e).__name__}: {e}"
        try:
            straight = deskew(flat)
        except Exception:  # noqa: BLE001
            straight = flat
        return png(denoise(straight)), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [one(b) for b in batch["image_bytes"]]
            yield pd.DataFrame({"slice_id": batch["slice_id"], "image_bytes": [d[0] for d in done], "error": [d[1] for d in done]})

    return df.select("slice_id", "image_bytes").mapInPandas(run, "slice_id string, image_bytes binary, error string")


def layout(pages: DataFrame) -> DataFrame:
    """Slices of ``pages`` (``doc_id, page_num, image_bytes``): one row each; unreadable pages have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, p, b in zip(batch["doc_id"], batch["page_num"], batch["image_bytes"]):
                try:
                    out += [{"doc_id": d, **s} for s in slices(unpng(bytes(b)), d, int(p))]
                except Exception:  # noqa: BLE001
                    continue
            yield pd.DataFrame(out, columns=["doc_id", "slice_id", "page_num", "entry_index", "bbox", "image_bytes"])

    kind = "doc_id string, slice_id string, page_num int, entry_index int, bbox struct<x1:int,y1:int,x2:int,y2:int>, image_bytes binary"
    return pages.select("doc_id", "page_num", "image_bytes").mapInPandas(run, kind)
