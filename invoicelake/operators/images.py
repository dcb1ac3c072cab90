"""Image measurements: one Arrow batch function over picture rows, numpy per picture.

Pictures are rows (height, width, channels, data) with 8-bit BGR or grey pixels, as Spark's image source
gives them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.operators.registry import pending

# Fixed values of the measurements.
BGR_TO_GRAY = (0.114, 0.587, 0.299)
SKEW_LIMIT = 10.0
SKEW_STEP = 0.5
SKEW_SCALE = 4
INK = 128
PAD = 40
SIDE = 128
POOL = 4
MARK = 251
AT_ONCE = 256  # pictures whose results are held at once


def to_pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return pixels[:, :, 0] if channels == 1 else pixels[:, :, :3]


def gray(pixels: np.ndarray) -> np.ndarray:
    if pixels.ndim == 2:
        return pixels
    return np.floor(pixels @ np.array(BGR_TO_GRAY) + 0.5).astype(np.uint8)


def stretch(image: np.ndarray) -> np.ndarray:
    """Darkest pixel 0, lightest 255 (single precision, as 8-bit images are usually scaled)."""
    low, high = int(image.min()), int(image.max())
    if high == low:
        return np.zeros_like(image)
    scale = np.float32(255.0 / (high - low))
    return np.clip(np.rint(image * scale - low * scale), 0, 255).astype(np.uint8)


def blur_score(image: np.ndarray) -> float:
    """Variance of the 4-neighbour Laplacian; borders mirror without repeating the edge."""
    mode = "reflect" if min(image.shape) > 1 else "edge"
    p = np.pad(image.astype(float), 1, mode=mode)
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]
    return float(lap.var())


def otsu(image: np.ndarray) -> int:
    """Threshold with the largest variance between the classes "up to" and "above" it."""
    counts = np.bincount(image.ravel(), minlength=256).astype(float)
    below = np.cumsum(counts)
    above = below[-1] - below
    mass = np.cumsum(counts * np.arange(256))
    valid = (below > 0) & (above > 0)
    gap = np.where(valid, mass / np.maximum(below, 1) - (mass[-1] - mass) / np.maximum(above, 1), 0.0)
    return int(np.argmax(below * above * gap * gap))


def shrink(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Resize by area: every target pixel is the mean of the source area it covers."""
    def weights(source: int, target: int) -> np.ndarray:
        edges = np.arange(target + 1) * (source / target)
        cells = np.arange(source)
        cover = np.minimum(edges[1:, None], cells + 1) - np.maximum(edges[:-1, None], cells)
        return np.clip(cover, 0, None) * (target / source)

    return weights(image.shape[0], height) @ image.astype(float) @ weights(image.shape[1], width).T


def row_spread(points: np.ndarray, angle: float, height: int, width: int) -> float:
    """Variance of the ink per row when the ink points (x, y from the middle) are turned by ``angle`` degrees."""
    cosine, sine = np.cos(np.deg2rad(angle)), np.sin(np.deg2rad(angle))
    x, y = points.T
    across, down = np.rint(x * cosine - y * sine + width / 2), np.rint(height / 2 - (x * sine + y * cosine))
    seen = down[(across >= 0) & (across < width) & (down >= 0) & (down < height)].astype(int)
    return float(np.bincount(seen, minlength=height).var())


def skew_angle(image: np.ndarray) -> float:
    """Rotation at which the rows of ink differ most; the first of equal angles, from -10 to 10 degrees."""
    height, width = (max(side // SKEW_SCALE, 1) for side in image.shape)
    small = np.rint(shrink(image, height, width)).astype(np.uint8)
    points = np.argwhere(small <= otsu(small))[:, ::-1] - np.array([width, height]) / 2
    if not len(points):
        return 0.0
    angles = np.linspace(-SKEW_LIMIT, SKEW_LIMIT, round(2 * SKEW_LIMIT / SKEW_STEP) + 1)
    return float(angles[np.argmax([row_spread(points, angle, height, width) for angle in angles])])


def _extent(marked: np.ndarray) -> tuple[int, int]:
    """First and last marked place with a margin, inside the axis; the whole axis when none is marked."""
    if not marked.any():
        return 0, len(marked)
    first, last = int(marked.argmax()), len(marked) - 1 - int(marked[::-1].argmax())
    return max(first - PAD, 0), min(last + PAD, len(marked))


def content_box(binary: np.ndarray) -> tuple[int, int, int, int]:
    """(x0, y0, x1, y1) around the dark pixels with a margin, from the projections on both axes."""
    ink = binary < INK
    (left, right), (top, bottom) = _extent(ink.any(axis=0)), _extent(ink.any(axis=1))
    return left, top, right, bottom


def pooled(image: np.ndarray) -> np.ndarray:
    """Ink share on a 32 x 32 grid: resized to 128 x 128, then means of 4 x 4 blocks."""
    ink = 1.0 - np.rint(shrink(image, SIDE, SIDE)) / 255.0
    n = SIDE // POOL
    return ink.reshape(n, POOL, n, POOL).mean(axis=(1, 3)).ravel().astype(np.float32)


def pixel_sums(image: np.ndarray) -> tuple[int, int]:
    """Sum of the pixels, and the sum weighted by their places (mod ``MARK``), which tells moved pixels."""
    flat = image.ravel().astype(np.int64)
    return int(flat.sum()), int(flat @ (np.arange(len(flat)) % MARK))


# what is measured, from the grey picture and the stretched one
MEASURES = {
    "gray": ("gray_sum long, gray_mark long", lambda grey, clear: pixel_sums(grey)),
    "contrast": ("contrast_sum long, contrast_mark long", lambda grey, clear: pixel_sums(clear)),
    "skew_angle": ("skew_angle double", lambda grey, clear: (skew_angle(clear),)),
    "blur_score": ("blur_score double", lambda grey, clear: (blur_score(grey),)),
    "otsu": ("otsu int", lambda grey, clear: (otsu(clear),)),
    "content_box": ("x0 int, y0 int, x1 int, y1 int", lambda grey, clear: content_box(np.where(clear > otsu(clear), 255, 0))),
    "features": ("features array<float>", lambda grey, clear: (pooled(grey).tolist(),)),
}


def _measure(wanted: tuple[str, ...], width_of: int, height, width, channels, data) -> tuple:
    try:
        grey = gray(to_pixels(int(height), int(width), int(channels), data))
        clear = stretch(grey)
        return (*(value for name in wanted for value in MEASURES[name][1](grey, clear)), None)
    except Exception as problem:  # a broken picture is reported, the others go on
        return (None,) * width_of + (str(problem) or type(problem).__name__,)


def _slices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in frames of at most ``AT_ONCE``: a task's memory must not hang on the number of rows in a batch."""
    return (frame.iloc[k:k + AT_ONCE] for frame in frames for k in range(0, len(frame), AT_ONCE))


def measure(images: DataFrame, *wanted: str) -> DataFrame:
    """The ``wanted`` measurements (names of ``MEASURES``; all when none is named) of every picture next to its other columns;
    ``error`` is set where a picture is unreadable."""
    wanted = wanted or tuple(MEASURES)
    carried = [f for f in images.schema.fields if f.name not in ("height", "width", "channels", "data")]
    fields = ", ".join([*(MEASURES[name][0] for name in wanted), "error string"])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), fields])
    names, measured = [f.name for f in carried], [part.split() for part in fields.split(", ")]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(frames):
            out = frame[names].copy()
            rows = [_measure(wanted, len(measured) - 1, *r) for r in zip(frame["height"], frame["width"], frame["channels"], frame["data"])]
            for i, (column, kind) in enumerate(measured):
                cells = pd.Series([r[i] for r in rows], index=out.index, dtype=object)
                out[column] = cells.astype({"int": "Int32", "long": "Int64"}.get(kind, "object"))
            yield out

    return images.mapInPandas(batches, schema)


def quality_job(registry: DataFrame, images: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(image_quality rows, failures) of the ingested documents not measured yet.

    ``images`` carries doc_id. Both results come from one measurement: persist or store it when both are written.
    """
    todo = pending(registry, done).select("doc_id")
    measured = measure(images.join(todo, "doc_id", "left_semi"), "skew_angle", "blur_score", "content_box")
    box = F.struct("x0", "y0", "x1", "y1")
    good = measured.filter("error IS NULL").select(
        "doc_id", "skew_angle", "blur_score", F.lit(None).cast("string").alias("processed_path"), box.alias("content_box"))
    return good, measured.filter("error IS NOT NULL").select("doc_id", "error")
