"""Images in the image source's struct: hashes, sizes, grey values, and crop and deskew, by Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """(channels, height, width), red first."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.ascontiguousarray((x[:, :, ::-1] if channels == 3 else x).transpose(2, 0, 1))


def resized(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear between pixel centres, without smoothing."""
    c, h, w = image.shape
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None], x - x0
    im = image.astype(float)
    top = im[:, y0][:, :, x0] * (1 - fx) + im[:, y0][:, :, x1] * fx
    low = im[:, y1][:, :, x0] * (1 - fx) + im[:, y1][:, :, x1] * fx
    return np.clip(np.rint(top * (1 - fy) + low * fy), 0, 255).astype(np.uint8)


def grey(image: np.ndarray) -> np.ndarray:
    """One channel: 0.299 red + 0.587 green + 0.114 blue; a single channel stays, of two the first."""
    if image.shape[0] < 3:
        return image[:1]
    return np.rint(np.tensordot(np.array([0.299, 0.587, 0.114]), image[:3].astype(float), 1))[None].astype(np.uint8)


def perceptual_hash(image: np.ndarray, size: int = 8) -> str:
    """Hex of size * size bits: low frequencies of a cosine transform of a small grey image, against their median."""
    n = 4 * size
    small = resized(grey(image), n, n)[0].astype(float)
    k = np.arange(n)
    cosines = np.cos(np.pi * k[:, None] * (2 * k + 1) / (2 * n))
    low = (cosines @ small @ cosines.T)[:size, :size]
    bits = (low > np.median(low)).ravel()
    return np.packbits(bits).tobytes().hex()


def content_box(image: np.ndarray, *, threshold: int = 24, padding: float = 0.02, least_side: int = 256, least_area: float = 0.60, most_margin: float = 0.25) -> tuple[tuple[int, int, int, int], bool]:
    """(left, top, right, bottom) of what differs from the border's shade, with padding; and whether it had to be widened
    to keep its least side and area, or a margin was too wide."""
    g = grey(image)[0].astype(int)
    h, w = g.shape
    border = np.concatenate([g[0], g[-1], g[:, 0], g[:, -1]])
    mask = g < 255 - threshold if border.mean() >= 128 else g > threshold
    if not mask.any():
        return (0, 0, w, h), False
    rows, columns = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    px, py = int(round(padding * w)), int(round(padding * h))
    box = [max(0, columns[0] - px), max(0, rows[0] - py), min(w, columns[-1] + 1 + px), min(h, rows[-1] + 1 + py)]
    wide = [min(box[0], int(most_margin * w)), min(box[1], int(most_margin * h)), max(box[2], w - int(most_margin * w)), max(box[3], h - int(most_margin * h))]
    clamped = wide != box
    if wide[2] - wide[0] < min(least_side, w) or wide[3] - wide[1] < min(least_side, h) or (wide[2] - wide[0]) * (wide[3] - wide[1]) < least_area * w * h:
        return (0, 0, w, h), True
    return tuple(int(v) for v in wide), clamped


def rotated(image: np.ndarray, degrees: float, fill: int = 255) -> np.ndarray:
    """Turned about the centre, nearest pixel."""
    c, h, w = image.shape
    a = np.deg2rad(degrees)
    y, x = np.mgrid[:h, :w]
    dy, dx = y - (h - 1) / 2, x - (w - 1) / 2
    sy = np.rint(np.cos(a) * dy + np.sin(a) * dx + (h - 1) / 2).astype(int)
    sx = np.rint(-np.sin(a) * dy + np.cos(a) * dx + (w - 1) / 2).astype(int)
    inside = (sy >= 0) & (sy < h) & (sx >= 0) & (sx < w)
    out = np.full_like(image, fill)
    out[:, inside] = image[:, sy[inside], sx[inside]]
    return out


def skew(image: np.ndarray, *, most: float = 3.0, step: float = 0.5) -> tuple[float, float]:
    """Angle whose rows of pixels differ most from one to the next, and how far it leads the second best."""
    dark = 255 - grey(image)
    angles = np.arange(-most, most + step / 2, step)
    score = np.array([np.abs(np.diff(rotated(dark, a, 0)[0].astype(float).sum(1))).mean() for a in angles])
    order = np.argsort(-score, kind="stable")
    lead = (score[order[0]] - score[order[1]]) / score[order[0]] if score[order[0]] > 0 else 0.0
    return float(angles[order[0]]), float(lead)


def transformed(image: np.ndarray, *, least_confidence: float = 0.15) -> np.ndarray:
    left, top, right, bottom = content_box(image)[0]
    out = image[:, top:bottom, left:right]
    angle, confidence = skew(out)
    return rotated(out, angle) if abs(angle) > 1e-6 and confidence >= least_confidence else out


def described(images: DataFrame, *, size: int = 8) -> DataFrame:
    """origin, height, width, phash, box, angle, confidence, error of rows of the image source; bad images have an error."""

    def one(r: dict) -> tuple:
        if r["height"] <= 0 or r["nChannels"] <= 0:
            return (r["origin"], None, None, None, None, None, None, "not an image")
        image = pixels(bytes(r["data"]), r["height"], r["width"], r["nChannels"])
        angle, confidence = skew(image)
        return (r["origin"], r["height"], r["width"], perceptual_hash(image, size), list(content_box(image)[0]), angle, confidence, None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([one(r) for r in batch.to_dict("records")], columns=["origin", "height", "width", "phash", "box", "angle", "confidence", "error"]).astype({"height": "Int32", "width": "Int32"})

    return images.select(F.col("image.*")).mapInPandas(run, "origin string, height int, width int, phash string, box array<int>, angle double, confidence double, error string")
