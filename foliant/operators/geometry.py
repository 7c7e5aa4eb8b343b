"""How far a page is turned: the angle of the least rectangle around its ink."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


TOGETHER = 1 << 20  #: pixels of rasters that are measured at once; a larger raster alone


def thresholds(gray: np.ndarray) -> np.ndarray:
    """threshold() of each row of pixels."""
    places = gray + 256 * np.arange(len(gray))[:, None]
    counts = np.bincount(places.ravel(), minlength=256 * len(gray)).reshape(-1, 256).astype(np.float64)
    dark, total = np.cumsum(counts, 1), counts.sum(1, keepdims=True)
    sums = np.cumsum(counts * np.arange(256), 1)
    light = total - dark
    both = (dark > 0) & (light > 0)
    gap = np.divide(sums, dark, where=both, out=np.zeros_like(sums)) - np.divide(sums[:, -1:] - sums, light, where=both, out=np.zeros_like(sums))
    return np.argmax(np.where(both, dark * light * gap * gap, 0.0), 1)


def threshold(gray: np.ndarray) -> int:
    """The gray level that parts a raster's dark and light pixels best: the one with the greatest variance between the
    two sides, the first of ties; 0 where all pixels are alike. Ink is what is no lighter."""
    return int(thresholds(gray.reshape(1, -1))[0])


def _corners(listed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    if len(listed) < 3:
        return listed

    def side(ordered: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for x, y in ordered:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (y - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (x - out[-2][0]):
                out.pop()
            out.append((x, y))
        return out[:-1]

    return side(listed) + side(listed[::-1])


def hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull of points sorted by their first coordinate, then the second."""
    return np.array(_corners(list(map(tuple, points.tolist()))))


def least_rectangle_angle(raw: bytes | None, width: int | None, height: int | None) -> float | None:
    """Degrees, from -45 to below 45 and positive clockwise, by which a side of the smallest rectangle around the ink
    of an 8-bit gray raster is turned; null without ink or a raster. One side of such a rectangle lies on a side of the
    hull, and the hull's corners are among each row's first and last ink."""
    return least_rectangle_angles([raw], width, height)[0]


def least_rectangle_angles(raws: list[bytes | None], width: int | None, height: int | None) -> list[float | None]:
    """least_rectangle_angle() of rasters of one size: thresholds and ink of about TOGETHER pixels at once, rectangles of
    all hulls of as many corners at once."""
    out: list[float | None] = [None] * len(raws)
    n = int(width) * int(height) if width and height else 0
    there = [i for i, raw in enumerate(raws) if n and raw is not None and len(raw) >= n]
    at_once = max(1, TOGETHER // max(1, n))
    for at in range(0, len(there), at_once):
        own = there[at : at + at_once]
        hulls: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
        gray = np.stack([np.frombuffer(raws[i], np.uint8, n) for i in own])
        ink = (gray <= thresholds(gray)[:, None]).reshape(len(own), int(height), int(width))
        raster, row = np.nonzero(ink.any(2))
        lines = ink[raster, row]
        first, last = lines.argmax(1).tolist(), (int(width) - 1 - lines[:, ::-1].argmax(1)).tolist()
        cuts, rows = np.searchsorted(raster, np.arange(len(own) + 1)).tolist(), row.tolist()
        for k, i in enumerate(own):
            ends = []
            for j in range(cuts[k], cuts[k + 1]):
                ends += [(rows[j], first[j])] if first[j] == last[j] else [(rows[j], first[j]), (rows[j], last[j])]
            corners = _corners(ends)
            if len(corners) == 1:
                out[i] = 0.0
            elif corners:
                hulls.setdefault(len(corners), []).append((i, corners))
        for found in hulls.values():
            for (i, _), angle in zip(found, _angles(np.array([c for _, c in found])[:, :, ::-1].astype(np.float64)), strict=True):
                out[i] = round(float(angle), 3) + 0.0
    return out


def _angles(corners: np.ndarray) -> np.ndarray:
    """The angle of the least rectangle around each hull; corners: hull, corner, x and y."""
    edges = np.roll(corners, -1, 1) - corners
    along = edges / np.hypot(edges[..., 0], edges[..., 1])[..., None]
    across = np.stack([-along[..., 1], along[..., 0]], 2)
    extent = lambda axes: np.ptp(corners @ axes.transpose(0, 2, 1), axis=1)
    angles = (np.degrees(np.arctan2(along[..., 1], along[..., 0])) + 45) % 90 - 45
    areas = extent(along) * extent(across)
    least = areas <= areas.min(1, keepdims=True) * (1 + 1e-9) + 1e-9
    return np.take_along_axis(angles, np.argmin(np.where(least, np.abs(angles), np.inf), 1)[:, None], 1)[:, 0]


def skew_angles(df: DataFrame, key: str, raster: str = "raster", width: str = "width", height: str = "height") -> DataFrame:
    """(key, skew_angle_deg) of every raster."""
    kind = next(f.dataType.simpleString() for f in df.schema if f.name == key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [(None if w != w else int(w), None if h != h else int(h)) for w, h in zip(batch[width].astype(float), batch[height].astype(float), strict=True)]
            alike: dict[tuple, list[int]] = {}
            for i, size in enumerate(sizes):
                alike.setdefault(size, []).append(i)
            rasters, found = batch[raster].tolist(), [None] * len(sizes)
            for size, places in alike.items():
                for i, angle in zip(places, least_rectangle_angles([rasters[i] for i in places], *size), strict=True):
                    found[i] = angle
            yield pd.DataFrame({key: batch[key], "skew_angle_deg": pd.Series(found, dtype="float64", index=batch.index)})

    return df.select(key, raster, width, height).mapInPandas(run, f"{key} {kind}, skew_angle_deg double")
