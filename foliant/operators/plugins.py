"""Injected functions: enrichment by callables, staged fallbacks, pixel metrics."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.sources.calls import called

PASSED_ON = 256  #: rows of finished calls that are passed on together


def enrich(df: DataFrame, key: str, inputs: list[str], fn: Callable[[dict], dict | None], schema: str, width: int = 1, deadline: float | None = None, budget: float | None = None) -> DataFrame:
    """(key, fields of schema, status): fn on each row's inputs; None is `not_found`, an exception `error`, and
    neither fails the task. schema: DDL of the fields that fn returns. A task makes `width` calls at a time, each with a
    deadline, and all within its budget of seconds (calls.called())."""
    from pyspark.sql import types as T

    names = T._parse_datatype_string(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch.to_dict("records"))
        held: list[dict] = []
        for row, found, status in called(rows, lambda row: fn({k: row[k] for k in inputs}) or None, width, deadline, budget):
            held.append({key: row[key], **{n: (found or {}).get(n) for n in names}, "status": status})
            if len(held) >= PASSED_ON:
                yield pd.DataFrame(held, columns=[key, *names, "status"])
                held = []
        yield pd.DataFrame(held, columns=[key, *names, "status"])

    kind = next(f.dataType.simpleString() for f in df.schema if f.name == key)
    return df.select(key, *[c for c in inputs if c != key]).mapInPandas(run, f"{key} {kind}, {schema}, status string")


def staged(df: DataFrame, key: str, stages: list[tuple[str, DataFrame]], field: str) -> DataFrame:
    """df with `field` and `stage`: the first stage that found something for the key."""
    for name, side in stages:
        df = df.join(side.where(F.col("status") == "success").select(key, F.col(field).alias(f"_{name}")), key, "left")
    found = F.coalesce(*[F.col(f"_{n}") for n, _ in stages])
    stage = reduce(lambda acc, n: F.when(F.col(f"_{n}").isNotNull(), n).otherwise(acc), [n for n, _ in reversed(stages)], F.lit("none"))
    return df.withColumn(field, found).withColumn("stage", stage).drop(*[f"_{n}" for n, _ in stages])


def gray_metrics(raw: bytes | None, width: int | None, height: int | None, dark: int = 128) -> dict | None:
    """Density of ink, black-to-white ratio, contrast, blur (variance of the Laplacian) and rows that staff lines may
    be, of an 8-bit gray raster."""
    if raw is None or not width or not height or len(raw) < width * height:
        return None
    g = np.frombuffer(raw, np.uint8, width * height).reshape(int(height), int(width)).astype(np.float64)
    ink = g < dark
    black, white = int(ink.sum()), int((~ink).sum())
    lap = g[1:-1, :-2] + g[1:-1, 2:] + g[:-2, 1:-1] + g[2:, 1:-1] - 4 * g[1:-1, 1:-1] if min(g.shape) > 2 else np.zeros(1)
    rows = ink.mean(1) >= 0.40
    lines = int((rows & ~np.r_[False, rows[:-1]]).sum())
    return {
        "text_density": round(black / g.size, 6),
        "black_white_ratio": round(black / white, 6) if white else None,
        "contrast_std": round(float(g.std()), 4),
        "blur_variance": round(float(lap.var()), 4),
        "staff_line_count": lines,
        "has_staves": lines >= 5,
    }


def skew_angle(raw: bytes | None, width: int | None, height: int | None, dark: int = 128, reach: float = 5.0, step: float = 0.5) -> float | None:
    """The shear, in degrees, under which rows of ink are sharpest; null without enough ink."""
    if raw is None or not width or not height or len(raw) < width * height:
        return None
    y, x = np.nonzero(np.frombuffer(raw, np.uint8, width * height).reshape(int(height), int(width)) < dark)
    if len(y) < 50:
        return None
    best = (-1.0, 0.0)
    for angle in np.arange(-reach, reach + step / 2, step):
        rows = np.round(y + x * np.tan(np.radians(angle))).astype(np.int64)
        sharp = float((np.bincount(rows - rows.min()).astype(np.float64) ** 2).sum())
        best = max(best, (sharp, float(angle)), key=lambda b: (b[0], -abs(b[1])))
    return round(best[1], 2)


def pixel_metrics(df: DataFrame, key: str, raster: str = "raster", width: str = "width", height: str = "height") -> DataFrame:
    fields = "text_density double, black_white_ratio double, contrast_std double, blur_variance double, staff_line_count int, has_staves boolean"
    return enrich(df, key, [raster, width, height], lambda r: gray_metrics(r[raster], r[width], r[height]), fields)


#: The share of a page that an image covers, and the characters of text, from and below which it is a scan.
SCAN_COVERAGE, SCAN_TEXT = 0.6, 30


def image_based(coverage: Column, text_length: Column) -> Column:
    return F.coalesce((coverage >= SCAN_COVERAGE) & (F.coalesce(text_length, F.lit(0)) < SCAN_TEXT), F.lit(False))


def estimated_dpi(image_pixels: Column, width_points: Column) -> Column:
    return F.when(width_points > 0, F.round(image_pixels / (width_points / 72), 1))


def orientation(width: Column, height: Column) -> Column:
    return F.when(width > height, "landscape").when(width < height, "portrait").otherwise("square")


def known_names(names: Column, known: list[str]) -> Column:
    """Names that the dictionary knows, in order, each once."""
    return F.array_distinct(F.filter(names, lambda x: x.isin(known)))


def available(df: DataFrame, paths: DataFrame, column: str = "thumbnail_path") -> DataFrame:
    """df with a flag for paths that exist."""
    there = paths.select(column).distinct().withColumn("thumbnail_available", F.lit(True))
    return df.join(there, column, "left").withColumn("thumbnail_available", F.coalesce("thumbnail_available", F.lit(False)))
