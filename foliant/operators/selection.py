"""Exact quantiles of a whole column in bounded memory."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW = 10_000  #: values that are sorted in one task
ACCURACY = 5_000  #: of the sketches that cuts are taken from


def ranked_value(values: DataFrame, rank: int, few: int | None = None) -> float:
    """The value at a place, from 0, of the sorted column v of `values`, which has no nulls and holds more rows.

    Two cuts about the place are taken from a quantile sketch; both are values of the column. Counting what lies below,
    at, between and beyond them tells exactly where the place is, and the search goes on there, until it meets a cut or
    few values are left. Every round is one aggregate, and leaves about 1 / ACCURACY of the rows."""
    at, n = rank, values.count()
    while True:
        if n <= (FEW if few is None else few):
            return values.orderBy("v").offset(at).limit(1).first()["v"]
        margin = 2 / ACCURACY
        shares = [max(0.0, at / n - margin), min(1.0, (at + 1) / n + margin)]
        low, high = values.agg(F.percentile_approx("v", shares, ACCURACY).alias("x")).first()["x"]
        v = F.col("v")
        parts = [(v < low, None), (v == low, low), ((v > low) & (v < high), None), ((v == high) & (v > low), high), (v > high, None)]
        counts = values.agg(*[F.count_if(c).alias(f"c{i}") for i, (c, _) in enumerate(parts)]).first()
        for (condition, met), size in zip(parts, counts, strict=True):
            if at < size:
                if met is not None:
                    return met
                values, n = values.where(condition), size
                break
            at -= size


def quantiles(df: DataFrame, column: Column, shares: list[float]) -> list[float | None]:
    """Quantiles of a column over all rows, linear between neighbours; nulls and NaN are left out. None where nothing is
    left."""
    values = df.select(column.cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    n, out = values.count(), []
    for share in shares if n else []:
        at = share * (n - 1)
        low = ranked_value(values, math.floor(at))
        high = low
        if at > math.floor(at):
            after = values.agg(F.count_if(F.col("v") <= low).alias("upto"), F.min(F.when(F.col("v") > low, F.col("v"))).alias("next")).first()
            high = low if after["upto"] > math.floor(at) + 1 else after["next"]
        out.append(low + (high - low) * (at - math.floor(at)))
    return out or [None] * len(shares)


def summarised(df: DataFrame, column: Column) -> DataFrame:
    """One row: cnt, mean, median (exact, interpolated), min and max of a column, rounded to three places; nulls where
    there is nothing."""
    middle = quantiles(df, column, [0.5])[0]
    r = lambda c: F.round(c, 3)
    base = df.agg(F.count(column).alias("cnt"), r(F.avg(column)).alias("mean"), r(F.min(column)).alias("min"), r(F.max(column)).alias("max"))
    return base.select("cnt", "mean", r(F.lit(middle).cast("double")).alias("median"), "min", "max")
