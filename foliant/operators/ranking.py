"""Ranks over a whole table, without gathering it in one task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.sources.scratch import new_folder

FEW = 10_000  #: rows that may come together
_PLACES = 1 << 33  #: monotonically_increasing_id() counts rows below it, partitions above


def with_rank(df: DataFrame, order: list[Column], name: str = "rank", limit: int = 0) -> DataFrame:
    """df with each row's place in the order, from 1; all rows, or the first `limit` of them. Ties are broken by a hash
    of the row.

    The rows are dealt to partitions by ranges of the order, sorted within each and numbered there; a partition's first
    place is the number of rows in those before it. Only these counts, one a partition, come together. The numbered rows
    are written, as both the counts and the ranks rest on one dealing. A great many equal keys are spread by the hash.
    Floats aside, rows that tie in the hash too are equal, so it doesn't matter which comes first."""
    spark = df.sparkSession
    if 0 < limit <= FEW:  # no task passes on more than these
        df = df.orderBy(*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).limit(limit)
    keyed = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    dealt = keyed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    path = new_folder(spark, "ranked")
    dealt.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))
    sizes = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    firsts, at = [], 1
    for part, n in sizes:
        firsts.append((part, at))
        at += n
    starts = spark.createDataFrame(firsts, "_part long, _first long")
    ranked = placed.join(F.broadcast(starts), "_part")  # a row a partition
    out = ranked.withColumn(name, F.col("_first") + F.col("_place") % _PLACES).select(*df.columns, name)
    return out.where(F.col(name) <= limit) if limit else out
