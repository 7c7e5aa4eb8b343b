"""Approximate nearest neighbours by score-aware (anisotropic) quantisation.

Cosine search is maximum inner product search over unit vectors. A product quantiser with 16 centres for every two
dimensions gives four-bit codes; it is trained, and vectors are encoded, under a loss that weighs the part of the
residual that is parallel to the vector ETA times as much as the rest, since that is the part that spoils large inner
products. A query's products with the centres make lookup tables; scanning a block's codes through them ranks its
vectors. The best of them set a threshold by their exact cosine. An approximate score falls short of the exact one by
what the residual has of the query, which for all but a small share of a sample's neighbours is less than a fitted part
of the residual's length (`spread`). Of each query, all vectors whose approximate score can reach the threshold within
that are reranked by exact cosine in double precision: no number of them is fixed, so a group of near copies with equal
codes is reranked whole, and the rest of the block is left out by its codes alone.

Vectors are dealt into cells around centres fitted on the same bounded sample, and a query goes to as many of the
nearest cells as the sample's own neighbours call for: few where the vectors cluster, nearly all where they don't. A
cell that holds many vectors is cut into blocks, so none lands in one task. Every vector moves once, to its block; the
queries are copied to the blocks. Queries that find too little go to all cells. Equal vectors are one class, with no
more of its ids than can show in a result, so a vector that a third of all rows share is one candidate.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.llm.common import table, written

CENTRES = 16
SAMPLE = 10_000  #: vectors that the quantiser is fitted on, at most about
THRESHOLD = 0.2  #: inner products above it matter; sets the weight of the parallel residual
CELLS, CELL = 256, 4096  #: cells at most, and vectors of a cell where there are fewer
COVERED = 0.99  #: share of the sample's neighbours that must lie in the cells a query goes to
BLOCK = 8192  #: vectors in a block, about
RERANK = 64  #: candidates of a block that set each query's threshold; all that may reach it are reranked
TOGETHER = 64  #: queries whose scores are looked through together
MISSED = 0.005  #: share of a sample's nearest neighbours whose residual may take more from the score than is allowed for
SLACK = 1e-4  #: more than the rounding of approximate scores (single precision)
ROUNDING = 1e-9  #: more than the rounding of exact ones
ASKED = 1024  #: queries that are searched at once
FLUSH = 50_000  #: classes held at once while rows are merged


class Quantiser:
    """Codebooks (subspaces x CENTRES x 2) of the anisotropic product quantiser."""

    def __init__(self, books: np.ndarray, eta: float, spread: float = 1.0):
        self.books, self.eta, self.spread = books, eta, spread

    @staticmethod
    def halves(x: np.ndarray) -> np.ndarray:
        """Unit vectors as (rows, subspaces, 2), a zero added to an odd dimension; float32."""
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
        if x.shape[1] % 2:
            x = np.pad(x, ((0, 0), (0, 1)))
        return x.reshape(len(x), -1, 2).astype(np.float32)

    @classmethod
    def fit(cls, vectors: np.ndarray, rounds: int = 8) -> Quantiser:
        x = cls.halves(vectors)
        d = vectors.shape[1]
        eta = max(1.0, (d - 1) * THRESHOLD**2 / (1 - THRESHOLD**2))
        rng = np.random.default_rng(5)
        pick = rng.choice(len(x), CENTRES, replace=len(x) < CENTRES)
        self = cls(np.ascontiguousarray(x[pick].transpose(1, 0, 2)), eta)
        for k in range(rounds):
            codes = self.encode(x, sweeps=0 if k == 0 else 1)
            self._update(x, codes)
        self.spread = self._fitted_spread(vectors)
        return self

    def _fitted_spread(self, vectors: np.ndarray, asked: int = 512, near: int = 10) -> float:
        """How much of its residual's length a vector may lose against a query near it: at all but MISSED of the
        nearest pairs within the sample, 1 (the bound of any) where there are too few."""
        v = np.unique(vectors, axis=0)
        if len(v) < 1000:
            return 1.0
        v = v[np.random.default_rng(11).permutation(len(v))]
        unit = v / np.sqrt((v * v).sum(1, keepdims=True))
        packed = self.pack(np.concatenate([self.encode(self.halves(v[i : i + 1024])) for i in range(0, len(v), 1024)]))
        along, aside = self.split(v, packed)
        q = slice(0, min(asked, len(v)))
        cosines = unit[q] @ unit.T
        cosines[np.arange(len(cosines)), np.arange(len(cosines))] = -2
        place = np.argpartition(-cosines, near, axis=1)[:, :near]
        s = np.clip(np.take_along_axis(cosines, place, 1), -1, 1)
        approx = np.take_along_axis(scan(packed, self.tables(v[q])).T, place, 1)
        lost = (along[place] * s - approx) / np.maximum(aside[place] * np.sqrt(1 - s * s), 1e-9)
        return float(np.clip(np.quantile(lost, 1 - MISSED), 0.05, 1.0))

    def _residual(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What each subspace adds to the residual's product with the vector."""
        chosen = np.take_along_axis(self.books[None], codes[:, :, None, None], 2)[:, :, 0]
        return ((x - chosen) * x).sum(2)

    def _update(self, x: np.ndarray, codes: np.ndarray) -> None:
        """Each subspace's centres by weighted least squares, the others held."""
        for m in range(x.shape[1]):
            parallel = self._residual(x, codes)
            rest = parallel.sum(1) - parallel[:, m]
            xm = x[:, m]
            pull = rest + (xm * xm).sum(1)
            for k in range(CENTRES):
                own = codes[:, m] == k
                if not own.any():
                    continue
                v = xm[own].astype(np.float64)
                a = own.sum() * np.eye(2) + (self.eta - 1) * v.T @ v
                self.books[m, k] = np.linalg.solve(a, v.sum(0) + (self.eta - 1) * pull[own] @ v)

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes (rows, subspaces) of halves: nearest centres first, then subspace by subspace under the loss."""
        gap = x[:, :, None] - self.books[None]  # rows, subspaces, centres, 2
        square = (gap * gap).sum(3)
        along = (gap * x[:, :, None]).sum(3)
        codes = square.argmin(2)
        parallel = np.take_along_axis(along, codes[:, :, None], 2)[:, :, 0]
        total = parallel.sum(1)
        for _ in range(sweeps):
            for m in range(x.shape[1]):
                rest = total - parallel[:, m]
                codes[:, m] = (square[:, m] + (self.eta - 1) * (rest[:, None] + along[:, m]) ** 2).argmin(1)
                parallel[:, m] = along[np.arange(len(x)), m, codes[:, m]]
                total = rest + parallel[:, m]
        return codes

    def split(self, vectors: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What packed codes stand for: its part along its unit vector, and the length of the rest."""
        x = self.halves(vectors)
        codes = np.stack([packed & 15, packed >> 4], 2).reshape(len(packed), -1)[:, : x.shape[1]]
        along, square = np.zeros(len(x)), np.zeros(len(x))
        for m in range(x.shape[1]):
            chosen = self.books[m, codes[:, m]].astype(np.float64)
            along += (chosen * x[:, m]).sum(1)
            square += (chosen * chosen).sum(1)
        return along, np.sqrt(np.maximum(square - along * along, 0))

    @staticmethod
    def pack(codes: np.ndarray) -> np.ndarray:
        """Two four-bit codes to a byte."""
        if codes.shape[1] % 2:
            codes = np.pad(codes, ((0, 0), (0, 1)))
        return (codes[:, ::2] | codes[:, 1::2] << 4).astype(np.uint8)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(bytes, 256, queries): the summed products of the two centres that a byte of codes names."""
        q = self.halves(queries)
        products = np.einsum("mkd,qmd->mkq", self.books, q)
        if products.shape[0] % 2:
            products = np.concatenate([products, np.zeros_like(products[:1])])
        low, high = products[::2], products[1::2]
        return (high[:, :, None] + low[:, None]).reshape(len(low), 256, -1)


def scan(codes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Approximate scores (rows, queries) of packed codes."""
    out = tables[0][codes[:, 0]]
    for j in range(1, codes.shape[1]):
        out += tables[j][codes[:, j]]
    return out


def least(along: np.ndarray, aside: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """The least approximate score that a vector with split() (along, aside) can have where its cosine is `cosine` or
    more. At the cosine s it is along * s - aside * sqrt(1 - s * s) or more, which is convex in s."""
    c = np.clip(cosine, -1, 1)
    size = np.hypot(along, aside)
    at = along * c - aside * np.sqrt(1 - c * c)
    return np.where(-along > c * size, -size, at) - SLACK


def search_block(vectors: np.ndarray, codes: np.ndarray, ids: np.ndarray, n_ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, quantiser: Quantiser, k: int, rerank: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The k best of a block for each query: its ids and scores; of a row of `ids` the first `n_ids` are a vector's.
    The `rerank` candidates of the best approximate scores give a threshold, the (k + 1)-th exact score among them;
    every candidate that may reach it by its codes is scored, each query's own."""
    tables = quantiser.tables(queries)
    approx = np.concatenate([scan(codes[at : at + 1024], tables) for at in range(0, len(codes), 1024)]).T
    lengths = np.sqrt((vectors * vectors).sum(1))
    unit, asked = vectors / lengths[:, None], queries / np.sqrt((queries * queries).sum(1, keepdims=True))
    along, aside = quantiser.split(vectors, codes)
    first, need = min(max(rerank, k + 1), len(vectors)), min(k + 1, len(vectors))
    out = []
    for at in range(0, len(queries), TOGETHER):
        part, some = approx[at : at + TOGETHER], asked[at : at + TOGETHER]
        place = np.argpartition(-part, first - 1, axis=1)[:, :first]
        reached = np.partition(np.einsum("qtd,qd->qt", unit[place], some), -need, axis=1)[:, -need]
        may = ~(part < least(along, quantiser.spread * aside, reached[:, None]))
        np.put_along_axis(may, place, True, 1)
        for q, query_id, own in zip(queries[at : at + TOGETHER], query_ids[at : at + TOGETHER], map(np.flatnonzero, may), strict=True):
            score = (vectors[own] * q).sum(1) / (lengths[own] * np.sqrt((q * q).sum()))
            row = np.argsort(-score, kind="stable")[: k + 1 + int((score == np.partition(score, -need)[-need]).sum())]
            found, some_ids = ids[own[row]], n_ids[own[row]]
            s = np.repeat(score[row], found.shape[1])
            there = np.arange(found.shape[1]) < some_ids[:, None]
            keep = (there & (found != query_id)).ravel()
            found, s = found.ravel()[keep], s[keep]
            order = np.lexsort((found, -s))[:k]
            out.append((found[order], s[order]))
    return out


def valid(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part, of whatever dimensions. Null, empty and zero vectors,
    those with null or non-finite components, and null ids take no part."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("v", lambda x: x == 0)
    v = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    return v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad & ~zero)


def dimensions(v: DataFrame) -> list[int]:
    """The dimensions of vectors, the most common first (the larger of equally common ones)."""
    return [r["d"] for r in v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).collect()]


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, int]:
    """The valid vectors of the most common dimension, and that dimension (0 if there is none)."""
    v = valid(vectors, key, column)
    d = next(iter(dimensions(v)), 0)
    return v.where(F.size("v") == d), d


def cell_centres(sample: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means on unit vectors; n centres."""
    rng = np.random.default_rng(9)
    centres = sample[rng.choice(len(sample), min(n, len(sample)), replace=False)]
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        lengths = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(lengths > 1e-9, sums / np.maximum(lengths, 1e-9), centres)
    return centres


def probes_for(sample: np.ndarray, centres: np.ndarray, k: int, covered: float = COVERED) -> int:
    """How many of the nearest cells hold `covered` of the k nearest neighbours within the sample. In the whole table
    neighbours are nearer still, so the share found there is rather larger."""
    of, places = (sample @ centres.T).argmax(1), []
    for at in range(0, min(len(sample), 2048), 256):
        asked = sample[at : at + 256]
        scores = asked @ sample.T
        scores[np.arange(len(asked)), at + np.arange(len(asked))] = -2
        near = np.argpartition(-scores, min(k, len(sample) - 1), axis=1)[:, :k]
        order = np.argsort(np.argsort(-(asked @ centres.T), axis=1), axis=1)
        places.append(np.take_along_axis(order, of[near], 1).ravel())
    return int(np.quantile(np.concatenate(places), covered, method="higher")) + 1


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _scaled(v) -> np.ndarray:
    """A vector, or each row, times the power of two that brings its largest component near 1: every cosine stays
    exactly the same and no square is too large or small for a double. -0 becomes 0."""
    v = np.asarray(v, np.float64)
    return np.ldexp(v, -np.frexp(np.abs(v).max(-1, keepdims=True))[1]) + 0.0


def dealt(vectors: DataFrame, centres, ids_kept: int) -> DataFrame:
    """(cell, b, ids): vectors as bytes of doubles with their least ids, and the cell of each. Equal vectors are merged
    within a task; those of different tasks meet in a block."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, list[int]] = {}

        def flush() -> pd.DataFrame:
            v = np.stack([np.frombuffer(b, np.float64) for b in held]) if held else np.zeros((0, centres.value.shape[1]))
            cells = np.concatenate([(_unit(v[i : i + 8192]) @ centres.value.T).argmax(1) for i in range(0, len(v), 8192)] or [np.zeros(0)])
            ids = pd.Series([sorted(set(x))[:ids_kept] for x in held.values()], dtype=object)
            out = pd.DataFrame({"cell": cells.astype(np.int32), "b": pd.Series(list(held), dtype=object), "ids": ids})
            held.clear()
            return out

        for batch in batches:
            for i, v in zip(batch["vec_id"], batch["v"], strict=True):
                own = held.setdefault(_scaled(v).tobytes(), [])
                own.append(int(i))
                if len(own) > 8 * ids_kept:
                    own[:] = sorted(set(own))[:ids_kept]
            if len(held) >= FLUSH:
                yield flush()
        yield flush()

    return vectors.mapInPandas(merge, "cell int, b binary, ids array<long>")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, rerank: int = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows of `vectors` but its own, by cosine, ties to the
    smaller id. Both have (vec_id, v) as usable() gives them; extra columns are left behind. Repeated ids with equal
    vectors count once, as candidates and as queries; a query id with different vectors has the nearest of each, ranked
    apart. Without candidates or queries there are no rows."""
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = vectors.count()
    if not n or queries.isEmpty():
        return none
    odds = min(1.0, SAMPLE / n)
    sampled = vectors.where(F.pmod(F.xxhash64("v", F.lit(3)), F.lit(1_000_003)) < odds * 1_000_003).select("v").distinct().collect() or vectors.select("v").limit(CENTRES).collect()
    sample = _scaled(np.array(sorted(r.v for r in sampled), np.float64))
    quantiser = Quantiser.fit(sample)
    centres = cell_centres(_unit(sample), min(CELLS, max(1, n // CELL)))
    probes = probes_for(_unit(sample), centres, k) if len(centres) > 1 else 1
    shipped, cells = spark.sparkContext.broadcast(quantiser), spark.sparkContext.broadcast(centres)  # bounded whatever the input
    held = written(dealt(vectors.select("vec_id", "v"), cells, k + 1), "cells")
    rows = {r.cell: r["count"] for r in held.groupBy("cell").count().collect()}
    cut = F.element_at(F.array(*[F.lit(-(-rows.get(c, 0) // BLOCK)) for c in range(len(centres))]), F.col("cell") + 1)
    block = F.pmod(F.xxhash64("b", F.lit(5)), cut).cast("int").alias("block")
    none_of = F.lit(None).cast("array<long>").alias("ids")
    candidates = held.select("cell", block, F.lit(0).alias("role"), F.lit(0).cast("long").alias("query_id"), "b", "ids")  # no null: pandas would make doubles of the ids

    def route(asked: DataFrame, to: int) -> DataFrame:
        """Queries, copied to every block of their `to` nearest cells."""

        def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                v = _scaled(np.stack(batch["v"].to_numpy())) if len(batch) else np.zeros((0, cells.value.shape[1]))
                near = np.argsort(-(_unit(v) @ cells.value.T), axis=1, kind="stable")[:, :to].astype(np.int32)
                yield pd.DataFrame({"query_id": batch["vec_id"], "b": pd.Series([x.tobytes() for x in v], dtype=object), "cells": pd.Series(list(near), dtype=object)})

        near = asked.mapInPandas(choose, "query_id long, b binary, cells array<int>").select("query_id", "b", F.explode("cells").alias("cell"))
        copies = near.where(cut > 0).select("*", F.explode(F.sequence(F.lit(0), cut.cast("int") - 1)).alias("block"))
        return copies.select("cell", "block", F.lit(1).alias("role"), "query_id", "b", none_of)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by block come candidates first; only one block is held."""
        at, found, ready = None, {}, None
        for batch in batches:
            for (cell, block, role), part in batch.groupby(["cell", "block", "role"], sort=True):
                if (cell, block) != at:
                    at, found, ready = (cell, block), {}, None
                if role == 0:
                    for b, ids in zip(part["b"], part["ids"], strict=True):
                        found[b] = [*found.get(b, []), *ids]
                    continue
                if not found:
                    continue
                if ready is None:
                    v = np.stack([np.frombuffer(b, np.float64) for b in found])
                    codes = np.concatenate([Quantiser.pack(shipped.value.encode(Quantiser.halves(v[i : i + 1024]))) for i in range(0, len(v), 1024)])
                    ids, sizes = np.zeros((len(v), k + 1), np.int64), np.zeros(len(v), np.int64)
                    for i, x in enumerate(found.values()):
                        least_ids = sorted(set(map(int, x)))[: k + 1]
                        ids[i, : len(least_ids)], sizes[i] = least_ids, len(least_ids)
                    ready = v, codes, ids, sizes
                for i in range(0, len(part), ASKED):
                    some = part.iloc[i : i + ASKED]
                    asked = np.stack([np.frombuffer(b, np.float64) for b in some["b"]])
                    ids = some["query_id"].to_numpy(np.int64)
                    best = search_block(*ready, asked, ids, shipped.value, k, rerank)
                    of = np.repeat(np.arange(len(ids)), [len(x) for x, _ in best])
                    yield pd.DataFrame({"query_id": ids[of], "b": some["b"].to_numpy()[of], "vec_id": np.concatenate([x for x, _ in best]), "score": np.concatenate([x for _, x in best])})

    def ranked(asked: DataFrame, to: int) -> DataFrame:
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        both = candidates.union(route(asked, to)).repartition(n_parts, "cell", "block").sortWithinPartitions("cell", "block", "role")
        out = both.mapInPandas(search, "query_id long, b binary, vec_id long, score double").select("query_id", F.xxhash64("b").alias("of"), "vec_id", "score")
        place = F.row_number().over(W.partitionBy("query_id", "of").orderBy(F.desc("score"), "vec_id"))
        return out.withColumn("rank", place).where(F.col("rank") <= k)

    asked = queries.select("vec_id", "v").distinct()
    columns = ["query_id", "rank", "vec_id", "score"]
    if probes >= len(centres):
        return ranked(asked, len(centres)).select(*columns)
    first = written(ranked(asked, probes), "nearest")
    full = first.where(F.col("rank") == k).select("query_id", "of")
    short = written(_lacking(asked, full), "short")
    if short.isEmpty():
        return first.select(*columns)
    again = ranked(short, len(centres))
    return first.join(again.select("query_id", "of").distinct(), ["query_id", "of"], "left_anti").select(*columns).union(again.select(*columns))


def _lacking(asked: DataFrame, full: DataFrame) -> DataFrame:
    """Queries whose (query_id, of) isn't in full: `of` is the hash of the vector's bytes."""

    @F.pandas_udf("binary")
    def as_bytes(v: pd.Series) -> pd.Series:
        return v.map(lambda x: _scaled(x).tobytes())

    known = asked.select("vec_id", "v", F.xxhash64(as_bytes("v")).alias("of"))
    return known.join(full.withColumnRenamed("query_id", "vec_id"), ["vec_id", "of"], "left_anti").select("vec_id", "v")


def nearest_by_dimension(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """nearest() among the vectors of each query's own dimension; both as valid() gives them."""
    parts = [nearest(vectors.where(F.size("v") == d), queries.where(F.size("v") == d), k) for d in dimensions(vectors) or [0]]
    return reduce(DataFrame.union, parts)


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every row of embeddings; vectors of different dimensions are searched apart. valid() says which vectors take
    part, nearest() what ties, repeated rows, few candidates and an empty table give."""
    vectors = valid(table(spark, sf_dir, "embeddings"))
    return nearest_by_dimension(vectors, vectors.where("vec_id % 50 = 0"), 5)
