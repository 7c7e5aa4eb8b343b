"""Mixing to target weights with soft membership.

A classifier learnt from a labelled table gives every document posteriors over domains. With n its tokens and p its
posteriors, a document kept at rate r adds r n p to the domains' expected token totals. The rates are fitted by
projected-gradient least squares: nonnegative, and such that the totals meet the target weights.

The gradient of a document's rate depends on the corpus only through the domains' totals. So an iteration is one
aggregate of a few sums over a narrow table, the driver keeps one number a domain and iteration, and a document's
current rate is folded from them, each step projected: no state is written, and a lost executor costs a recomputed task.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import as_row, bounded_sample, table, texts_of, written
from foliant.llm.passages import passage_features, words

TRAIN_DOCS = 2000  #: bound of the labelled sample
HASHED = 1 << 12  #: hashed words
#: The mix of op6 and the pipeline: shares of the tokens of good, poor and toxic documents.
TARGETS = {"good": 0.92, "poor": 0.05, "toxic": 0.03}
ROUNDS, TOLERANCE = 40, 0.01
STALLED = 6  #: rounds in which the squared residuals must fall by a hundredth


def _read(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """The hashed words that occur, each once; the passages' surface, on average and at most; how many words."""
    parsed = words(text)
    f = passage_features(None, parsed, grams=False)
    there = np.zeros(HASHED, bool)
    there[parsed[2] & np.uint32(HASHED - 1)] = True
    return np.flatnonzero(there).astype(np.uint16), np.concatenate([f.mean(0), f.max(0)]), len(parsed[1])


@dataclass
class DomainModel:
    """Multinomial logistic regression over hashed words' presence and the passages' surface."""

    domains: list[str]
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray  # (HASHED + 2 * SURFACE, domains)
    b: np.ndarray

    def logits(self, bag: np.ndarray, dense: np.ndarray) -> np.ndarray:
        found = self.w[bag].sum(0) if len(bag) else 0
        return found + np.clip((dense - self.mean) / self.scale, -8, 8) @ self.w[HASHED:] + self.b

    def posteriors(self, bag: np.ndarray, dense: np.ndarray) -> np.ndarray:
        z = self.logits(bag, dense)
        e = np.exp(z - z.max())
        return e / e.sum()


def fit(bags: list[np.ndarray], dense: np.ndarray, of: np.ndarray, domains: list[str], prior: np.ndarray, rounds: int = 120) -> DomainModel:
    """Full-batch Adam. `prior`: the domains' true shares; the sample may be more even than they are."""
    mean, scale = dense.mean(0), dense.std(0) + 0.02
    x = np.zeros((len(bags), HASHED), np.float32)
    for i, bag in enumerate(bags):
        x[i, bag] = 1
    # long texts hold many words: the columns' means are taken out, and words in few texts count little
    x = np.hstack([x, np.clip((dense - mean) / scale, -8, 8).astype(np.float32)])
    y = np.eye(len(domains), dtype=np.float32)[of]
    w, b = np.zeros((x.shape[1], len(domains)), np.float32), np.zeros(len(domains), np.float32)
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = x @ w + b
        e = np.exp(z - z.max(1, keepdims=True))
        g = (e / e.sum(1, keepdims=True) - y) / len(y)
        gw = x.T @ g + 1e-4 * w
        m1, m2 = 0.9 * m1 + 0.1 * gw, 0.99 * m2 + 0.01 * gw * gw
        w = w - 0.01 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
        b = b - 0.5 * g.sum(0)
    seen = np.bincount(of, minlength=len(domains)) / len(of)
    return DomainModel(domains, mean, scale, w.astype(np.float32), b + np.log(prior / seen))


@F.pandas_udf(T.StructType([T.StructField("bag", T.BinaryType()), T.StructField("dense", T.BinaryType())]))
def _training_row(texts: pd.Series) -> pd.DataFrame:
    read = [_read(t) for t in texts]
    return pd.DataFrame({"bag": [r[0].tobytes() for r in read], "dense": [r[1].tobytes() for r in read]}, dtype=object)


def train(docs: DataFrame, labelled: DataFrame, bound: int = TRAIN_DOCS) -> DomainModel | None:
    """Learn the domains from labelled (doc_id, domain), at most `bound` documents. None if none is labelled."""
    known = labelled.where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "domain")
    rows = texts_of(docs, bounded_sample(known, "domain", bound)).select("domain", _training_row(F.col("text").cast("binary")).alias("x")).select("domain", "x.*").collect()
    if not rows:
        return None
    rows.sort()
    domains = sorted({r.domain for r in rows})
    counts = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    prior = np.array([counts[d] for d in domains], float)
    return fit([np.frombuffer(r.bag, np.uint16) for r in rows], np.stack([np.frombuffer(r.dense, np.float32) for r in rows]), np.array([domains.index(r.domain) for r in rows]), domains, prior / prior.sum())


def memberships(docs: DataFrame, model: DomainModel, *keep: str) -> DataFrame:
    """(doc_id, keep, n_tokens, p): each row's words and its posteriors, in the order of model.domains."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # its size is that of the hashed vocabulary

    @F.pandas_udf("n long, p array<double>")
    def posteriors(texts: pd.Series) -> pd.DataFrame:
        read = [_read(t) for t in texts]
        return pd.DataFrame({"n": [r[2] for r in read], "p": [shipped.value.posteriors(r[0], r[1]).astype(float) for r in read]})

    found = posteriors(F.coalesce("text", F.lit("")).cast("binary"))
    return docs.select("doc_id", *keep, found.alias("x")).select("doc_id", *keep, F.col("x.n").alias("n_tokens"), "x.p")


def rate_after(steps: list[list[float]], most: float | None = None) -> Column:
    """A row's rate after projected-gradient steps from rate 1. A step (momentum, a number a domain) first moves on by
    its momentum's share of the last change, then along the row's posteriors, and is projected to be nonnegative (and
    at most `most`)."""
    if not steps:
        return F.lit(1.0)

    def step(a: Column, s: Column) -> Column:
        r = a["r"] + s[0] * (a["r"] - a["before"])
        for i in range(len(steps[0]) - 1):
            r = r - F.get("p", F.lit(i)) * s[i + 1]
        r = F.greatest(F.lit(0.0), r)
        return F.struct((r if most is None else F.least(F.lit(float(most)), r)).alias("r"), a["r"].alias("before"))

    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("before"))
    return F.aggregate(F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps]), start, step, lambda a: a["r"])


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], rounds: int = ROUNDS, whole: str | None = None, most: float | None = None) -> tuple[Column, dict]:
    """The rate as a column over members (n_tokens, p), and what was reached: totals, targets, the largest relative
    error (above TOLERANCE: the targets are out of the posteriors' reach, and the rates are the nearest found) and the
    rounds taken. Targets are normalised over the domains that have tokens. The budget is the largest that no domain's
    tokens at rate 1 fall short of. With `whole`, a domain that has tokens and a target, it is the one that takes
    exactly its tokens at rate 1: no others are cut below their shares of it, and domains that are scarcer than that
    aim at their own tokens at rate 1. `most`: an upper bound of every rate.

    Projected-gradient least squares: with T the totals and G the targets, f = 1/2 sum((T - G)**2 / S), where S are the
    domains' tokens at rate 1, so a scarce domain counts as much as a common one. A step is r <- max(0, r - eta *
    p . ((T - G) / S)), taken per token, so that a document's length doesn't set its pace; eta is 1 over the largest
    curvature (of f along p, over all tokens), at which no step overshoots. Steps have Nesterov's momentum, which begins
    anew whenever f rises; totals are linear in the rates, so those at the point moved on to follow from the last two.
    A round is one aggregate of some sums. It ends at TOLERANCE, or where f has all but stopped falling."""
    k = len(domains)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    p = [F.get("p", F.lit(i)) for i in range(k)]
    first = members.agg(*[F.sum(F.col("n_tokens") * x).alias(f"t{i}") for i, x in enumerate(p)], *[F.sum(F.col("n_tokens") * p[i] * p[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    full = np.array([first[f"t{i}"] or 0.0 for i in range(k)], float)
    weight = np.array([targets.get(d, 0.0) for d in domains]) * (full > 0)
    if not weight.sum():
        return F.lit(1.0), {"reached": full.tolist(), "targets": full.tolist(), "error": 0.0, "rounds": 0}
    weight = weight / weight.sum()
    kept = domains.index(whole) if whole in domains else None
    if kept is not None and weight[kept] > 0:
        goal = np.minimum(weight * (full[kept] / weight[kept]), full)
    else:
        goal = weight * min(full[i] / weight[i] for i in range(k) if weight[i] > 0)
    scale = np.where(full > 0, full, 1.0)
    curve = np.zeros((k, k))
    for i, j in pairs:
        curve[i, j] = curve[j, i] = (first[f"c{i}_{j}"] or 0.0) / np.sqrt(scale[i] * scale[j])
    eta = 1 / np.linalg.eigvalsh(curve)[-1]
    size = np.maximum(goal, 1e-3 * full.sum())
    off = lambda totals: float(((totals - goal) ** 2 / scale).sum())
    steps: list[list[float]] = []
    now = last = full
    best, falls, pace = (float(np.abs((full - goal) / size).max()), [], full), [off(full)], 1.0
    while best[0] > TOLERANCE and len(steps) < rounds and (len(falls) <= STALLED or falls[-1] < 0.99 * falls[-1 - STALLED]):
        momentum = (pace - 1) / (pace := (1 + np.sqrt(1 + 4 * pace * pace)) / 2)
        ahead = now + momentum * (now - last)
        steps = [*steps, [momentum, *(eta * (ahead - goal) / scale).tolist()]]
        rows = members.select("n_tokens", "p", rate_after(steps, most).alias("r"))
        got = rows.agg(*[F.sum(F.col("n_tokens") * F.col("r") * x).alias(f"t{i}") for i, x in enumerate(p)]).first()
        last, now = now, np.array([got[f"t{i}"] or 0.0 for i in range(k)], float)
        if off(now) > off(last):
            pace = 1.0
        falls.append(min(falls[-1], off(now)))
        error = float(np.abs((now - goal) / size).max())
        if error < best[0]:
            best = (error, steps, now)
    return rate_after(best[1], most), {"reached": best[2].tolist(), "targets": goal.tolist(), "error": best[0], "rounds": len(best[1])}


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table: toxic, else poor or good by quality; rows that lack both say nothing."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


def uniform(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], *keep: str, whole: str | None = None, most: float | None = None) -> tuple[DataFrame, list[str], dict]:
    """Rows (doc_id, keep, n_tokens, p, rate, copies): how many copies of each row a mix takes, its rate rounded up
    or down by a hash of its id; the domains of p; and what fit_rates reached. Null or empty texts have no tokens and a
    rate like others; repeated rows each count; very long texts are read whole; an empty table gives no rows; extra
    columns that aren't kept are left behind; without labels every rate is 1. `whole`, `most`: see fit_rates."""
    model = train(docs, labelled)
    if model is None:
        plain = docs.select("doc_id", *keep, F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long").alias("n_tokens"), F.array().cast("array<double>").alias("p"))
        return plain.withColumn("rate", F.lit(1.0)).withColumn("copies", F.lit(1).cast("long")), [], {"error": 0.0}
    members = written(memberships(docs, model, *keep), "members")
    rate, reached = fit_rates(members, model.domains, targets, whole=whole, most=most)
    rated = members.withColumn("rate", rate)
    draw = (uniform(F.col("doc_id")) < F.col("rate") - F.floor("rate")).cast("long")
    return rated.withColumn("copies", F.floor("rate").cast("long") + F.coalesce(draw, F.lit(0))), model.domains, reached


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, posteriors p_good, p_poor, p_toxic (null for a domain that no label names),
    rate, copies, and fit_error, the largest relative distance of a domain's reached total from its target (the same
    in every row; above TOLERANCE the targets are out of reach). mix() says what odd rows give."""
    rows, domains, reached = mix(table(spark, sf_dir, "documents"), label_domains(table(spark, sf_dir, "labels")), TARGETS)
    p = [(F.get("p", F.lit(domains.index(d))) if d in domains else F.lit(None).cast("double")).alias(f"p_{d}") for d in TARGETS]
    return rows.select("doc_id", "n_tokens", *p, "rate", "copies", F.lit(float(reached["error"])).alias("fit_error"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay with the probability of their rate. Rates are fitted between 0 and 1, so what is applied is what
    was fitted and no document is repeated. The budget is that of all good tokens, so poor and toxic ones are cut down
    to their shares of it, and good ones aren't cut where the others are scarce. Null, empty, repeated and very long
    texts: as mix() says; a null doc_id hashes like any other; extra columns pass through; an empty table stays so."""
    held = docs.select("doc_id", "text", as_row(docs).alias("row"))
    rows, _, _ = mix(held, label_domains(table(spark, sf_dir, "labels")), TARGETS, "row", whole="good", most=1.0)
    return rows.where("copies > 0").select("row.*")
