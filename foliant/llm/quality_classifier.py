"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of which only the bag is labelled. Every passage of the whole text is encoded, from
a learnt embedding of its hashed words beside its surface; gated attention weighs the passages, and the weighted mean
is scored. Embedding, encoder, attention and scorer are learnt together from the document labels, on a bounded sample
of labelled rows whose texts are read whole.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import bounded_sample, crc_fold, held_out, table, texts_of
from foliant.llm.passages import PASSAGE, WIDTH, passage_features, words

TRAIN_DOCS = 1500  #: bound of the labelled sample
BUCKETS = 512  #: hashed words that have an embedding
INPUT = WIDTH + BUCKETS
ENCODED, GATE = 16, 8
DECISION = 0.3


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def encoded(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The passages' surface (passages, WIDTH) and the bucket of every word."""
    parsed = words(text or b"")
    return passage_features(None, parsed), (parsed[2] & np.uint32(BUCKETS - 1)).astype(np.uint16)


def passages_of(surface: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """(passages, INPUT): the surface, and the square roots of the shares of each bucket's words in a passage."""
    k = len(surface)
    of = np.minimum(np.arange(len(buckets)) // PASSAGE, k - 1)  # a short rest belongs to the passage before
    bags = np.bincount(of * BUCKETS + buckets, minlength=k * BUCKETS).reshape(k, BUCKETS).astype(np.float32)
    return np.hstack([surface, np.sqrt(bags / np.maximum(bags.sum(1, keepdims=True), 1))])


@dataclass
class MilModel:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Everything from standardised passages x, whose bags begin at `starts`, to the bags' logits."""
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (v * u) @ p["a"]
        sizes = np.diff(np.r_[starts, len(x)])
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "sizes": sizes, "logit": z @ p["c"] + p["d"]}

    def standard(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8)

    def score(self, features: np.ndarray) -> tuple[float, float]:
        """The score of one document's passages, and the largest attention weight."""
        f = self.forward(self.standard(features), np.array([0]))
        return float(_sigmoid(f["logit"])[0]), float(f["a"].max())


def fit(bags: list[np.ndarray], labels: list[int], rounds: int = 150, rate: float = 0.02, decay: float = 1e-3) -> MilModel:
    """Full-batch Adam on the mean log loss."""
    if not bags:
        return MilModel(np.zeros(INPUT, np.float32), np.ones(INPUT, np.float32), {})
    x, y, width = np.concatenate(bags), np.array(labels, np.float32), bags[0].shape[1]
    starts = np.r_[0, np.cumsum([len(b) for b in bags])[:-1]]
    model = MilModel(x.mean(0), x.std(0) + 0.02, {})
    x = model.standard(x)
    rng = np.random.default_rng(3)
    shape = {"w": (width, ENCODED), "v": (ENCODED, GATE), "u": (ENCODED, GATE), "a": (GATE,), "c": (ENCODED,)}
    p = {k: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32) for k, s in shape.items()}
    share = np.clip(y.mean(), 0.01, 0.99)
    p |= {"b": np.zeros(ENCODED, np.float32), "d": np.array(np.log(share / (1 - share)), np.float32)}
    model.p = p
    m1, m2 = {k: 0 * v for k, v in p.items()}, {k: 0 * v for k, v in p.items()}
    for t in range(1, rounds + 1):
        f = model.forward(x, starts)
        bag = (_sigmoid(f["logit"]) - y) / len(y)
        spread = lambda g, f=f: np.repeat(g, f["sizes"], axis=0)
        dz = spread(bag[:, None] * p["c"])
        da = (dz * f["h"]).sum(1)
        de = f["a"] * (da - spread(np.add.reduceat(f["a"] * da, starts)))
        dv, du = de[:, None] * p["a"] * f["u"] * (1 - f["v"] ** 2), de[:, None] * p["a"] * f["v"] * f["u"] * (1 - f["u"])
        dh = (f["a"][:, None] * dz + dv @ p["v"].T + du @ p["u"].T) * (1 - f["h"] ** 2)
        grads = {"c": f["z"].T @ bag, "d": bag.sum(), "a": (f["v"] * f["u"]).T @ de, "v": f["h"].T @ dv, "u": f["h"].T @ du, "w": x.T @ dh, "b": dh.sum(0)}
        for k, g in grads.items():
            g = g + (decay * p[k] if k in ("w", "c") else 0)
            m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g, 0.99 * m2[k] + 0.01 * g * g
            p[k] = (p[k] - rate * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return model


@F.pandas_udf(T.StructType([T.StructField("surface", T.BinaryType()), T.StructField("buckets", T.BinaryType())]))
def _encoded(texts: pd.Series) -> pd.DataFrame:
    found = [encoded(t) for t in texts]
    return pd.DataFrame({"surface": [a.tobytes() for a, _ in found], "buckets": [b.tobytes() for _, b in found]}, dtype=object)


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> MilModel:
    """Learn from documents with a quality label of 0 or 1 whose crc32 fold is not 0; at most `bound`, as
    evenly over the labels as they allow, weighted back to the labels' true shares by the scorer's offset."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id")) != 0)).select("doc_id", F.col("quality").alias("y"))
    shares = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    rows = texts_of(docs, bounded_sample(known, "y", bound)).select("y", _encoded(F.col("text").cast("binary")).alias("x")).collect()
    rows.sort(key=lambda r: (r.y, r.x.surface, r.x.buckets))
    model = fit([passages_of(np.frombuffer(r.x.surface, np.float32).reshape(-1, WIDTH), np.frombuffer(r.x.buckets, np.uint16)) for r in rows], [r.y for r in rows])
    if model.p and len(shares) == 2:
        seen = np.mean([r.y for r in rows])
        if 0 < seen < 1:  # the sample is more even than the labels are
            model.p["d"] = np.float32(model.p["d"] + np.log(shares[1] / shares[0]) - np.log(seen / (1 - seen)))
    return model


def score_column(spark: SparkSession, model: MilModel, text):
    """A struct (score, attention) of a binary text; score 0.5 where nothing could be learnt."""
    shipped = spark.sparkContext.broadcast(model)  # some thousand numbers, whatever the input

    @F.pandas_udf("score double, attention double")
    def score(texts: pd.Series) -> pd.DataFrame:
        m = shipped.value
        found = [m.score(passages_of(*encoded(t))) if m.p else (0.5, 1.0) for t in texts]
        return pd.DataFrame(found, columns=["score", "attention"])

    return score(text)


def classify(docs: DataFrame, model: MilModel) -> DataFrame:
    """(doc_id, held_out, score, predicted, attention) per row. Null and empty texts are one passage without words;
    a null doc_id isn't held out; repeated rows are each scored; very long texts are scored whole, passage by passage;
    an empty table gives no rows; extra columns, whatever their names, are left behind."""
    found = score_column(docs.sparkSession, model, F.col("t"))
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("t")).select("doc_id", found.alias("x"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "x.score", (F.col("x.score") >= DECISION).cast("int").alias("predicted"), "x.attention")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every row of documents; classify() says what null, empty, repeated and very long texts give. Without
    labels every score is 0.5."""
    docs = table(spark, sf_dir, "documents")
    return classify(docs, train(docs, table(spark, sf_dir, "labels")))
