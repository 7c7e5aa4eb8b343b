"""Language identification by error-correcting output codes.

Every language has a codeword of bits; one logistic classifier over hashed character n-grams learns each bit.
A text's bit margins are decoded by loss-weighted decoding: the logistic loss of each bit against each codeword,
weighted by how well that bit's classifier did on that language in training. The nearest codeword wins, and a
text whose two nearest codewords lie close together is flagged ambiguous.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import as_row, bounded_sample, crc_fold, held_out, table

BITS = 12  #: 2**BITS hashed n-gram features
CHUNK = 1 << 20  #: code points that are held as arrays at once
TRAIN_DOCS = 1500  #: bound of the labelled sample
PIECE = 80  #: code points of the short slices that training adds to whole texts
AMBIGUOUS = 0.9  #: a score below this flags a text as ambiguous
FAR = 0.45  #: a loss against the nearest codeword above it is far from every codeword (a coin's is log 2 = 0.69)
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Each letter's own code point, 0 for all else."""
    return np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x110000)), np.uint32, 0x110000)


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed letter 1-, 2- and 3-grams (what is no letter separates words); None without any letter.
    A part also holds the two characters before it, for the n-grams that end in it: every n-gram counts once."""
    letters, total, seen = _letters(), np.zeros(1 << BITS), False
    shift, text = np.uint32(32 - BITS), text.lower()
    for at in range(0, len(text), CHUNK):
        known = min(2, at)
        x = letters[np.frombuffer(text[at - known : at + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")]
        if not x.any():
            continue
        seen = seen or bool(x[known:].any())
        two = x[:-1] * np.uint32(2654435761) + x[1:] * np.uint32(40503)
        three = two[:-1] * np.uint32(2246822519) + x[2:] * np.uint32(3266489917)
        one = x[known:][x[known:] > 0] * np.uint32(668265263)
        two = (two[(x[:-1] > 0) | (x[1:] > 0)] if known < 2 else two[1:][(x[1:-1] > 0) | (x[2:] > 0)]) ^ np.uint32(0x9E3779B9)
        three = three[x[1:-1] > 0]
        for h in (one, two, three):
            total += np.bincount((h * np.uint32(2654435769)) >> shift, minlength=1 << BITS)
    return total.astype(np.float32) if seen else None


def features(text: str | None) -> np.ndarray | None:
    """The square roots of the n-grams' shares: a vector of length 1."""
    counts = ngram_counts(text) if text else None
    return None if counts is None else np.sqrt(counts / counts.sum())


def codewords(n: int) -> np.ndarray:
    """n rows of +1/-1: every split of the languages in two where they are few, else seeded random splits that
    keep the least distance of any two codewords largest."""
    if n == 1:
        return np.ones((1, 1), np.float32)
    if n <= 7:
        splits = [s for k in range(1, n) for s in combinations(range(n), k) if 0 in s]
        code = np.array([[1.0 if i in s else -1.0 for s in splits] for i in range(n)], np.float32)
        return code
    rng, bits, best, far = np.random.default_rng(11), int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        code = np.where(rng.random((n, bits)) < 0.5, -1.0, 1.0).astype(np.float32)
        code = code[:, (code.min(0) < 0) & (code.max(0) > 0)]
        gap = int(((code[:, None] != code[None]).sum(2) + np.eye(n) * bits).min())
        if gap > far:
            best, far = code, gap
    return best


@dataclass
class EcocModel:
    languages: list[str]
    code: np.ndarray  # languages x bits, +1/-1
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # languages x bits; a row sums to 1

    def decode(self, x: np.ndarray) -> tuple[str, float, bool, float]:
        """The language, its score, whether it is ambiguous, and the loss against its codeword."""
        margins = x @ self.weights + self.bias
        loss = (self.trust * np.logaddexp(0, -self.code * margins)).sum(1)
        odds = np.exp(-(loss - loss.min()) * self.code.shape[1])
        odds = odds / odds.sum()
        best = int(odds.argmax())
        return self.languages[best], float(odds[best]), bool(odds[best] < AMBIGUOUS), float(loss[best])

    def predict(self, text: str | None) -> tuple[str, float, bool, float]:
        x = features(text) if self.languages else None
        return (UNKNOWN, 0.0, True, float("inf")) if x is None else self.decode(x)


def fit(x: np.ndarray, langs: list[str], rounds: int = 150, ridge: float = 1e-5) -> EcocModel:
    """Logistic regressions for all bits at once, by Nesterov's accelerated gradient."""
    names = sorted(set(langs))
    if not names:
        return EcocModel([], *[np.zeros((0, 0), np.float32)] * 4)
    code = codewords(len(names))
    of = np.array([names.index(v) for v in langs])
    y = code[of]
    balance = (1.0 / np.bincount(of))[of][:, None].astype(np.float32) / len(names)
    w = v = np.zeros((x.shape[1], code.shape[1]), np.float32)
    b = c = np.zeros(code.shape[1], np.float32)
    for k in range(rounds):
        m = x @ v + c
        g = -y * balance / (1 + np.exp(np.clip(y * m, -30, 30)))
        w1, b1 = v - 3.0 * (x.T @ g + ridge * v), c - 3.0 * g.sum(0)
        v, c = w1 + (w1 - w) * (k / (k + 3)), b1 + (b1 - b) * (k / (k + 3))
        w, b = w1, b1
    right = (np.sign(x @ w + b) == y).astype(np.float64)
    trust = np.stack([right[of == i].mean(0) + 1e-3 for i in range(len(names))])
    return EcocModel(names, code, w, b, (trust / trust.sum(1, keepdims=True)).astype(np.float32))


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _training_rows(texts: pd.Series) -> pd.Series:
    """The whole text's features, and those of three short slices spread over it."""
    def rows(t: str | None):
        pieces = [t] + ([t[i : i + PIECE] for i in (len(t) // 5, len(t) // 2, len(t) * 4 // 5)] if t and len(t) > PIECE else [])
        return [f.astype(np.float16).tobytes() for p in pieces if (f := features(p)) is not None]

    return texts.map(rows)


def train(docs: DataFrame, bound: int = TRAIN_DOCS) -> EcocModel:
    """Learn from (doc_id, text, lang) rows whose lang is known and whose crc32 fold is not 0; at most
    `bound` different ones, as evenly over the languages as they allow."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_fold(F.col("doc_id")) != 0))
    rows = bounded_sample(known, "lang", bound).select("lang", F.explode(_training_rows("text")).alias("x")).collect()
    rows.sort(key=lambda r: (r.lang, r.x))
    x = np.stack([np.frombuffer(r.x, np.float16) for r in rows]).astype(np.float32) if rows else np.zeros((0, 1 << BITS), np.float32)
    return fit(x, [r.lang for r in rows])


def predict_column(spark: SparkSession, model: EcocModel, text: Column) -> Column:
    """A struct (lang_pred, score, ambiguous). The model is a few hundred KB, whatever the input."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean, loss double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [shipped.value.predict(t) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score", "ambiguous", "loss"])

    return predict.asNondeterministic()(text)  # so that a filter on it doesn't run it twice


def identify(docs: DataFrame, model: EcocModel) -> DataFrame:
    """(row, lang_pred, score, ambiguous, loss): each row of docs as a struct, its language, and the loss against the
    nearest codeword. Null, empty or letterless texts: `und`, score 0, ambiguous, infinite loss. Repeated rows are each
    predicted; an empty table gives no rows; very long texts are read whole, part by part; other columns, whatever
    their names, only pass through."""
    found = predict_column(docs.sparkSession, model, F.col("text"))
    return docs.select(as_row(docs).alias("row"), found.alias("found")).select("row", "found.*")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every row of documents, as identify() defines it for null, empty and very long texts, ties (the
    first of equally near codewords in the languages' order), repeated rows and an empty table."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go (no letter, or ambiguous and farther than FAR from every codeword),
    as do null and empty texts; the rest stay, and a null lang becomes the predicted one. Repeated rows are each
    judged; extra columns stay as they are; an empty table stays empty. Without any labelled language nothing can be
    told and every document is `und`."""
    found = identify(docs, train(docs)).where((F.col("lang_pred") != UNKNOWN) & ~(F.col("ambiguous") & (F.col("loss") > FAR)))
    kept = [F.coalesce("row.lang", "lang_pred").alias(c) if c == "lang" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return found.select(*kept)
