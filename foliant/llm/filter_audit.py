"""How filters interact: what each removes at each step of every order they could be applied in.

A set of filters that has been applied is a node of the lattice of subsets, and applying one more filter is an edge:
80 edges for five filters. What a document does on an edge depends on which filters it fails and on nothing else, not
on the order in which the filters before were applied. So documents are first counted by the set that they fail (at
most 32 sets a part), the counts are laid on the 80 edges, and each of the 120 orders reads its five steps off the
edges that it passes: no order is run over the documents.
"""
from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import drop_written, table, written

FILTERS = "ABCDE"
MIN_WORDS = 50
LEAST_DISTINCT = 65  #: percent of the words
MOST_CAPITALS = 5  #: percent of the code points
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_SYMBOLS = re.compile(rb"[#$%&*|]")
_NOT_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)
_CONTINUES = bytes(range(0x80, 0xC0))  #: bytes that begin no code point


def failures(text: bytes) -> int:
    """The filters A to D that a text fails, a bit each."""
    words = text.split()  # for bytes, at spaces and the controls 9 to 13
    capitals = len(text.translate(None, _NOT_CAPITALS))
    points = len(text.translate(None, _CONTINUES))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (_SYMBOLS.search(text) is not None) << 3
    )


@F.pandas_udf(T.StructType().add("fails", T.IntegerType()).add("digest", T.BinaryType()))
def _read(texts: pd.Series) -> pd.DataFrame:
    found = [(failures(t), hashlib.sha256(t).digest()) for t in (bytes(x or b"") for x in texts)]
    return pd.DataFrame(found, columns=["fails", "digest"])


def failed_filters(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails, digest): the filters A to D that each row's text fails, and the text's SHA-256."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.col("text").cast("binary").alias("text"))
    return rows.select("doc_id", "part", _read("text").alias("x")).select("doc_id", "part", "x.fails", "x.digest")


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): rows by part, set of failed filters (bits of A to E) and labels.

    A document fails E if its text stands in a row of a smaller doc_id, whatever became of that row. The smallest id of
    each text that occurs twice or more is found by a partial aggregate and joined back, so a text that fills a third of
    the table is neither gathered nor sorted. A row without an id has no smaller one and is none's: it neither fails E
    nor makes others fail. Rows that share an id are counted apart, and none makes the other fail. A null or empty text
    fails A (no words) and nothing else, but for E. Labels that repeat an id count as good or toxic if one of them does;
    a document without labels is neither. Texts are read whole; an empty table gives no rows."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    rows = written(failed_filters(docs), "audit")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    firsts = written(firsts, "firsts")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    whole = rows.join(firsts, "digest", "left").select("doc_id", "part", (F.col("fails") + F.when(copy, 16).otherwise(0)).alias("fails"))
    marked = whole.join(marks, "doc_id", "left").select("part", "fails", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    counts = written(marked.groupBy("part", "fails", "good", "toxic").agg(F.count("*").alias("n")), "counts")
    drop_written(rows, firsts)
    return counts


def lattice(n: int = len(FILTERS)) -> tuple[list[tuple[int, int, int]], list[tuple[str, int, int, int]]]:
    """The edges (filters applied before, as bits; the next filter; how many orders pass it) and the steps of all orders
    (the order, the step, filters applied before, the next filter)."""
    steps = [
        ("".join(FILTERS[f] for f in order), k + 1, sum(1 << f for f in order[:k]), f)
        for order in itertools.permutations(range(n))
        for k, f in enumerate(order)
    ]
    return [(before, f, passes) for (before, f), passes in sorted(Counter((s[2], s[3]) for s in steps).items())], steps


def _rows(names: str, rows: Iterable[tuple]) -> Column:
    """An array of structs of whole numbers, as a literal."""
    return F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names.split(), r, strict=True)]) for r in rows])


def edge_counts(counts: DataFrame) -> DataFrame:
    """(part, before, next, passes, and COUNTS) for every part and edge: each count of failure_counts() goes to all
    edges, where it is kept, removed or redundant by its set of failed filters."""
    edges, _ = lattice()
    laid = counts.select("*", F.inline(_rows("before next passes", edges)))
    hit = F.expr("(fails >> next) & 1 = 1")
    clean = F.expr("fails & before = 0")
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")
    return laid.groupBy("part", "before", "next", "passes").agg(
        count(~hit & clean).alias("kept"),
        count(hit & clean).alias("removed"),
        count(hit & ~clean).alias("redundant"),
        count(F.expr("fails = 1 << next")).alias("unique_fails"),
        count(hit & clean & F.col("good")).alias("good_lost"),
        count(hit & clean & F.col("toxic")).alias("toxic_lost"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included, with COUNTS and shapley, the removals of
    the step's filter over all orders. Every part has 600 rows; failure_counts() says what odd rows count as."""
    _, steps = lattice()
    edges = edge_counts(failure_counts(docs, labels))
    whole = edges.groupBy("part", "next").agg(F.sum(F.col("removed") * F.col("passes")).alias("shapley"))
    path = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, next int")
    known = edges.join(F.broadcast(path), ["before", "next"])  # 600 rows, whatever the data
    return known.join(whole, ["part", "next"]).select("part", "filter_order", "step", *COUNTS, "shapley")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of whole documents by source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), read AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(w) < 50,
    100 * len(list_distinct(w)) < 65 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
    regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f
  FROM read LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, good, toxic, f, count(*) AS n FROM failed GROUP BY ALL
), orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS letters(x) WHERE length(o) < 5 AND NOT contains(o, x)
), steps AS (
  SELECT o, s::INTEGER AS step, ascii(o[s]) - 64 AS k,
    list_transform(range(1, s), lambda i: ascii(o[i]) - 64) AS before
  FROM orders, range(1, 6) AS r(s) WHERE length(o) = 5
), met AS (
  SELECT part, o, step, k, n, good, toxic, f[k] AS hit, NOT list_bool_or([false] || list_transform(before, lambda i: f[i])) AS clean,
    f[k] AND len(list_filter(f, lambda x: x)) = 1 AS alone
  FROM cells, steps
), counted AS (
  SELECT part, o AS filter_order, step, k,
    coalesce(sum(n) FILTER (NOT hit AND clean), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (hit AND clean), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (hit AND NOT clean), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (hit AND clean AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (hit AND clean AND toxic), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT * EXCLUDE (k), (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM counted
"""
