"""Passages that stand in several documents, found level by level at doubling lengths.

A window that is repeated holds nothing but repeated windows. So windows of a short length are counted first, and only
those that are repeated are extended to twice the length, until the length that was asked for is reached or none is
left (`repeated_windows`); `longest_repeats` goes on until no candidate survives.

The first level needn't hold all windows: of each window of twice the length, the least of its short windows' hashes
marks one. Texts that share a window of twice the length share its mark, wherever it stands in them, so nothing is
lost, and one word in thirteen is looked at instead of each.

A window counts as repeated if documents of two different ids hold it. Windows go by 96 bits of hash.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import drop_written, table, written_lean

WINDOW = 50
SHORT = 13  #: no level is shorter than this
SEGMENT = 1 << 20  #: bytes of a text that are split into words at once
CHUNK = 1 << 16  #: windows of a text that are hashed at once
PACK = 1 << 18  #: rows that are passed on at once
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  #: odd


def levels(window: int, short: int | None = None) -> list[int]:
    """The lengths gone through to reach `window`: each is twice the one before, or one less. The first is half of the
    second, so two at least."""
    out = [window, (window + 1) // 2]
    while out[-1] >= 2 * (short or SHORT):
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def segments(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(text):
        end = at + SEGMENT
        gap = _SPACE.search(text, end) if end < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[at:end].split()  # for bytes, at spaces and the controls 9 to 13
        at = end


def word_hashes(text: bytes) -> np.ndarray:
    parts = [np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) for words in segments(text)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    made: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    @classmethod
    def of(cls, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Powers of each base and of its inverse, n of each."""
        if n not in cls.made:
            cls.made[n] = [(_powers(b, n), _powers(pow(b, -1, 1 << 64), n)) for b in _BASES]
        return cls.made[n]


def window_hashes(words: np.ndarray, length: int, chunk: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(the first window's start, 64 bits, 32 further bits) of all windows of `length` words, chunk by chunk: sums of
    the words' hashes times powers of their places, shifted back to the window's start."""
    step = chunk or CHUNK
    for at in range(0, len(words) - length + 1, step):
        part = words[at : at + step + length - 1]
        n, found = len(part) - length + 1, []
        for k, (up, down) in enumerate(_Tables.of(step + length)):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part if k == 0 else part ^ (part >> np.uint64(29))) * up[: len(part)], out=sums[1:])
            found.append((sums[length:] - sums[:n]) * down[:n])
        yield at, found[0], (found[1] >> np.uint64(32)).astype(np.uint32)


def _sliding(x: np.ndarray, span: int, best: Callable) -> np.ndarray:
    """The least or greatest of each `span` neighbours."""
    width = 1
    while 2 * width <= span:
        x, width = best(x[:-width], x[width:]), 2 * width
    rest = span - width
    return best(x[:-rest], x[rest:]) if rest else x


def marks(words: np.ndarray, length: int, within: int, chunk: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of `length` whose hash is the least in some window of `within` words."""
    span, step = within - length + 1, chunk or CHUNK
    starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at in range(0, len(words) - within + 1, step):
        part = words[at : at + step + within - 1]
        _, h, _ = next(window_hashes(part, length, step + within))
        least = _sliding(h, span, np.minimum)
        edge = np.zeros(span - 1, np.uint64)
        found = np.flatnonzero(h == _sliding(np.concatenate([edge, least, edge]), span, np.maximum))
        starts.append(found + at)
        hashes.append(h[found])
    at, first = np.unique(np.concatenate(starts), return_index=True)
    return at, np.concatenate(hashes)[first]


def _packed(rows: Iterable[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tid, h, c, start) batches of rows whose last three are arrays."""
    held, n = [], 0

    def pack() -> pa.RecordBatch:
        ids, tids, sizes = [r[0] for r in held], [r[1] for r in held], [len(r[2]) for r in held]
        columns = [np.repeat(np.array(x, np.int64), sizes) for x in (ids, tids)]
        columns += [np.concatenate([r[k] for r in held]).astype(t, copy=False) for k, t in ((3, np.int32), (4, np.int32))]
        h = np.concatenate([r[2] for r in held]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*columns[:2], h, *columns[2:])], ["doc_id", "tid", "h", "c", "start"])

    for row in rows:
        if len(row[2]):
            held.append(row)
            n += len(row[2])
        if n >= PACK:
            yield pack()
            held, n = [], 0
    if held:
        yield pack()


_FOUND = "doc_id long, tid long, h long, c int, start int"


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, tid, text): tid tells texts of one id apart."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("tid"), "text")


def marked(rows: DataFrame, length: int, within: int) -> DataFrame:
    """The first level: every row's marks, as (doc_id, tid, h, c, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, tid, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                    start, h = marks(word_hashes(text.as_py() or b""), length, within)
                    yield doc_id.as_py(), tid.as_py(), h, np.zeros(len(h), np.int32), start

        return _packed(each())

    return rows.where("doc_id is not null").mapInArrow(run, _FOUND)


def extended(rows: DataFrame, alive: DataFrame, length: int, half: int, by_mark: bool) -> DataFrame:
    """A further level: the windows of `length` words all of whose known windows of `half` words are alive, as (doc_id,
    tid, h, c, start). `alive` has (doc_id, tid, starts); by_mark: starts of marks, one of which a window holds;
    otherwise of all windows, and the first and the last half count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, tid, text, starts in zip(*(batch.column(i) for i in range(4)), strict=True):
                    words = word_hashes(text.as_py())
                    n, known = len(words) - length + 1, starts.values.to_numpy()
                    if n < 1:
                        continue
                    if by_mark:
                        edges = np.zeros(n + 1, np.int32)
                        np.add.at(edges, np.maximum(known - (length - half), 0), 1)
                        np.add.at(edges, np.minimum(known + 1, n), -1)
                        wanted = np.cumsum(edges[:-1]) > 0
                    else:
                        held = np.zeros(len(words) + 1, bool)
                        held[known] = True
                        wanted = held[:n] & held[length - half : length - half + n]
                    for at, h, c in window_hashes(words, length):
                        of = np.flatnonzero(wanted[at : at + len(h)])
                        yield doc_id.as_py(), tid.as_py(), h[of], c[of], of + at

        return _packed(each())

    return rows.join(alive, ["doc_id", "tid"]).select("doc_id", "tid", "text", "starts").mapInArrow(run, _FOUND)


def _alive(windows: DataFrame, later: bool) -> DataFrame:
    """(doc_id, tid, starts) of the windows that two ids have; later: only in documents other than the one of the least
    id. Windows are counted by a partial aggregate and the counts written, so that the join reads two tables and
    adaptive execution can split a window that a third of all documents hold."""
    ids = windows.groupBy("h", "c").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    ids = written_lean(ids.select("h", "c", "first"), "repeated")
    kept = windows.join(ids, ["h", "c"])
    return (kept.where("doc_id > first") if later else kept).groupBy("doc_id", "tid").agg(F.collect_set("start").alias("starts"))


def _first_level(rows: DataFrame, length: int, within: int) -> DataFrame:
    windows = written_lean(marked(rows, length, within), "marks")
    alive = written_lean(_alive(windows, False), "alive")
    drop_written(windows)
    return alive


def _next_level(rows: DataFrame, alive: DataFrame, length: int, half: int, by_mark: bool, later: bool) -> DataFrame:
    windows = written_lean(extended(rows, alive, length, half, by_mark), "windows")
    found = written_lean(_alive(windows, later), "alive")
    drop_written(windows, alive)
    return found


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, tid, starts): where windows of `window` words start that also start in a document of a smaller id; tid
    is xxhash64 of the text as bytes. Rows without an id take no part; rows that share an id don't repeat each other; a
    null text has no words, and texts shorter than the window have no windows. Texts are read whole; an empty table
    gives no rows."""
    rows, lengths = _identified(docs), levels(window)
    alive = _first_level(rows, *lengths[:2])
    for k in range(1, len(lengths)):
        alive = _next_level(rows, alive, lengths[k], lengths[k - 1], k == 1, later=lengths[k] == window)
    return alive


def longest_repeats(docs: DataFrame, short: int = 25) -> DataFrame:
    """(doc_id, tid, longest): the greatest of the lengths 2 x short, 4 x short, ... of which a document holds a window
    that a document of another id holds too; no row for a document without any. Goes on until no candidate survives."""
    rows, length, found = _identified(docs), short, None
    alive, by_mark = _first_level(rows, short, 2 * short), True
    while True:
        length *= 2
        alive = _next_level(rows, alive, length, length // 2, by_mark, later=False)
        by_mark = False
        if alive.isEmpty():
            break
        here = written_lean(alive.select("doc_id", "tid", F.lit(length).alias("longest")), "longest")
        found = here if found is None else found.union(here)
    drop_written(alive)
    if found is None:
        return alive.sparkSession.createDataFrame([], "doc_id long, tid long, longest int")
    return found.groupBy("doc_id", "tid").agg(F.max("longest").alias("longest"))


def without_repeats(text: bytes, starts: np.ndarray | None, window: int) -> tuple[int, int, str]:
    """(words, words under the windows at `starts`, SHA-256 of the others joined by spaces)."""
    cover, at, removed, digest, begun = None, 0, 0, hashlib.sha256(), False
    if starts is not None and len(starts):
        edges = np.zeros(int(starts.max()) + window + 1, np.int32)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + window, -1)
        cover = np.cumsum(edges) > 0
    for words in segments(text):
        kept = words
        if cover is not None:
            gone = cover[at : at + len(words)]
            kept = [*compress(words, ~gone), *words[len(gone) :]]
        at += len(words)
        removed += len(words) - len(kept)
        if kept:
            digest.update((b" " if begun else b"") + b" ".join(kept))
            begun = True
    return at, removed, digest.hexdigest()


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row: what is left once the windows of repeated_windows() are
    gone. A row without an id keeps all its words; a null or empty text has none, and repeated rows give a row each."""
    found = repeated_windows(docs, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, starts in zip(batch.column(1), batch.column(2), strict=True):
                known = starts.values.to_numpy().astype(np.int64) if starts.is_valid else None
                out.append(without_repeats(text.as_py() or b"", known, window))
            n, removed, digest = zip(*out, strict=True) if out else ((), (), ())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = _identified(docs).join(found, ["doc_id", "tid"], "left").select("doc_id", "text", "starts")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without the windows of 50 words that documents of a smaller id have."""
    return deduplicated(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, rid, w, unnest(range(1, len(w) + 1)) AS i FROM texts
), windows AS (
  SELECT doc_id, rid, i, w[i] AS word, CASE WHEN i + 49 <= len(w) THEN md5(array_to_string(w[i : i + 49], ' ')) END AS x FROM places
), firsts AS (
  SELECT x, min(doc_id) AS first FROM windows WHERE x IS NOT NULL GROUP BY x HAVING min(doc_id) < max(doc_id)
), flagged AS (
  SELECT rid, i, word, coalesce(windows.doc_id > first, false) AS again FROM windows LEFT JOIN firsts USING (x)
), covered AS (
  SELECT rid, i, word, bool_or(again) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM flagged
), left_over AS (
  SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (rid)
"""
