"""Phrases whose words stand together more often than chance would have it, mined in passes with hashed bucket counts.

Pass k counts phrases of k words exactly, and in the same pass adds up how often each bucket of phrases of k + 1 words
is hit. A phrase of k + 1 words is counted in the next pass only if its bucket reached the support (a bitmap of
2**BITS bits, broadcast) and both of its phrases of k words did (another such bitmap, by hash). Both bitmaps let
phrases through that needn't be counted and hold back none that must be, and both have the same size whatever the
corpus; what is counted is exact.

Everything is per language, which goes into the hashes.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.llm.common import drop_written, table, written, written_lean

SUPPORT = 100
LONGEST = 5  #: words of a phrase
TOP = 2000  #: phrases of a language's report
BITS = 24  #: of a bucket's number
BLOCK = 1 << 20  #: bytes of texts that are gone through at once; a piece may be longer
HELD = 150_000  #: phrases whose counts a task holds before it passes them on
BATCH = 1 << 16  #: rows that a task passes on at once
_BASE, _WORD_BASE, _CHECK_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0x85EBCA6B  #: odd
_WORD_INVERSE, _CHECK_INVERSE = pow(_WORD_BASE, -1, 1 << 64), pow(_CHECK_BASE, -1, 1 << 32)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_END = 10  #: the byte between pieces
#: A-Z in lower case, the signs between pieces one, both kinds of space one.
FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0a\x0b\x0c\x0d\t", bytes(range(97, 123)) + b"\n" * 10 + b" ")


class _Powers:
    """Powers of the bases of words' hashes and of their inverses, as many as the longest block so far has bytes."""

    made: tuple[np.ndarray, ...] = ()

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, ...]:
        if not cls.made or len(cls.made[0]) < n:
            def powers(base: int, kind: type) -> np.ndarray:
                out = np.full(max(n, BLOCK + 1), base, kind)
                out[0] = 1
                return np.multiply.accumulate(out, dtype=kind)

            made = tuple(powers(b, t) for b, t in ((_WORD_BASE, np.uint64), (_WORD_INVERSE, np.uint64), (_CHECK_BASE, np.uint32), (_CHECK_INVERSE, np.uint32)))
            if n > 1 << 24:  # not kept for one enormous piece
                return made
            cls.made = made
        return cls.made


class Block:
    """The words of some texts of one language: where they stand, the piece of each, two hashes of each."""

    def __init__(self, texts: list[bytes], lang: int):
        self.bytes = b"\n".join(texts)
        x = np.frombuffer(self.bytes, np.uint8)
        solid = np.concatenate([[False], (x != 32) & (x != _END), [False]])
        turns = np.flatnonzero(solid[1:] != solid[:-1])
        self.starts, self.ends = turns[::2], turns[1::2]
        self.piece = np.cumsum(x == _END, dtype=np.int32)[self.starts]
        up, down, up2, down2 = _Powers.to(len(x))
        if len(self.starts):
            y = (x.astype(np.uint32) + np.uint32(1)) * solid[1:-1]
            self.hash = np.add.reduceat(y * up[: len(x)], self.starts) * down[self.starts] + np.uint64(lang)
            self.check = np.add.reduceat(y * up2[: len(x)], self.starts, dtype=np.uint32) * down2[self.starts]
        else:
            self.hash, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint32)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the phrases of k words, from each word on: whether they stay within a piece, their hash and their other
        hash. The hash of a phrase within is that of the same words alone."""
        n = max(0, len(self.starts) - k + 1)
        h, c = np.zeros(n, np.uint64), np.zeros(n, np.uint32)
        for j in range(k):
            h = h * np.uint64(_BASE) + self.hash[j : j + n]
            c = c * np.uint32(_CHECK_BASE) + self.check[j : j + n]
        h ^= h >> np.uint64(32)
        h *= _MIX
        return self.piece[:n] == self.piece[k - 1 : k - 1 + n], h ^ (h >> np.uint64(29)), c

    def phrase(self, start: int, end: int) -> bytes:
        found = self.bytes[start:end]
        return b" ".join(found.split()) if b"  " in found else found


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _in(bitmap: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return (bitmap[buckets >> 3] >> (buckets & 7).astype(np.uint8) & 1).astype(bool)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, folded texts) of about BLOCK bytes. A longer text is cut between pieces."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang, text = lang.as_py(), text.as_py().translate(FOLD)
            at = 0
            while at < len(text):
                cut = text.find(b"\n", at + BLOCK) if len(text) - at > BLOCK else -1
                part = text[at : cut if cut >= 0 else len(text)] if at or cut >= 0 else text
                at += len(part) + 1
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                if sizes[lang] >= BLOCK:
                    yield lang, held.pop(lang)
                    sizes.pop(lang)
        while sum(sizes.values()) > 4 * BLOCK:  # many languages
            lang = max(sizes, key=sizes.__getitem__)
            yield lang, held.pop(lang)
            sizes.pop(lang)
    yield from held.items()


def lang_seed(lang: str) -> int:
    return int.from_bytes(lang.encode("utf-8", "surrogatepass")[:64].ljust(8, b"\0"), "big") * _BASE % (1 << 64)


def _rows(counts: dict[str, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
    """Counts by language and phrase, each in one number with its bucket, n << BITS | bucket; what is passed on is let go."""
    while counts:
        lang, own = counts.popitem()
        keys, packed = list(own), np.fromiter(own.values(), np.int64, len(own))
        own.clear()
        for at in range(0, len(keys), BATCH):
            n = packed[at : at + BATCH]
            langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32)))
            yield pa.RecordBatch.from_arrays([langs, pa.array(keys[at : at + BATCH], pa.string()), pa.array(n & (1 << BITS) - 1), pa.array(n >> BITS)], ["lang", "phrase", "bucket", "n"])


def one_pass(texts: DataFrame, k: int, shorter: Broadcast | None, allowed: Broadcast | None, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, bucket, n): partial counts of the phrases of k words that may reach the support, with their own
    bucket; and, without lang and phrase, partial counts of the buckets of k + 1 words. `shorter`: the bitmap of the
    frequent phrases of k - 1 words; `allowed`: that of the frequent buckets of k words."""

    def passing(block: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside, h, check = block.grams(k)
        if k > 1 and shorter is not None:
            ok = inside & _in(allowed.value, bucket(h))
            of = _in(shorter.value, bucket(block.grams(k - 1)[1]))
            inside = ok & of[: len(h)] & of[1 : 1 + len(h)]
        return inside, h, check

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[bytes, int]] = {}
        held = added = 0
        hits = np.zeros(1 << BITS, np.uint32) if k < longest else None
        for lang, parts in _blocks(batches):
            block = Block(parts, lang_seed(lang))
            good, h, check = passing(block, k)
            left = np.flatnonzero(good)
            while len(left):  # once, unless hashes collide
                _, first, back, n = np.unique(h[left], return_index=True, return_inverse=True, return_counts=True)
                other = check[left] != check[left][first][back]
                if other.any():
                    n = np.bincount(back[~other], minlength=len(first))
                of, own = left[first], counts.setdefault(lang, {})
                held -= len(own)
                for start, end, b, m in zip(block.starts[of].tolist(), block.ends[of + k - 1].tolist(), bucket(h[of]).tolist(), n.tolist(), strict=True):
                    key = block.phrase(start, end)
                    own[key] = own[key] + (m << BITS) if key in own else m << BITS | b
                held += len(own)
                left = left[other]
            if hits is not None:
                inside, longer, _ = block.grams(k + 1)
                inside &= good[: len(longer)] & good[1 : 1 + len(longer)]
                np.add.at(hits, bucket(longer[inside]), 1)
                added += int(inside.sum())
                if added > 1 << 31:
                    yield from _bucket_rows(hits)
                    hits[:], added = 0, 0
            if held > HELD:
                yield from _rows(counts)
                held = 0
        yield from _rows(counts)
        if hits is not None:
            yield from _bucket_rows(hits)

    return texts.mapInArrow(run, "lang string, phrase string, bucket long, n long")


def _bucket_rows(hits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The buckets that were hit, and how often."""
    for at in range(0, len(hits), BATCH):
        own = np.flatnonzero(hits[at : at + BATCH])
        if len(own):
            none = pa.nulls(len(own), pa.string())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(own + at), pa.array(hits[own + at].astype(np.int64))], ["lang", "phrase", "bucket", "n"])


def bitmap(buckets: DataFrame) -> np.ndarray:
    """2**BITS bits, those of the column bucket set. It is put together by Spark; the driver gets the bitmap alone."""
    number = F.col("bucket") + 1
    found = buckets.groupBy(F.bitmap_bucket_number(number).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    out = np.zeros(max((1 << BITS) // 8, 4096), np.uint8)
    for row in found.collect():
        out[(row.k - 1) * 4096 : row.k * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of all phrases of up to `longest` words found `support` times or more in a language, and
    (lang, n) its words in all. A null lang is `und`, a null or empty text has no words, repeated rows count each, texts
    are read whole, and an empty table gives no rows."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")).where("text is not null")
    spark, shorter, allowed, found, totals = docs.sparkSession, None, None, [], None
    for k in range(1, longest + 1):
        counted = written(one_pass(texts, k, shorter, allowed, longest), "counted")
        phrases = counted.where("phrase is not null")
        if k == 1:
            totals = written_lean(phrases.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        own = phrases.groupBy("lang", "phrase").agg(F.sum("n").alias("f"), F.first("bucket").alias("bucket")).where(F.col("f") >= support)
        own = written_lean(own.select("lang", F.lit(k).alias("k"), "phrase", "f", "bucket"), "frequent")
        found.append(own)
        for old in (shorter, allowed):
            if old is not None:
                old.destroy()
        if k < longest:
            full = counted.where("phrase is null").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
            shorter, allowed = (spark.sparkContext.broadcast(bitmap(x)) for x in (own, full))
        drop_written(counted)
    out = found[0]
    for own in found[1:]:
        out = out.union(own)
    return out.drop("bucket"), totals


def _part(first: str, count: str) -> str:
    return f"array_join(slice(words, {first}, {count}), ' ')"


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases by the score of their weakest cut, score
    floor(1000 a n / (l r)) in whole numbers of up to 38 digits. Left out are phrases that a longer frequent one holds
    as often. Ties go to the larger a, then to the lesser phrase in UTF-8's order. frequent_phrases() says what odd rows
    give."""
    found, totals = frequent_phrases(docs, support, longest)
    phrases = written_lean(found.select("lang", "phrase", "k", "f", F.split("phrase", " ").alias("words")), "phrases")
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("times"))
    several = phrases.where("k > 1")
    # a longer phrase has its parts' words, so a part is kept unless one of them is found as often
    inner = several.where("k > 2").select("lang", "f", "words", F.expr("explode(sequence(2, k - 1)) as size"), "k")
    inner = inner.select("lang", "f", "words", "size", F.expr("explode(sequence(1, k - size + 1)) as at")).select("lang", F.expr(_part("at", "size")).alias("phrase"), "f")
    held = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = several.join(held, ["lang", "phrase"], "left").where("longer is null or longer < f").select("lang", "phrase", "words", "k", F.col("f").alias("a"))
    cuts = kept.select("*", F.expr("explode(sequence(1, k - 1)) as cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.expr(_part("1", "cut")).alias("head"), F.expr(_part("cut + 1", "k - cut")).alias("rest"))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("head"), F.col("times").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("rest"), F.col("times").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    whole = lambda c: f"cast({c} as decimal(20, 0))"
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {whole('a')} * {whole('n')}) div ({whole('l')} * {whole('r')})")
    least = cuts.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "cut", "l", "r").alias("x")).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("x").alias("x"))
    scored = least.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")  # tasks pass on `top` rows a language at most
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of each language of documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM texts
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) AS r(k) WHERE len(w) >= k)
), counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::HUGEINT AS n FROM counted WHERE k = 1 GROUP BY lang
), frequent AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= 100
), inner_phrases AS (
  SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM frequent, range(2, 5) AS r(s) WHERE s < k) GROUP BY ALL
), kept AS (
  SELECT c.* FROM frequent c LEFT JOIN inner_phrases USING (lang, phrase) WHERE k > 1 AND NOT coalesce(100 * longer >= 100 * f, false)
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, cut, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) c
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')
  JOIN totals ON totals.lang = c.lang
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n::BIGINT AS n, score
FROM scored QUALIFY rank <= 2000
"""
