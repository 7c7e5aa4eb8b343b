"""SimHash near-duplicates over a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight bytes at eight positions. Two fingerprints that differ in at most d = 4 bits differ in at
most d bytes, so they share at least 8 - d positional bytes: the guaranteed minimum of the count filter. The index
posts each distinct fingerprint under its (position, byte) keys. Of positions 0 to d alone, as a pair that shares the
minimum shares one of these. Within a list, each pair's shared positional bytes are tallied; pairs that reach the
minimum are verified by Hamming distance.

A list of more than LIST members is split by one more positional byte, at a later position: a pair that reaches the
minimum must share a further one, as long as the list's key is shorter than that. Lists that agree in 8 - d bytes and
are still too long are split by fifths of the bits that are left, of which a pair within d bits agrees in one at least.
So lists stay short however many fingerprints there are, and every pair that the whole index would find is in one of
them. Of a list's links, only a spanning forest leaves the task: components need no more, and a list of n near copies
gives at most n - 1 rows. Connected components then run over the distinct fingerprints.
"""
from __future__ import annotations

from collections.abc import Iterator
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import as_row, drop_written, table, written
from foliant.llm.components import connected_components

SHINGLE = 4
DISTANCE = 4
CHUNK = 1 << 15  #: shingles whose bits are counted at once
LIST = 512  #: longer posting lists are split
POSITIONS = 8


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer; 0 for null or no words."""
    words = text.lower().split() if text else []  # both concern ASCII only, for bytes
    if not words:
        return 0
    line, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - size + 1)
    starts, ends = (ends - lengths)[:n].tolist(), ends[min(size, len(words)) - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([digest(line[a:b], 42) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row."""
    return docs.select("doc_id", F.col("text").cast("binary").alias("t")).select("doc_id", _fingerprints("t").alias("fp"))


def _zero_bytes(x: np.ndarray) -> np.ndarray:
    """How many of each number's bytes are 0."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    return POSITIONS - np.bitwise_count(((x & low) + low | x) & ~low)


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within `distance` bits among distinct fingerprints (uint64): shared positional
    bytes are tallied, and pairs that reach the guaranteed minimum are verified. What has been reached is never
    compared again, so a dense list costs little more than its length."""
    out, left = [], fps
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            differs = left ^ at
            candidates = np.flatnonzero(_zero_bytes(differs) >= POSITIONS - distance)
            near = candidates[np.bitwise_count(differs[candidates]) <= distance]
            if len(near):
                found, left = left[near], np.delete(left, near)
                out += [(int(x), int(at)) for x in found]
                front += list(found)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _split_masks(mask: int, distance: int) -> list[int]:
    """The masks (bits that a list's members agree in) that a list of `mask` is split into; none if it can't be."""
    whole = [p for p in range(POSITIONS) if mask >> 8 * p & 0xFF == 0xFF]
    need = POSITIONS - distance
    if len(whole) < need and mask == sum(0xFF << 8 * p for p in whole):
        start = whole[-1] + 1 if whole else 0
        return [mask | 0xFF << 8 * p for p in range(start, POSITIONS - need + len(whole) + 1)]
    rest = [b for b in range(64) if not mask >> b & 1]
    if len(rest) <= 4 * (distance + 1):
        return []  # members that differ in so few bits are close together
    parts = distance + 1
    return [mask | sum(1 << b for b in rest[k * len(rest) // parts : (k + 1) * len(rest) // parts]) for k in range(parts)]


def _posted(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """(mask, b, fp) of rows (mask, fp), under every mask that theirs is split into."""
    table = F.create_map(*[x for m, split in masks.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in split]))])
    each = rows.select("fp", F.explode(F.try_element_at(table, F.col("mask"))).alias("mask"))
    return each.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("b"), "fp")


def candidate_links(distinct: DataFrame, distance: int = DISTANCE, longest: int | None = None, made: list[DataFrame] | None = None) -> DataFrame:
    """Verified links (u, v) between distinct fingerprints (fp): of every posting list, a spanning forest.

    Lists are split level by level. The first levels, whose lists are too long on average, are gone through at once.
    `made` gets the tables that the links rest on."""
    longest, made = longest or LIST, [] if made is None else made
    n = distinct.count()
    masks, depth = [0], 0
    while depth < 1 or (depth < POSITIONS - distance and n / 256**depth > longest / 4):
        split = {m: _split_masks(m, distance) for m in masks}
        masks, depth = [k for x in split.values() for k in x], depth + 1
    base = F.array(*[F.lit(_signed(m)) for m in masks])
    rows = distinct.select("fp", F.explode(base).alias("mask")).select(F.col("mask"), F.col("fp").bitwiseAND(F.col("mask")).alias("b"), "fp")
    links = None
    while True:
        splits = {m: x for m in masks if (x := _split_masks(m, distance))}
        if splits:
            rows = written(rows, "postings")
            sizes = written(rows.groupBy("mask", "b").agg(F.count("*").alias("n")).where(F.col("n") > longest).select("mask", "b"), "long")
            known = F.col("mask").isin([_signed(m) for m in splits])
            found_long = not sizes.where(known).isEmpty()
            made += [rows, sizes]
        else:
            found_long = False
        short = rows.join(sizes.where(known), ["mask", "b"], "left_anti") if found_long else rows
        own = written(_verified(short, distance), "links")
        made.append(own)
        links = own if links is None else links.union(own)
        if not found_long:
            break
        longer = rows.join(sizes.where(known), ["mask", "b"], "left_semi").select("mask", "fp")
        rows, masks = _posted(longer, splits), [k for x in splits.values() for k in x]
        masks = list(dict.fromkeys(masks))
    return links


def _verified(rows: DataFrame, distance: int) -> DataFrame:
    """The forests of the lists (mask, b) of rows (mask, b, fp)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "mask", "b").sortWithinPartitions("mask", "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last = None

        def close(out: list) -> None:
            if held and sum(map(len, held)) > 1:
                out += _forest(np.unique(np.concatenate(held).view(np.uint64)), distance)
            held.clear()

        def pack(out: list) -> pa.RecordBatch:
            x = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["u", "v"])

        for batch in batches:
            k, b, fp = (batch.column(i).to_numpy() for i in range(3))
            if not len(fp):
                continue
            cuts = np.flatnonzero((np.diff(k) != 0) | (np.diff(b) != 0)) + 1
            starts, ends, out = np.r_[0, cuts], np.r_[cuts, len(fp)], []
            long_ones = np.flatnonzero(ends - starts > 1).tolist()
            for i in dict.fromkeys([0, *long_ones, len(starts) - 1]):
                key = (int(k[starts[i]]), int(b[starts[i]]))
                if key != last:
                    close(out)
                    last = key
                held.append(fp[starts[i] : ends[i]])
            yield pack(out)
        out: list = []
        close(out)
        yield pack(out)

    return dealt.mapInArrow(verify, "u long, v long")


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """prints (doc_id, fp) with component_id, the least doc_id reachable over links of at most `distance` bits.
    Rows with a null doc_id link like others but never name a component, unless it has no other id (null then).
    Repeated rows stay as they are; texts without words, null or empty, all have fingerprint 0 and are one component;
    very long texts are fingerprinted whole; an empty table gives no rows."""
    prints = written(prints, "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    made: list[DataFrame] = []
    roots = connected_components(candidate_links(distinct, distance, made=made))
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of = written(of, "roots")
    names = written(of.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    named = written(of.join(names, "root").select("fp", "root", "component_id"), "named")
    drop_written(distinct, of, names, *made)
    return prints.join(named, "fp").select("doc_id", "fp", "component_id", "root")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of documents; components() says what odd rows give."""
    found = components(fingerprints(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: that of the least doc_id (all rows that share that id, should an id
    repeat). A component of rows without an id keeps one of them: of the least fingerprint and text. Null, empty,
    repeated and very long texts: as components() says; extra columns, whatever their names, pass through; an empty
    table stays empty."""
    named = docs.where(F.col("doc_id").isNotNull())
    found = components(fingerprints(docs))
    stay = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = named.join(stay, "doc_id", "left_semi").select(*docs.columns)
    bare = docs.where(F.col("doc_id").isNull())
    if bare.isEmpty():
        return kept
    lone = written(found.where("component_id is null").select("fp", "root").distinct(), "lone")
    rows = bare.select(as_row(docs).alias("row"), F.col("text").alias("_t"), _fingerprints(F.col("text").cast("binary")).alias("fp"))
    first = rows.join(lone, "fp").groupBy("root").agg(F.min(F.struct("fp", F.coalesce("_t", F.lit("")).alias("t"), F.to_json("row").alias("by"), "row")).alias("x"))
    return kept.union(first.select("x.row.*"))
