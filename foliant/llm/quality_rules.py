"""Quality rules with adaptive thresholds. DataFrame functions only.

Per text, word statistics are computed with array functions inside one stage (windows of words are hashed, sorted and
compared within the row; nothing is exploded or shuffled). Ratios are summarised per language and source in mergeable
quantile sketches, which merge by addition, so a source with a third of all rows is counted in every task and never
gathered. Each group's cutoffs lie beyond the tail quantiles of its own sketch, and a join of the documents with them
filters.

A sketch counts values by their 8 leading bits: bins of a relative width of at most 1/128, over any range, 128 for
each power of two. Counts are exact, so a quantile's bin is that of the value of exactly this rank (no rank error but
among values of one bin) and its lower end is within 1/128 of that value.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.llm.common import SPACE, drop_written, table, written

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
POSITION_BITS = 20  #: of a sorted key; the other 44 bits are of the window's hash
PPM, MILLI = 1_000_000, 1000
LEADING = 8  #: bits of a value that its bin keeps
PRIOR = 50  #: documents that the wider group's cutoff counts for beside a group's own
#: Ratios: their scale, the rank (in hundredths) of the tail quantile, and whether the lower tail counts too. A cutoff
#: lies as far beyond its quantile as that is from the median.
RATIOS = {"symbol_ratio": (PPM, 90, False), "dup_line_ratio": (PPM, 98, False), "repeat_ratio": (PPM, 98, False), "word_length": (MILLI, 95, True)}


def _covered(sorted_positions: Column) -> Column:
    """How many positions lie in windows of three that begin at the given ones, which ascend."""
    start = F.struct(F.lit(-1).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + 3 - F.greatest(F.lit(0), a["end"] - p)).alias("n"))
    return F.aggregate(sorted_positions, start, step, lambda a: a["n"])


def _repeated(keys: Column, same) -> Column:
    """Of sorted keys, those equal to a neighbour."""
    return F.filter(keys, lambda x, i: F.coalesce(same(x, F.get(keys, i + 1)), F.lit(False)) | F.coalesce(same(x, F.get(keys, i - 1)), F.lit(False)))


def word_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Per row of docs: doc_id, `keep`, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long). A null
    text has no words.

    Windows of three words are told apart by 64-bit hashes. The fast path sorts 44 bits of them with the position in
    one long; where that merges two different windows (then there are fewer 44-bit than 64-bit values) or the text
    has more positions than fit, pairs of hash and position are sorted instead."""
    text = F.coalesce("text", F.lit(""))
    step = docs.select(
        "doc_id", *keep, text.alias("t"), F.array_remove(F.split(text, SPACE, -1), "").alias("w"), F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines")
    )
    words = F.col("w")
    starts = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    step = step.select(
        "doc_id",
        *keep,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))).alias("h"),
    )
    low = (1 << POSITION_BITS) - 1
    step = step.select("*", F.size(F.array_distinct("h")).alias("distinct"))
    has = F.col("distinct") < F.size("h")  # else no window is repeated and nothing need be sorted
    fits = F.size("h") <= low
    packed = F.transform("h", lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
    step = step.select("*", F.when(has & fits, F.sort_array(packed)).alias("keys"))
    top = lambda x: x.bitwiseAND(F.lit(~low))
    exact = F.size(F.array_distinct(F.transform("keys", top))) == F.col("distinct")
    step = step.select("*", F.when(has & fits, exact).otherwise(False).alias("exact"))
    pairs = F.transform("h", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i")))
    step = step.select("*", F.when(has & ~F.col("exact"), F.array_sort(pairs)).alias("pairs"))
    fast = F.transform(_repeated(F.col("keys"), lambda x, y: top(x) == top(y)), lambda x: x.bitwiseAND(F.lit(low)))
    slow = F.transform(_repeated(F.col("pairs"), lambda x, y: x["h"] == y["h"]), lambda x: x["i"])
    step = step.select("*", F.when(~has, F.array().cast("array<long>")).when(F.col("exact"), fast).otherwise(slow).alias("at"))
    return step.select("doc_id", *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", _covered(F.sort_array("at")).alias("n_repeat_words"), "n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _bin(top: Column, below: Column, scale: int) -> Column:
    """floor(scale * top / below) to its leading bits, in whole numbers (0 where `below` is 0)."""
    value = F.when(below > 0, (top * scale - F.pmod(top * scale, below)) / below).otherwise(0).cast("long")
    drop = F.greatest(F.lit(0), F.length(F.bin(value)) - LEADING)
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def ratio_bins(stats: DataFrame) -> DataFrame:
    c = F.col
    return stats.select(
        "*",
        _bin(c("n_symbols"), c("word_chars"), RATIOS["symbol_ratio"][0]).alias("symbol_ratio"),
        _bin(c("n_dup_lines"), c("n_lines"), RATIOS["dup_line_ratio"][0]).alias("dup_line_ratio"),
        _bin(c("n_repeat_words"), c("n_words"), RATIOS["repeat_ratio"][0]).alias("repeat_ratio"),
        _bin(c("word_chars"), c("n_words"), RATIOS["word_length"][0]).alias("word_length"),
    )


def sketches(stats: DataFrame, *group: str) -> DataFrame:
    """(group, ratio, bin, n): a quantile sketch per group and ratio. Sketches of parts merge by adding n."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), F.col(r).alias("bin")) for r in RATIOS])).alias("x")
    return stats.select(*group, each).groupBy(*group, "x.ratio", "x.bin").agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, *group: str) -> DataFrame:
    """Per group one row: n, and high_ and low_ of every ratio (low_ below any value where only the upper tail
    counts). A sketch has at most 128 bins for each power of two, however many documents it saw."""
    key = [*group, "ratio"]
    run = sketch.withColumn("below", F.sum("n").over(W.partitionBy(*key).orderBy("bin"))).withColumn("all", F.sum("n").over(W.partitionBy(*key)))
    at = lambda q: F.min(F.when(F.col("below") * 100 >= F.col("all") * q, F.col("bin")))
    ranks = sorted({q for _, q, _ in RATIOS.values()} | {100 - q for _, q, low in RATIOS.values() if low} | {50})
    quantiles = run.groupBy(*key).agg(F.max("all").alias("n"), *[at(q).alias(f"q{q}") for q in ranks])
    pick = lambda r, v: F.max(F.when(F.col("ratio") == r, v))
    beyond = lambda q: 2 * F.col(f"q{q}") - F.col("q50")
    out = []
    for r, (_, q, low) in RATIOS.items():
        out += [pick(r, beyond(q)).alias(f"high_{r}"), pick(r, beyond(100 - q) if low else F.lit(-1).cast("long")).alias(f"low_{r}")]
    return quantiles.groupBy(*group).agg(F.max("n").alias("n"), *out)


CUTOFFS = [f"{side}_{r}" for r in RATIOS for side in ("high", "low")]


def drawn(own: DataFrame, wider: DataFrame, on: Column) -> DataFrame:
    """Cutoffs drawn towards those of a wider group, which count for PRIOR documents: the fewer a group has, the more.
    In whole numbers, rounded down."""
    n = F.col("own.n")

    def toward(c: str) -> Column:
        top = F.col(f"own.{c}") * n + F.col(f"wider.{c}") * PRIOR
        return F.call_function("div", top - F.pmod(top, n + PRIOR), n + PRIOR).alias(c)

    keep = [F.col(f"own.`{c}`") for c in own.columns if c not in CUTOFFS]
    return own.alias("own").join(wider.alias("wider"), on, "left").select(*keep, *map(toward, CUTOFFS))


def judge(docs: DataFrame, language: str = "lang", source: str = "source") -> DataFrame:
    """Per row of docs: doc_id, the statistics, base_failed, kept and the ratios that spoke against it. Groups are a
    language and a source (nulls are a group of their own). A group's cutoffs are drawn towards its language's, and a
    language's towards the whole table's, by weight. Values at a cutoff are kept. Documents that fail the base rules
    don't shape the cutoffs; groups of nothing else have no need of any.

    Null and empty texts have no words and fail the base rules; repeated rows are each judged, and count; very long
    texts are read whole; an empty table gives no rows; extra columns, whatever their names, are left behind."""
    rows = docs.select("doc_id", "text", F.col(language).alias("g1"), F.col(source).alias("g2"))
    stats = written(ratio_bins(word_statistics(rows, "g1", "g2")).withColumn("base_failed", base_failed()), "stats")
    sketch = written(sketches(stats.where("not base_failed"), "g1", "g2"), "sketch")
    merged = lambda *group: sketch.groupBy(*group, "ratio", "bin").agg(F.sum("n").alias("n"))
    table_wide = thresholds(merged().withColumn("g", F.lit(1)), "g")
    by_language = drawn(thresholds(merged("g1"), "g1"), F.broadcast(table_wide), F.lit(True))  # one row
    limits = drawn(thresholds(sketch, "g1", "g2"), by_language, F.col("own.g1").eqNullSafe(F.col("wider.g1")))
    key = F.xxhash64("g1", "g2", F.col("g1").isNull(), F.col("g2").isNull()).alias("g")
    limits = written(limits.select(key, *CUTOFFS), "limits")
    drop_written(sketch)
    both = stats.withColumn("g", key).join(limits, "g", "left")
    against = F.array_compact(F.array(*[F.when(~F.col(r).between(F.col(f"low_{r}"), F.col(f"high_{r}")), F.lit(r)) for r in RATIOS]))
    judged = both.withColumn("against", F.when(F.col("base_failed"), F.lit("base")).otherwise(F.array_join(against, ",")))
    return judged.withColumn("kept", F.col("against") == "")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents by judge(), which says what null, empty, repeated and very long texts give."""
    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "against")


def _limits_sql(relation: str, group: str) -> str:
    """Cutoffs from exact quantiles of the bins."""
    at = lambda r, q: f"quantile_disc({r}, {q / 100})"
    columns = []
    for r, (_, q, low) in RATIOS.items():
        columns += [f"2 * {at(r, q)} - {at(r, 50)} AS high_{r}", (f"2 * {at(r, 100 - q)} - {at(r, 50)}" if low else "-1") + f" AS low_{r}"]
    return f"SELECT {group}count(*) AS n, {', '.join(columns)} FROM {relation} WHERE NOT base_failed"


_DRAWN = ", ".join(f"((o.{c} * o.n + w.{c} * {PRIOR}) - ((o.{c} * o.n + w.{c} * {PRIOR}) % (o.n + {PRIOR}) + o.n + {PRIOR}) % (o.n + {PRIOR})) // (o.n + {PRIOR}) AS {c}" for c in CUTOFFS)
_OVER = ", ".join(f"CASE WHEN {r} NOT BETWEEN g.low_{r} AND g.high_{r} THEN '{r}' END" for r in RATIOS)
_RATIO_SQL = {"symbol_ratio": ("n_symbols", "word_chars"), "dup_line_ratio": ("n_dup_lines", "n_lines"), "repeat_ratio": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}
_VALUES = ", ".join(f"CASE WHEN {below} > 0 THEN {top} * {RATIOS[r][0]} // {below} ELSE 0 END AS v_{r}" for r, (top, below) in _RATIO_SQL.items())
_BINS = ", ".join(f"(v_{r} >> greatest(0, length(bin(v_{r})) - {LEADING})) << greatest(0, length(bin(v_{r})) - {LEADING}) AS {r}" for r in RATIOS)

#: The same rows in DuckDB's SQL, with exact quantiles of the same bins.
ORACLE_SQL = rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3))),
cov AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM win, (SELECT unnest(range(0, 3)) AS d) WHERE c > 1 GROUP BY doc_id),
s0 AS (SELECT w.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
s1 AS (SELECT *, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed FROM s0),
s2 AS (SELECT *, {_VALUES} FROM s1), s AS (SELECT *, {_BINS} FROM s2),
a AS ({_limits_sql("s", "")}), l0 AS ({_limits_sql("s", "lang, ")} GROUP BY lang), l AS (SELECT o.lang, o.n, {_DRAWN} FROM l0 o CROSS JOIN a w),
g0 AS ({_limits_sql("s", "lang, source, ")} GROUP BY lang, source), g AS (SELECT o.lang, o.source, {_DRAWN} FROM g0 o JOIN l w ON w.lang IS NOT DISTINCT FROM o.lang),
v AS (SELECT s.*, array_to_string(list_filter([{_OVER}], lambda x: x IS NOT NULL), ',') AS over_ FROM s LEFT JOIN g ON g.lang IS NOT DISTINCT FROM s.lang AND g.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND over_ = '' AS kept, CASE WHEN base_failed THEN 'base' ELSE over_ END AS against FROM v"""
