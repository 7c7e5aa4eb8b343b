"""Regular-expression matches with their places, in DataFrame functions only.

split() gives what lies between the matches and regexp_extract_all() the matches; the lengths of both, summed up,
are the places in code points. Sums are carried over blocks of BLOCK matches, so a text with very many matches costs
little more than in proportion. Patterns must not match the empty string.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
CUT = 1024  #: code points of the pieces that masking cuts a text into


def with_matches(df: DataFrame, text: str, patterns: dict[str, str], gates: dict[str, Column] | None = None, context: bool = False) -> DataFrame:
    """df with, for each kind k, `k_hits`: array<struct<s, e, m>> of all leftmost non-overlapping matches:
    start, end (exclusive) and the matched text; with `context` also `before` and `after`, of what lies between it and the
    last and the next match the last three and the first two pieces that spaces separate, and whether white space
    parts them from the match (`apart`, `parted`). `gates`: a cheap
    condition that any text with a match fulfils."""
    gates = gates or {}
    none = F.array().cast("array<string>")
    kinds = list(patterns)
    step = df.select(
        "*",
        *[F.when(gates.get(k, F.lit(True)), F.regexp_extract_all(F.col(text), F.lit(patterns[k]), F.lit(0))).otherwise(none).alias(f"_{k}_m") for k in kinds],
    )
    step = step.select(
        "*", *[F.when(F.size(f"_{k}_m") > 0, F.split(F.col(text), patterns[k], -1)).otherwise(none).alias(f"_{k}_p") for k in kinds]
    )
    step = step.select(
        "*",
        *[F.zip_with(f"_{k}_p", f"_{k}_m", lambda p, m: F.length(p).cast("long") + F.coalesce(F.length(m), F.lit(0))).alias(f"_{k}_l") for k in kinds],
    )
    step = step.select("*", *[_block_sums(F.col(f"_{k}_l")).alias(f"_{k}_b") for k in kinds])
    keep = [F.col(f"`{c}`") for c in df.columns]
    return step.select(*keep, *[_hits(k, context).alias(f"{k}_hits") for k in kinds])


def _block_sums(lengths: Column) -> Column:
    """The sum of all lengths before each block."""
    blocks = F.when(F.size(lengths) > 0, F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    total = lambda b: F.aggregate(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0).cast("long"), lambda a, x: a + x)
    return F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + total(b))))


def _hits(kind: str, context: bool) -> Column:
    m, p, lengths, sums = (F.col(f"_{kind}_{x}") for x in "mplb")

    def hit(match: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        before = F.get(sums, block) + F.aggregate(F.slice(lengths, block * BLOCK + 1, i - block * BLOCK), F.lit(0).cast("long"), lambda a, x: a + x)
        start = before + F.length(F.get(p, i))
        found = [start.alias("s"), (start + F.length(match)).alias("e"), match.alias("m")]
        if context:
            blank = F.lit(" \t\n\r\x0b\f")
            found += [F.substring_index(F.rtrim(F.get(p, i), blank), " ", -3).alias("before"), F.substring_index(F.ltrim(F.get(p, i + 1), blank), " ", 2).alias("after")]
            found += [F.get(p, i).rlike(r"[\x20\x09-\x0D]$").alias("apart"), F.get(p, i + 1).rlike(r"^[\x20\x09-\x0D]").alias("parted")]
        return F.struct(*found)

    return F.transform(m, hit)


def _overlaps(hit: Column, spans: Column) -> Column:
    """A binary search: of the spans that start before the hit's end, the last ends last."""
    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(spans))))  # as many halvings as the size has bits, one more

    def halve(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        before = (a["lo"] < a["hi"]) & (F.get(spans, mid)["s"] < hit["e"])
        return F.struct(F.when(before, mid + 1).otherwise(a["lo"]).alias("lo"), F.when((a["lo"] < a["hi"]) & ~before, mid).otherwise(a["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    last = F.aggregate(steps, start, halve, lambda a: a["lo"]) - 1
    return F.coalesce(F.get(spans, last)["e"] > hit["s"], F.lit(False))


def overlaps_sorted(hit: Column, columns: list[str]) -> Column:
    """Whether a hit overlaps a span of any of the array columns; each must hold spans (s, e) that ascend and don't
    overlap one another."""
    out = F.lit(False)
    for c in columns:
        out = out | _overlaps(hit, F.col(c))
    return out


def with_masked(df: DataFrame, text: str, spans: str, out: str) -> DataFrame:
    """df with `out`: the text with every span (s, e, kind) replaced by its kind in angle brackets; overlapping spans
    are one, named by the first. The text is cut into pieces of CUT code points once and put together from these, and
    the largest end so far is carried over blocks of spans, so a text with very many spans costs in proportion."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].cast("long").alias("s"), x["e"].cast("long").alias("e"), x["kind"].alias("kind"))))
    step = df.select(*keep, order.alias("_o"))
    o = F.col("_o")
    blocks = F.when(F.size(o) > 0, F.sequence(F.lit(0), F.floor((F.size(o) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    top = lambda part: F.coalesce(F.array_max(F.transform(part, lambda x: x["e"])), F.lit(0).cast("long"))
    reach = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda acc, b: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), top(F.slice(o, b * BLOCK + 1, F.lit(BLOCK)))))))
    step = step.select("*", reach.alias("_r"))

    def ended(i: Column) -> Column:
        """The largest end of the spans before the i-th."""
        block = F.floor(i / BLOCK).cast("int")
        return F.greatest(F.get("_r", block), top(F.slice(o, block * BLOCK + 1, i - block * BLOCK)))

    step = step.select("*", F.transform(o, lambda x, i: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), ended(i).alias("before"))).alias("_e"))
    step = step.select("*", F.filter("_e", lambda x: x["s"] >= x["before"]).alias("_g"))
    pieces = F.when(F.size("_g") > 0, F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)))
    step = step.select("*", pieces.alias("_p"))

    def between(a: Column, b: Column) -> Column:
        at, to = F.floor(a / CUT).cast("int"), F.floor(b / CUT).cast("int")
        first, last = (a % CUT).cast("int"), (b % CUT).cast("int")
        same = F.substring(F.get("_p", at), first + 1, last - first)
        far = F.concat(F.substring(F.get("_p", at), first + 1, F.lit(CUT)), F.array_join(F.slice("_p", at + 2, to - at - 1), ""), F.substring(F.coalesce(F.get("_p", to), F.lit("")), F.lit(1), last))
        return F.when(b <= a, F.lit("")).when(at == to, same).otherwise(far)

    told = F.transform("_g", lambda x: F.concat(between(x["before"], x["s"]), F.lit("<"), x["kind"], F.lit(">")))
    rest = between(F.element_at("_r", -1), F.length(text).cast("long"))
    whole = F.when(F.size("_g") > 0, F.concat(F.array_join(told, ""), rest)).otherwise(F.col(text))
    return step.select(*keep, whole.alias(out))


def joined(spans: Column) -> Column:
    """kind:start:end of an array of structs that hold them, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
