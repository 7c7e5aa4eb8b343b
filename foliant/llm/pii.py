"""Personal data by bootstrapped contextual extraction. DataFrame functions only.

Fixed patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers: the seeds. What stands beside a
seed is a lexical pattern for its kind: the word before it, the word after it, or what is joined to its front. Patterns
and the identifier-like values that occur in them form a bipartite graph whose scores are computed in turns, apart for
each kind. A pattern is as good as the share of all its occurrences in the corpus, whatever stands there, that hold a
believed value; a word that also precedes ordinary words has a low one. A value is believed as far as its reliable
patterns are good, and believed values support new patterns in the next turn, seeds or none. Reliable patterns, which
rest on enough different values and are many times as telling as chance, find identifiers that no fixed pattern covers;
they are added as kind `context_<kind>`. Matches that fail a fixed pattern's check narrowly (a card's Luhn digit, an
address part, a phone number's length) are never believed.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import SPACE, as_row, drop_written, table, written
from foliant.llm.spans import joined, overlaps_sorted, with_masked, with_matches

PATTERNS = {
    # \G: a match may begin where the last one ended, in the middle of a run of these characters
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": r"(?<![A-Za-z0-9._@+-])[A-Za-z._@+-]*+[0-9][A-Za-z0-9._@+-]*+",
}
KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 5  #: different believed values that a pattern must rest on
RELIABLE = 0.6  #: the least score of a pattern that is used, and the least belief in a value
LIFT = 5  #: and how many times the kind's share of all words it must be
TOKEN_DIGITS = 5  #: digits of an identifier-like token
FEW = 100_000  #: patterns that may be broadcast (two numbers each)

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    back = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)))
    return F.aggregate(back, F.lit(0).cast("long"), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    digits = _digits(x["m"])
    if kind == "ip":
        return x["m"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _narrow(kind: str, x: Column) -> Column:
    """Whether a match that isn't valid looks much like the kind."""
    return F.length(_digits(x["m"])).between(13, 19) if kind == "card" else F.lit(True)


def _plain(word: Column) -> Column:
    """A word as patterns know it: any with a digit is like any other."""
    return F.when(word.rlike("[0-9]"), F.lit("#")).otherwise(F.lower(word))


def _telling(word: Column) -> Column:
    return word.rlike(r"[\p{L}0-9]")


def _key(side: str, words: Column) -> Column:
    return F.struct(F.lit(side).alias("side"), F.xxhash64(words).alias("x"))


def contexts(x: Column) -> Column:
    """The patterns of a match: L, the word before it (where that is no more than signs, with the one before that), P,
    what is joined to its front if that has letters and no digit, and R, the word after it."""
    before, after = F.split(x["before"], SPACE), F.split(x["after"], SPACE)
    skip = F.when(x["apart"], 0).otherwise(1)  # what is joined to the match is no word before it
    word = F.coalesce(F.try_element_at(before, -1 - skip), F.lit(""))
    further = F.coalesce(F.try_element_at(before, -2 - skip), F.lit(""))
    joint = F.when(~x["apart"], F.try_element_at(before, F.lit(-1)))
    follows = F.coalesce(F.try_element_at(after, F.when(x["parted"], 1).otherwise(2)), F.lit(""))
    left = F.when(_telling(word), _plain(word)).when((word != "") & (further != ""), F.concat(_plain(further), F.lit(" "), word))
    return F.array_compact(F.array(
        F.when(left.isNotNull(), _key("L", left)),
        F.when(joint.rlike(r"\p{L}") & ~joint.rlike("[0-9]"), _key("P", F.lower(joint))),
        F.when(follows != "", _key("R", _plain(follows))),
    ))


def scan(docs: DataFrame, *keep: str) -> DataFrame:
    """One row for each row of docs: rid, doc_id, `keep`, n_words (pieces that spaces separate), base spans (by kind,
    then start) and other identifier-like tokens, each with its patterns; `bad` tokens lie in a narrowly failed match.
    Null texts count as empty."""
    text = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("t"))
    t = F.col("t")
    digit = t.rlike("[0-9]")
    gates = {"email": t.contains("@"), "ip": t.rlike(r"[0-9]\.[0-9]"), "card": digit, "phone": t.contains("+"), "token": digit}
    found = with_matches(text, "t", PATTERNS, gates, context=True)
    span = lambda k: lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), contexts(x).alias("at"), F.xxhash64(x["m"]).alias("h"))
    check = lambda kind: lambda x: _valid(kind, x)
    miss = lambda kind: lambda x: ~_valid(kind, x) & _narrow(kind, x)
    place = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    n_words = (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words")
    held = found.select(
        "doc_id", *keep, n_words, F.concat(*[F.transform(F.filter(f"{k}_hits", check(k)), span(i)) for i, k in enumerate(KINDS)]).alias("base"),
        F.filter("token_hits", lambda x: F.length(_digits(x["m"])) >= TOKEN_DIGITS).alias("tokens"),
        *[F.transform(F.filter(f"{k}_hits", check(k)), place).alias(f"{k}_at") for k in KINDS],
        *[F.transform(F.filter(f"{k}_hits", miss(k)), place).alias(f"{k}_miss") for k in KINDS[1:]],
    )
    held = held.withColumn("tokens", F.filter("tokens", lambda x: ~overlaps_sorted(x, [f"{k}_at" for k in KINDS])))
    bad = lambda x: overlaps_sorted(x, [f"{k}_miss" for k in KINDS[1:]]).alias("bad")
    told = F.transform("tokens", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), contexts(x).alias("at"), F.xxhash64(x["m"]).alias("h"), bad(x)))
    return held.select(F.monotonically_increasing_id().alias("rid"), "doc_id", *keep, "n_words", "base", told.alias("tokens"))


#: A word without letters and digits.
LONE_SIGNS = r"(?:^|[\x20\x09-\x0D])[^\p{L}0-9\x20\x09-\x0D]+(?:[\x20\x09-\x0D]|$)"


def word_counts(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(x, n): how often the words of patterns L and R (x) occur in all texts, whatever stands beside them. Words are
    exploded plainly; only texts that hold words of mere signs are gone through again, for what stands before those."""
    text = F.coalesce("text", F.lit(""))
    words = F.split(text, SPACE)
    w = F.col("w")
    alone = docs.select(F.explode(words).alias("w")).where(w != "").select(F.xxhash64(_plain(w)).alias("x"))

    def after(word: Column, i: Column) -> Column:
        pair = F.concat(_plain(F.coalesce(F.get("w", i - 1), F.lit(""))), F.lit(" "), word)
        return F.when(~_telling(word) & (word != ""), F.xxhash64(pair))

    pairs = docs.where(text.rlike(LONE_SIGNS)).select(words.alias("w")).select(F.explode(F.array_compact(F.transform("w", after))).alias("x"))
    known = patterns.select("x").distinct()
    if known.limit(FEW + 1).count() <= FEW:
        near = F.broadcast(known)
        return alone.join(near, "x").union(pairs.join(near, "x")).groupBy("x").agg(F.count("*").alias("n"))
    return alone.union(pairs).groupBy("x").agg(F.count("*").alias("n")).join(known, "x")


def reliable_patterns(links: DataFrame, occurrences: Callable[[DataFrame], DataFrame], chance: dict[str, float], rounds: int = ROUNDS) -> DataFrame:
    """(side, x, kind, score) of the patterns worth using, from links (side, x, h, kind, bad, n): how often a value
    stands in a pattern; kind null for values that no fixed pattern covers. `occurrences` gives (side, x, total), the
    patterns' counts in the corpus, for those of SUPPORT values or more; `chance` is each kind's share of all words.

    Turns: a pattern's score for a kind is the sum of the belief in what stands in it over all its occurrences (and one
    more, against chance); belief in a seed is 1, in another value 1 less the product of its reliable patterns' doubts.
    Everything is a sum, aggregated before it is shuffled, however common a word is."""
    on = ["side", "x"]
    by_chance = F.coalesce(*[F.when(F.col("kind") == k, F.lit(float(v))) for k, v in sorted(chance.items())], F.lit(0.0))
    # only patterns that enough values could support at all
    fit = links.where("not bad").groupBy(*on).agg(F.count_distinct("h").alias("values")).where(F.col("values") >= SUPPORT).select(*on)
    fit = written(fit, "fit")
    totals = written(occurrences(fit), "totals")
    edges = written(links.join(totals, on), "edges")
    beliefs = edges.where("kind is not null").select("h", "kind", F.lit(1.0).alias("b")).distinct()
    good, old = None, []
    for _ in range(rounds):
        stands = edges.where("not bad").drop("kind").join(beliefs, "h")
        score = (F.sum(F.col("b") * F.col("n")) / (F.max("total") + 1)).alias("score")
        told = stands.groupBy(*on, "kind").agg(score, F.count_distinct("h").alias("support"))
        enough = (F.col("support") >= SUPPORT) & (F.col("score") >= RELIABLE) & (F.col("score") >= F.lit(float(LIFT)) * by_chance)
        old += [good] if good is not None else []
        good = written(told.where(enough).select(*on, "kind", "score"), "good")
        doubt = F.sum(F.log(1.000001 - F.least(F.col("score"), F.lit(1.0))))
        fresh = edges.where("kind is null and not bad").drop("kind").join(good, on).groupBy("h", "kind").agg((1 - F.exp(doubt)).alias("b")).where(F.col("b") >= RELIABLE)
        beliefs = written(edges.where("kind is not null").select("h", "kind", F.lit(1.0).alias("b")).distinct().union(fresh), "beliefs")
        old.append(beliefs)
    drop_written(fit, totals, edges, *old)
    return good


def find_pii(docs: DataFrame, *keep: str) -> DataFrame:
    """Per row of docs: doc_id, `keep`, base (array of k, s, e, kind by kind, then start) and spans (base and
    discovered).

    Null and empty texts have none; repeated rows each have theirs, and count; very long texts and texts of very many
    spans are read whole, in proportion to their length; ties between a found token's kinds go to the first listed;
    extra columns that aren't kept, whatever their names, are left behind; an empty table gives no rows."""
    rows = written(scan(docs, *keep), "pii")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("x.k") + 1)
    seeds = rows.select(F.explode("base").alias("x")).select(F.explode("x.at").alias("p"), "x.h", kind.alias("kind"), F.lit(False).alias("bad"))
    others = rows.select("rid", F.explode("tokens").alias("x")).select("rid", "x.*")
    free = others.select(F.explode("at").alias("p"), "h", F.lit(None).cast("string").alias("kind"), "bad")
    links = written(seeds.union(free).groupBy("p.side", "p.x", "h", "kind", "bad").agg(F.count("*").alias("n")), "links")
    counts = rows.agg(F.sum("n_words").alias("n"), *[F.sum(F.size(F.filter("base", lambda x: x["k"] == i))).alias(k) for i, k in enumerate(KINDS)]).first()  # noqa: B023
    chance = {k: (counts[k] or 0) / max(1, counts["n"] or 0) for k in KINDS}

    def occurrences(fit: DataFrame) -> DataFrame:
        joint = links.where("side = 'P'").groupBy("side", "x").agg(F.sum("n").alias("total")).join(fit, ["side", "x"])
        beside = fit.where("side <> 'P'").join(word_counts(docs, fit.where("side <> 'P'")), "x").select("side", "x", F.col("n").alias("total"))
        return joint.select("side", "x", "total").union(beside)

    good = reliable_patterns(links, occurrences, chance)
    drop_written(links)
    k = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    each = others.where("not bad").select("rid", "s", "e", F.explode("at").alias("p")).select("rid", "s", "e", "p.*").join(good, ["side", "x"])
    best = each.groupBy("rid", "s", "e").agg(F.min(F.struct((-F.col("score")).alias("by"), k.alias("k"), "kind")).alias("y"))
    span = F.struct((F.col("y.k") + len(KINDS) - 1).alias("k"), "s", "e", F.concat(F.lit("context_"), "y.kind").alias("kind"))
    found = best.groupBy("rid").agg(F.array_sort(F.collect_list(span)).alias("added"))
    plain = F.transform("base", lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["k"] + 1).alias("kind")))
    both = rows.join(found, "rid", "left").select("doc_id", *keep, plain.alias("base"), "added")
    return both.select("doc_id", *keep, "base", F.concat("base", F.coalesce("added", F.filter("base", lambda x: F.lit(False)))).alias("spans"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every row of documents; find_pii() says what null, empty, repeated and very long texts give.
    n_spans counts all spans, those of discovered identifiers included."""
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    found = find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[n(k) for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the spans found in its text are replaced by <kind>, and n_chars, where there is such a
    column, follows. Null and empty texts stay as they are; repeated rows are each masked; other columns, whatever their
    names, pass through; an empty table stays empty."""
    found = find_pii(docs.select("doc_id", "text", as_row(docs).alias("row")), "row")
    masked = with_masked(found.select("row", F.col("row.text").alias("text"), "spans"), "text", "spans", "masked")
    changed = {"text": F.col("masked")} | ({"n_chars": F.length("masked").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return masked.select(*[F.coalesce(changed[c], F.col(f"row.`{c}`")).alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
