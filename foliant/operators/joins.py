"""Joins: deduplicating lookups, dictionary matches, multi-source assembly, fallback links, differences.

Dictionaries are the only sides that are ever broadcast, and only below a checked number of rows; all else is left to
the optimiser, which measures sides at run time."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.functions.text import blank_to_null, contains_word, normalize_name, snake_case

BROADCAST_ROWS = 100_000  #: a dictionary of more rows is joined by shuffle


def dictionary(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it has at most `most` rows (which costs counting that many)."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def one_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order. Ties must be broken by the order itself."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def first_wins(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    return one_per_key(df, keys, F.asc(position))


def last_wins(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    return one_per_key(df, keys, F.desc(position))


def first_rows(df: DataFrame, keys: list[str], most: int, *order: Column) -> DataFrame:
    """The first rows of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def first_non_empty(df: DataFrame, key: str, position: str, text: str) -> DataFrame:
    """(key, text): the first text of each key that is neither null nor empty. An aggregate, so no key is gathered."""
    return df.where(blank_to_null(F.col(text)).isNotNull()).groupBy(key).agg(F.min_by(text, position).alias(text))


def lookup(left: DataFrame, right: DataFrame, keys: list[str], position: str | None = None, last: bool = True, tasks: int | None = None) -> DataFrame:
    """left, with the columns of the last (or first) row of its key on the right; each left row once. Both sides are
    dealt to `tasks` tasks by the keys, if that is given, else to as many as Spark thinks fit."""
    if tasks:
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    side = right if position is None else one_per_key(right, keys, F.desc(position) if last else F.asc(position)).drop(position)
    return left.join(side, keys, "left")


def assemble(key: str, universe: list[DataFrame], single: dict[str, DataFrame], many: dict[str, DataFrame], orders: dict[str, list[str]]) -> DataFrame:
    """One row for each key of the universe's union: a struct of each single side, an ordered array of each many side.
    Sides in `many` are folded before the join, so rows are never multiplied; all rows of a key must fit in one task
    then. Where a count or an extreme is enough, aggregate the side and give it as a single one."""
    ids = reduce(lambda a, b: a.union(b), [u.select(key) for u in universe]).where(F.col(key).isNotNull()).distinct()
    for name, side in single.items():
        rest = [c for c in side.columns if c != key]
        ids = ids.join(side.select(key, F.struct(*rest).alias(name)), key, "left")
    for name, side in many.items():
        rest = [*orders[name], *[c for c in side.columns if c != key and c not in orders[name]]]
        ids = ids.join(side.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name)), key, "left")
    return ids


def best_per_key(df: DataFrame, key: str, preference: dict[str, int], kind: str, *ties: Column) -> DataFrame:
    """The row of the most preferred kind; unknown kinds come last, ties by `ties`."""
    rank = reduce(lambda acc, kv: F.when(F.col(kind) == kv[0], kv[1]).otherwise(acc), preference.items(), F.lit(len(preference) + 1))
    return one_per_key(df, [key], rank, *ties)


def canonical_names(df: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """df with `canonical` of a name by dictionary, or the name in snake case."""
    dim = one_per_key(aliases.select(normalize_name(F.col("alias")).alias("_norm"), "canonical", "pos"), ["_norm"], F.asc("pos")).drop("pos")
    out = df.withColumn("_norm", normalize_name(F.col(name))).join(dictionary(dim), "_norm", "left")
    return out.withColumn("canonical", F.coalesce("canonical", snake_case(F.col(name)))).drop("_norm")


#: Short words that say little on their own, and words that qualify an instrument.
ABBREVIATIONS = ["cl", "hn", "tbn", "tpt", "ob", "fl", "alto", "tenor", "bass"]
#: The points of a hit: for each character of the alias, an alias that is all of the text, one of several
#: words, one of three characters at most, an abbreviation, a qualifier in the alias or in the text, and an alias of four
#: characters at most in a text of several words.
POINTS = {"character": 2, "whole": 20, "words": 10, "short": -35, "abbreviation": -20, "qualified": 12, "qualified_text": 6, "short_in_words": -10}
QUALIFIERS = ["bass", "alto", "tenor", "baritone", "soprano", "contra", "eb", "bb"]


def match_score(text: Column, alias: Column, qualifiers: list[str] | None = None, abbreviations: list[str] | None = None) -> Column:
    """How specific a dictionary hit is: long, exact, qualified and multi-word aliases count more, short ones less."""
    some = lambda c: reduce(lambda a, b: a | b, [F.contains(c, F.lit(q)) for q in qualifiers or QUALIFIERS])
    spaced = lambda c: F.contains(c, F.lit(" "))
    on = {
        "whole": alias == text,
        "words": spaced(alias),
        "short": F.length(alias) <= 3,
        "abbreviation": alias.isin(abbreviations or ABBREVIATIONS),
        "qualified": some(alias),
        "qualified_text": some(text),
        "short_in_words": spaced(text) & (F.length(alias) <= 4),
    }
    return reduce(lambda total, k: total + F.when(on[k], POINTS[k]).otherwise(0), on, F.length(alias) * POINTS["character"])


def dictionary_hits(texts: DataFrame, key: str, text: str, aliases: DataFrame, min_length: int = 1) -> DataFrame:
    """(key, text, canonical, alias, pos, start, score) of every alias that a normalized text holds at word borders.

    Candidates come from an equi join on the alias's first word, exploded from the text once, so the dictionary is
    never compared with every text; the word-bounded test confirms them."""
    first = F.regexp_extract(F.col("alias"), "([a-z0-9]+)", 1)
    dim = aliases.where(F.length("alias") >= min_length).select("canonical", "alias", "pos", first.alias("_w")).where("_w <> ''")
    tokens = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit("[a-z0-9]+"), F.lit(0)))
    candidates = texts.select(key, text, F.explode(tokens).alias("_w")).join(dictionary(dim), "_w")
    hits = candidates.where(contains_word(F.col(text), F.col("alias")))
    padded = lambda c: F.concat(F.lit(" "), F.regexp_replace(c, "[^a-z0-9]", " "), F.lit(" "))
    start = F.position(padded(F.col("alias")), padded(F.col(text)))
    return hits.select(key, text, "canonical", "alias", "pos", start.alias("start"), match_score(F.col(text), F.col("alias")).alias("score"))


def best_match(hits: DataFrame, key: str, earliest: bool = False) -> DataFrame:
    """(key, canonical, alias, score, alternates): the most specific hit, or the earliest; with up to two other
    canonical names and their scores relative to the best."""
    longest = [F.desc(F.length("alias")), F.asc("pos")]
    order = [F.asc("start"), F.desc("score"), F.asc("canonical"), F.asc("alias")] if earliest else [F.desc("score"), *longest]
    best = one_per_key(hits, [key], *order).select(key, "canonical", "alias", "score")
    listed = order if earliest else longest
    others = one_per_key(hits.join(best.select(key, F.col("canonical").alias("_c"), F.col("score").alias("_best")), key).where("canonical <> _c"), [key, "canonical"], *listed)
    ranked = others.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*listed))).where("_n <= 2")
    relative = F.round(F.col("score") / F.greatest(F.col("_best"), F.lit(1)), 3)
    folded = ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_n", "canonical", relative.alias("score")))).alias("alternates"))
    return best.join(folded, key, "left")


def sections(df: DataFrame, canonical: str, dim: DataFrame, family: str) -> DataFrame:
    """df with `section`: by dictionary, else the family; without a name `score` for scores, else `unknown`."""
    known = dictionary(dim.select(F.col("canonical").alias(canonical), F.col("section").alias("_s")).distinct())
    unnamed = F.when(F.col(family) == "score", "score").otherwise("unknown")
    section = F.when(F.col(canonical).isNull(), unnamed).otherwise(F.coalesce("_s", family))
    return df.join(known, canonical, "left").withColumn("section", section).drop("_s")


def linked(slots: DataFrame, docs: DataFrame, key: list[str]) -> DataFrame:
    """Each slot's documents at the best level of match: same chair and role, same chair, no chair but the role, no
    chair; an unnumbered slot takes documents of its role, then any. slots: key, slot, part_index, role;
    docs: key, doc, part_index, role."""
    d = docs.select(*key, "doc", F.col("part_index").alias("_i"), F.col("role").alias("_r"))
    both = slots.join(d, key)
    same, role, bare = F.col("part_index") == F.col("_i"), F.col("role") == F.col("_r"), F.col("_i").isNull()
    numbered = F.when(same & role, 1).when(same, 2).when(bare & role, 3).when(bare, 4)
    level = F.when(F.col("part_index").isNotNull(), numbered).otherwise(F.when(role, 1).otherwise(2))
    ranked = both.withColumn("level", level).where("level is not null")
    best = ranked.withColumn("_b", F.min("level").over(W.partitionBy(*key, "slot"))).where("level = _b")
    return best.groupBy(*key, "slot").agg(F.min("level").alias("level"), F.array_sort(F.collect_list("doc")).alias("docs"))


def orphans(prior: DataFrame, current: DataFrame, key: str) -> DataFrame:
    return prior.join(current.select(key), key, "left_anti")


def reuse_split(current: DataFrame, prior: DataFrame, key: str, version: str) -> tuple[DataFrame, DataFrame]:
    """(reused, to do): rows whose fingerprint and version an earlier run has seen, and the rest.
    prior: key, fingerprint, record_version."""
    seen = prior.where(F.col("record_version") == version).select(key, F.col("fingerprint").alias("_f"))
    both = current.join(seen, key, "left")
    same = F.coalesce(F.col("fingerprint") == F.col("_f"), F.lit(False))
    return both.where(same).drop("_f"), both.where(~same).drop("_f")


def search(groups: list[tuple[str, DataFrame, str, list[str]]], needle: str, most: int) -> DataFrame:
    """Substring search over several tables, (grp, ord, id, label), at most `most` rows a table in id order.
    groups: name, table, id column, searched columns (the first is the label)."""
    from foliant.functions.predicates import any_column_contains

    found = []
    for i, (name, df, key, columns) in enumerate(groups):
        hits = any_column_contains(df, needle, columns).orderBy(key).limit(most)
        found.append(hits.select(F.lit(name).alias("grp"), F.lit(i).alias("ord"), F.col(key).cast("string").alias("id"), F.col(columns[0]).cast("string").alias("label")))
    return reduce(lambda a, b: a.unionByName(b), found)
