"""Expected slots: normalising what a lookup says, filling in what it left out, prompts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.predicates import generic_umbrella, score_slot
from foliant.functions.text import blank_to_null, first_truthy
from foliant.operators.joins import canonical_names, dictionary, dictionary_hits
from foliant.operators.reconcile import slot_role

#: Names that say too little without a subtype or chair.
GENERIC = ["clarinet", "trombone", "horn", "trumpet", "cornet"]


def normalize_slots(raw: DataFrame, aliases: DataFrame, key: str = "piece_id") -> DataFrame:
    """Slots (key, pos, canonical, part_index, label, section, required, role) of a lookup's parts (key, pos, name,
    part_index string, label, section, required): known names, no score slots, no bare family names; the dictionary's
    section wins; required unless said otherwise."""
    named = canonical_names(raw.where(blank_to_null(F.col("name")).isNotNull()), "name", aliases)
    dim = dictionary(aliases.groupBy("canonical").agg(F.max("section").alias("_section")))
    both = named.join(dim, "canonical", "left")
    index = F.col("part_index").try_cast("int")
    bare = F.col("canonical").isin(GENERIC) & generic_umbrella(F.translate("label", "_", " "), index, [*GENERIC, *[g + "s" for g in GENERIC]])
    kept = both.where(~score_slot(F.col("canonical"), F.col("section")) & ~F.coalesce(bare, F.lit(False)))
    label = first_truthy(F.col("label"), F.col("canonical"))
    return kept.select(key, "pos", "canonical", index.alias("part_index"), label.alias("label"), F.coalesce("_section", "section").alias("section"), F.coalesce("required", F.lit(True)).alias("required"), slot_role(label).alias("role"))


def backfill(slots: DataFrame, texts: DataFrame, aliases: DataFrame, generic: str, key: str = "piece_id", region: str = r"(?is)instrumentation(.*)") -> DataFrame:
    """slots with the instruments of a family (aliases) that a text's instrumentation names and the slots lack; the
    family's generic slot goes where any were added."""
    part = F.lower(F.regexp_extract("text", region, 1))
    named = texts.select(key, part.alias("region")).where("region <> ''")
    found = dictionary_hits(named, key, "region", aliases.where(F.col("canonical") != generic))
    hits = found.groupBy(key, "canonical").agg(F.min_by("alias", "pos").alias("alias"))
    new = hits.join(slots.select(key, "canonical"), [key, "canonical"], "left_anti")
    added = new.select(key, F.lit(9999).alias("pos"), "canonical", F.lit(None).cast("int").alias("part_index"), F.initcap("alias").alias("label"), F.lit(generic).alias("section"), F.lit(True).alias("required"), F.lit("section").alias("role"))
    old = slots.join(new.select(key).distinct().withColumn("_new", F.lit(True)), key, "left").where(~((F.col("canonical") == generic) & F.coalesce("_new", F.lit(False)))).drop("_new")
    return old.unionByName(added, allowMissingColumns=True)


def prompt_query(df: DataFrame, key: str, title: str, parts: str | None = None) -> DataFrame:
    """(key, query): what an enrichment is asked, as JSON; with the held parts' labels where they are to be shown."""
    fields = [F.col(title).alias("title")]
    if parts:
        fields.append(F.array_join(F.transform(parts, lambda p: p["label"]), ", ").alias("holdings"))
    return df.select(key, F.to_json(F.struct(*fields)).alias("query"))


def unlisted(parts: Column, roles: tuple[str, ...] = ("section",)) -> Column:
    """Held parts of some roles with the first facet's name and chair, in order of name and chair."""
    kept = F.filter(parts, lambda p: p["role"].isin(*roles))
    return F.array_sort(F.transform(kept, lambda p: F.struct(F.get(p["instruments"], F.lit(0))["canonical"].alias("canonical"), F.get(p["instruments"], F.lit(0))["part_index"].alias("part_index"), p["label"].alias("label"))))
