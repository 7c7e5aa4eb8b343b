"""Part classification: facets of a name, and the decision list over what names, texts and models say."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.predicates import other_section, prefer_vision, yes
from foliant.functions.text import chair_runs, contains_word, normalize_part_text, part_index, reliable_label, split_combined
from foliant.operators.joins import dictionary, dictionary_hits

#: How sure each kind of evidence is: alone, agreeing with the name, in its section, in another.
CONFIDENCE = {
    "score": 0.90,
    "ocr_llm": (0.80, 0.90, 0.80, 0.70),
    "vision": (0.80, 0.88, 0.78, 0.68),
    "text": (0.50, 0.90, 0.80, 0.70),
    "filename": (0.75, 0.90),
    "with_key": 0.05,
    "most": 0.98,
}


def _hits(texts: DataFrame, key: str, aliases: DataFrame) -> DataFrame:
    """What the dictionary finds in a document's texts (key, kind, text), in one match and one aggregate a key: `named`
    has each piece's hits of kind `name`, the best of a piece first; `ul` and `ft` are the earliest name of the upper
    left and the most specific one of the whole text, of four characters at least; `placed` has all the upper left's
    hits by place. No list is longer than a dictionary for each different text."""
    told = texts.select(F.struct(F.col(key).alias("key"), "kind").alias("_t"), "text")
    found = dictionary_hits(told, "_t", "text", aliases)
    c = F.col
    kind, long = c("_t.kind"), F.length("alias") >= 4
    points, size = -c("score"), -F.length("alias")
    return found.groupBy(c("_t.key").alias(key)).agg(
        F.array_sort(F.collect_set(F.when(kind == "name", F.struct("text", points.alias("score"), size.alias("size"), "pos", "canonical", "alias")))).alias("_named"),
        F.min_by("canonical", F.when((kind == "ul") & long, F.struct("start", points, "canonical", "alias"))).alias("ul_canon"),
        F.min_by("canonical", F.when((kind == "ft") & long, F.struct(points, size, "pos", "canonical"))).alias("ft_canon"),
        F.array_sort(F.collect_set(F.when(kind == "ul", F.struct("start", size.alias("size"), "canonical", "alias")))).alias("_placed"),
    )


def _facets(pieces: Column, named: Column) -> Column:
    """The instruments and chairs of a name's pieces, in order, each once; `named` has the pieces' hits."""

    def read(piece: Column) -> Column:
        best = F.get(F.filter(named, lambda h: h["text"] == piece), F.lit(0))
        bare = best.isNull() & piece.rlike("^[0-9][0-9a-z, -]*$")
        chairs = F.when(best.isNull(), chair_runs(piece)).otherwise(chair_runs(piece, best["alias"]))
        return F.struct(best["canonical"].alias("canonical"), bare.alias("bare"), chairs.alias("chairs"), part_index(piece).alias("one"))

    kind = "array<struct<canonical:string,part_index:int>>"
    start = F.struct(F.lit(None).cast("string").alias("last"), F.array().cast(kind).alias("all"))

    def step(a: Column, x: Column) -> Column:
        last = F.coalesce(x["canonical"], a["last"])
        several = (F.size(x["chairs"]) >= 2) | (x["bare"] & (F.size(x["chairs"]) > 0))
        index = F.when(several, x["chairs"]).otherwise(F.array(x["one"]))
        more = F.transform(index, lambda i: F.struct(last.alias("canonical"), i.cast("int").alias("part_index")))
        counts = last.isNotNull() & (x["canonical"].isNotNull() | x["bare"])
        return F.struct(last.alias("last"), F.when(counts, F.concat(a["all"], more)).otherwise(a["all"]).alias("all"))

    return F.array_distinct(F.aggregate(F.transform(pieces, read), start, step, lambda a: a["all"]))


def name_facets(names: DataFrame, key: str, name: str, aliases: DataFrame) -> DataFrame:
    """(key, facets): the instruments and chairs that a name covers, in order, each once. Combined names are split;
    a piece of bare chairs extends the instrument before it ("horn 1 & 2"); runs give a facet for each chair."""
    cut = names.select(key, F.explode(F.array(normalize_part_text(F.col(name)))).alias("_n")).select(key, split_combined(F.col("_n")).alias("_pieces"))
    texts = cut.select(key, F.lit("name").alias("kind"), F.explode("_pieces").alias("text"))
    both = cut.join(_hits(texts, key, aliases).select(key, "_named"), key)
    return both.select(key, _facets(F.col("_pieces"), F.col("_named")).alias("facets")).where(F.size("facets") > 0)


def classify(docs: DataFrame, aliases: DataFrame, key: str = "pdf_path", book: str = "mallet_percussion") -> DataFrame:
    """(key, instruments, predicted, confidence, evidence_source, conflict, needs_review, details) by the decision list:
    a score; what a language model read; what was seen; the text at the upper left, or elsewhere within the section;
    the name alone. A book of mallets (`book`) whose texts name several of them has a facet for each, `details` their
    shown names in the same order; else that is null.

    docs: key (each once), name (the part's name), is_score, upper_left, full_text, transposition, llm array<string>,
    llm_confidence, vision array<string>, vision_chairs array<int>, vision_confidence, and if there is one vision_label;
    any of them null. The dictionary is matched once, with all texts of a document together."""
    groups = dictionary(aliases.groupBy("canonical").agg(F.max("section").alias("section")))
    label = F.col("vision_label") if "vision_label" in docs.columns else F.lit(None).cast("string")
    normal = {"name": F.col("name"), "ul": F.col("upper_left"), "ft": F.col("full_text"), "label": label}
    # a generated row, so that what follows reads the normalized texts instead of normalizing them at each use
    told = F.explode(F.array(F.struct(*[normalize_part_text(v).alias(k) for k, v in normal.items()])))
    docs = docs.withColumn("_told", told).withColumns({"_pieces": split_combined(F.col("_told.name")), "_ul": F.col("_told.ul"), "_ft": F.col("_told.ft")})
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(f"_{k}").alias("text")) for k in ("ul", "ft")]
    pieces = F.transform(F.coalesce("_pieces", F.array().cast("array<string>")), lambda x: F.struct(F.lit("name").alias("kind"), x.alias("text")))
    texts = docs.select(key, F.inline(F.concat(pieces, F.array(*kinds))))
    both = docs.join(_hits(texts, key, aliases), key, "left").withColumn("facets", _facets(F.col("_pieces"), F.col("_named")))
    empty = F.array().cast("array<string>")
    c = F.col
    both = both.withColumns(
        {
            "facets": F.coalesce("facets", F.array().cast("array<struct<canonical:string,part_index:int>>")),
            "llm": F.coalesce("llm", empty),
            "vision": F.coalesce("vision", empty),
            "vision_chairs": F.coalesce("vision_chairs", F.array().cast("array<int>")),
        }
    )
    both = both.withColumn("named", F.get("facets", F.lit(0))["canonical"]).withColumn("seen", F.coalesce("ul_canon", "ft_canon"))
    lead = F.when(F.size("llm") > 0, F.get("llm", F.lit(0)))
    both = both.withColumn("llm_first", lead).withColumn("vis_first", F.get("vision", F.lit(0)))
    # one dictionary of sections, looked up four times; each is a broadcast, no shuffle
    for column in ("named", "seen", "llm_first", "vis_first"):
        both = both.join(groups.select(c("canonical").alias(column), c("section").alias(f"{column}_section")), column, "left")
    drop = other_section(c("seen_section"), c("named_section"), c("ul_canon").isNull() & (c("seen") != c("named")))
    both = both.withColumn("seen", F.when(~drop, c("seen")))
    # a hit that isn't the part's own label doesn't override the name
    texts = [c("_ul"), c("_ft")]
    firm = reliable_label(texts[0], c("seen")) | reliable_label(texts[1], c("seen"))
    weak = yes(c("named").isNotNull() & (c("seen") != c("named")) & ~firm)
    both = both.withColumns({"seen": F.when(weak, c("named")).otherwise(c("seen")), "seen_section": F.when(weak, c("named_section")).when(c("seen").isNotNull(), c("seen_section"))})
    index = F.when(F.size("facets") == 1, F.get("facets", F.lit(0))["part_index"])
    one = lambda name, i: F.array(F.struct(name.alias("canonical"), i.cast("int").alias("part_index")))
    plain = lambda names: F.transform(names, lambda x: F.struct(x.alias("canonical"), F.lit(None).cast("int").alias("part_index")))
    seen_chairs = F.when(F.size("vision_chairs") >= 2, F.transform("vision_chairs", lambda i: F.struct(c("vis_first").alias("canonical"), i.alias("part_index"))))
    seen_one = F.when(F.size("vision_chairs") == 1, one(c("vis_first"), F.get("vision_chairs", F.lit(0)))).otherwise(one(c("vis_first"), F.when(c("named") == c("vis_first"), index)))
    better = prefer_vision(c("vision"), c("llm"), c("vision_confidence"), c("llm_confidence"))
    known = c("named").isNotNull()
    text_holds_name = F.lit(False)
    for t in texts:
        text_holds_name = text_holds_name | yes(contains_word(t, F.replace(c("named"), F.lit("_"), F.lit(" "))))
    keyed = F.least(F.lit(CONFIDENCE["most"]), F.lit(0.90) + F.when(c("transposition").isNotNull(), CONFIDENCE["with_key"]).otherwise(0.0))

    def grade(kind: str, agrees: Column, section: Column, bonus: Column | None = None) -> Column:
        alone, same, near, far = CONFIDENCE[kind]
        return F.when(~known, alone).when(agrees, bonus if bonus is not None else F.lit(same)).when(yes(section == c("named_section")), near).otherwise(far)

    def verdict(instruments: Column, confidence: Column, evidence: Column, conflict: Column) -> Column:
        return F.struct(instruments.alias("instruments"), confidence.cast("double").alias("confidence"), evidence.alias("evidence_source"), conflict.alias("conflict"))

    def by(kind: str, instruments: Column, first: Column, agrees: Column, section: Column, bonus: Column | None = None) -> Column:
        clash = known & ~agrees & ~yes(section == c("named_section"))
        return verdict(instruments, grade(kind, agrees, section, bonus), F.when(known, "combined").otherwise(kind), clash)

    none = F.filter("facets", lambda x: F.lit(False))
    llm_facets = F.when(F.size("llm") == 1, one(c("llm_first"), index)).otherwise(plain(c("llm")))
    vis_facets = F.when(F.size("vision") == 1, F.coalesce(seen_chairs, seen_one)).otherwise(plain(c("vision")))
    name_only = verdict(c("facets"), F.when(text_holds_name, keyed).otherwise(CONFIDENCE["filename"][0]), F.when(text_holds_name, "combined").otherwise("filename"), F.lit(False))
    chosen = (
        F.when(yes(c("is_score")), verdict(none, F.lit(CONFIDENCE["score"]), F.lit("filename"), F.lit(False)))
        .when((F.size("llm") > 0) & ~better, by("ocr_llm", llm_facets, c("llm_first"), yes(F.array_contains("llm", c("named"))), c("llm_first_section")))
        .when(F.size("vision") > 0, by("vision", vis_facets, c("vis_first"), yes(F.array_contains("vision", c("named"))), c("vis_first_section")))
        .when(c("seen").isNotNull() & (F.size("facets") <= 1), by("text", one(c("seen"), index), c("seen"), yes(c("seen") == c("named")), c("seen_section"), keyed))
        .when(F.size("facets") > 0, name_only)
        .otherwise(verdict(none, F.lit(0.0), F.lit("none"), F.lit(False)))
    )
    out = both.select(key, "is_score", "_told", "_ul", "_placed", chosen.alias("v")).select(key, "is_score", "_told", "_ul", "_placed", "v.*")
    first = F.get("instruments", F.lit(0))["canonical"]
    alone = (F.size("instruments") == 1) & F.get("instruments", F.lit(0))["part_index"].isNull()
    # a single instrument without a chair whose page names several: one facet for each chair
    place = F.get(F.filter("_placed", lambda x: x["canonical"] == first), F.lit(0))
    out = out.withColumn("_chairs", F.when(alone & place.isNotNull(), chair_runs(c("_ul"), place["alias"])))
    each = F.transform("_chairs", lambda i: F.struct(first.alias("canonical"), i.alias("part_index")))
    out = out.withColumn("instruments", F.when(F.size("_chairs") >= 2, each).otherwise(c("instruments")))
    # a book of mallets: one facet for each that its texts name
    held = sub_instruments([c("_told")[k] for k in normal])
    out = out.withColumn("details", F.when(alone & (first == book) & ~yes(c("is_score")), held)).withColumn("details", F.when(F.size("details") >= 2, c("details")))
    every = F.transform("details", lambda _: F.struct(first.alias("canonical"), F.lit(None).cast("int").alias("part_index")))
    out = out.withColumn("instruments", F.coalesce(every, c("instruments"))).select(key, "instruments", "confidence", "evidence_source", "conflict", "details")
    review = (c("confidence") < 0.75) | c("conflict")
    return out.withColumn("predicted", F.get("instruments", F.lit(0))["canonical"]).withColumn("needs_review", review)


#: The pitched percussion that one book of mallets may hold: shown name, and the words for it.
MALLETS = {
    "Bells": ["orchestra bells", "glockenspiel", "bells"],
    "Xylophone": ["xylophone"],
    "Vibraphone": ["vibraphone", "vibes"],
    "Marimba": ["marimba"],
    "Chimes": ["chimes", "tubular bells"],
}


def sub_instruments(texts: Column | list[Column], kinds: dict[str, list[str]] | None = None) -> Column:
    """The kinds that normalized texts name, in the kinds' order. Words inside a longer kind's words still count."""
    texts = texts if isinstance(texts, list) else [texts]
    found = []
    for name, words in (kinds or MALLETS).items():
        hit = reduce(lambda a, b: a | b, [yes(contains_word(t, w)) for t in texts for w in words])
        found.append(F.when(hit, name))
    return F.array_compact(F.array(*found))
