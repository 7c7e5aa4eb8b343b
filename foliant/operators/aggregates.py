"""Aggregations: rollups of pages, documents and pieces, scores, seeded distributions, summaries."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.functions.numbers import clamp, completeness_tier, fold_skew
from foliant.functions.predicates import PENALTIES, yes

BANDS = ("good", "fair", "poor", "unknown")
#: The least scores of the bands.
GOOD, FAIR = 80, 50
#: Reason codes in their canonical order.
REASONS = (
    "missing_score",
    "missing_required_parts",
    "unexpected_parts",
    "low_confidence_parts",
    "duplicate_parts",
    "instrumentation_unresolved",
)
#: Points of the review queue.
WEIGHTS = {
    "missing_score": 40,
    "missing_required_part": 10,
    "low_confidence_part": 5,
    "unmatched_part": 5,
    "duplicate_part": 2,
    "unexpected_part": 1,
}
SEVERITY_POINTS = {"high": 20, "review": 8, "ok": 0}


def band_for(score: Column) -> Column:
    return F.when(score >= GOOD, "good").when(score >= FAIR, "fair").otherwise("poor")


def document_rollup(pages: DataFrame, key: str) -> DataFrame:
    """Per document: page counts, text totals and shares, and the first page's text."""
    c = F.col
    n = F.count("*")
    share = lambda on: F.round(F.count_if(on) / n, 3)
    return pages.groupBy(key).agg(
        n.cast("int").alias("page_count"),
        F.count_if(yes(c("text_is_searchable"))).alias("pages_with_text"),
        F.count_if(yes(c("needs_ocr"))).alias("pages_needing_ocr"),
        share(yes(c("needs_ocr"))).alias("ocr_fraction"),
        F.sum(F.coalesce("embedded_text_length", F.lit(0))).alias("total_text_length"),
        F.sum(F.coalesce("word_count", F.lit(0))).alias("total_word_count"),
        F.count_if(yes(c("is_image_based"))).alias("pages_image_based"),
        share(yes(c("is_image_based"))).alias("image_based_fraction"),
        F.count_if(yes(c("is_blank"))).alias("blank_page_count"),
        F.count_if(yes(c("ocr_applied"))).alias("pages_ocr_applied"),
        F.min_by("text", "page_num").alias("first_page_text"),
    )


def score_documents(pages: DataFrame, key: str, page: str = "page_num", issues: str = "issues", penalties: dict[str, int] | None = None) -> DataFrame:
    """Per document: score, band, issue_summary, top_issues, page_issue_count, worst_page. Each issue costs its
    penalty times the share of pages that have it. One aggregate: per-issue counts are conditional sums."""
    cost = penalties or PENALTIES
    on = {i: yes(F.array_contains(issues, i)) for i in cost}
    counts = [F.count_if(hit).alias(f"_{i}") for i, hit in on.items()]
    worst = F.max(F.struct(F.size(F.array_distinct(issues)).alias("n"), (-F.col(page)).alias("p")))
    base = pages.groupBy(key).agg(F.count("*").alias("analyzed"), *counts, F.count_if(F.size(issues) > 0).alias("page_issue_count"), worst.alias("_worst"))
    share = {i: F.lit(float(p)) * F.col(f"_{i}") / F.col("analyzed") for i, p in cost.items()}
    total = reduce(lambda a, b: a + b, share.values())
    score = F.greatest(F.lit(0.0), 100 - total)
    listed = F.array(*[F.struct((-share[i]).alias("c"), F.lit(k).alias("k"), F.lit(i).alias("i")) for k, i in enumerate(cost)])
    top = F.transform(F.array_sort(F.filter(listed, lambda x: x["c"] < 0)), lambda x: x["i"])
    entries = F.filter(F.array(*[F.struct(F.lit(i).alias("k"), F.col(f"_{i}").alias("v")) for i in cost]), lambda x: x["v"] > 0)
    return base.select(
        key,
        "analyzed",
        F.round(score, 1).alias("quality_score"),
        band_for(score).alias("quality_band"),
        F.map_from_entries(entries).alias("issue_summary"),
        top.alias("top_issues"),
        "page_issue_count",
        F.when(F.col("_worst.n") > 0, -F.col("_worst.p")).alias("worst_page"),
    )


def quality_metrics(pages: DataFrame, key: str) -> DataFrame:
    """Per document over pages that rendered: medians, means and extremes of the page metrics."""
    good = pages.where(yes(F.col("processing_status") != "error"))
    heard = yes(F.col("ocr_word_count") > 0)
    return good.groupBy(key).agg(
        F.median("estimated_dpi").alias("median_estimated_dpi"),
        F.round(F.avg("contrast_std"), 2).alias("mean_contrast_std"),
        F.round(F.avg("blur_variance"), 2).alias("mean_blur_variance"),
        F.round(F.avg("alnum_ratio"), 4).alias("mean_alnum_ratio"),
        F.round(F.avg(F.when(heard, F.col("ocr_confidence"))), 3).alias("mean_ocr_confidence"),
        F.max(F.abs(fold_skew(F.col("skew_angle_deg")))).alias("max_skew_angle_deg"),
        F.round(F.count_if(yes(F.col("is_image_based"))) / F.count("*"), 3).alias("image_based_fraction"),
        F.count_if(yes(F.col("is_blank"))).alias("blank_page_count"),
    )


def notation_source(searchable: Column, confidence: Column, alnum: Column) -> Column:
    """struct(type, confidence) from the searchable share and the means of OCR confidence and alphanumeric ratio."""
    answer = lambda kind, c: F.struct(F.lit(kind).alias("type"), F.round(c, 2).alias("confidence"))
    least = F.lit(0.30)
    printed = (confidence >= 0.80) & (alnum.isNull() | (alnum >= 0.70))
    hand = (confidence <= 0.35) & yes(alnum <= 0.45)
    by_ocr = (
        F.when(printed, answer("printed", clamp(0.55 + (confidence - 0.80) / 0.20, 0.30, 0.9)))
        .when(hand, answer("handwritten", clamp(0.5 + (0.35 - confidence) / 0.30, 0.30, 0.85)))
        .otherwise(answer("mixed_or_uncertain", least))
    )
    by_alnum = F.when(alnum >= 0.70, answer("printed", least + 0.1)).when(alnum <= 0.45, answer("handwritten", least + 0.1)).otherwise(answer("mixed_or_uncertain", least))
    return (
        F.when(searchable >= 0.5, answer("printed", clamp(0.55 + 0.4 * searchable, 0.30, 0.95)))
        .when(confidence.isNotNull(), by_ocr)
        .when(alnum.isNotNull(), by_alnum)
        .otherwise(answer("mixed_or_uncertain", F.lit(0.0)))
    )


def adjudicate(band: Column, source: Column, legibility: Column, confidence: Column, status: Column, own_source: Column, least: float = 0.5) -> Column:
    """struct(applied, notation_source_type, quality_band, new_issues): a confident look overrides the notation; only
    legibility caps the band; handwriting is merely noted."""
    on = yes(status == "success") & source.isNotNull() & yes(confidence >= least)
    rank = lambda b: F.when(b == "good", 3).when(b == "fair", 2).when(b == "poor", 1)
    cap = F.when(legibility == "poor", 1).when(legibility == "fair", 2)
    scored = on & rank(band).isNotNull()
    lower = F.least(rank(band), F.coalesce(cap, F.lit(3)))
    capped = F.when(lower == 3, "good").when(lower == 2, "fair").otherwise("poor")
    issues = F.array_compact(F.array(F.when(scored & (source == "handwritten"), "handwritten"), F.when(scored & yes(legibility == "poor"), "low_legibility")))
    return F.struct(on.alias("applied"), F.when(on, source).otherwise(own_source).alias("notation_source_type"), F.when(scored, capped).otherwise(band).alias("quality_band"), issues.alias("new_issues"))


def piece_rollup(predictions: DataFrame, key: str) -> DataFrame:
    """Per piece: counts of documents by outcome and the sorted sets of families, sections and score types."""
    c = F.col
    sets = lambda col: F.array_sort(F.collect_set(col))
    return predictions.groupBy(key).agg(
        F.count("*").alias("document_count"),
        F.bool_or(yes(c("is_score"))).alias("has_score"),
        F.count_if(yes(c("is_score"))).alias("score_count"),
        F.count_if(c("predicted_part").isNull()).alias("unmatched_count"),
        F.count_if(yes(c("needs_review"))).alias("needs_review_count"),
        F.count_if(yes(c("confidence_tier") == "low")).alias("low_confidence_count"),
        F.countDistinct("canonical").alias("distinct_instruments"),
        sets("family").alias("families"),
        sets("section").alias("sections"),
        sets("score_type").alias("score_types"),
    )


def facet_signature(instruments: Column) -> Column:
    """A text that is the same for the same set of (canonical, part_index), whatever their order; nulls first."""
    keys = F.transform(instruments, lambda x: F.concat_ws("#", F.coalesce(x["canonical"], F.lit("")), F.lpad(F.coalesce(x["part_index"].cast("string"), F.lit("")), 4, " ")))
    return F.array_join(F.array_sort(keys), "|")


def observed_groups(parts: DataFrame, *key: str) -> DataFrame:
    """Held parts grouped by what they are: count, extremes of confidence, flags and the first label."""
    return parts.groupBy(*key, "signature", "clef", "transposition", "part_role").agg(
        F.count("*").alias("count"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
        F.bool_or(yes(F.col("needs_review"))).alias("needs_review"),
        F.min_by("label", "pos").alias("label"),
    )


def flag_duplicates(df: DataFrame, *key: str, eligible: Column | None = None, column: str = "duplicate") -> DataFrame:
    """A flag on rows whose key others share too. The counts are aggregated first and joined, so a value that very
    many rows share is never gathered for a window."""
    on = eligible if eligible is not None else F.lit(True)
    counts = df.where(on).groupBy(*key).agg((F.count("*") > 1).alias("_many")).where("_many")
    return df.join(counts, list(key), "left").withColumn(column, on & F.coalesce("_many", F.lit(False))).drop("_many")


def completeness(slots: DataFrame, key: str) -> DataFrame:
    """Per piece over slots (required, present, is_score): present share of the required, missing counts and tier.
    A required score counts as one more slot; nothing required is complete."""
    required = yes(F.col("required"))
    part, there = required & ~yes(F.col("is_score")), yes(F.col("present"))
    base = slots.groupBy(key).agg(
        F.count_if(required).alias("required_count"),
        F.count_if(required & there).alias("present_count"),
        F.count_if(part & ~there).alias("missing_required_count"),
        F.bool_or(required & yes(F.col("is_score")) & ~there).alias("score_missing"),
    )
    score = F.when(F.col("required_count") == 0, 1.0).otherwise(F.col("present_count") / F.greatest("required_count", F.lit(1)))
    done = base.withColumn("completeness_score", F.round(score, 3))
    return done.withColumn("completeness_tier", completeness_tier(score, F.col("missing_required_count"), F.col("score_missing")))


def reason_codes(flags: dict[str, Column]) -> Column:
    """The codes whose flags are on, in canonical order."""
    return F.array_compact(F.array(*[F.when(yes(flags[r]), r) for r in REASONS if r in flags]))


def severity(codes: Column) -> Column:
    high = F.array_contains(codes, "missing_score") | F.array_contains(codes, "missing_required_parts")
    return F.when(high, "high").when(F.size(codes) > 0, "review").otherwise("ok")


def action_items(codes: Column, actions: dict[str, str], targets: dict[str, Column]) -> Column:
    """An array of struct(reason_code, action, targets), in the codes' order."""
    none = F.array().cast("array<string>")
    items = [F.when(F.array_contains(codes, r), F.struct(F.lit(r).alias("reason_code"), F.lit(actions[r]).alias("action"), F.coalesce(targets.get(r, none), none).alias("targets"))) for r in REASONS if r in actions]
    return F.array_compact(F.array(*items))


def seeded_distribution(df: DataFrame, value: Column, known: list[str], fold: str | None = None) -> DataFrame:
    """(ord, key, n): known keys in order, zero if absent, then unknown ones (all of them under `fold`, if given)."""
    v = F.coalesce(value.cast("string"), F.lit("unknown"))
    if fold is not None:
        v = F.when(v.isin(known), v).otherwise(fold)
    counts = df.groupBy(v.alias("key")).agg(F.count("*").alias("_n"))
    dim = df.sparkSession.createDataFrame([(i, k) for i, k in enumerate(known)], "ord int, key string")
    return counts.join(F.broadcast(dim), "key", "full").select(F.coalesce("ord", F.lit(len(known))).alias("ord"), "key", F.coalesce("_n", F.lit(0)).cast("long").alias("n"))


def worst_band(band: Column) -> Column:
    rank = F.when(band == "poor", 3).when(band == "fair", 2).when(band == "good", 1).otherwise(0)
    return F.element_at(F.array(*[F.lit(b) for b in ("unknown", "good", "fair", "poor")]), F.max(rank) + 1)


def most_missing(missing: DataFrame, piece: str, label: str, most: int) -> DataFrame:
    """(label, pieces): the labels that most pieces lack."""
    return missing.groupBy(label).agg(F.countDistinct(piece).alias("pieces")).orderBy(F.desc("pieces"), label).limit(most)


def worst_of(bands: Column) -> Column:
    """The worst of an array of bands, nulls left out; null for none."""
    rank = lambda b: F.when(b == "poor", 3).when(b == "fair", 2).when(b == "good", 1).otherwise(0)
    top = F.array_max(F.transform(F.filter(bands, lambda b: b.isNotNull()), rank))
    return F.when(top.isNotNull(), F.element_at(F.array(*[F.lit(b) for b in ("unknown", "good", "fair", "poor")]), top + 1))


def total_of_maps(counts: Column, known: tuple[str, ...] = BANDS[:3]) -> Column:
    """An aggregate: the sums, key by key, of maps of counts, as an array of (key, n) in the keys' order with unknown
    ones under `unknown`."""
    part = lambda test: F.sum(F.aggregate(F.map_values(F.map_filter(counts, lambda k, v: test(k))), F.lit(0).cast("long"), lambda a, x: a + x))
    each = [F.struct(F.lit(k).alias("key"), F.coalesce(part(lambda x: x == k), F.lit(0)).alias("n")) for k in known]  # noqa: B023
    return F.array(*each, F.struct(F.lit("unknown").alias("key"), F.coalesce(part(lambda x: ~x.isin(*known)), F.lit(0)).alias("n")))


def multi_pass_text(pages: DataFrame, key: str, first: int = 2, cap: int = 16_000) -> DataFrame:
    """(key, text): the first pages' OCR passes in one labelled text; pages without passes are left out.
    pages: key, page_num, headers array<string>, ocr_candidates array<struct<dpi, psm, confidence, text>>."""
    ranked = pages.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy("page_num"))).where((F.col("_n") <= first) & (F.size("ocr_candidates") > 0))
    head = F.concat(F.lit("--- Page "), F.col("page_num").cast("string"), F.lit(" ---"))
    named = F.when(F.size("headers") > 0, F.concat(F.lit("[header] "), F.array_join("headers", " ")))
    told = lambda c: F.concat(F.lit("[dpi="), c["dpi"].cast("string"), F.lit(" psm="), c["psm"].cast("string"), F.lit(" conf="), c["confidence"].cast("string"), F.lit("] "), F.coalesce(c["text"], F.lit("")))
    lines = ranked.select(key, "page_num", F.array_join(F.concat(F.array_compact(F.array(head, named)), F.transform("ocr_candidates", told)), "\n").alias("text"))
    return ordered_concat(lines, key, "page_num", "text", cap=cap)


def band_counts(band: Column) -> list[Column]:
    """A count for each band; unknown names and nulls count as unknown."""
    named = F.when(band.isin("good", "fair", "poor"), band).otherwise("unknown")
    return [F.count_if(named == b).alias(f"{b}_count") for b in BANDS]


def number_summary(value: Column) -> list[Column]:
    """count, mean, median (interpolated), min and max, rounded to three places; nulls where there is nothing."""
    r = lambda c: F.round(c, 3)
    return [F.count(value).alias("cnt"), r(F.avg(value)).alias("mean"), r(F.median(value)).alias("median"), r(F.min(value)).alias("min"), r(F.max(value)).alias("max")]


def priority(c: dict[str, Column]) -> dict[str, Column]:
    """The components of the review queue's score, by name."""
    n = lambda k: F.coalesce(c[k], F.lit(0))
    base = reduce(lambda acc, kv: F.when(c["severity"] == kv[0], kv[1]).otherwise(acc), SEVERITY_POINTS.items(), F.lit(0))
    return {
        "severity_base": base,
        "missing_score": F.when(yes(c["score_missing"]), WEIGHTS["missing_score"]).otherwise(0),
        "missing_required_parts": n("missing_required_count") * WEIGHTS["missing_required_part"],
        "low_confidence_parts": n("low_confidence_count") * WEIGHTS["low_confidence_part"],
        "unmatched_parts": n("unmatched_count") * WEIGHTS["unmatched_part"],
        "duplicate_parts": n("duplicate_count") * WEIGHTS["duplicate_part"],
        "unexpected_parts": n("unexpected_part_count") * WEIGHTS["unexpected_part"],
    }


def ordered_concat(df: DataFrame, key: str, order: str, text: str, first: int | None = None, cap: int | None = None, column: str = "text") -> DataFrame:
    """The texts of each key joined by newlines in order; the first rows only, and so many characters, if given."""
    if first is not None:
        df = df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("_n") <= first)
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "\n")
    return df.groupBy(key).agg((F.left(lines, F.lit(cap)) if cap else lines).alias(column))


def best_pass(candidates: Column) -> Column:
    """The OCR pass with the most confident words: confidence times the root of its words; the first of ties."""
    scored = F.transform(candidates, lambda x, i: F.struct((-(x["confidence"] * F.sqrt(x["word_count"]))).alias("s"), i.alias("i"), x.alias("x")))
    return F.get(F.array_sort(scored), F.lit(0))["x"]


def first_pages_confidence(pages: DataFrame, key: str, first: int = 2) -> DataFrame:
    """Per document over its first pages: the mean OCR confidence, and the best of any pass or page."""
    ranked = pages.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy("page_num"))).where(F.col("_n") <= first)
    passes = F.array_max(F.transform("ocr_candidates", lambda x: x["confidence"]))
    return ranked.groupBy(key).agg(F.avg(F.when(yes(F.col("ocr_applied")), F.col("ocr_confidence"))).alias("mean_confidence"), F.max(F.coalesce(passes, F.col("ocr_confidence"))).alias("best_confidence"))


def bar_share(df: DataFrame, value: str, *group: str) -> DataFrame:
    """value as a percentage of its group's largest, by a join of the aggregate."""
    keys = list(group) or ["_all"]
    base = df if group else df.withColumn("_all", F.lit(1))
    top = base.groupBy(*keys).agg(F.max(value).alias("_top"))
    out = base.join(top, keys).withColumn("bar_pct", F.when(F.col("_top") > 0, F.round(100 * F.col(value) / F.col("_top"), 1)).otherwise(0.0))
    return out.drop("_top", *([] if group else ["_all"]))
