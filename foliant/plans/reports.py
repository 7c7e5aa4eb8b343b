"""Markdown reports: each a few capped tables over aggregates that are small by construction."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.numbers import percent, piece_order
from foliant.functions.text import markdown_cell
from foliant.operators import aggregates as A
from foliant.operators.selection import summarised
from foliant.sources.sinks import markdown_report, shown_targets


def _distribution(df: DataFrame, value: Column, known: list[str]) -> DataFrame:
    return A.seeded_distribution(df, value, known).orderBy("ord", "key").select("key", "n")


def extraction_report(documents: DataFrame) -> str:
    """Coverage, spread and folders of extracted documents (pdf_path, piece_folder, page_count, pages_needing_ocr)."""
    total = documents.agg(F.count("*").alias("documents"), F.sum("page_count").alias("pages"), F.sum("pages_needing_ocr").alias("pages_needing_ocr"))
    covered = total.withColumn("ocr_pct", F.round(percent(F.col("pages_needing_ocr"), F.col("pages")), 1))
    spread = documents.agg(F.min("page_count").alias("min"), F.median("page_count").alias("median"), F.max("page_count").alias("max"))
    folders = documents.groupBy("piece_folder").agg(F.count("*").alias("documents"), F.sum("page_count").alias("pages"), F.sum("pages_needing_ocr").alias("pages_needing_ocr")).orderBy("piece_folder")
    flagged = documents.where("pages_needing_ocr > 0").orderBy(F.desc("pages_needing_ocr"), "pdf_path").select("pdf_path", "pages_needing_ocr")
    return markdown_report("Extraction", [("Coverage", covered, 1), ("Pages per document", spread, 1), ("Folders", folders, 25), ("Flagged documents", flagged, 20)])


def classification_report(predictions: DataFrame) -> str:
    """Families, evidence, confidence and pieces of predictions."""
    count = lambda c: predictions.groupBy(c).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c)
    tiers = _distribution(predictions, F.col("confidence_tier"), ["high", "medium", "low", "none"])
    pieces = predictions.groupBy("piece_id").agg(F.count("*").alias("documents"), F.count_if(F.col("needs_review")).alias("to_review")).orderBy(F.desc("to_review"), "piece_id")
    return markdown_report("Classification", [("Confidence", tiers, 10), ("Families", count("family"), 25), ("Evidence", count("evidence_source"), 10), ("Pieces", pieces, 25)])


def tallies(records: DataFrame, dimensions: dict[str, Column], measures: dict[str, Column]) -> DataFrame:
    """(dimension, key, *measures): aggregates by each dimension, and over all records (dimension `all`, key null), from
    one scan: a record is dealt to all its groups, which are aggregated within the tasks before they are shuffled.
    dimensions: arrays of a record's keys, none, one or several; a key that stands twice counts twice, a null one is a
    group of its own. Measures are aggregates. Without records there are no rows."""
    entry = lambda name: lambda key: F.struct(F.lit(name).alias("dimension"), key.cast("string").alias("key"))
    none = F.array().cast("array<struct<dimension:string,key:string>>")
    groups = F.concat(F.array(entry("all")(F.lit(None))), *[F.coalesce(F.transform(keys, entry(n)), none) for n, keys in dimensions.items()])
    return records.select("*", F.inline(groups)).groupBy("dimension", "key").agg(*[m.alias(k) for k, m in measures.items()])


def foremost(records: DataFrame, lists: dict[str, tuple], key: str, shown: list[str], most: int = 20) -> DataFrame:
    """(list, rank, *shown): the first `most` records of each list, from one scan. lists: name to (condition, number,
    text), ordered by number, text, the record's key and what is shown, nulls first. A record may be in several lists.
    Tasks keep only their own first ones, so no list gathers all its members."""
    entry = lambda name, on, number, text: F.when(on, F.struct(F.lit(name).alias("list"), number.cast("double").alias("_number"), text.cast("string").alias("_text")))
    found = F.array_compact(F.array(*[entry(n, *spec) for n, spec in lists.items()]))
    rows = records.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_s_{c}") for c in shown], F.inline(found))
    place = F.row_number().over(W.partitionBy("list").orderBy("_number", "_text", "_key", *[f"_s_{c}" for c in shown]))
    return rows.withColumn("rank", place).where(F.col("rank") <= most).select("list", "rank", *[F.col(f"_s_{c}").alias(c) for c in shown])


def _table(head: str, fields: list[str], values: list[tuple], cap: int, count: int | None = None) -> list[str]:
    """The lines of a headed table of at most `cap` rows; `count` tells how many there are where not all came here."""
    text = lambda v: "" if v is None else f"{v:.2f}" if isinstance(v, float) else str(v)
    escaped = [[text(v).replace("|", "\\|").replace("\n", " ") for v in row] for row in values[:cap]]
    lines = ["| " + " | ".join(row) + " |" for row in escaped]
    left = len(values) > cap or (count or 0) > len(lines)
    return [head, "", "| " + " | ".join(fields) + " |", "|" + "---|" * len(fields), *lines, "", *(["(more rows not shown)", ""] if left else [])]


def _groups(counted: DataFrame, first: Column, most: int):
    """A function from a dimension to its first groups, one more than `most`, by `first` and the key."""
    place = F.row_number().over(W.partitionBy("dimension").orderBy(first, "key"))
    rows = counted.withColumn("_n", place).where(F.col("_n") <= most + 1).orderBy("dimension", "_n").collect()
    return lambda dimension: [r for r in rows if r.dimension == dimension]


#: What a page may be, each a boolean column of page records, in the order of the report.
PAGE_STATES = ("needs_ocr", "ocr_applied", "rotated", "image_based", "blank", "music")


def extraction_tallies(pages: DataFrame) -> DataFrame:
    """Counts of pages by folder, type of document, source of text and issue, and over all, from one scan.

    pages: pdf_path, page_number, piece_folder, document_type, text_source, the columns of PAGE_STATES, issues
    array<string>, error; any of them null. Documents are counted by their first pages."""
    by = {"folder": F.array("piece_folder"), "type": F.array(F.coalesce("document_type", F.lit("unknown"))), "source": F.array(F.coalesce("text_source", F.lit("none"))), "issue": F.array_distinct("issues")}
    states = {k: F.count_if(F.coalesce(k, F.lit(False))) for k in PAGE_STATES}
    return tallies(pages, by, {"pages": F.count("*"), "documents": F.count_if(F.col("page_number") == 1), **states, "errors": F.count("error")})


def extraction_attention(pages: DataFrame, issues: list[str], most: int = 15) -> DataFrame:
    """(list, rank, pdf_path, page_number, text_source, error): the first pages with errors, of those that need OCR, and
    of each of the issues, in the order of documents and pages."""
    c, none = F.col, F.lit(None)
    has = lambda i: F.coalesce(F.array_contains("issues", i), F.lit(False))
    lists = {"errors": (c("error").isNotNull(), none, none), "needs_ocr": (F.coalesce("needs_ocr", F.lit(False)), none, none), **{i: (has(i), none, none) for i in issues}}
    return foremost(pages, lists, "pdf_path", ["pdf_path", "page_number", "text_source", "error"], most)


def full_extraction_report(pages: DataFrame, most: int = 15, groups: int = 1000) -> str:
    """The whole report on extracted pages: key figures, text coverage, types, issues, what wants attention, folders. Two
    scans whatever the number of its tables; only the rows that are shown come to the driver."""
    first = F.when(F.col("dimension") == "folder", F.lit(0)).otherwise(-F.col("pages"))
    of = _groups(extraction_tallies(pages), first, groups)
    total = next(iter(of("all")), Row(pages=0, documents=0, errors=0, **dict.fromkeys(PAGE_STATES, 0)))
    figures = ["documents", "pages", "errors", *PAGE_STATES]
    out = ["# Extraction", "", *_table("## At a glance", ["metric", "value"], [(k, total[k]) for k in figures], len(figures))]
    for head, dimension in (("## Text coverage", "source"), ("## Document types", "type"), ("## Image quality", "issue")):
        rows = [(r.key, r.pages, round(100.0 * r.pages / total.pages, 1)) for r in of(dimension)]
        out += _table(head, [dimension, "pages", "percent"], rows, groups)
    issues = {r.key: r.pages for r in of("issue")[:groups] if r.key is not None}
    listed = extraction_attention(pages, sorted(issues), most).orderBy("list", "rank").collect()
    out += ["## Attention", ""]
    for name, n in {"errors": total.errors, "needs_ocr": total.needs_ocr, **issues}.items():
        shown = ["pdf_path", "page_number", "error" if name == "errors" else "text_source"]
        out += _table(f"### {name} ({n})", shown, [tuple(r[f] for f in shown) for r in listed if r.list == name], most, n) if n else []
    per = ["key", "documents", "pages", "needs_ocr", "ocr_applied", "blank", "errors"]
    out += _table("## Folders", ["folder", *per[1:]], [tuple(r[f] for f in per) for r in of("folder")], groups)
    return "\n".join(out)


#: From which confidence a prediction is sure, and below which it is doubtful.
SURE, DOUBTFUL = 0.90, 0.75


def _states() -> dict[str, Column]:
    """What a classified record may be, as conditions that are never null."""
    c, on = F.col, lambda x: F.coalesce(x, F.lit(False))
    fine, score, sure = c("error").isNull(), on(c("is_score")), F.coalesce("confidence", F.lit(0.0))
    part, named = fine & ~score, on(F.size("facets") > 0)
    return {
        "errors": ~fine,
        "classified": part & named,
        "scores": fine & score,
        "unmatched": part & ~named,
        "doubtful": part & named & (sure < DOUBTFUL),
        "duplicates": fine & on(c("duplicate")),
        "to_review": on(c("needs_review")),
        "sure": fine & (sure >= SURE),
        "medium": fine & (sure >= DOUBTFUL) & (sure < SURE),
        "low": fine & (sure > 0) & (sure < DOUBTFUL),
        "no_confidence": fine & (sure <= 0),
    }


def classification_tallies(records: DataFrame) -> DataFrame:
    """Counts of classified documents by piece, family, instrument and evidence, and over all, from one scan. A part of
    several instruments counts for each; scores are a family of their own; records with errors count by piece and over
    all alone.

    records: pdf_path, piece_folder, catalog_number, predicted, facets array<struct<canonical, family>>, is_score,
    confidence, evidence_source, duplicate, needs_review, error; any of them null."""
    on = _states()
    each = lambda field, other: F.transform("facets", lambda x: F.coalesce(x[field], F.lit(other)))
    by = {
        "piece": F.array("piece_folder"),
        "family": F.when(on["scores"], F.array(F.lit("score"))).when(on["unmatched"], F.array(F.lit("unknown"))).when(on["classified"], each("family", "other")),
        "instrument": F.when(on["unmatched"], F.array(F.lit("(unmatched)"))).when(on["classified"], each("canonical", "(unmatched)")),
        "evidence": F.when(~on["errors"], F.array(F.coalesce("evidence_source", F.lit("none")))),
    }
    return tallies(records, by, {"documents": F.count("*"), **{k: F.count_if(x) for k, x in on.items()}, "catalog_number": F.min("catalog_number")})


def classification_attention(records: DataFrame, most: int = 20) -> DataFrame:
    """(list, rank, pdf_path, piece_folder, predicted, confidence, evidence_source, error): the first records with
    errors, without a match, of low confidence (the lowest first), and those whose label another of the piece has."""
    on, none = _states(), F.lit(None)
    lists = {
        "errors": (on["errors"], none, none),
        "unmatched": (on["unmatched"], none, none),
        "doubtful": (on["doubtful"], F.col("confidence"), none),
        "duplicates": (on["duplicates"], none, F.concat_ws("\u0001", F.coalesce("piece_folder", F.lit("")), F.coalesce("predicted", F.lit("")))),
    }
    return foremost(records, lists, "pdf_path", ["pdf_path", "piece_folder", "predicted", "confidence", "evidence_source", "error"], most)


def full_classification_report(records: DataFrame, most: int = 20, groups: int = 1000, detailed: int = 200) -> str:
    """The whole report on classified documents: key figures, coverage, confidence and evidence, what wants attention,
    pieces and single documents. Three scans whatever the number of its tables; only the rows that are shown come to
    the driver: `groups` a dimension, `most` an attention list, `detailed` documents."""
    counted = classification_tallies(records)
    first = F.when(F.col("dimension") == "piece", F.coalesce(F.col("catalog_number").try_cast("long"), F.lit(2**62))).otherwise(-F.col("documents"))
    of = _groups(counted, first, groups)
    total = next(iter(of("all")), Row(documents=0, **dict.fromkeys(_states(), 0)))
    glance = [("documents", total.documents)] + [(k, total[k]) for k in ("errors", "classified", "scores", "unmatched", "doubtful", "duplicates", "to_review")]
    out = ["# Classification", "", *_table("## At a glance", ["metric", "value"], glance, len(glance)), "## Coverage", ""]
    out += _table("### Families", ["family", "documents"], [(r.key, r.documents) for r in of("family")], groups)
    out += _table("### Instruments", ["instrument", "documents"], [(r.key, r.documents) for r in of("instrument")], groups)
    bands = [("high", total.sure), ("medium", total.medium), ("low", total.low), ("none", total.no_confidence)]
    out += _table("## Confidence", ["band", "documents"], bands, 4) + _table("## Evidence", ["evidence_source", "documents"], [(r.key, r.documents) for r in of("evidence")], groups)
    listed = classification_attention(records, most).orderBy("list", "rank").collect()
    fields = {"errors": ["pdf_path", "error"], "unmatched": ["pdf_path", "evidence_source"], "doubtful": ["pdf_path", "predicted", "confidence", "evidence_source"], "duplicates": ["piece_folder", "pdf_path", "predicted"]}
    out += ["## Attention", ""]
    for name, shown in fields.items():
        if total[name]:
            out += _table(f"### {name.capitalize()} ({total[name]})", shown, [tuple(r[f] for f in shown) for r in listed if r.list == name], most, total[name])
    per = ["catalog_number", "key", "documents", "classified", "scores", "unmatched", "doubtful", "duplicates", "to_review"]
    out += _table("## Pieces", ["catalog", "piece", *per[2:]], [tuple(r[f] for f in per) for r in of("piece")], groups)
    detail = ["pdf_path", "piece_folder", "predicted", "confidence", "evidence_source"]
    documents = records.orderBy("pdf_path", *detail[1:]).select(*detail).limit(detailed).collect()
    out += _table("## Documents", detail, [tuple(r) for r in documents], detailed, total.documents)
    return "\n".join(out)


def _shares(head: str, field: str, counts: list[tuple], total: int, cap: int) -> list[str]:
    """A table of values with their counts and shares of `total`."""
    return _table(head, [field, "n", "percent"], [(k, n, round(100.0 * n / total, 1) if total else 0.0) for k, n in counts], cap)


def _in_order(rows: list, field: str, known: list[str]) -> list[tuple]:
    """(key, count) of the known keys, zeros included, then of the others as they come."""
    counts = {r.key: r[field] for r in rows}
    return [(k, counts.pop(k, 0)) for k in known] + list(counts.items())


def quality_tallies(documents: DataFrame) -> DataFrame:
    """Counts of scored documents by band, source of notation and issue, and over all, from one scan; `pages` of an issue
    are those that it affects.

    documents: pdf_path, piece_id, quality_score, quality_band, notation_source_type, page_count, issue_summary
    map<string, pages>, top_issues; any of them null."""
    by = {"band": F.array(F.coalesce("quality_band", F.lit("unknown"))), "source": F.array(F.coalesce("notation_source_type", F.lit("unknown"))), "issue": F.map_keys("issue_summary")}
    pages = F.sum(F.when(F.col("dimension") == "issue", F.try_element_at("issue_summary", F.col("key"))).otherwise(F.col("page_count")))
    return tallies(documents, by, {"documents": F.count("*"), "pages": pages.cast("long"), "unscored": F.count_if(F.col("quality_score").isNull())})


def full_quality_report(documents: DataFrame, most: int = 200, groups: int = 1000) -> str:
    """The whole report on scored documents: key figures, bands, sources of notation, issues, and the worst documents,
    lowest score first and unscored ones before them. Two scans; only the rows that are shown come to the driver."""
    of = _groups(quality_tallies(documents), F.when(F.col("dimension") == "issue", -F.col("pages")).otherwise(-F.col("documents")), groups)
    total = next(iter(of("all")), Row(documents=0, pages=0, unscored=0))
    out = ["# Quality", "", *_table("## At a glance", ["metric", "value"], [(k, total[k] or 0) for k in ("documents", "pages", "unscored")], 3)]
    out += _shares("## Bands", "band", _in_order(of("band"), "documents", list(A.BANDS)), total.documents, groups)
    out += _shares("## Notation", "source", [(r.key, r.documents) for r in of("source")], total.documents, groups)
    out += _table("## Issues", ["issue", "pages", "documents"], [(r.key, r.pages, r.documents) for r in of("issue")], groups)
    shown = ["pdf_path", "piece_id", "page_count", "quality_score", "quality_band", "notation_source_type", "top_issues"]
    flat = documents.withColumn("top_issues", F.array_join("top_issues", ", "))
    worst = foremost(flat, {"worst": (F.lit(True), F.col("quality_score"), F.lit(None))}, "pdf_path", shown, most).orderBy("rank").collect()
    out += _table("## Worst first", shown, [tuple(r[f] for f in shown) for r in worst], most, total.documents)
    return "\n".join(out)


#: Tiers of completeness in the order of reports.
TIERS = ["complete", "near_complete", "incomplete", "severely_incomplete", "unknown"]


def expected_tallies(pieces: DataFrame) -> DataFrame:
    """Counts of pieces with expected parts by status of the lookup, tier, ensemble and missing part, and over all, from
    one scan; a piece counts once for a part that it lacks twice.

    pieces: piece_id, catalog_number, piece_folder, lookup_status, completeness_tier, completeness_score, ensemble,
    missing array<string> (labels of required parts that are not there), needs_review, error; any of them null."""
    either = lambda c, other: F.array(F.coalesce(c, F.lit(other)))
    by = {"status": either("lookup_status", "none"), "tier": either("completeness_tier", "unknown"), "ensemble": either("ensemble", "unknown"), "missing": F.array_distinct(F.array_compact("missing"))}
    on = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    measures = {
        "pieces": F.count("*"),
        "confident": on(F.col("lookup_status") == "matched"),
        "complete": on(F.col("completeness_tier") == "complete"),
        "to_review": on(F.col("needs_review")),
        "errors": F.count("error"),
        "missing_parts": F.coalesce(F.sum(F.greatest(F.size("missing"), F.lit(0))), F.lit(0)),
    }
    return tallies(pieces, by, measures)


def _by_catalog(records: DataFrame, shown: list[str], most: int, on: Column | None = None) -> list[Row]:
    """The first records by catalogue number, those without one last, then by folder."""
    number = F.coalesce(F.col("catalog_number").try_cast("double"), F.lit(float("inf")))
    return foremost(records, {"all": (F.lit(True) if on is None else on, number, F.col("piece_folder"))}, "piece_id", shown, most).orderBy("rank").collect()


def full_expected_report(pieces: DataFrame, most: int = 500, groups: int = 1000) -> str:
    """The whole report on expected parts: key figures, lookups, completeness, ensembles, what most pieces lack, and the
    pieces one by one. Two scans; only the rows that are shown come to the driver."""
    of = _groups(expected_tallies(pieces), -F.col("pieces"), groups)
    figures = ["pieces", "confident", "complete", "to_review", "errors", "missing_parts"]
    total = next(iter(of("all")), Row(**dict.fromkeys(figures, 0)))
    out = ["# Expected parts", "", *_table("## At a glance", ["metric", "value"], [(k, total[k]) for k in figures], len(figures))]
    out += _shares("## Lookups", "status", [(r.key, r.pieces) for r in of("status")], total.pieces, groups)
    out += _shares("## Completeness", "tier", _in_order(of("tier"), "pieces", TIERS), total.pieces, groups)
    out += _table("## Ensembles", ["ensemble", "pieces"], [(r.key, r.pieces) for r in of("ensemble")], groups)
    out += _table("## Most missing", ["part", "pieces"], [(r.key, r.pieces) for r in of("missing")], 25, len(of("missing")))
    shown = ["catalog_number", "piece_folder", "ensemble", "lookup_status", "completeness_tier", "completeness_score", "missing", "needs_review"]
    rows = _by_catalog(pieces.withColumn("missing", F.array_join("missing", ", ")), shown, most)
    out += _table("## Pieces", shown, [tuple(r[f] for f in shown) for r in rows], most, total.pieces)
    return "\n".join(out)


def collection_tallies(pieces: DataFrame) -> DataFrame:
    """Counts of pieces by severity, tier, reason, worst band, version, missing part and missing section, and over all,
    from one scan; `documents` are those of the pieces.

    pieces: piece_id, catalog_number, piece_folder, severity, completeness_tier, completeness_score, reason_codes,
    worst_quality_band, record_version, missing_required_parts array<struct<label, section>>, document_count,
    low_quality_count, needs_review, score_missing; any of them null."""
    either = lambda c: F.array(F.coalesce(c, F.lit("unknown")))
    lacks = lambda field: F.array_distinct(F.array_compact(F.col("missing_required_parts")[field]))
    by = {
        "severity": either("severity"),
        "tier": either("completeness_tier"),
        "reason": F.array_distinct("reason_codes"),
        "band": either("worst_quality_band"),
        "version": either("record_version"),
        "missing": lacks("label"),
        "section": lacks("section"),
    }
    on = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    measures = {
        "pieces": F.count("*"),
        "complete": on(F.col("completeness_tier") == "complete"),
        "to_review": on(F.col("needs_review")),
        "without_score": on(F.col("score_missing")),
        "with_findings": on(F.size("reason_codes") > 0),
        "documents": total("document_count"),
        "low_quality_documents": total("low_quality_count"),
        "completeness": F.round(F.avg("completeness_score"), 3),
    }
    return tallies(pieces, by, measures)


def full_collection_report(pieces: DataFrame, most: int = 50, groups: int = 1000) -> str:
    """The whole dashboard of a collection: headline, distributions, reasons, missing parts and sections, versions, and the
    pieces that want attention, the severe ones first. Two scans; only the rows that are shown come to the driver."""
    of = _groups(collection_tallies(pieces), -F.col("pieces"), groups)
    figures = ["pieces", "complete", "to_review", "without_score", "with_findings"]
    total = next(iter(of("all")), Row(**dict.fromkeys(figures, 0), documents=0, low_quality_documents=0, completeness=None))
    out = ["# Collection", "", *_shares("## Headline", "metric", [(k, total[k]) for k in figures], total.pieces, len(figures))]
    out += _table("## Documents", ["metric", "value"], [("documents", total.documents), ("low quality", total.low_quality_documents), ("mean completeness", total.completeness)], 3)
    known = {"severity": ["high", "review", "ok"], "tier": TIERS, "reason": list(A.REASONS), "band": list(A.BANDS)}
    for head, dimension in (("Severity", "severity"), ("Completeness", "tier"), ("Reasons", "reason"), ("Worst band", "band")):
        out += _shares(f"## {head}", dimension, _in_order(of(dimension), "pieces", known[dimension]), total.pieces, groups)
    for head, dimension in (("Most missing parts", "missing"), ("Most missing sections", "section"), ("Versions", "version")):
        out += _table(f"## {head}", [dimension, "pieces"], [(r.key, r.pieces) for r in of(dimension)], 25, len(of(dimension)))
    shown = ["catalog_number", "piece_folder", "severity", "completeness_tier", "reason_codes"]
    flat = pieces.withColumn("reason_codes", F.array_join("reason_codes", ", "))
    number = F.coalesce(F.col("catalog_number").try_cast("double"), F.lit(float("inf")))
    lists = {name: (F.coalesce(F.col("severity") == name, F.lit(False)), number, F.col("piece_folder")) for name in ("high", "review")}
    rows = foremost(flat, lists, "piece_id", shown, most).orderBy("list", "rank").collect()
    wanting = sum(r.pieces for r in of("severity") if r.key in lists)
    out += _table("## Attention", shown, [tuple(r[f] for f in shown) for r in rows][:most], most, wanting)
    return "\n".join(out)


def expected_report(pieces: DataFrame, slots: DataFrame) -> str:
    tiers = _distribution(pieces, F.col("completeness_tier"), ["complete", "near_complete", "incomplete", "severely_incomplete", "unknown"])
    missing = slots.where("required and not present").groupBy("label").agg(F.countDistinct("piece_id").alias("pieces")).orderBy(F.desc("pieces"), "label")
    summary = summarised(pieces, F.col("completeness_score"))
    return markdown_report("Expected parts", [("Completeness", summary, 1), ("Tiers", tiers, 10), ("Most missing", missing, 25)])


def quality_report(documents: DataFrame, most: int = 200) -> str:
    bands = _distribution(documents, F.col("quality_band"), list(A.BANDS))
    issues = documents.select(F.explode("issue_summary").alias("issue", "pages")).groupBy("issue").agg(F.sum("pages").alias("pages")).orderBy(F.desc("pages"), "issue")
    worst = documents.orderBy(F.coalesce("quality_score", F.lit(-1.0)), "pdf_path").select("pdf_path", "quality_score", "quality_band", "top_issues")
    return markdown_report("Quality", [("Bands", bands, 10), ("Issues", issues, 20), ("Worst first", worst, most)])


def _section(df: DataFrame, column: str, *fields: str) -> list[tuple[str, DataFrame, int]]:
    """The rows of an array column as a section headed by its name; none where there is no such column."""
    if column not in df.columns:
        return []
    rows = df.select(F.inline(column))
    return [(column.replace("_", " ").capitalize(), rows.select(*fields) if fields else rows, 200)]


def piece_report(piece: DataFrame) -> str:
    """One piece's findings: identity, slots, what is to be done, documents, and, as far as it has them, observed and
    unexpected parts and the evidence."""
    head = piece.select("piece_id", "piece_folder", "severity", "completeness_tier", "completeness_score")
    slots = piece.select(F.inline("expected_parts"))
    todo = piece.select(F.explode("action_items").alias("x")).select("x.reason_code", "x.action", shown_targets(F.col("x.targets")).alias("targets"))
    documents = piece.select(F.inline("documents")).select("pdf_filename", "quality_band")
    more = [*_section(piece, "observed_parts"), *_section(piece, "unexpected_parts"), *_section(piece, "evidence_sources", "title", "url")]
    return markdown_report("Piece", [("Summary", head, 1), ("Expected parts", slots, 200), ("To do", todo, 10), ("Documents", documents, 200), *more])


def _table_lines(head: str, rows: Column, fields: list, most: int) -> Column:
    """The lines of a headed table over an array of structs, at most so many rows and a note on what is left out.
    fields: names, or functions of a row to text with their name."""
    names = [f if isinstance(f, str) else f[0] for f in fields]
    cell = lambda x, f: markdown_cell((x[f] if isinstance(f, str) else f[1](x)).cast("string"))
    shown = F.transform(F.slice(rows, 1, most), lambda x: F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(x, f) for f in fields]), F.lit(" |")))
    start = F.array(F.lit(f"## {head}"), F.lit("| " + " | ".join(names) + " |"), F.lit("|" + "---|" * len(names)))
    note = F.when(F.size(rows) > most, F.array(F.lit("(more rows not shown)"))).otherwise(F.array().cast("array<string>"))
    return F.concat(start, F.coalesce(shown, F.array().cast("array<string>")), note)


def piece_reports(pieces: DataFrame) -> DataFrame:
    """(piece_id, lines): the report of every piece, from its nested record, as piece_report() writes one; a null list
    has no rows. Each is made where its record is, so there may be any number of them. Score, quality and confidence
    have sections where the record has their columns."""
    c = F.col
    head = F.array(F.struct("piece_id", "piece_folder", "severity", "completeness_tier", "completeness_score"))
    listed = lambda name: F.filter(c(name), lambda x: x.isNotNull())
    sections = [
        F.array(F.lit("# Piece")),
        _table_lines("Summary", head, ["piece_id", "piece_folder", "severity", "completeness_tier", "completeness_score"], 1),
        _table_lines("Expected parts", listed("expected_parts"), ["label", "required", "present"], 200),
        _table_lines("To do", listed("action_items"), ["reason_code", "action", ("targets", lambda x: shown_targets(x["targets"]))], 10),
        _table_lines("Documents", listed("documents"), ["pdf_filename", "quality_band"], 200),
    ]
    for title, fields in (("Score", ("score_types", "has_score", "score_expected", "score_missing")), ("Quality findings", ("worst_quality_band", "quality_summary")), ("Confidence", ("identity_match_confidence", "review_counts", "needs_review"))):
        there = [f for f in fields if f in pieces.columns]
        if there:
            nested = lambda f: isinstance(pieces.schema[f].dataType, (T.ArrayType, T.MapType, T.StructType))
            rows = F.array(*[F.struct(F.lit(f).alias("field"), (F.to_json(f) if nested(f) else c(f).cast("string")).alias("value")) for f in there])
            sections.append(_table_lines(title, rows, ["field", ("value", lambda x: F.coalesce(x["value"], F.lit("")))], len(there)))
    return pieces.select("piece_id", F.concat(*sections).alias("lines"))


def instrumentation_report(pieces: DataFrame) -> str:
    """Each piece's instrumentation: where it comes from, and its parts (piece_folder, method_label, parts)."""
    rows = pieces.orderBy("piece_folder").select("piece_folder", "method_label", F.array_join("parts", ", ").alias("parts"))
    return markdown_report("Instrumentation", [("Pieces", rows, 500)])


def index_lines(pieces: DataFrame, folder: str) -> DataFrame:
    """(piece_id, line): a linked line for each piece's report."""
    link = F.concat(F.lit("["), markdown_cell(F.col("piece_folder")), F.lit(f"]({folder}/"), F.col("piece_id").cast("string"), F.lit(".md) - "), F.col("severity"))
    return pieces.select("piece_id", link.alias("line"))


def dashboard(pieces: DataFrame) -> str:
    """Severity, completeness, reasons and the pieces that want attention."""
    severity = _distribution(pieces, F.col("severity"), ["high", "review", "ok"])
    tiers = _distribution(pieces, F.col("completeness_tier"), ["complete", "near_complete", "incomplete", "severely_incomplete", "unknown"])
    reasons = _distribution(pieces.select(F.explode("reason_codes").alias("code")), F.col("code"), list(A.REASONS))
    rank = F.when(F.col("severity") == "high", 0).otherwise(1)
    attention = pieces.where(F.col("severity").isin("high", "review")).orderBy(rank, *piece_order(F.col("catalog_number"), F.col("piece_folder"))).select("catalog_number", "piece_folder", "severity", "reason_codes")
    tables = [("Severity", severity, 5), ("Completeness", tiers, 10), ("Reasons", reasons, 10)]
    if "worst_quality_band" in pieces.columns:
        tables.append(("Quality", _distribution(pieces, F.col("worst_quality_band"), list(A.BANDS)), 10))
    if "record_version" in pieces.columns:
        tables.append(("Versions", pieces.groupBy("record_version").agg(F.count("*").alias("n")).orderBy("record_version"), 10))
    if "missing_required_parts" in pieces.columns:
        missing = pieces.select("piece_id", F.explode("missing_required_parts").alias("p")).select("piece_id", F.col("p.label").alias("label"))
        tables.append(("Most missing", A.most_missing(missing, "piece_id", "label", 25), 25))
    return markdown_report("Collection", [*tables, ("Attention", attention, 50)])


def phases(counted: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """(ord, phase, unit, records): how many records each phase of the processing has made."""
    rows = [df.agg(F.count("*").alias("records")).select(F.lit(i).alias("ord"), F.lit(phase).alias("phase"), F.lit(unit).alias("unit"), "records") for i, (phase, unit, df) in enumerate(counted)]
    return reduce(lambda a, b: a.union(b), rows)


def review_pack(queue: DataFrame, most: int = 50, detailed: int = 0) -> str:
    """The weights, the foremost entries, and what is to be done about the first `detailed` of them."""
    weights = queue.sparkSession.createDataFrame(sorted(A.WEIGHTS.items()), "component string, points int")
    rows = queue.orderBy("rank").select("rank", "piece_id", "priority_score", "severity", "reason_codes")
    out = [markdown_report("Review queue", [("Weights", weights, 10), ("Queue", rows, most)])]
    for r in queue.orderBy("rank").limit(detailed).collect() if detailed else []:
        out += [f"## {r.piece_id}", "", *[f"- {a}" for a in r.recommended_actions or []], ""]
    return "\n".join(out)


def glossary(tables: dict[str, DataFrame], meanings: dict[str, str] | None = None) -> str:
    """The columns of tables, with what is known of their meaning (`table.column`)."""
    out = ["# Tables", ""]
    for name, df in tables.items():
        told = [f"- `{f.name}`: {f.dataType.simpleString()}" + (f", {m}" if (m := (meanings or {}).get(f"{name}.{f.name}")) else "") for f in df.schema]
        out += [f"## {name}", "", *told, ""]
    return "\n".join(out)


def manifest(pieces: DataFrame, documents: DataFrame, version: str) -> DataFrame:
    """One row of counts and key figures."""
    p = pieces.agg(F.count("*").alias("pieces"), F.count_if(F.col("severity") == "high").alias("high"), F.round(F.avg("completeness_score"), 3).alias("mean_completeness"))
    d = documents.agg(F.count("*").alias("documents"), F.sum("page_count").alias("pages"))
    return p.crossJoin(F.broadcast(d)).withColumn("record_version", F.lit(version))  # a row by a row
