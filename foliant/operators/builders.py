"""Whole records: the columns, in their order, that later steps and other tools read. Column names and their order are
fixed values; what a source lacks is null."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.numbers import file_fingerprint, sha256_tagged, short_id, to_pct, utc_text
from foliant.functions.predicates import readable_text, yes
from foliant.functions.text import alnum_ratio, blank_to_null, file_name, first_truthy, text_hash, word_count
from foliant.operators.aggregates import BANDS, worst_of
from foliant.operators.records import envelope, evidence, missing_required

#: The columns of each kind of record, in order.
ENVELOPE = ("record_version", "run_id", "processing_status", "processing_timestamp")
INVENTORY = (
    "record_version", "run_id", "piece_id", "piece_folder", "piece_folder_hash", "pdf_path", "pdf_filename", "file_size_bytes", "modified_timestamp",
    "file_fingerprint", "page_count", "pdf_readable", "is_encrypted", "pdf_metadata", "health_flags", "processing_status", "error_message", "processing_timestamp",
)
METADATA = ("title", "author", "subject", "creator", "producer", "creation_date", "modification_date")
PAGE_TEXT = (
    "record_version", "run_id", "pdf_path", "piece_id", "page_num", "page_index_zero", "embedded_text", "embedded_text_length", "extraction_method", "text_is_searchable", "needs_ocr",
    "ocr_text", "ocr_confidence", "ocr_word_count", "ocr_candidates", "ocr_applied", "ocr_status", "ocr_engine", "text_source", "word_count", "alnum_ratio", "page_text_hash",
    "header_text_candidates", "top_lines", "zone_top_left", "zone_top_center", "zone_top_right", "zone_bottom", "processing_timestamp", "processing_status", "error_message",
)
PAGE_FEATURES = (
    "record_version", "run_id", "pdf_path", "piece_id", "page_num", "page_index_zero", "thumbnail_path", "thumbnail_hash", "render_dpi", "render_width_px", "render_height_px",
    "render_file_size_bytes", "text_density", "black_white_ratio", "page_width_pt", "page_height_pt", "rotation", "orientation", "aspect_ratio", "image_count", "largest_image_coverage",
    "is_image_based", "estimated_dpi", "contrast_std", "blur_variance", "skew_angle_deg", "is_blank", "has_staves", "staff_line_count", "osd_rotation", "osd_orientation_conf",
    "osd_script", "render_timestamp", "processing_status", "error_message",
)
DETECTED = (
    "pdf_path", "pdf_filename", "predicted_part", "confidence_tier", "needs_review", "is_score", "score_type", "duplicate_in_piece", "page_count", "quality_band", "quality_score",
    "notation_source_type", "quality_top_issues", "thumbnail_path", "part_sort_key",
)
PIECE = (
    *ENVELOPE, "piece_id", "catalog_number", "piece_title_guess", "piece_folder", "document_count", "documents", "ensemble_type", "ensemble_display_name", "lookup_status",
    "identity_match_confidence", "work_identity", "evidence_sources", "instrumentation_provenance", "expected_parts", "missing_required_parts", "missing_optional_parts", "unexpected_parts",
    "completeness_score", "completeness_tier", "has_expected_parts", "expected_part_count", "missing_required_count", "unexpected_part_count", "observed_instrument_count", "observed_parts",
    "distinct_instruments", "families", "sections", "score_types", "review_counts", "worst_quality_band", "quality_summary", "reason_codes", "severity", "needs_review", "has_score",
    "score_expected", "score_missing", "recommended_actions", "action_items",
)
PIECES_CSV = (
    "catalog_number", "piece_title_guess", "piece_id", "severity", "completeness_tier", "completeness_score", "needs_review", "missing_required_count", "unexpected_part_count",
    "score_missing", "worst_quality_band", "low_quality_doc_count", "handwritten_doc_count", "document_count", "reason_codes",
)
QUEUE_CSV = (
    "rank", "priority_score", "catalog_number", "piece_title_guess", "piece_id", "severity", "completeness_tier", "completeness_score", "missing_required_count", "missing_required_parts",
    "low_quality_doc_count", "handwritten_doc_count", "unexpected_part_count", "duplicate_count", "reason_codes", "next_action",
)
#: How an instrumentation was found, as it is shown.
METHODS = {
    "local_score_ocr": ("OCR of local score", "Read from the OCR'd text of the piece's own score."),
    "windrep_lookup": ("Web lookup (Wind Repertory Project)", "Identified by an LLM web search of authoritative publisher/catalog sources."),
    "authority_lookup": ("Web lookup (authority source)", "Identified by an LLM web search of authoritative publisher/catalog sources."),
    "score_image_ocr": ("OCR of score image from web", "Read from OCR of a score image found via web search."),
    "conservative_fallback": ("No authoritative source (observed parts only)", "No authoritative instrumentation found; only the parts observed in the library copy are known."),
}


def field(df: DataFrame, path: str, kind: str = "string") -> Column:
    """A column or a struct's field by dotted path; null of a type where df has no such field."""
    at = df.schema
    for name in path.split("."):
        names = getattr(at, "names", [])
        if name not in names:
            return F.lit(None).cast(kind)
        at = at[name].dataType
    return F.col(path)


def in_order(df: DataFrame, columns: tuple[str, ...], kinds: dict[str, str] | None = None) -> DataFrame:
    """Exactly these columns."""
    return df.select(*[field(df, c, (kinds or {}).get(c, "string")).alias(c) for c in columns])


def inventory_record(files: DataFrame, version: str) -> DataFrame:
    """The 18 columns of an inventory from scanned and probed files (pdf_path, piece_folder, file_size_bytes, modified,
    health, optionally pdf_metadata). A file without a size is missing: fixed values, status `error`."""
    c, gone = F.col, F.col("file_size_bytes").isNull()
    health = lambda name, kind: field(files, f"health.{name}", kind)
    message = F.coalesce(health("error_message", "string"), F.when(gone, "missing"))
    bad = gone | message.isNotNull()
    known = {n: field(files, f"pdf_metadata.{n}") for n in METADATA}
    flags = F.struct(
        yes(health("is_zero_page", "boolean") & ~bad).alias("is_zero_page"), (bad | yes(health("is_malformed", "boolean"))).alias("is_malformed"), F.lit(False).alias("is_corrupted"),
        F.array_compact(F.array(message)).alias("warnings"),
    )
    out = envelope(files, version).withColumns(
        {
            "piece_id": short_id(c("piece_folder")),
            "piece_folder_hash": sha256_tagged(c("piece_folder")),
            "pdf_filename": file_name(c("pdf_path")),
            "file_fingerprint": F.when(gone, sha256_tagged(F.concat("pdf_path", F.lit("|missing")))).otherwise(file_fingerprint(c("pdf_path"), c("file_size_bytes"), c("modified"))),
            "modified_timestamp": utc_text(F.coalesce("modified", F.current_timestamp())),
            "page_count": F.when(bad, -1).otherwise(health("page_count", "int")),
            "pdf_readable": yes(health("pdf_readable", "boolean") & ~bad),
            "is_encrypted": yes(health("is_encrypted", "boolean") & ~bad),
            "pdf_metadata": F.struct(*[F.when(~bad, v).alias(n) for n, v in known.items()]),
            "health_flags": flags,
            "error_message": message,
            "processing_status": F.when(bad, "error").otherwise("success"),
        }
    )
    return in_order(out.withColumn("file_size_bytes", F.coalesce(c("file_size_bytes").cast("long"), F.lit(-1))), INVENTORY)


def page_text_record(pages: DataFrame, version: str) -> DataFrame:
    """The 31 columns of a page's text. pages: pdf_path, piece_id, page_num, embedded_text and, as far as known, `ocr`
    (a struct, null where OCR wasn't applied), header_text_candidates, top_lines and the struct `zones`."""
    text, heard = F.coalesce("embedded_text", F.lit("")), field(pages, "ocr", "string").isNotNull()
    ocr = lambda name, kind="string": field(pages, f"ocr.{name}", kind)
    searchable = readable_text(F.col("embedded_text"))
    none = F.array().cast("array<string>")
    return in_order(
        envelope(pages, version).withColumns(
            {
                "page_index_zero": F.col("page_num") - 1,
                "embedded_text_length": F.length(text),
                "extraction_method": F.lit("embedded"),
                "text_is_searchable": searchable,
                "needs_ocr": ~searchable,
                "ocr_text": ocr("ocr_text"),
                "ocr_confidence": ocr("ocr_confidence", "double"),
                "ocr_word_count": ocr("ocr_word_count", "int"),
                "ocr_candidates": F.coalesce(ocr("ocr_candidates", "array<string>"), none) if "ocr" not in pages.columns else ocr("ocr_candidates", "array<string>"),
                "ocr_applied": heard,
                "ocr_status": F.when(heard, F.coalesce(ocr("ocr_status"), F.lit("not_applied"))).otherwise("not_applied"),
                "ocr_engine": F.when(heard, "tesseract"),
                "text_source": F.when(searchable, "embedded").when(first_truthy(ocr("ocr_text")).isNotNull(), "ocr").otherwise("none"),
                "word_count": word_count(text),
                "alnum_ratio": alnum_ratio(text),
                "page_text_hash": text_hash(text),
                "header_text_candidates": F.coalesce(field(pages, "header_text_candidates", "array<string>"), none),
                "top_lines": F.coalesce(field(pages, "top_lines", "array<string>"), none),
                **{f"zone_{z}": field(pages, f"zones.{z}") for z in ("top_left", "top_center", "top_right", "bottom")},
                "error_message": field(pages, "error_message"),
            }
        ),
        PAGE_TEXT,
    )


def page_feature_record(pages: DataFrame, version: str) -> DataFrame:
    """The 35 columns of a page's features, from whichever of them pages has."""
    out = envelope(pages, version).withColumn("page_index_zero", F.col("page_num") - 1)
    if "processing_status" in pages.columns:
        out = out.withColumn("processing_status", pages["processing_status"])
    return in_order(out.withColumn("render_timestamp", F.col("processing_timestamp")), PAGE_FEATURES)


def provenance(method: Column, status: Column, confidence: Column, model: Column, notes: Column, sources: Column | None = None, path: Column | None = None, ocr: Column | None = None) -> Column:
    """Where an instrumentation comes from: the method, its label and summary, and what the lookup told."""
    by = lambda i, rest: F.coalesce(*[F.when(method == m, texts[i]) for m, texts in METHODS.items()], rest)
    label = by(0, F.initcap(F.replace(method, F.lit("_"), F.lit(" "))))
    none = F.lit(None).cast("string")
    return F.struct(
        method.alias("method"), label.alias("method_label"), by(1, F.lit(METHODS["conservative_fallback"][1])).alias("summary"), status.alias("status"),
        F.round(F.coalesce(confidence, F.lit(0.0)), 3).alias("confidence"), blank_to_null(model).alias("model"), F.trim(F.coalesce(notes, F.lit(""))).alias("notes"),
        (path if path is not None else none).alias("local_score_path"), (ocr if ocr is not None else none).alias("ocr_source"),
        (evidence(sources) if sources is not None else F.array().cast("array<struct<url:string,title:string,snippet:string>>")).alias("sources"),
    )


def detected_documents(predictions: DataFrame, quality: DataFrame, documents: DataFrame, thumbnails: DataFrame) -> DataFrame:
    """piece_id and the 15 columns of each predicted document; every other side has one row a pdf_path."""
    q = quality.select("pdf_path", *[field(quality, c, "double" if c == "quality_score" else "string").alias(c) for c in ("quality_band", "quality_score", "notation_source_type")], field(quality, "top_issues", "array<string>").alias("quality_top_issues"))
    both = predictions.join(q, "pdf_path", "left").join(documents.select("pdf_path", "page_count"), "pdf_path", "left").join(thumbnails.select("pdf_path", "thumbnail_path"), "pdf_path", "left")
    flag = {c: yes(field(predictions, c, "boolean")) for c in ("needs_review", "is_score", "duplicate_in_piece")}
    out = both.withColumns({**flag, "pdf_filename": first_truthy(field(predictions, "pdf_filename"), file_name(F.col("pdf_path"))), "part_sort_key": F.coalesce(field(predictions, "part_sort_key"), F.lit("")), "quality_top_issues": F.coalesce("quality_top_issues", F.array().cast("array<string>"))})
    return out.select("piece_id", *[field(out, c).alias(c) for c in DETECTED])


def piece_documents(detected: DataFrame) -> DataFrame:
    """(piece_id, documents): each piece's detected documents, in the parts' order."""
    key = F.struct(F.col("part_sort_key").alias("_a"), F.coalesce("pdf_filename", F.lit("")).alias("_b"), F.struct(*DETECTED).alias("d"))
    return detected.groupBy("piece_id").agg(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["d"]).alias("documents"))


def quality_summary(documents: Column) -> Column:
    """Counts of a piece's documents by band, low ones and those that look handwritten."""
    band = lambda b: F.size(F.filter(documents, lambda d: (d["quality_band"] == b) if b != "unknown" else ~yes(d["quality_band"].isin(*BANDS[:3]))))
    counts = F.struct(*[band(b).alias(b) for b in BANDS])
    hand = F.size(F.filter(documents, lambda d: yes(d["notation_source_type"].isin("handwritten", "mixed_or_uncertain"))))
    return F.struct(counts.alias("band_counts"), (band("poor") + band("fair")).alias("low_quality_doc_count"), hand.alias("handwritten_doc_count"))


def piece_record(pieces: DataFrame, version: str, actions: dict[str, str]) -> DataFrame:
    """The 44 columns of a piece. pieces: the identity, `expected` and `observed` (structs, null where there is none),
    `documents` (as piece_documents gives them), reason_codes, severity and action_items. Counts fall back to the
    lengths of their lists, the count of instruments to the observed one."""
    e = lambda name, kind="string": field(pieces, f"expected.{name}", kind)
    o = lambda name, kind="string": field(pieces, f"observed.{name}", kind)
    parts = "array<struct<label:string,required:boolean,present:boolean>>"
    lists = {n: F.coalesce(e(n, parts), F.array().cast(parts)) if "expected" not in pieces.columns or n not in pieces.schema["expected"].dataType.names else F.coalesce(e(n), F.filter(e(n), lambda x: F.lit(False))) for n in ("expected_parts", "missing_required_parts", "missing_optional_parts", "unexpected_parts")}
    lists = {n: F.when(F.col("expected").isNotNull(), v).otherwise(v) for n, v in lists.items()}
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    texts = "array<string>"
    counts = ("needs_review_count", "low_confidence_count", "unmatched_count", "duplicate_count")
    codes = F.col("reason_codes")
    docs = F.col("documents")
    has_score = F.exists(F.coalesce(docs, F.filter(docs, lambda d: F.lit(False))), lambda d: yes(d["is_score"]))
    out = envelope(pieces, version).withColumns(
        {
            "document_count": size(docs),
            **{n: e(n) for n in ("ensemble_type", "ensemble_display_name", "lookup_status", "work_identity", "instrumentation_provenance")},
            "identity_match_confidence": e("identity_match_confidence", "double"),
            "evidence_sources": e("evidence_sources", texts),
            **lists,
            "completeness_score": e("completeness_score", "double"),
            "completeness_tier": F.coalesce(blank_to_null(e("completeness_tier")), F.lit("unknown")),
            "has_expected_parts": F.col("expected").isNotNull(),
            "expected_part_count": e("expected_part_count", "int"),
            "missing_required_count": F.coalesce(e("missing_required_count", "int"), size(lists["missing_required_parts"])),
            "unexpected_part_count": F.coalesce(e("unexpected_part_count", "int"), size(lists["unexpected_parts"])),
            "observed_instrument_count": F.coalesce(e("observed_instrument_count", "int"), o("distinct_instruments", "int")),
            "observed_parts": o("observed_parts", texts),
            "distinct_instruments": o("distinct_instruments", "int"),
            **{n: F.coalesce(o(n, texts), F.array().cast(texts)) for n in ("families", "sections", "score_types")},
            "review_counts": F.struct(*[o(n, "long").alias(n) for n in counts]),
            "worst_quality_band": worst_of(F.transform(docs, lambda d: d["quality_band"])),
            "quality_summary": quality_summary(docs),
            "needs_review": (size(codes) > 0) | yes(e("needs_review", "boolean")) | yes(o("needs_review_count", "long") > 0),
            "has_score": has_score,
            "score_expected": yes(e("score_expected", "boolean")),
            "score_missing": F.array_contains(codes, "missing_score"),
            "recommended_actions": F.transform(codes, lambda r: F.coalesce(*[F.when(r == k, v) for k, v in actions.items()])),
        }
    )
    return in_order(out, PIECE)


def pieces_index(records: DataFrame) -> DataFrame:
    """The structured grid of pieces: nulls as zero and false, and the counts that a review queue weighs."""
    n = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c.split(".")[-1])
    review = F.struct(*[F.coalesce(F.col(f"review_counts.{c}").cast("int"), F.lit(0)).alias(c) for c in ("needs_review_count", "low_confidence_count", "unmatched_count", "duplicate_count")])
    return records.select(
        "piece_id", "catalog_number", first_truthy(F.col("piece_title_guess"), F.col("piece_folder")).alias("piece_title_guess"), "severity", "completeness_tier", "completeness_score",
        yes(F.col("needs_review")).alias("needs_review"), yes(F.col("score_missing")).alias("score_missing"), n("missing_required_count"), n("unexpected_part_count"), n("document_count"),
        "worst_quality_band", n("quality_summary.low_quality_doc_count"), n("quality_summary.handwritten_doc_count"), review.alias("review_counts"), F.coalesce("reason_codes", F.array().cast("array<string>")).alias("reason_codes"),
    )


def queue_entries(records: DataFrame, folder: str, points: dict[str, Column]) -> DataFrame:
    """The 24 fields of a review queue's entry but its rank, which comes after sorting. `points` are the components of
    its score, by name."""
    n = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c.split(".")[-1])
    review = F.struct(*[F.coalesce(F.col(f"review_counts.{c}").cast("int"), F.lit(0)).alias(c) for c in ("low_confidence_count", "unmatched_count", "duplicate_count")])
    shown = F.get(F.filter(F.transform("documents", lambda d: d["thumbnail_path"]), lambda t: blank_to_null(t).isNotNull()), F.lit(0))
    total = sum(points.values(), F.lit(0)).cast("int")
    return records.select(
        "piece_id", "catalog_number", first_truthy(F.col("piece_title_guess"), F.col("piece_folder")).alias("piece_title_guess"), "piece_folder", total.alias("priority_score"),
        F.struct(*[v.alias(k) for k, v in points.items()]).alias("priority_breakdown"), "severity", "completeness_tier", "completeness_score", yes(F.col("score_missing")).alias("score_missing"),
        "worst_quality_band", n("missing_required_count"), n("unexpected_part_count"), n("quality_summary.low_quality_doc_count"), n("quality_summary.handwritten_doc_count"), n("document_count"),
        review.alias("review_counts"), "reason_codes", "recommended_actions", "action_items", missing_required(F.col("expected_parts")).alias("missing_required_parts"), shown.alias("sample_thumbnail"),
        F.when(F.col("piece_id").isNotNull(), F.concat(F.lit(f"{folder}/"), "piece_id", F.lit(".md"))).alias("report_path"),
    )


def pieces_csv(index: DataFrame) -> DataFrame:
    return in_order(index, PIECES_CSV)


def queue_csv(queue: DataFrame) -> DataFrame:
    """The 16 columns of the queue's CSV: missing parts by label, the first action as the next."""
    labels = F.array_join(F.transform("missing_required_parts", lambda p: F.coalesce(blank_to_null(p["label"]), F.lit(""))), "; ")
    out = queue.withColumns({"missing_required_parts": F.coalesce(labels, F.lit("")), "duplicate_count": F.col("review_counts.duplicate_count"), "next_action": F.coalesce(F.get("recommended_actions", F.lit(0)), F.lit(""))})
    return in_order(out, QUEUE_CSV)


def conservative_record(pieces: DataFrame, status: Column, version: str) -> DataFrame:
    """What is recorded of a piece whose lookup didn't match: what was observed, nothing expected, always for review.
    pieces: piece_id, piece_folder, observed_canonicals array<string>."""
    zero, no = F.lit(0), F.lit(False)
    fixed = {
        "detection_method": F.lit("conservative_fallback"), "inference_method": F.lit("fallback_conservative"), "lookup_status": status, "authority_coverage": F.lit("none"),
        "instrumentation_provenance": provenance(F.lit("conservative_fallback"), status, F.lit(0.0), F.lit(""), F.lit("")),
        "expected_parts": F.array().cast("array<string>"), "missing_required_parts": F.array().cast("array<string>"), "unexpected_parts": F.array().cast("array<string>"),
        "score_expected": no, "score_missing": no, "completeness_score": F.lit(None).cast("double"), "completeness_tier": F.lit("unknown"),
        "observed_instrument_count": F.size(F.array_distinct("observed_canonicals")), "expected_part_count": zero, "missing_required_count": zero, "unexpected_part_count": zero, "needs_review": F.lit(True),
    }
    return envelope(pieces, version).withColumns(fixed).drop("observed_canonicals")


def unexpected_entry(part: Column) -> Column:
    """A held part that no slot asked for, as it is listed: its facets without families, role, count and clefs."""
    facets = F.transform(part["instruments"], lambda x: F.struct(x["canonical"].alias("canonical"), x["part_index"].alias("part_index")))
    return F.struct(part["predicted_part"].alias("predicted_part"), facets.alias("instruments"), F.coalesce(part["part_role"], F.lit("section")).alias("part_role"), F.coalesce(part["count"], F.lit(1)).alias("count"), F.coalesce(part["observed_clefs"], F.array().cast("array<string>")).alias("observed_clefs"))


def site_pieces(index: DataFrame, reports: DataFrame, pages: DataFrame) -> DataFrame:
    """Pieces as they are shown: percentages and counts. reports: piece_id, piece_folder, expected_parts,
    expected_part_count; pages: piece_id, page_count."""
    both = index.join(reports.select("piece_id", "piece_folder", "expected_parts", "expected_part_count"), "piece_id", "left").join(pages, "piece_id", "left")
    size = F.greatest(F.coalesce(F.size("expected_parts"), F.lit(0)), F.lit(0))
    asked = F.coalesce(F.nullif(F.col("expected_part_count"), F.lit(0)), size)
    there = F.greatest(F.coalesce(F.size(F.filter("expected_parts", lambda p: yes(p["present"]))), F.lit(0)), F.lit(0))
    return both.select(
        "piece_id", F.col("piece_title_guess").alias("title"), "catalog_number", "piece_folder", "severity", to_pct(F.col("completeness_score")).cast("int").alias("completeness_pct"), "completeness_tier",
        "document_count", F.coalesce("page_count", F.lit(0)).alias("page_count"), asked.alias("expected_part_count"), there.alias("present_part_count"), F.greatest(asked - there, F.lit(0)).alias("missing_part_count"),
        "missing_required_count", (size > 0).alias("has_expected_parts"),
    )


def site_documents(documents: DataFrame, detected: DataFrame, parts: DataFrame) -> DataFrame:
    """Documents as they are shown. detected: pdf_path, predicted_part, is_score, quality_band; parts: predicted_part,
    section, part_role (a row each)."""
    meta = detected.select("pdf_path", "predicted_part", "is_score", F.col("quality_band").alias("quality"))
    both = documents.join(meta, "pdf_path", "left").join(parts, "predicted_part", "left")
    read = F.coalesce(field(documents, "ocr_llm_instruments", "array<string>"), F.array().cast("array<string>"))
    instrument = first_truthy(F.col("predicted_part"), F.array_join(read, ", "))
    return both.select(short_id(F.col("pdf_path")).alias("doc_id"), "piece_id", "pdf_path", file_name(F.col("pdf_path")).alias("pdf_filename"), instrument.alias("instrument"), "section", "part_role", yes(F.col("is_score")).alias("is_score"), F.coalesce("page_count", F.lit(0)).alias("page_count"), "quality")




#: What is shown of a page, beside its ids.
SITE_PAGE = (
    "piece_id", "page_num", "thumbnail_path", "render_dpi", "render_width_px", "render_height_px", "orientation", "aspect_ratio", "text_density", "black_white_ratio", "is_blank", "has_staves",
    "staff_line_count", "contrast_std", "blur_variance", "skew_angle_deg", "estimated_dpi", "osd_rotation", "osd_orientation_conf", "osd_script",
)


def site_pages(pages: DataFrame) -> DataFrame:
    """Pages as they are shown: ids, the document's file name and the features there are."""
    from foliant.functions.numbers import page_id

    ids = [page_id(F.col("pdf_path"), F.col("page_num")).alias("page_id"), short_id(F.col("pdf_path")).alias("doc_id"), file_name(F.col("pdf_path")).alias("doc_filename")]
    return pages.select(*ids, *[field(pages, c).alias(c) for c in SITE_PAGE])
