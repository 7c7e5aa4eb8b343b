"""Filter conditions, each a nullable boolean column: a null metric never fires."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.numbers import fold_skew
from foliant.functions.text import first_truthy, strip_glyphs

#: The limits of the page rules.
LIMITS = {
    "min_dpi": 200,
    "min_width": 1000,
    "min_height": 1400,
    "max_skew": 3.0,
    "min_contrast": 22.0,
    "min_blur": 90.0,
    "min_ocr_confidence": 0.30,
    "min_alnum": 0.55,
    "blank_density": 0.004,
    "noise_density": 0.55,
    "noise_words": 3,
}
#: What an issue on every page takes from a document's score of 100.
PENALTIES = {
    "low_resolution": 25,
    "excessive_skew": 5,
    "low_contrast": 20,
    "heavy_blur": 30,
    "ocr_illegible": 20,
    "blank_page": 35,
    "noise_page": 35,
}


def yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def readable_pdf() -> Column:
    c = F.col
    flags = ~yes(c("health_flags.is_zero_page")) & ~yes(c("health_flags.is_malformed"))
    return yes(c("pdf_readable")) & ~yes(c("is_encrypted")) & yes(c("page_count") >= 1) & ~yes(c("processing_status") == "error") & flags


def readable_text(text: Column) -> Column:
    return yes(strip_glyphs(text).rlike(r"[\p{L}\p{N}]"))


def needs_ocr(text: Column, image_based: Column) -> Column:
    return ~readable_text(text) | yes(image_based)


def scanned(image_pages: Column, ocr_pages: Column) -> Column:
    return yes(image_pages > 0) | yes(ocr_pages > 0)


def blank_page(status: Column, density: Column, text: Column, image_based: Column, most: float = LIMITS["blank_density"]) -> Column:
    """Null on a page that failed to render."""
    return F.when(status != "error", (density < most) & ~readable_text(text) & ~yes(image_based))


def page_issues(limits: dict | None = None) -> Column:
    """The issues of a page in rule order: an array of codes over the joined page and text columns."""
    v, c = {**LIMITS, **(limits or {})}, F.col
    word_count = F.coalesce(c("word_count"), F.lit(0))
    small = F.when(c("estimated_dpi").isNotNull(), c("estimated_dpi") < v["min_dpi"]).otherwise((c("render_width_px") < v["min_width"]) | (c("render_height_px") < v["min_height"]))
    both = c("render_width_px").isNotNull() & c("render_height_px").isNotNull()
    low = yes(c("is_image_based")) & (c("estimated_dpi").isNotNull() | both) & small
    blank = yes(c("is_blank")) | yes((c("text_density") <= v["blank_density"]) & (word_count == 0))
    noise = (c("text_density") >= v["noise_density"]) & (word_count <= v["noise_words"])
    heard = c("ocr_confidence").isNotNull() & yes(c("ocr_word_count") > 0)
    from_ocr = yes(c("text_source") == "ocr") | yes(c("ocr_applied"))
    proxy = from_ocr & (word_count > 0) & (c("alnum_ratio") < v["min_alnum"])
    illegible = ~blank & F.when(heard, c("ocr_confidence") < v["min_ocr_confidence"]).otherwise(proxy)
    rules = {
        "low_resolution": low,
        "excessive_skew": F.abs(fold_skew(c("skew_angle_deg"))) > v["max_skew"],
        "low_contrast": c("contrast_std") < v["min_contrast"],
        "heavy_blur": c("blur_variance") < v["min_blur"],
        "blank_page": blank,
        "noise_page": noise,
        "ocr_illegible": illegible,
    }
    return F.array_compact(F.array(*[F.when(yes(on), code) for code, on in rules.items()]))


def score_type_usable(score_type: Column, excluded: list[str]) -> Column:
    return ~F.lower(F.coalesce(score_type, F.lit("full"))).isin(excluded)


def score_slot(canonical: Column, section: Column) -> Column:
    return yes(F.contains(F.lower(canonical), F.lit("score"))) | yes(F.lower(section) == "score")


def generic_umbrella(label: Column, index: Column, names: list[str]) -> Column:
    """A bare family name without a chair."""
    return index.isNull() & yes(F.lower(F.trim(label)).isin(names))


def role_compatible(slot_role: Column, role: Column) -> Column:
    r = F.coalesce(role, F.lit("section"))
    return F.when(slot_role == "solo", r.isin("solo", "solo_alternative")).otherwise(r == "section")


def transposition_compatible(slot_key: Column, key: Column) -> Column:
    return first_truthy(key).isNull() | first_truthy(slot_key).isNull() | (F.lower(F.trim(slot_key)) == F.lower(F.trim(key)))


def prefer_vision(vision: Column, read: Column, vision_confidence: Column, read_confidence: Column) -> Column:
    """Vision names a strict, not much larger part of what was read, and no less surely."""
    subset = (F.size(F.array_except(vision, read)) == 0) & (F.size(read) > F.size(vision)) & (F.size(vision) > 0)
    return yes(subset & (F.size(read) <= 3) & (vision_confidence >= read_confidence))


def other_section(section: Column, base_section: Column, from_full_text: Column) -> Column:
    """A full-text hit in another section than the file name's: to be dropped."""
    return yes(from_full_text & base_section.isNotNull() & (section != base_section))


def lookup_usable(text: Column, confidence: Column, min_chars: int = 200, min_confidence: float = 0.4) -> Column:
    return yes(F.length(F.trim(text)) >= min_chars) & yes(F.coalesce(confidence, F.lit(1.0)) >= min_confidence)


def lookup_matched(found: Column, parts: Column, confidence: Column, least: float = 0.5) -> Column:
    return yes(found) & (F.coalesce(F.size(parts), F.lit(0)) > 0) & yes(confidence >= least)


def single_piece_decision(number: Column, wanted: int | None, prior_present: Column) -> Column:
    """normal when no piece is singled out; else process for that piece and reuse, or process, for others."""
    if wanted is None:
        return F.lit("normal")
    return F.when(number == wanted, "process").when(prior_present, "reuse").otherwise("process")


def unchanged(fingerprint: Column, prior: Column, version: Column, prior_version: Column) -> Column:
    return yes((fingerprint == prior) & (version == prior_version))


def declared(df: DataFrame, conditions: dict[str, list]) -> DataFrame:
    """Rows whose fields are in the given lists, field by field."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isin(v) for k, v in conditions.items()], F.lit(True)))


def any_column_contains(df: DataFrame, needle: str, columns: list[str] | None = None) -> DataFrame:
    """Case-insensitive substring over the given columns, or all of them."""
    low = F.lit(needle.lower())
    tests = [yes(F.contains(F.lower(F.col(c).cast("string")), low)) for c in columns or df.columns]
    return df.where(reduce(lambda a, b: a | b, tests))
