"""Hashes, ids, tiers, angles and shares as column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.text import blank_to_null, slashes

#: Tiers of confidence.
HIGH_CONFIDENCE, LOW_CONFIDENCE = 0.90, 0.75
#: Shares of required parts that make a piece nearly complete, or incomplete.
NEAR_COMPLETE, INCOMPLETE = 0.85, 0.5


def sha256_tagged(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def untagged(c: Column) -> Column:
    return F.element_at(F.split(c, ":"), -1)


def short_id(c: Column) -> Column:
    return F.substring(F.sha2(slashes(c), 256), 1, 16)


def page_id(path: Column, page: Column) -> Column:
    return F.concat(short_id(path), F.lit("-p"), F.lpad(page.cast("string"), 4, "0"))


def file_fingerprint(path: Column, size: Column, modified: Column) -> Column:
    return sha256_tagged(F.concat_ws("|", path, size.cast("string"), modified.cast("string")))


def record_fingerprint(*cs: Column) -> Column:
    """A hash of all parts in order, nulls told from empty strings."""
    return sha256_tagged(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cs)]), {"ignoreNullFields": "false"}))


def piece_fingerprint(fingerprints: Column) -> Column:
    """A hash of an array of fingerprints that doesn't depend on their order."""
    return sha256_tagged(F.array_join(F.array_sort(fingerprints), "|"))


def config_fingerprint(settings: dict) -> str:
    """A hash of settings that doesn't depend on the order of their keys."""
    import hashlib
    import json

    return "sha256:" + hashlib.sha256(json.dumps(settings, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def confidence_tier(c: Column) -> Column:
    return F.when(c >= HIGH_CONFIDENCE, "high").when(c >= LOW_CONFIDENCE, "medium").when(c > 0, "low").otherwise("none")


def completeness_tier(score: Column, missing: Column, score_missing: Column) -> Column:
    done = (missing == 0) & ~score_missing
    return F.when(done, "complete").when(score >= NEAR_COMPLETE, "near_complete").when(score >= INCOMPLETE, "incomplete").otherwise("severely_incomplete")


def fold_skew(angle: Column) -> Column:
    """An angle as its distance from the nearest right angle, -45 to 45."""
    return F.when(angle.isNotNull(), angle + 45 - F.floor((angle + 45) / 90) * 90 - 45)


def notable_skew(angle: Column) -> Column:
    return F.abs(angle).between(1, 45)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(100 * part / whole)


def to_pct(c: Column, places: int = 0) -> Column:
    return F.round(c * 100, places)


def part_sort_key(rank: Column, index: Column, clef_rank: Column, is_score: Column, score_rank: Column) -> Column:
    part = F.format_string("1-%03d-%02d-%d", F.coalesce(rank, F.lit(999)), F.coalesce(index, F.lit(0)), F.coalesce(clef_rank, F.lit(0)))
    return F.when(is_score, F.format_string("0-%02d", F.coalesce(score_rank, F.lit(9)))).otherwise(part)


def piece_order(catalog: Column, folder: Column) -> list[Column]:
    """Sort keys: by catalog text, pieces without one last, then by folder."""
    return [F.coalesce(blank_to_null(catalog), F.lit("~")), F.coalesce(folder, F.lit(""))]


def utc_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_id(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
