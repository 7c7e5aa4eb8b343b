"""Scalar functions and predicates on literals."""
import pytest
from pyspark.sql import functions as F

from foliant.functions import numbers as N
from foliant.functions import predicates as P
from foliant.functions import text as X


def one(spark, column, **values):
    """The column's value over one row of string, int, float or None values."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("make", "given", "want"),
    [
        (X.normalize_name, "Bass-Clarinet_in  Bb ", "bass clarinet in bb"),
        (X.normalize_part_text, "Horn 1 – 2", "horn 1-2"),
        (X.normalize_part_text, "Contra-Bass_3", "contra bass 3"),
        (X.normalize_label, "B♭ Clarinet (1)", "b flat clarinet 1"),
        (X.snake_case, "English Horn", "english_horn"),
        (X.strip_cues, "clarinet 2 oboe cue solo", "clarinet 2 solo"),
        (X.strip_glyphs, "a\ue000\ue001b", "a b"),
        (X.catalog_number, "0123 - March", "0123"),
        (X.catalog_number, "March 12", None),
        (X.catalog_title, "0123 - March", "March"),
        (X.catalog_title, "March 12", "March 12"),
        (X.catalog_int, "00042_x", 42),
        (X.catalog_int, "x", None),
        (X.file_name, "a\\b/c.pdf", "c.pdf"),
        (X.top_folder, "Piece/sub/x.pdf", "Piece"),
        (X.top_folder, "root.pdf", "root"),
        (X.part_index, "clarinet 2nd in b", 2),
        (X.part_index, "clarinet", None),
        (X.part_index, "op 1234", None),
        (X.chair_runs, "horn 1-3", [1, 2, 3]),
        (X.chair_runs, "trumpet ist & 2nd", [1, 2]),
        (X.chair_runs, "2 to 4 flutes", [2, 3, 4]),
        (X.chair_runs, "flutes 2 to 4", [2, 3, 4]),
        (X.chair_runs, "1, 2 & 4", [1, 2, 4]),
        (X.part_index, "f1 horn 2", 2),
        (X.strip_cues, "oboe cue", ""),
        (X.strip_cues, "cue 2 flute", "cue 2 flute"),
        (X.split_combined, "flute 1 & piccolo", ["flute 1", "piccolo"]),
        (X.split_combined, "oboe / english horn", ["oboe", "english horn"]),
        (X.split_combined, "clarinet w/ bass clarinet dbl. sax", ["clarinet", "bass clarinet", "sax"]),
        (X.split_combined, "e.h. 1-2 and sandman doubling", ["e.h. 1-2", "sandman"]),
        (X.split_combined, "& /", []),
        (X.split_combined, "", []),
        (X.split_combined, None, None),
        (X.chair_runs, "horn 1 & & 2", [2]),
        (X.chair_runs, "1 2 horn", [1]),
        (X.chair_runs, "horn 3-1", [3, 1]),
        (X.chair_runs, "horn 1, 1-2", [1, 2]),
        (X.chair_runs, "- 2", [2]),
        (X.chair_runs, "opus 123", []),
        (X.chair_runs, "", []),
        (X.chair_runs, None, []),
        (lambda c: X.reliable_label(c, F.lit("trombone")), "trombone arranged by x", True),
        (lambda c: X.reliable_label(c, F.lit("trombone")), "trombone arranged by a trombone player", False),
        (lambda c: X.reliable_label(c, F.lit("trombone")), "arranged by x", False),
        (lambda c: X.reliable_label(c, F.lit("trombone")), "Trombone arr. smith", True),
        (lambda c: X.reliable_label(c, F.lit("trombone")), "trombone arr.smith", False),
        (lambda c: X.reliable_label(c, F.lit("trombone")), "to  voice trombone", False),
        (lambda c: X.reliable_label(c, F.lit("trombone")), "to voices, trombone", True),
        (lambda c: X.reliable_label(c, F.lit("bass_trombone")), "1st bass trombone, copyright 1990", False),
        (lambda c: X.reliable_label(c, F.lit("bass_trombone")), "(bass trombone)", True),
        (lambda c: X.reliable_label(c, F.lit("trombone")), "trombones", False),
        (lambda c: X.reliable_label(c, F.lit("")), "trombone", False),
        (X.keyed_transposition, "horn in f 2", "F"),
        (X.keyed_transposition, "clarinet in b flat", "Bb"),
        (X.keyed_transposition, "clarinet in eb", "Eb"),
        (X.keyed_transposition, "in memoriam", None),
        (X.display_name, "bass_clarinet", "Bass Clarinet"),
        (X.word_count, "  a  b\nc ", 3),
        (X.word_count, None, 0),
        (X.alnum_ratio, "ab--", 0.5),
        (X.alnum_ratio, " ", None),
        (X.slug, "a b/c", "a_b_c"),
        (X.markdown_cell, "a|b\nc", "a\\|b c"),
        (N.untagged, "sha256:ab", "ab"),
    ],
)
def test_text(spark, make, given, want):
    assert one(spark, make(F.lit(given).cast("string"))) == want


def test_segments_and_roles(spark):
    seg = lambda f, d: one(spark, X.part_segment(F.lit(f), F.lit(d)))
    assert seg("0123 March - Flute 1.pdf", "0123 March") == "Flute 1"
    assert seg("0123 - Flute.pdf", "Other") == "Flute"
    role = lambda p, s, sc=False: one(spark, X.part_role(F.lit(p), F.lit(s), F.lit(sc)))
    assert [role("a/b.pdf", "Flute"), role("a/b.pdf", "Solo Cornet"), role("a/Solo Alternatives/b.pdf", "x"), role("a", "b", True)] == ["section", "solo", "solo_alternative", "score"]
    assert one(spark, X.role_label(F.lit("Cornet"), F.lit("solo"))) == "Solo Cornet"
    assert one(spark, X.compose_label(F.lit("Horn"), F.lit("F"), F.lit(2), F.lit("treble"))) == "Horn in F 2 (TC)"


def test_words_at_borders(spark):
    hit = lambda t, w: one(spark, X.contains_word(F.lit(t), F.lit(w)))
    assert hit("alto sax 1", "alto sax") and not hit("contralto sax", "alto sax") and not hit("alto  sax", "alto sax")
    assert hit("b.c. tuba", "b.c.") and not hit("altos", "alto")


def test_identity(spark):
    got = one(spark, X.identity(F.lit("March\nArranged by J. Doe\nby A. Smith\nCopyright 1999 by Some House. All rights reserved.")))
    assert (got.arranger, got.composer, got.copyright_year) == ("J. Doe", "J. Doe" if got.composer == "J. Doe" else "A. Smith", 1999)
    assert "Some House" in got.publisher
    assert one(spark, X.identity(F.lit(None).cast("string"))).copyright_year is None


def test_sentinel_json(spark):
    f = lambda t: one(spark, X.sentinel_json(F.lit(t), "<<", ">>"))
    assert f('x << {"a": 1,} >> {"b": 2}') == '{"a": 1}'
    assert f('pre {"a": [1, 2,]} post') == '{"a": [1, 2]}'
    assert f("nothing") is None


def test_numbers(spark):
    assert [one(spark, N.fold_skew(F.lit(v))) for v in (0.0, 46.0, 89.0, -46.0, 180.0)] == [0.0, -44.0, -1.0, 44.0, 0.0]
    assert [one(spark, N.confidence_tier(F.lit(v))) for v in (0.9, 0.75, 0.1, 0.0)] == ["high", "medium", "low", "none"]
    assert one(spark, N.percent(F.lit(1), F.lit(0))) == 0.0 and one(spark, N.percent(F.lit(1), F.lit(4))) == 25.0
    tier = lambda s, m, sc=False: one(spark, N.completeness_tier(F.lit(s), F.lit(m), F.lit(sc)))
    assert [tier(1.0, 0), tier(1.0, 0, True), tier(0.85, 2), tier(0.5, 3), tier(0.4, 3)] == ["complete", "near_complete", "near_complete", "incomplete", "severely_incomplete"]
    null = F.lit(None).cast("int")
    assert one(spark, N.part_sort_key(F.lit(7), F.lit(2), null, F.lit(False), null)) == "1-007-02-0"
    assert one(spark, N.part_sort_key(null, null, null, F.lit(True), F.lit(1))) == "0-01"
    a = one(spark, N.record_fingerprint(F.lit("a"), F.lit(None).cast("string")))
    assert a != one(spark, N.record_fingerprint(F.lit("a"), F.lit("")))


PAGE = {
    "is_image_based": False, "estimated_dpi": None, "render_width_px": None, "render_height_px": None, "skew_angle_deg": None, "contrast_std": None,
    "blur_variance": None, "text_density": None, "is_blank": None, "word_count": 50, "ocr_confidence": None, "ocr_word_count": 0, "text_source": "embedded", "ocr_applied": False, "alnum_ratio": None,
}
KIND = "is_image_based boolean, estimated_dpi double, render_width_px double, render_height_px double, skew_angle_deg double, contrast_std double, blur_variance double, text_density double, is_blank boolean, word_count int, ocr_confidence double, ocr_word_count int, text_source string, ocr_applied boolean, alnum_ratio double"


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({}, []),
        ({"estimated_dpi": 100.0}, []),
        ({"estimated_dpi": 100.0, "is_image_based": True}, ["low_resolution"]),
        ({"estimated_dpi": 300.0, "is_image_based": True, "render_width_px": 10.0, "render_height_px": 10.0}, []),
        ({"is_image_based": True, "render_width_px": 900.0, "render_height_px": 2000.0}, ["low_resolution"]),
        ({"is_image_based": True, "render_width_px": 900.0}, []),
        ({"skew_angle_deg": 88.0}, []),
        ({"skew_angle_deg": 86.0}, ["excessive_skew"]),
        ({"contrast_std": 21.9, "blur_variance": 89.9}, ["low_contrast", "heavy_blur"]),
        ({"text_density": 0.004, "word_count": 0}, ["blank_page"]),
        ({"is_blank": True, "ocr_confidence": 0.1, "ocr_word_count": 4}, ["blank_page"]),
        ({"text_density": 0.6, "word_count": 3}, ["noise_page"]),
        ({"ocr_confidence": 0.1, "ocr_word_count": 4}, ["ocr_illegible"]),
        ({"ocr_confidence": 0.9, "ocr_word_count": 4, "alnum_ratio": 0.1, "text_source": "ocr"}, []),
        ({"alnum_ratio": 0.1}, []),
        ({"alnum_ratio": 0.1, "text_source": "ocr"}, ["ocr_illegible"]),
    ],
)
def test_page_issues(spark, change, want):
    df = spark.createDataFrame([{**PAGE, **change}], KIND)
    assert df.select(P.page_issues().alias("i")).first().i == want


def test_compatibility(spark):
    role = lambda a, b: one(spark, P.role_compatible(F.lit(a), F.lit(b)))
    assert role("solo", "solo_alternative") and role("section", None) and not role("section", "solo")
    key = lambda a, b: one(spark, P.transposition_compatible(F.lit(a), F.lit(b)))
    assert key("F", None) and key(None, "Eb") and key("eb", "Eb") and not key("F", "Eb")
    pick = lambda v, r, a, b: one(spark, P.prefer_vision(F.array(*map(F.lit, v)), F.array(*map(F.lit, r)), F.lit(a), F.lit(b)))
    assert pick(["a"], ["a", "b"], 0.9, 0.8) and not pick(["a"], ["a"], 0.9, 0.8) and not pick(["a"], ["a", "b"], 0.5, 0.8)


def test_scoping(spark):
    d = lambda n, w, p: one(spark, P.single_piece_decision(F.lit(n), w, F.lit(p)))
    assert [d(1, None, True), d(1, 1, True), d(2, 1, True), d(2, 1, False)] == ["normal", "process", "reuse", "process"]
