"""Registered queries over names, labels, paths and conditions. Texts are built from columns, so their SQL twins know
the answer from the columns alone."""
from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import numbers as N
from foliant.functions import predicates as P
from foliant.functions import text as X
from foliant.operators import classifier as K
from foliant.operators import plugins as G
from foliant.operators import reconcile as R
from foliant.operators import records as C
from foliant.operators import slots as S
from foliant.plans.registry import query
from foliant.plans.tables import load


def part(spark, sf_dir):
    return load(spark, sf_dir, "part")


@query(
    """SELECT p_partkey, p_name || ' ' || lower(p_type) AS glyphs, p_name || ' ' || p_size || '-' || (p_size + 2) || ' x' AS part_text,
  'b flat ' || p_name || ' ' || p_size AS label, p_name || ' ' || p_size AS cued, replace(p_name, ' ', '_') || '_' || lower(p_type) AS snake FROM part"""
)
def text_normalizers(spark, sf_dir):
    """Glyphs, dashes, signs and cues out of names."""
    c = F.col
    raw = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])
    return part(spark, sf_dir).select(
        "p_partkey",
        X.normalize_name(X.strip_glyphs(raw(c("p_name"), "", c("p_type")))).alias("glyphs"),
        X.normalize_part_text(raw(F.upper("p_name"), "  ", c("p_size"), " – ", c("p_size") + 2, "_X")).alias("part_text"),
        X.normalize_label(raw("B♭ ", c("p_name"), " (", c("p_size"), ")")).alias("label"),
        X.strip_cues(raw(c("p_name"), " horn cue ", c("p_size"))).alias("cued"),
        X.snake_case(raw(c("p_name"), "-", c("p_type"))).alias("snake"),
    )


@query(
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN lpad(p_size::VARCHAR, 4, '0') END AS number, CASE WHEN p_size % 3 = 0 AND p_size % 2 = 0 THEN NULL ELSE p_name END AS title,
  CASE WHEN p_size % 2 = 0 THEN p_size END AS catalog_int FROM part"""
)
def catalog_parse(spark, sf_dir):
    """Number and title of a folder's name; a number alone has no title."""
    name = F.when(F.col("p_size") % 2 == 0, F.concat(F.lpad(F.col("p_size").cast("string"), 4, "0"), F.lit(" - "), F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_name")))).otherwise(F.col("p_name"))
    return part(spark, sf_dir).withColumn("f", name).select("p_partkey", X.catalog_number(F.col("f")).alias("number"), X.catalog_title(F.col("f")).alias("title"), X.catalog_int(F.col("f")).alias("catalog_int"))


@query(
    """SELECT p_partkey, p_name || ' ' || p_size AS segment, p_brand || ' ' || p_name || ' ' || p_size || '.pdf' AS filename, p_brand AS folder,
  CASE WHEN p_size % 7 = 0 THEN 'score' WHEN p_size % 5 = 0 THEN 'solo_alternative' WHEN p_name LIKE 'red %' THEN 'section' ELSE 'section' END AS role, left(sha256(p_brand), 16) AS piece_id FROM part"""
)
def path_parts(spark, sf_dir):
    """Folder, file name, the part's own segment, its role and the piece's id from a path."""
    sub = F.when(F.col("p_size") % 5 == 0, "/Solo Alternatives/").otherwise("\\")
    path = F.concat("p_brand", sub, F.col("p_brand"), F.lit(" "), F.col("p_name"), F.lit(" "), F.col("p_size").cast("string"), F.lit(".pdf"))
    rows = part(spark, sf_dir).withColumn("path", path)
    name, folder = X.file_name(F.col("path")), X.top_folder(F.col("path"))
    segment = X.part_segment(name, folder)
    return rows.select("p_partkey", segment.alias("segment"), name.alias("filename"), folder.alias("folder"), X.part_role(F.col("path"), segment, F.col("p_size") % 7 == 0).alias("role"), N.short_id(folder).alias("piece_id"))


@query(
    """SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 'condensed' WHEN p_name LIKE '%gear%' THEN 'full' END AS score_type,
  CASE WHEN p_size % 3 = 0 THEN 'treble' WHEN p_size % 3 = 1 THEN 'bass' END AS clef FROM part"""
)
def score_marks(spark, sf_dir):
    """Score type and clef by the first keyword, in order, that a text holds."""
    kind = X.first_keyword(F.col("p_name"), {"condensed": ["ring", "short"], "full": ["gear"]})
    mark = F.element_at(F.array(*[F.lit(x) for x in ("(tc)", "(bc)", "")]), F.col("p_size") % 3 + 1)
    clef = X.first_keyword(F.concat("p_name", F.lit(" "), mark), {"treble": ["(tc)", "treble clef"], "bass": ["(bc)", "bass clef"]})
    return part(spark, sf_dir).select("p_partkey", kind.alias("score_type"), clef.alias("clef"))


@query(
    """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'Bb' WHEN 2 THEN 'Eb' WHEN 3 THEN 'C#' WHEN 4 THEN 'Bb' END AS key, CASE WHEN p_size % 6 = 5 THEN 'A' END AS marked FROM part"""
)
def transposition_marks(spark, sf_dir):
    """Keys: "in X", X flat, beside the instrument's name, and by a dictionary's own marker."""
    text = F.element_at(F.array(*[F.lit(x) for x in ("horn in f 2", "clarinet in b flat", "march op 12 eb alto clarinet 1", "trumpet in c sharp", "bb trumpet", "flute 1 (written a)")]), F.col("p_size") % 6 + 1)
    alias = F.when(F.col("p_size") % 6 == 2, "alto clarinet").when(F.col("p_size") % 6 == 4, "trumpet").when(F.col("p_size") % 6 == 5, "flute").otherwise("horn")
    return part(spark, sf_dir).select("p_partkey", X.keyed_transposition(text, alias=alias).alias("key"), X.keyed_transposition(text, {"written a": "A"}).alias("m"), "p_size").select("p_partkey", "key", F.when(F.col("p_size") % 6 == 5, F.col("m")).alias("marked"))


@query(
    """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN '1;2' WHEN 1 THEN '1;2;3;4' WHEN 2 THEN '2;3;4' WHEN 3 THEN '1;2' WHEN 4 THEN '12' ELSE '1;2' END AS chairs,
  CASE p_size % 6 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 12 ELSE 1 END AS first_index FROM part"""
)
def chair_expansion(spark, sf_dir):
    """The chairs beside an instrument's name, lists and ranges, other numbers left alone."""
    text = F.element_at(F.array(*[F.lit(x) for x in ("1st & 2nd oboe", "oboe 1-4", "oboe 2 to 4", "march ist & 2nd oboe", "symphony no 12 oboe", "oboe 1, 2 page 30")]), F.col("p_size") % 6 + 1)
    chairs = X.chair_runs(text, F.lit("oboe"))
    return part(spark, sf_dir).select("p_partkey", F.array_join(chairs.cast("array<string>"), ";").alias("chairs"), X.part_index(text).alias("first_index"))


@query(
    """SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'Full Score' ELSE n || CASE WHEN p_size % 2 = 1 THEN ' in F' ELSE '' END || ' ' || p_size || CASE WHEN p_size % 3 = 0 THEN ' (TC)' WHEN p_size % 3 = 1 THEN ' (BC)' ELSE '' END END || CASE WHEN p_size % 5 = 0 THEN ' - large print' ELSE '' END AS label,
  'Solo ' || n AS solo, CASE WHEN p_name = 'small ring' THEN 'Little Ring' ELSE n END AS shown
FROM (SELECT *, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS n FROM part)"""
)
def part_labels(spark, sf_dir):
    c = F.col
    name = X.display_name(X.snake_case(c("p_name")))
    clef = F.when(c("p_size") % 3 == 0, "treble").when(c("p_size") % 3 == 1, "bass")
    label = X.compose_label(name, F.when(c("p_size") % 2 == 1, "F"), c("p_size"), clef, F.when(c("p_size") % 4 == 0, "Full Score"), F.when(c("p_size") % 5 == 0, "large print"))
    return part(spark, sf_dir).select("p_partkey", label.alias("label"), X.role_label(name, F.lit("solo")).alias("solo"), X.display_name(X.snake_case(c("p_name")), {"small_ring": "Little Ring"}).alias("shown"))


@query(
    """SELECT p_partkey, 'Jane ' || p_name AS arranger, CASE WHEN p_size % 2 = 0 THEN 'John ' || p_brand END AS composer, '(c) ' || (1950 + p_size) || ' ' || p_type || ' Music, All Rights Reserved' AS copyright_line, 1950 + p_size AS copyright_year, p_type || ' Music' AS publisher FROM part"""
)
def identity_lines(spark, sf_dir):
    """Composer, arranger and rights from a first page: an arranger's line names no composer."""
    by = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("by John "), "p_brand", F.lit("\n"))).otherwise("")
    text = F.concat(F.lit("March\nArranged by Jane "), "p_name", F.lit("\n"), by, F.lit("(c) "), (F.col("p_size") + 1950).cast("string"), F.lit(" "), "p_type", F.lit(" Music, All Rights Reserved"))
    return part(spark, sf_dir).select("p_partkey", X.identity(text).alias("x")).select("p_partkey", "x.*")


@query(
    r"""SELECT page_id, regexp_replace(replace(url || '|' || chr(10) || ' x', '|', '\|'), '\s*\n\s*', ' ', 'g') AS cell, regexp_replace(url, '[^\p{L}\p{N}._-]', '_', 'g') AS slug,
  'Find ' || page_id || ' at ' || url || '.' AS prompt, '{"title":"' || page_id || '"}' AS query FROM pages"""
)
def markdown_and_prompts(spark, sf_dir):
    pages = load(spark, sf_dir, "pages", "page_id", "url")
    cell = X.markdown_cell(F.concat("url", F.lit("|\n x")))
    rows = pages.select("page_id", cell.alias("cell"), X.slug(F.col("url")).alias("slug"), X.render_prompt("Find {id} at {url}.", id=F.col("page_id").cast("string"), url=F.col("url")).alias("prompt"), F.col("page_id").cast("string").alias("t"))
    return rows.join(S.prompt_query(rows, "page_id", "t"), "page_id").drop("t")


@query(
    """SELECT o_orderkey, 'sha256:' || sha256('orders/' || o_orderkey || '|' || o_custkey || '|' || o_orderstatus) AS file, 'sha256:' || sha256('{"c0":' || o_orderkey || ',"c1":' || CASE WHEN o_orderstatus = 'F' THEN '"F"' ELSE 'null' END || '}') AS record,
  left(sha256('orders/' || o_orderkey), 16) || '-p' || lpad((o_custkey % 100)::VARCHAR, 4, '0') AS page, sha256(o_custkey || '|' || o_orderstatus) AS cache_key FROM orders"""
)
def fingerprints(spark, sf_dir):
    """Fingerprints of files and records, ids of pages, keys of caches."""
    from foliant.sources.sinks import cache_key

    orders = load(spark, sf_dir, "orders")
    path = F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string"))
    status = F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus"))
    return orders.select("o_orderkey", N.file_fingerprint(path, F.col("o_custkey"), F.col("o_orderstatus")).alias("file"), N.record_fingerprint(F.col("o_orderkey"), status).alias("record"), N.page_id(path, F.col("o_custkey") % 100).alias("page"), cache_key(F.col("o_custkey"), F.col("o_orderstatus")).alias("cache_key"))


@query(
    """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '0-' || lpad(coalesce((p_size % 3)::VARCHAR, '9'), 2, '0') ELSE '1-' || lpad((p_size % 7)::VARCHAR, 3, '0') || '-' || lpad((p_size % 4)::VARCHAR, 2, '0') || '-' || p_size % 2 END AS part_key,
  CASE WHEN p_size % 2 = 0 THEN lpad(p_size::VARCHAR, 4, '0') ELSE '~' END AS catalog_key, p_name AS folder_key FROM part"""
)
def sort_keys(spark, sf_dir):
    """Keys that parts and scores sort by, and pieces: by catalog number, those without last, then by folder."""
    c = F.col
    key = N.part_sort_key(c("p_size") % 7, c("p_size") % 4, c("p_size") % 2, c("p_size") % 5 == 0, c("p_size") % 3)
    catalog = F.when(c("p_size") % 2 == 0, F.lpad(c("p_size").cast("string"), 4, "0")).otherwise("")
    by = N.piece_order(catalog, c("p_name"))
    return part(spark, sf_dir).select("p_partkey", key.alias("part_key"), by[0].alias("catalog_key"), by[1].alias("folder_key"))


@query(
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_partkey % 100) / 100.0 AS x, (l_suppkey % 50) / 50.0 AS y, l_returnflag || l_partkey AS t FROM lineitem)
SELECT l_orderkey, coalesce(string_agg(t, ' ' ORDER BY y, x, t) FILTER (y <= 0.22 AND x < 0.38), '') AS top_left, coalesce(string_agg(t, ' ' ORDER BY y, x, t) FILTER (y <= 0.22 AND x BETWEEN 0.38 AND 0.62), '') AS top_center,
  coalesce(string_agg(t, ' ' ORDER BY y, x, t) FILTER (y <= 0.22 AND x > 0.62), '') AS top_right, coalesce(string_agg(t, ' ' ORDER BY y, x, t) FILTER (y >= 0.82), '') AS bottom FROM s GROUP BY l_orderkey"""
)
def zone_buckets(spark, sf_dir):
    """Texts of a page's corners and foot by the places of its spans."""
    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    span = F.struct((F.col("l_partkey") % 100 / F.lit(100.0)).alias("x"), (F.col("l_suppkey") % 50 / F.lit(50.0)).alias("y"), F.concat("l_returnflag", F.col("l_partkey").cast("string")).alias("text"))
    return items.groupBy("l_orderkey").agg(F.collect_list(span).alias("spans")).select("l_orderkey", C.zones(F.col("spans")).alias("z")).select("l_orderkey", "z.*")


@query(
    """SELECT p_partkey, array_to_string(list_distinct(list_filter(string_split(p_name, ' '), lambda w: w IN ('ring', 'gear'))), ';') AS known, CASE WHEN p_size % 3 = 0 THEN 'Bells;Marimba' WHEN p_size % 3 = 1 THEN 'Xylophone' ELSE '' END AS mallets FROM part"""
)
def instrument_names(spark, sf_dir):
    """Names that a dictionary knows, and the instruments of a book of mallets."""
    known = G.known_names(F.split("p_name", " "), ["ring", "gear"])
    text = F.element_at(F.array(F.lit("marimba & orchestra bells"), F.lit("xylophone 2"), F.lit("snare drum")), F.col("p_size") % 3 + 1)
    return part(spark, sf_dir).select("p_partkey", F.array_join(known, ";").alias("known"), F.array_join(K.sub_instruments(text), ";").alias("mallets"))


_SPANS = [("bass_clarinet", "bass clarinet"), ("clarinet", "clarinet"), ("bass", "bass"), ("oboe", "oboe")]


@query(
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'oboe;bass_clarinet' WHEN 1 THEN 'clarinet;bass' WHEN 2 THEN 'bass_clarinet;clarinet' ELSE '' END AS found FROM part"""
)
def spans_by_length(spark, sf_dir):
    """All names in a text, longer ones first to take their place, in order of place."""
    text = F.element_at(F.array(*[F.lit(x) for x in ("oboe and bass clarinet", "clarinet, bass", "bass clarinet doubling clarinet", "clarinets")]), F.col("p_size") % 4 + 1)
    return part(spark, sf_dir).select("p_partkey", F.array_join(R.all_matches(text, _SPANS), ";").alias("found"))


@query(
    """SELECT event_id, array_to_string(list_filter([CASE WHEN raster AND dpi < 200 THEN 'low_resolution' END, CASE WHEN abs(skew) > 3 THEN 'excessive_skew' END, CASE WHEN contrast < 22 THEN 'low_contrast' END, CASE WHEN blur < 90 THEN 'heavy_blur' END,
  CASE WHEN blank THEN 'blank_page' END, CASE WHEN density >= 0.55 AND words <= 3 THEN 'noise_page' END, CASE WHEN NOT blank AND words > 0 AND confidence < 0.30 THEN 'ocr_illegible' END], lambda x: x IS NOT NULL), ';') AS issues,
  event_type = 'error' OR NOT text_there AS needs_ocr, skew BETWEEN 1 AND 45 OR skew BETWEEN -45 AND -1 AS notable_skew, event_type = 'error' OR user_id % 3 = 0 AS scanned,
  CASE WHEN event_type <> 'purchase' THEN density < 0.004 AND NOT text_there AND event_type <> 'error' END AS blank_page
FROM (SELECT *, density <= 0.004 AND words = 0 AS blank FROM (SELECT *, event_type = 'error' AS raster, value * 10 AS dpi, ((event_id % 90 + 45) % 90 - 45)::DOUBLE AS skew, value AS contrast, value * 4 AS blur, (event_id % 250) / 250.0 AS density, (event_id % 5)::INT AS words, (user_id % 10) / 10.0 AS confidence, event_id % 5 > 0 AS text_there FROM events))"""
)
def page_rules(spark, sf_dir):
    """All seven page rules, and the conditions for OCR, skew, scans and blank pages."""
    c = F.col
    text = F.when(c("event_id") % 5 > 0, "words").otherwise("")
    pages = load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", (c("event_type") == "error").alias("is_image_based"), (c("value") * 10).alias("estimated_dpi"), F.lit(None).cast("double").alias("render_width_px"), F.lit(None).cast("double").alias("render_height_px"),
        (c("event_id") % 90).cast("double").alias("skew_angle_deg"), c("value").alias("contrast_std"), (c("value") * 4).alias("blur_variance"), (c("event_id") % 250 / F.lit(250.0)).alias("text_density"), (c("event_id") % 5).cast("int").alias("word_count"),
        F.lit(False).alias("is_blank"), (c("user_id") % 10 / F.lit(10.0)).alias("ocr_confidence"), (c("event_id") % 5).cast("int").alias("ocr_word_count"), F.lit("ocr").alias("text_source"), F.lit(True).alias("ocr_applied"), F.lit(1.0).alias("alnum_ratio"), text.alias("text"),
    )
    status = F.when(c("event_type") == "purchase", "error").otherwise("success")
    return pages.select(
        "event_id", F.array_join(P.page_issues(), ";").alias("issues"), P.needs_ocr(c("text"), c("is_image_based")).alias("needs_ocr"), N.notable_skew(N.fold_skew(c("skew_angle_deg"))).alias("notable_skew"),
        P.scanned(F.when(c("is_image_based"), 1).otherwise(0), F.when(c("user_id") % 3 == 0, 1).otherwise(0)).alias("scanned"), P.blank_page(status, c("text_density"), c("text"), c("is_image_based")).alias("blank_page"),
    )


@query(
    """SELECT 'readable' AS kind, count(*) AS n FROM customer WHERE c_acctbal > 0 AND c_nationkey % 5 > 0 AND c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT 'skipped', count(*) FILTER (NOT (c_acctbal > 0 AND c_nationkey % 5 > 0 AND c_mktsegment <> 'HOUSEHOLD')) FROM customer"""
)
def readable_items(spark, sf_dir):
    """Documents of an inventory that can be read, and how many can't."""
    from foliant.sources.readers import readable_items as pick

    c = F.col
    flags = F.struct((c("c_nationkey") % 5 == 0).alias("is_zero_page"), F.lit(False).alias("is_malformed"))
    rows = load(spark, sf_dir, "customer").select(
        c("c_name").alias("pdf_path"), F.lit("p").alias("piece_id"), F.lit("f").alias("piece_folder"), c("c_name").alias("pdf_filename"), F.lit("x").alias("file_fingerprint"), F.lit(1).alias("page_count"),
        (c("c_acctbal") > 0).alias("pdf_readable"), F.lit(False).alias("is_encrypted"), F.when(c("c_mktsegment") == "HOUSEHOLD", "error").otherwise("success").alias("processing_status"), flags.alias("health_flags"),
    )
    items, skipped = pick(rows)
    return items.agg(F.count("*").alias("n")).select(F.lit("readable").alias("kind"), "n").union(skipped.select(F.lit("skipped"), F.col("skipped")))


@query(
    """SELECT p_partkey, p_type <> 'PROMO' AS usable, p_type = 'ECONOMY' OR p_name LIKE '%ring%' AS score_slot, p_name LIKE '%gear' AND p_size % 2 = 0 AS umbrella,
  CASE WHEN p_size % 2 = 0 THEN p_size % 4 < 2 ELSE p_size % 4 = 3 END AS role_fits, p_size % 3 <> 0 OR p_size % 5 < 3 AS key_fits, p_size % 3 = 1 AS reliable FROM part"""
)
def slot_predicates(spark, sf_dir):
    """Conditions of slots: usable scores, score slots, bare family names, roles, keys and reliable labels."""
    c = F.col
    role = F.element_at(F.array(*[F.lit(x) for x in ("solo", "section", "section", "section")]), F.when(c("p_size") % 2 == 0, F.when(c("p_size") % 4 < 2, 1).otherwise(2)).otherwise(F.when(c("p_size") % 4 == 3, 2).otherwise(1)).cast("int"))
    slot_role = F.when(c("p_size") % 2 == 0, "solo").otherwise("section")
    held_key, slot_key = F.when(c("p_size") % 3 == 0, "bb"), F.when(c("p_size") % 5 < 3, " Bb ").otherwise("F")
    label = F.element_at(F.array(F.lit("arranged by a tuba player"), F.lit("tuba 1"), F.lit("to tba tuba")), c("p_size") % 3 + 1)
    canonical = F.when(c("p_name").like("%ring%"), "full score").otherwise("tuba")
    last = F.element_at(F.split("p_name", " "), -1)
    return part(spark, sf_dir).select(
        "p_partkey", P.score_type_usable(c("p_type"), ["promo"]).alias("usable"), P.score_slot(canonical, F.when(c("p_type") == "ECONOMY", "Score")).alias("score_slot"),
        P.generic_umbrella(last, F.when(c("p_size") % 2 == 1, c("p_size")), ["gear"]).alias("umbrella"), P.role_compatible(slot_role, role).alias("role_fits"), P.transposition_compatible(slot_key, held_key).alias("key_fits"), X.reliable_label(label, F.lit("tuba")).alias("reliable"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber IN (2, 3) AND l_discount >= 0.05 AS vision, l_linenumber IN (2, 3) AS strict_subset, l_returnflag = 'R' AND l_linestatus = 'F' AS veto,
  l_linenumber >= 2 AND l_tax >= 0.04 AS text_usable, l_linenumber > 1 AND l_discount >= 0.05 AS matched, l_returnflag = 'A' AND l_linestatus = 'O' AS unchanged FROM lineitem"""
)
def model_choice(spark, sf_dir):
    """Whether what was seen wins over what was read, a hit of another section falls, a lookup is good enough, and an
    earlier record still holds."""
    c = F.col
    read = F.slice(F.array(*[F.lit(x) for x in "abcdefg"]), 1, c("l_linenumber"))
    vision = F.array(F.lit("a"))
    subset = (F.size(F.array_except(vision, read)) == 0) & (F.size(read) > F.size(vision)) & (F.size(read) <= 3)
    text = F.repeat(F.lit("x"), c("l_linenumber") * 100)
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", P.prefer_vision(vision, read, c("l_discount"), F.lit(0.05)).alias("vision"), subset.alias("strict_subset"),
        P.other_section(c("l_linestatus"), F.when(c("l_returnflag") == "R", "O"), F.lit(True)).alias("veto"), P.lookup_usable(text, c("l_tax") * 10).alias("text_usable"),
        P.lookup_matched(F.lit(True), F.when(c("l_linenumber") > 1, read), c("l_discount"), 0.05).alias("matched"), P.unchanged(c("l_returnflag"), F.lit("A"), c("l_linestatus"), F.lit("O")).alias("unchanged"),
    )
