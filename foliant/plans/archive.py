"""Registered queries over whole records: inventories, page texts and features, documents, pieces, queues and what is
shown of them. Customers are pieces, orders their documents, line items pages or parts."""
from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import aggregates as A
from foliant.operators import builders as B
from foliant.operators import plugins as G
from foliant.operators import records as C
from foliant.operators import slots as S
from foliant.operators.ranking import with_rank
from foliant.plans.registry import query
from foliant.plans.tables import load

VERSION = "1.0"


@query(
    """SELECT s_suppkey, '1.0' AS record_version, 'success' AS processing_status, 4 AS added, left(sha256('NATION_' || s_nationkey), 16) AS piece_id, 'sha256:' || sha256('NATION_' || s_nationkey) AS piece_folder_hash,
  s_name || '.pdf' AS pdf_filename, CASE WHEN s_suppkey % 5 = 0 THEN -1 ELSE s_suppkey END AS file_size_bytes, CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 THEN -1 ELSE s_suppkey % 11 END::INT AS page_count,
  s_suppkey % 5 > 0 AND s_suppkey % 7 > 0 AND s_suppkey % 11 > 0 AS pdf_readable, CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN s_suppkey % 7 = 0 THEN 'bad' WHEN s_suppkey % 5 = 0 THEN 'missing' ELSE '' END AS warnings,
  'sha256:' || sha256('NATION_' || s_nationkey || '/' || s_name || '.pdf' || CASE WHEN s_suppkey % 5 = 0 THEN '|missing' ELSE '|' || s_suppkey || '|2024-01-02 03:04:05' END) AS file_fingerprint, '2024-01-02T03:04:05Z' AS modified_timestamp, 18 AS columns FROM supplier"""
)
def inventory_records(spark, sf_dir):
    """The inventory's 18 columns, with missing files and failed probes as error rows."""
    c = F.col
    key = c("s_suppkey")
    fault = F.when(key % 7 == 0, "bad")
    health = F.struct((key % 11).cast("int").alias("page_count"), (key % 11 > 0).alias("pdf_readable"), F.lit(False).alias("is_encrypted"), F.lit(False).alias("is_zero_page"), F.lit(False).alias("is_malformed"), fault.alias("error_message"))
    folder = F.concat(F.lit("NATION_"), c("s_nationkey").cast("string"))
    files = load(spark, sf_dir, "supplier").select("s_suppkey", folder.alias("piece_folder"), F.concat(folder, F.lit("/"), "s_name", F.lit(".pdf")).alias("pdf_path"), F.when(key % 5 > 0, key).alias("file_size_bytes"), F.lit("2024-01-02 03:04:05").cast("timestamp").alias("modified"), health.alias("health"))
    records = B.inventory_record(files, VERSION)
    env = C.envelope(files, VERSION).select("pdf_path", "record_version", "processing_status", F.lit(len(C.envelope(files, VERSION).columns) - len(files.columns)).alias("added"))
    rows = records.drop("record_version").withColumnRenamed("processing_status", "status").join(files.select("s_suppkey", "pdf_path"), "pdf_path").join(env, "pdf_path")
    kept = ("s_suppkey", "record_version", "processing_status", "added", "piece_id", "piece_folder_hash", "pdf_filename", "file_size_bytes", "page_count", "pdf_readable", "status")
    return rows.select(*kept, F.array_join("health_flags.warnings", ";").alias("warnings"), "file_fingerprint", "modified_timestamp", F.lit(len(records.columns)).alias("columns"))


@query(
    r"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS e, CASE WHEN doc_id % 2 = 0 THEN 'ocr words' END AS o FROM documents)
SELECT doc_id, doc_id::BIGINT - 1 AS page_index_zero, length(e)::INT AS embedded_text_length, doc_id % 3 > 0 AND regexp_matches(e, '[\p{L}\p{N}]') AS text_is_searchable, doc_id % 2 = 0 AS ocr_applied,
  CASE WHEN doc_id % 3 > 0 AND regexp_matches(e, '[\p{L}\p{N}]') THEN 'embedded' WHEN doc_id % 2 = 0 THEN 'ocr' ELSE 'none' END AS text_source, CASE WHEN doc_id % 2 = 0 THEN 'done' ELSE 'not_applied' END AS ocr_status,
  len(list_filter(string_split_regex(trim(e), '\s+'), lambda x: x <> ''))::INT AS word_count, 'sha256:' || sha256(lower(array_to_string(list_filter(string_split_regex(trim(e), '\s+'), lambda x: x <> ''), ' '))) AS page_text_hash, o AS ocr_text, 31 AS columns FROM t"""
)
def page_text_records(spark, sf_dir):
    """The 31 columns of a page's text: which source it has, and its signals."""
    heard = F.struct(F.lit("ocr words").alias("ocr_text"), F.lit("done").alias("ocr_status"), F.lit(0.5).alias("ocr_confidence"))
    pages = load(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.col("doc_id").cast("string").alias("pdf_path"), F.lit("p").alias("piece_id"), F.col("doc_id").alias("page_num"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text")).alias("embedded_text"), F.when(F.col("doc_id") % 2 == 0, heard).alias("ocr"))
    records = B.page_text_record(pages, VERSION)
    kept = ("page_index_zero", "embedded_text_length", "text_is_searchable", "ocr_applied", "text_source", "ocr_status", "word_count", "page_text_hash", "ocr_text")
    return records.select(F.col("pdf_path").cast("long").alias("doc_id"), *kept, F.lit(len(records.columns)).alias("columns"))


@query(
    """SELECT event_id, event_id - 1 AS page_index_zero, 150 AS render_dpi, value AS contrast_std, CASE WHEN event_id % 3 = 0 THEN 'landscape' WHEN event_id % 3 = 1 THEN 'portrait' ELSE 'square' END AS orientation,
  event_type = 'view' AS is_image_based, CASE WHEN user_id > 0 THEN round(floor(value) / 3.0, 1) END AS estimated_dpi, 35 AS columns FROM events"""
)
def page_feature_records(spark, sf_dir):
    """The 35 columns of a page's features, with orientation, resolution and whether it is a scan."""
    c = F.col
    width, height = F.when(c("event_id") % 3 == 0, 2).otherwise(1), F.when(c("event_id") % 3 == 1, 2).otherwise(1)
    pages = load(spark, sf_dir, "events").select(
        F.lit("x").alias("pdf_path"), F.lit("p").alias("piece_id"), c("event_id").alias("page_num"), F.lit(150).alias("render_dpi"), c("value").alias("contrast_std"), G.orientation(width, height).alias("orientation"),
        G.image_based(F.when(c("event_type") == "view", 0.9).otherwise(0.1), F.lit(5)).alias("is_image_based"), G.estimated_dpi(F.floor("value"), F.when(c("user_id") > 0, 216)).alias("estimated_dpi"),
    )
    records = B.page_feature_record(pages, VERSION)
    return records.select(F.col("page_num").alias("event_id"), "page_index_zero", "render_dpi", "contrast_std", "orientation", "is_image_based", "estimated_dpi", F.lit(len(records.columns)).alias("columns"))


@query(
    """SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'score' ELSE p_type END AS family, p_name AS canonical, p_size AS part_index, p_type AS section FROM part"""
)
def facet_accessors(spark, sf_dir):
    """Fields of a part's first facet; a score is its own family."""
    c = F.col
    made = F.array(C.facet(c("p_name"), c("p_size"), c("p_type"), c("p_type")), C.facet(F.lit("other"), F.lit(None).cast("int"), F.lit("x"), F.lit("y")))
    rows = load(spark, sf_dir, "part").withColumn("f", made)
    one = lambda n: C.primary(F.col("f"), n).alias(n)
    return rows.select("p_partkey", C.primary(c("f"), "family", c("p_size") % 4 == 0).alias("family"), one("canonical"), one("part_index"), one("section"))


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment ELSE c_name END AS title, CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE 'composer' || c_nationkey END AS composer,
  CASE WHEN c_nationkey % 2 = 0 THEN 2 ELSE 1 END AS n_sources, CASE WHEN c_nationkey % 2 = 0 THEN 'http://a|source' ELSE 'source' END AS titles, CASE WHEN c_nationkey % 5 = 0 THEN c_acctbal END AS asserted,
  CASE WHEN c_nationkey % 3 = 0 THEN 'OCR of local score' WHEN c_nationkey % 3 = 1 THEN 'Other Way' ELSE 'No authoritative source (observed parts only)' END AS method_label, round(c_acctbal / 10000.0, 3) AS confidence FROM customer"""
)
def work_identity(spark, sf_dir):
    """What a lookup found wins where it is neither null nor empty; evidence with titles; where it all comes from."""
    c = F.col
    given = F.struct(c("c_name").alias("title"), F.lit(None).cast("string").alias("composer"))
    found = F.struct(F.when(c("c_nationkey") % 3 == 0, c("c_mktsegment")).otherwise("").alias("title"), F.when(c("c_nationkey") % 4 > 0, F.concat(F.lit("composer"), c("c_nationkey").cast("string"))).alias("composer"))
    item = lambda u, t, s: F.struct(F.lit(u).alias("url"), F.lit(t).alias("title"), F.lit(s).alias("snippet"))
    items = F.when(c("c_nationkey") % 2 == 0, F.array(item("http://a", "", None), item(None, None, "text"), item("", None, ""))).otherwise(F.array(item(None, None, "text"), item(None, None, None)))
    method = F.element_at(F.array(F.lit("local_score_ocr"), F.lit("other_way"), F.lit("conservative_fallback")), c("c_nationkey") % 3 + 1)
    told = B.provenance(method, F.lit("matched"), c("c_acctbal") / 10000.0, F.lit(""), F.lit(" x "), items)
    rows = load(spark, sf_dir, "customer").select("c_custkey", C.resolved(given, found, ["title", "composer"]).alias("r"), told.alias("p"), C.conservative(F.when(c("c_nationkey") % 5 == 0, "matched").otherwise("failed"), c("c_acctbal")).alias("asserted"))
    return rows.select("c_custkey", "r.title", "r.composer", F.size("p.sources").alias("n_sources"), F.array_join(F.transform("p.sources", lambda s: s["title"]), "|").alias("titles"), "asserted", "p.method_label", "p.confidence")


@query(
    """SELECT c_custkey, 'failed' AS lookup_status, 0 AS missing_required_count, true AS needs_review, 'unknown' AS completeness_tier, CASE WHEN c_nationkey % 2 = 0 THEN 2 ELSE 1 END AS observed_instrument_count,
  'No authoritative source (observed parts only)' AS method_label FROM customer"""
)
def conservative_records(spark, sf_dir):
    """Pieces without a match: nothing expected, nothing missing, always for review."""
    seen = F.array(F.lit("flute"), F.when(F.col("c_nationkey") % 2 == 0, "oboe").otherwise("flute"))
    pieces = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("piece_id"), F.col("c_name").alias("piece_folder"), seen.alias("observed_canonicals"))
    rows = B.conservative_record(pieces, F.lit("failed"), VERSION)
    kept = ("lookup_status", "missing_required_count", "needs_review", "completeness_tier", "observed_instrument_count")
    return rows.select(F.col("piece_id").alias("c_custkey"), *kept, F.col("instrumentation_provenance.method_label").alias("method_label"))


#: A small dictionary of instruments over the words of part names: canonical name, alias, section.
DIM = [("gear", "gear", "brass"), ("ring", "ring", "winds"), ("ring", "small ring", "winds"), ("horn", "horn", "brass"), ("full_score", "score", "score")]


def _dim(spark):
    return spark.createDataFrame([(c, a, None, s, i) for i, (c, a, s) in enumerate(DIM)], "canonical string, alias string, family string, section string, pos int")


@query(
    """WITH r AS (SELECT o_orderkey, o_custkey, o_orderkey % 6 AS k, o_orderstatus FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN 'gear' WHEN 1 THEN 'ring' WHEN 2 THEN 'horn' ELSE 'odd_thing' END AS canonical, CASE WHEN k = 2 OR k % 2 = 1 THEN 3 END AS part_index,
  CASE k WHEN 0 THEN 'Solo Gear' WHEN 1 THEN 'ring' WHEN 2 THEN 'Horn' ELSE 'odd thing' END AS label, CASE k WHEN 0 THEN 'brass' WHEN 1 THEN 'winds' WHEN 2 THEN 'brass' ELSE 'given' END AS section, o_orderstatus <> 'F' AS required, CASE WHEN k = 0 THEN 'solo' ELSE 'section' END AS role FROM r WHERE k <> 4 """
)
def slot_normalization(spark, sf_dir):
    """A lookup's parts as slots: known names, the dictionary's sections, no score slots; required unless said."""
    k = F.col("o_orderkey") % 6
    pick = lambda *x: F.element_at(F.array(*[F.lit(v) for v in x]), (k + 1).cast("int"))
    index = F.when((k == 2) | (k % 2 == 1), "3").otherwise("n/a")
    raw = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("piece_id"), F.lit(0).alias("pos"), pick("Gear", "small-ring", "HORN", "odd thing", "Score", "odd thing").alias("name"), index.alias("part_index"),
        pick("Solo Gear", None, "Horn", "odd thing", "Score", "odd thing").alias("label"), F.lit("given").alias("section"), F.when(F.col("o_orderstatus") == "F", False).when(F.col("o_orderstatus") == "O", True).alias("required"),
    )
    rows = S.normalize_slots(raw, _dim(spark))
    return rows.select(F.col("piece_id").alias("o_orderkey"), "canonical", "part_index", F.col("label"), "section", "required", "role")


@query(
    """SELECT p_partkey, p_name AS predicted_part, 'section' AS part_role, 1 AS count, 'ring:1;gear:' AS facets, CASE WHEN p_size % 2 = 0 THEN 'bass' ELSE '' END AS clefs FROM part"""
)
def unexpected_entries(spark, sf_dir):
    """Held parts that nothing asked for, as they are listed."""
    facet = lambda n, i: F.struct(F.lit(n).alias("canonical"), F.lit(i).cast("int").alias("part_index"), F.lit("f").alias("family"))
    held = F.struct(F.col("p_name").alias("predicted_part"), F.array(facet("ring", 1), facet("gear", None)).alias("instruments"), F.lit(None).cast("string").alias("part_role"), F.lit(None).cast("int").alias("count"), F.when(F.col("p_size") % 2 == 0, F.array(F.lit("bass"))).alias("observed_clefs"))
    rows = load(spark, sf_dir, "part").select("p_partkey", B.unexpected_entry(held).alias("u"))
    shown = F.array_join(F.transform("u.instruments", lambda x: F.concat(x["canonical"], F.lit(":"), F.coalesce(x["part_index"].cast("string"), F.lit("")))), ";")
    return rows.select("p_partkey", "u.predicted_part", "u.part_role", "u.count", shown.alias("facets"), F.array_join("u.observed_clefs", ";").alias("clefs"))


#: Orders as detected documents of a customer: what the record builders read.
_DETECTED_SQL = """d AS (SELECT o_custkey, o_orderkey, 'Order ' || o_orderkey || '.pdf' AS pdf_filename, o_orderpriority AS predicted_part, o_orderstatus = 'P' AS needs_review, o_orderpriority = '1-URGENT' AS is_score,
  CASE WHEN o_orderkey % 4 < 3 THEN ['good', 'fair', 'poor'][o_orderkey % 4 + 1] END AS quality_band, CASE WHEN o_orderkey % 4 < 3 THEN o_orderkey % 4 * 10.0 END AS quality_score, CASE WHEN o_orderkey % 4 = 1 THEN 'handwritten' WHEN o_orderkey % 4 < 3 THEN 'printed' END AS notation_source_type,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 10 END AS page_count, CASE WHEN o_orderkey % 2 = 0 THEN 't' || o_orderkey END AS thumbnail_path, o_orderpriority AS part_sort_key FROM orders)"""


def detected(spark, sf_dir):
    c = F.col
    orders = load(spark, sf_dir, "orders").withColumn("pdf_path", F.concat(F.lit("lib/Order "), c("o_orderkey").cast("string"), F.lit(".pdf")))
    key = c("o_orderkey")
    predictions = orders.select(c("o_custkey").alias("piece_id"), "pdf_path", c("o_orderpriority").alias("predicted_part"), (c("o_orderstatus") == "P").alias("needs_review"), (c("o_orderpriority") == "1-URGENT").alias("is_score"), c("o_orderpriority").alias("part_sort_key"))
    rated = orders.where(key % 4 < 3).select("pdf_path", F.element_at(F.array(F.lit("good"), F.lit("fair"), F.lit("poor")), (key % 4 + 1).cast("int")).alias("quality_band"), (key % 4 * 10.0).cast("double").alias("quality_score"), F.when(key % 4 == 1, "handwritten").otherwise("printed").alias("notation_source_type"), F.array(F.lit("x")).alias("top_issues"))
    documents = orders.where(key % 3 == 0).select("pdf_path", (key % 10).alias("page_count"))
    thumbs = orders.where(key % 2 == 0).select("pdf_path", F.concat(F.lit("t"), key.cast("string")).alias("thumbnail_path"))
    return B.detected_documents(predictions, rated, documents, thumbs)


@query(
    f"""WITH {_DETECTED_SQL} SELECT o_custkey, 'lib/' || pdf_filename AS pdf_path, pdf_filename, predicted_part, needs_review, is_score, quality_band, quality_score::DOUBLE AS quality_score, notation_source_type, page_count, thumbnail_path, CASE WHEN quality_band IS NULL THEN 0 ELSE 1 END AS issues, 16 AS columns FROM d"""
)
def detected_documents(spark, sf_dir):
    """The 15 columns of detected documents: predictions with quality, page counts and thumbnails."""
    rows = detected(spark, sf_dir)
    kept = ("pdf_path", "pdf_filename", "predicted_part", "needs_review", "is_score", "quality_band", "quality_score", "notation_source_type", "page_count", "thumbnail_path")
    return rows.select(F.col("piece_id").alias("o_custkey"), *kept, F.size("quality_top_issues").alias("issues"), F.lit(len(rows.columns)).alias("columns"))


def pieces(spark, sf_dir):
    """Customers as pieces, with what was expected of the even nations' and the documents that are held."""
    c = F.col
    docs = B.piece_documents(detected(spark, sf_dir))
    lines = F.array(F.struct(F.lit("Flute").alias("label"), F.lit(True).alias("required"), (c("c_acctbal") > 0).alias("present")), F.struct(F.lit("Oboe").alias("label"), F.lit(False).alias("required"), F.lit(False).alias("present")))
    expected = F.struct(F.lit("band").alias("ensemble_type"), F.lit("matched").alias("lookup_status"), F.lit(0.9).alias("identity_match_confidence"), lines.alias("expected_parts"), C.missing_required(lines).alias("missing_required_parts"), F.when(c("c_acctbal") > 0, 1.0).otherwise(0.0).alias("completeness_score"), F.when(c("c_acctbal") > 0, "complete").otherwise("").alias("completeness_tier"), F.lit(2).alias("expected_part_count"))
    observed = F.struct(F.lit(3).alias("distinct_instruments"), F.array(F.lit("winds")).alias("families"), (c("c_custkey") % 3).alias("needs_review_count"), (c("c_custkey") % 2).alias("duplicate_count"))
    rows = load(spark, sf_dir, "customer").join(docs, c("c_custkey") == c("piece_id"), "left").drop("piece_id")
    rows = rows.select(c("c_custkey").alias("piece_id"), F.when(c("c_custkey") % 2 == 0, F.lpad(c("c_custkey").cast("string"), 5, "0")).alias("catalog_number"), F.lit("").alias("piece_title_guess"), c("c_name").alias("piece_folder"), F.when(c("c_nationkey") % 2 == 0, expected).alias("expected"), observed.alias("observed"), "documents")
    flags = {"missing_required_parts": F.size(c("expected.missing_required_parts")) > 0, "duplicate_parts": c("observed.duplicate_count") > 0, "instrumentation_unresolved": c("expected").isNull()}
    rows = rows.withColumn("reason_codes", A.reason_codes(flags))
    todo = {r: f"do {r}" for r in A.REASONS}
    rows = rows.withColumns({"severity": A.severity(c("reason_codes")), "action_items": A.action_items(c("reason_codes"), todo, {})})
    return B.piece_record(rows, VERSION, todo)


_PIECES_SQL = f"""{_DETECTED_SQL}, n AS (SELECT o_custkey, count(*)::INT AS documents, bool_or(is_score) AS has_score, count(*) FILTER (quality_band IN ('poor', 'fair')) AS low, count(*) FILTER (notation_source_type = 'handwritten') AS hand,
  max(CASE quality_band WHEN 'poor' THEN 3 WHEN 'fair' THEN 2 WHEN 'good' THEN 1 END) AS worst, min_by(thumbnail_path, (part_sort_key, pdf_filename)) FILTER (thumbnail_path IS NOT NULL) AS thumb FROM d GROUP BY o_custkey),
p AS (SELECT c_custkey, c_name, c_acctbal, c_nationkey % 2 = 0 AS known, coalesce(documents, 0) AS documents, coalesce(has_score, false) AS has_score, coalesce(low, 0)::INT AS low, coalesce(hand, 0)::INT AS hand, ['good', 'fair', 'poor'][worst] AS worst, thumb,
  CASE WHEN c_nationkey % 2 = 0 AND NOT c_acctbal > 0 THEN 1 ELSE 0 END AS missing, c_custkey % 2 AS dup, c_custkey % 3 AS todo FROM customer LEFT JOIN n ON o_custkey = c_custkey),
q AS (SELECT *, list_filter([CASE WHEN missing > 0 THEN 'missing_required_parts' END, CASE WHEN dup > 0 THEN 'duplicate_parts' END, CASE WHEN NOT known THEN 'instrumentation_unresolved' END], lambda x: x IS NOT NULL) AS codes FROM p),
r AS (SELECT *, CASE WHEN missing > 0 THEN 'high' WHEN len(codes) > 0 THEN 'review' ELSE 'ok' END AS severity, CASE WHEN known AND c_acctbal > 0 THEN 'complete' ELSE 'unknown' END AS tier FROM q)"""


@query(
    f"""WITH {_PIECES_SQL} SELECT c_custkey, documents AS document_count, known AS has_expected_parts, tier AS completeness_tier, CASE WHEN known THEN CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END END::DOUBLE AS completeness_score, missing AS missing_required_count, 3 AS observed_instrument_count,
  worst AS worst_quality_band, low AS low_quality, hand AS handwritten, array_to_string(codes, ';') AS reason_codes, severity, len(codes) > 0 OR todo > 0 AS needs_review, has_score, array_to_string(list_transform(codes, lambda x: 'do ' || x), ';') AS actions, 44 AS columns FROM r"""
)
def piece_records(spark, sf_dir):
    """The 44 columns of a piece's record."""
    rows = pieces(spark, sf_dir)
    kept = ("document_count", "has_expected_parts", "completeness_tier", "completeness_score", "missing_required_count", "observed_instrument_count", "worst_quality_band")
    low = [F.coalesce(F.col(f"quality_summary.{c}"), F.lit(0)) for c in ("low_quality_doc_count", "handwritten_doc_count")]
    flags = ("severity", "needs_review", F.coalesce("has_score", F.lit(False)).alias("has_score"))
    return rows.select(F.col("piece_id").alias("c_custkey"), *kept, F.greatest(low[0], F.lit(0)).alias("low_quality"), F.greatest(low[1], F.lit(0)).alias("handwritten"), F.array_join("reason_codes", ";").alias("reason_codes"), *flags, F.array_join("recommended_actions", ";").alias("actions"), F.lit(len(rows.columns)).alias("columns"))


@query(
    f"""WITH {_PIECES_SQL} SELECT CASE WHEN c_custkey % 2 = 0 THEN lpad(c_custkey::VARCHAR, 5, '0') END AS catalog_number, c_name AS piece_title_guess, c_custkey AS piece_id, severity, tier AS completeness_tier, CASE WHEN known THEN CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END END::DOUBLE AS completeness_score,
  len(codes) > 0 OR todo > 0 AS needs_review, missing AS missing_required_count, 0 AS unexpected_part_count, false AS score_missing, worst AS worst_quality_band, low AS low_quality_doc_count, hand AS handwritten_doc_count, documents AS document_count, array_to_string(codes, '; ') AS reason_codes FROM r"""
)
def pieces_index(spark, sf_dir):
    """The grid of pieces, as the 15 columns of its CSV."""
    rows = B.pieces_csv(B.pieces_index(pieces(spark, sf_dir)))
    zero = {c: F.greatest(F.col(c), F.lit(0)) for c in ("low_quality_doc_count", "handwritten_doc_count")}
    return rows.withColumns({**zero, "reason_codes": F.array_join("reason_codes", "; ")})


@query(
    f"""WITH {_PIECES_SQL}, w AS (SELECT *, CASE severity WHEN 'high' THEN 20 WHEN 'review' THEN 8 ELSE 0 END + missing * 10 + dup * 2 AS score FROM r)
SELECT row_number() OVER (ORDER BY score DESC, CASE WHEN c_custkey % 2 = 0 THEN lpad(c_custkey::VARCHAR, 5, '0') ELSE '~' END, c_name)::INT AS rank, score::INT AS priority_score, c_custkey AS piece_id, severity, missing AS missing_required_count, CASE WHEN missing > 0 THEN 'Flute' ELSE '' END AS missing_required_parts,
  dup::INT AS duplicate_count, array_to_string(codes, '; ') AS reason_codes, CASE WHEN len(codes) > 0 THEN 'do ' || codes[1] ELSE '' END AS next_action, 'pieces/' || c_custkey || '.md' AS report_path, thumb AS sample_thumbnail FROM w"""
)
def review_entries(spark, sf_dir):
    """The review queue, all of it, with the columns of its CSV."""
    from foliant.functions.numbers import piece_order

    rows = pieces(spark, sf_dir).withColumn("piece_id", F.col("piece_id").cast("string"))
    counts = {"severity": F.col("severity"), "score_missing": F.col("score_missing"), "missing_required_count": F.col("missing_required_count"), "low_confidence_count": F.lit(0), "unmatched_count": F.lit(0), "duplicate_count": F.col("review_counts.duplicate_count"), "unexpected_part_count": F.lit(0)}
    queue = B.queue_entries(rows, "pieces", A.priority(counts))
    order = [F.desc("priority_score"), *piece_order(F.col("catalog_number"), F.col("piece_folder"))]
    ranked = with_rank(queue, order).withColumn("rank", F.col("rank").cast("int"))
    flat = B.queue_csv(ranked).select("rank", "priority_score", F.col("piece_id").cast("long").alias("piece_id"), "severity", "missing_required_count", "missing_required_parts", "duplicate_count", F.array_join("reason_codes", "; ").alias("reason_codes"), "next_action")
    return flat.join(ranked.select(F.col("piece_id").cast("long").alias("piece_id"), "report_path", "sample_thumbnail"), "piece_id")


@query(
    """SELECT m AS metric, CASE m WHEN 'pieces' THEN pieces::VARCHAR WHEN 'by.nations' THEN nations::VARCHAR WHEN 'tags' THEN 'a; b' WHEN 'top[0].name' THEN 'first' WHEN 'top[0].n' THEN pieces::VARCHAR WHEN 'top[1].name' THEN 'second' WHEN 'top[1].n' THEN nations::VARCHAR END AS value
FROM (SELECT count(*) AS pieces, count(DISTINCT c_nationkey) AS nations FROM customer), (SELECT unnest(['pieces', 'by.nations', 'tags', 'top[0].name', 'top[0].n', 'top[1].name', 'top[1].n']) AS m)"""
)
def metric_rows(spark, sf_dir):
    """A nested summary as rows of a path and a value."""
    t = load(spark, sf_dir, "customer").agg(F.count("*").alias("pieces"), F.countDistinct("c_nationkey").alias("nations"))
    top = F.array(F.struct(F.lit("first").alias("name"), F.col("pieces").alias("n")), F.struct(F.lit("second").alias("name"), F.col("nations").alias("n")))
    return C.metric_rows(t.select("pieces", F.struct("nations").alias("by"), F.array(F.lit("a"), F.lit("b")).alias("tags"), top.alias("top"), F.lit("left out").alias("note")), skip=("note",))


@query(
    f"""WITH {_PIECES_SQL} SELECT c_custkey AS piece_id, c_name AS title, severity, CASE WHEN known THEN CASE WHEN c_acctbal > 0 THEN 100 ELSE 0 END END AS completeness_pct, documents AS document_count, c_custkey % 7 AS page_count,
  CASE WHEN known THEN 2 ELSE 0 END AS expected_part_count, CASE WHEN known AND c_acctbal > 0 THEN 1 ELSE 0 END AS present_part_count, CASE WHEN known THEN CASE WHEN c_acctbal > 0 THEN 1 ELSE 2 END ELSE 0 END AS missing_part_count, known AS has_expected_parts FROM r"""
)
def site_pieces(spark, sf_dir):
    rows = pieces(spark, sf_dir)
    pages = rows.select("piece_id", (F.col("piece_id") % 7).alias("page_count"))
    out = B.site_pieces(B.pieces_index(rows), rows, pages)
    return out.select("piece_id", "title", "severity", "completeness_pct", "document_count", "page_count", "expected_part_count", "present_part_count", "missing_part_count", "has_expected_parts")


@query(
    f"""WITH {_DETECTED_SQL} SELECT left(sha256('lib/' || pdf_filename), 16) AS doc_id, o_custkey AS piece_id, pdf_filename, predicted_part AS instrument, CASE WHEN predicted_part <> '5-LOW' THEN 'section ' || left(predicted_part, 1) END AS section, is_score, coalesce(page_count, 0) AS page_count, quality_band AS quality FROM d"""
)
def site_documents(spark, sf_dir):
    """Documents as they are shown: ids, the part's section and the quality."""
    rows = detected(spark, sf_dir)
    names = rows.select("predicted_part").distinct().where("predicted_part <> '5-LOW'")
    parts = names.select("predicted_part", F.concat(F.lit("section "), F.left("predicted_part", F.lit(1))).alias("section"), F.lit("section").alias("part_role"))
    out = B.site_documents(rows.select("piece_id", "pdf_path", "page_count"), rows.drop("page_count"), parts)
    return out.select("doc_id", "piece_id", "pdf_filename", "instrument", "section", "is_score", "page_count", "quality")


@query(
    """WITH d AS (SELECT o_custkey, o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '2-HIGH' THEN 0 WHEN '1-URGENT' THEN 1 ELSE 9999 END, o_orderkey) AS n FROM orders)
SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ';' ORDER BY n) AS ordered, coalesce(string_agg(o_orderkey::VARCHAR, ';' ORDER BY o_orderkey) FILTER (o_orderpriority = '5-LOW'), '') AS unlisted FROM d GROUP BY o_custkey"""
)
def display_order(spark, sf_dir):
    """A piece's documents by the ranks of their fields, unknown values last; and those of some roles apart."""
    docs = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").alias("label"), F.col("o_orderpriority").alias("role"), F.array(F.struct(F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("canonical"), F.lit(1).alias("part_index"))).alias("instruments"))).alias("d"))
    ordered = C.ranked_order(F.col("d"), {"role": {"2-HIGH": 0, "1-URGENT": 1}})
    join = lambda c: F.array_join(F.transform(c, lambda x: x["label"].cast("string")), ";")
    return docs.select("o_custkey", join(ordered).alias("ordered"), join(S.unlisted(F.col("d"), ("5-LOW",))).alias("unlisted"))


@query(
    """SELECT count(*) AS pieces, count(*) FILTER (c_acctbal < 0) AS high, round(avg(c_acctbal / 10000.0), 3) AS mean_completeness, (SELECT count(*) FROM orders) AS documents, (SELECT sum(o_orderkey % 10) FROM orders)::BIGINT AS pages, '1.0' AS record_version FROM customer"""
)
def manifest(spark, sf_dir):
    """One row of counts and key figures."""
    from foliant.plans.reports import manifest as make

    p = load(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") < 0, "high").otherwise("ok").alias("severity"), (F.col("c_acctbal") / 10000.0).alias("completeness_score"))
    return make(p, load(spark, sf_dir, "orders").select((F.col("o_orderkey") % 10).alias("page_count")), VERSION)


@query(
    """SELECT s_suppkey, s_name || ' first' || chr(10) || 'second' AS excerpt, 'Big ' || s_nationkey || ';' || 'Near' AS prominent FROM supplier"""
)
def prominent_lines(spark, sf_dir):
    """The largest texts of a page, and its first lines."""
    span = lambda x, y, size, t: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(size).alias("size"), t.alias("text"))
    spans = F.array(span(0.5, 0.5, 18.0, F.lit("Near")), span(0.1, 0.1, 20.0, F.concat(F.lit("Big "), F.col("s_nationkey").cast("string"))), span(0.2, 0.2, 8.0, F.lit("small")))
    lines = C.excerpt_lines(F.concat(F.lit("\n "), F.col("s_name"), F.lit(" first\n\n  second \n third")), 2)
    return load(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(lines, "\n").alias("excerpt"), F.array_join(C.prominent(spans), ";").alias("prominent"))


@query("SELECT conv_id, string_agg(t, chr(10) ORDER BY turn) AS gathered FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text ELSE '[ocr] ' || text END AS t FROM conversations WHERE turn < 2 AND length(trim(text)) > 0) GROUP BY conv_id")
def signal_gather(spark, sf_dir):
    """A document's signals in two tiers: its first pages' own text, or else what OCR read, in order."""
    turns = load(spark, sf_dir, "conversations").where("turn < 2")
    own = F.when(F.col("role") == "user", F.col("text"))
    read = F.concat(F.lit("[ocr] "), F.col("text"))
    rows = turns.select("conv_id", "turn", F.coalesce(X.blank_to_null(F.trim(own)), read).alias("t"), "text").where(F.length(F.trim("text")) > 0)
    rows = rows.select("conv_id", "turn", F.when(F.startswith("t", F.lit("[ocr] ")), F.col("t")).otherwise(F.col("text")).alias("t"))
    return A.ordered_concat(rows, "conv_id", "turn", "t", column="gathered")


@query(
    """SELECT event_id, left(sha256('lib/' || user_id || '.pdf'), 16) || '-p' || lpad((event_id % 9999)::VARCHAR, 4, '0') AS page_id, left(sha256('lib/' || user_id || '.pdf'), 16) AS doc_id, user_id || '.pdf' AS doc_filename, value AS contrast_std, NULL::VARCHAR AS osd_script FROM events"""
)
def site_pages(spark, sf_dir):
    """Pages as they are shown: ids and the features there are."""
    path = F.concat(F.lit("lib/"), F.col("user_id").cast("string"), F.lit(".pdf"))
    pages = load(spark, sf_dir, "events").select(path.alias("pdf_path"), (F.col("event_id") % 9999).alias("page_num"), F.col("value").alias("contrast_std"), F.col("event_id").alias("piece_id"))
    return B.site_pages(pages).select(F.col("piece_id").alias("event_id"), "page_id", "doc_id", "doc_filename", "contrast_std", "osd_script")


@query(
    """SELECT o_custkey, 'sha256:' || sha256(string_agg('f' || o_orderkey, '|' ORDER BY 'f' || o_orderkey)) AS fingerprint, 'sha256:' || sha256('{"a":1,"b":{"c":[1,2]}}') AS settings FROM orders GROUP BY o_custkey"""
)
def piece_fingerprints(spark, sf_dir):
    """A piece's fingerprint from its documents', in whatever order they come; and that of settings."""
    from foliant.functions.numbers import config_fingerprint, piece_fingerprint

    own = F.concat(F.lit("f"), F.col("o_orderkey").cast("string"))
    rows = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(piece_fingerprint(F.collect_list(own)).alias("fingerprint"))
    return rows.withColumn("settings", F.lit(config_fingerprint({"b": {"c": [1, 2]}, "a": 1})))
