"""Registered queries over documents, pages and conversations."""
from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.functions import numbers as N
from foliant.functions import predicates as P
from foliant.functions import text as X
from foliant.operators import aggregates as A
from foliant.operators import joins as J
from foliant.plans.registry import query
from foliant.plans.tables import PAGES_SQL, document_pages, load

_SCORE_SQL = """
  greatest(0.0, 100 - (25.0 * low_resolution / n + 5.0 * excessive_skew / n + 20.0 * low_contrast / n + 30.0 * heavy_blur / n + 20.0 * ocr_illegible / n))"""
_COUNTS_SQL = """count(*) AS n, count(*) FILTER (low_resolution) AS low_resolution, count(*) FILTER (excessive_skew) AS excessive_skew,
    count(*) FILTER (low_contrast) AS low_contrast, count(*) FILTER (heavy_blur) AS heavy_blur, count(*) FILTER (ocr_illegible) AS ocr_illegible"""


@query(
    f"""WITH {PAGES_SQL}, counted AS (SELECT doc_id, {_COUNTS_SQL} FROM issues_of GROUP BY doc_id),
scored AS (SELECT *, {_SCORE_SQL} AS s FROM counted),
banded AS (SELECT *, CASE WHEN s >= 80 THEN 'good' WHEN s >= 50 THEN 'fair' ELSE 'poor' END AS band FROM scored)
SELECT b.doc_id, round(s, 1) AS quality_score,
  CASE WHEN l.quality = 0 THEN 'poor' ELSE band END AS quality_band,
  l.quality IS NOT NULL AS label_applied,
  low_resolution + excessive_skew + low_contrast + heavy_blur + ocr_illegible AS issue_count
FROM banded b LEFT JOIN labels l ON l.doc_id = b.doc_id"""
)
def doc_quality_score(spark, sf_dir):
    """Issues, penalty score and band of each document; a label overrides by capping the band."""
    pages = document_pages(spark, sf_dir).withColumn("issues", P.page_issues())
    scored = A.score_documents(pages, "doc_id", page="doc_id")
    labels = load(spark, sf_dir, "labels", "doc_id", "quality")
    both = scored.join(labels, "doc_id", "left")
    status = F.when(F.col("quality").isNotNull(), "success").otherwise("not_applied")
    verdict = A.adjudicate(F.col("quality_band"), F.lit("printed"), F.when(F.col("quality") == 0, "poor"), F.lit(1.0), status, F.lit("printed"))
    total = F.aggregate(F.map_values("issue_summary"), F.lit(0).cast("long"), lambda a, x: a + x)
    return both.withColumn("v", verdict).select("doc_id", "quality_score", F.col("v.quality_band").alias("quality_band"), F.col("v.applied").alias("label_applied"), total.alias("issue_count"))


@query(
    f"""WITH {PAGES_SQL}, counted AS (SELECT source, {_COUNTS_SQL},
    count(*) FILTER (low_resolution OR excessive_skew OR low_contrast OR heavy_blur OR ocr_illegible) AS page_issue_count
  FROM issues_of GROUP BY source), scored AS (SELECT *, {_SCORE_SQL} AS s FROM counted)
SELECT source, n AS analyzed, round(s, 1) AS quality_score, CASE WHEN s >= 80 THEN 'good' WHEN s >= 50 THEN 'fair' ELSE 'poor' END AS quality_band,
  page_issue_count, low_resolution, heavy_blur FROM scored"""
)
def piece_quality_score(spark, sf_dir):
    """Issues of all pages of a piece, each weighed by the share of pages that it affects."""
    pages = document_pages(spark, sf_dir).withColumn("issues", P.page_issues())
    found = A.score_documents(pages, "source")
    n = lambda i: F.coalesce(F.try_element_at("issue_summary", F.lit(i)), F.lit(0).cast("long")).alias(i)
    return found.select("source", "analyzed", "quality_score", "quality_band", "page_issue_count", n("low_resolution"), n("heavy_blur"))


@query(
    f"""WITH {PAGES_SQL}, counted AS (SELECT *, (low_resolution::INT + excessive_skew::INT + low_contrast::INT + heavy_blur::INT + ocr_illegible::INT) AS k FROM issues_of)
SELECT source, first(doc_id ORDER BY k DESC, doc_id) AS worst_page, max(k)::BIGINT AS issues FROM counted GROUP BY source HAVING max(k) > 0"""
)
def worst_row_per_group(spark, sf_dir):
    """The page with most issues, the lowest number among ties."""
    pages = document_pages(spark, sf_dir).withColumn("issues", P.page_issues())
    found = A.score_documents(pages, "source", page="doc_id").where("worst_page is not null")
    most = pages.select(F.col("doc_id").alias("worst_page"), F.size("issues").cast("long").alias("issues"))
    return found.select("source", "worst_page").join(most, "worst_page").select("source", "worst_page", "issues")


@query(
    f"""WITH {PAGES_SQL}, counted AS (SELECT doc_id, {_COUNTS_SQL} FROM issues_of GROUP BY doc_id), scored AS (SELECT *, {_SCORE_SQL} AS s FROM counted),
b AS (SELECT CASE WHEN s >= 80 THEN 'good' WHEN s >= 50 THEN 'fair' ELSE 'poor' END AS band FROM scored)
SELECT k.ord, k.band, count(b.band) AS n, CASE WHEN (SELECT count(*) FROM b) = 0 THEN 0.0 ELSE 100.0 * count(b.band) / (SELECT count(*) FROM b) END AS pct
FROM (VALUES (0, 'good'), (1, 'fair'), (2, 'poor'), (3, 'unknown')) k(ord, band) LEFT JOIN b ON b.band = k.band GROUP BY k.ord, k.band"""
)
def quality_band_distribution(spark, sf_dir):
    """Documents per band, bands without any included, and their share."""
    pages = document_pages(spark, sf_dir).withColumn("issues", P.page_issues())
    bands = A.score_documents(pages, "doc_id", page="doc_id")
    dist = A.seeded_distribution(bands, F.col("quality_band"), list(A.BANDS))
    total = dist.agg(F.sum("n").alias("t"))
    return dist.crossJoin(F.broadcast(total)).select("ord", F.col("key").alias("band"), "n", N.percent(F.col("n"), F.col("t")).alias("pct"))


@query(
    r"""SELECT doc_id, len(w)::INT AS word_count,
  CASE WHEN length(regexp_replace(text, '\s', '', 'g')) > 0 THEN round(length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) / length(regexp_replace(text, '\s', '', 'g')), 4) END AS alnum_ratio,
  'sha256:' || sha256(lower(array_to_string(w, ' '))) AS text_hash
FROM (SELECT doc_id, text, list_filter(string_split_regex(trim(text), '\s+'), lambda x: x <> '') AS w FROM documents)"""
)
def text_signals(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    t = F.col("text")
    return docs.select("doc_id", X.word_count(t).alias("word_count"), X.alnum_ratio(t).alias("alnum_ratio"), X.text_hash(t).alias("text_hash"))


@query(
    f"""WITH {PAGES_SQL}, m AS (SELECT source, avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) AS s, avg(CASE WHEN word_count > 0 THEN alnum_ratio END) AS a FROM pages_of GROUP BY source)
SELECT source, CASE WHEN s >= 0.5 OR a >= 0.70 THEN 'printed' WHEN a <= 0.45 THEN 'handwritten' ELSE 'mixed_or_uncertain' END AS notation_source_type,
  CASE WHEN s >= 0.5 THEN round(greatest(0.30, least(0.95, 0.55 + 0.4 * s)), 2) WHEN a IS NULL THEN 0.0 WHEN a >= 0.70 OR a <= 0.45 THEN round(0.30 + 0.1, 2) ELSE 0.30 END AS confidence
FROM m"""
)
def notation_decision_list(spark, sf_dir):
    """The decision list over the searchable share and the mean alphanumeric ratio."""
    pages = document_pages(spark, sf_dir)
    means = pages.groupBy("source").agg(F.avg(F.when(F.col("lang") == "en", 1.0).otherwise(0.0)).alias("s"), F.avg(F.when(F.col("word_count") > 0, F.col("alnum_ratio"))).alias("a"))
    found = means.withColumn("n", A.notation_source(F.col("s"), F.lit(None).cast("double"), F.col("a")))
    return found.select("source", F.col("n.type").alias("notation_source_type"), F.col("n.confidence").alias("confidence"))


@query(
    f"""WITH {PAGES_SQL} SELECT source, median(n_chars / 4.0) AS median_estimated_dpi, round(avg(n_chars / 20.0), 2) AS mean_contrast_std,
  round(avg(alnum_ratio), 4) AS mean_alnum_ratio, max(abs(((((doc_id % 97) + 45) % 90) - 45)))::DOUBLE AS max_skew_angle_deg,
  round(avg(CASE WHEN lang <> 'en' THEN 1.0 ELSE 0.0 END), 3) AS image_based_fraction FROM pages_of GROUP BY source"""
)
def quality_metrics(spark, sf_dir):
    pages = document_pages(spark, sf_dir).withColumn("processing_status", F.lit("success"))
    return A.quality_metrics(pages, "source").select("source", "median_estimated_dpi", "mean_contrast_std", "mean_alnum_ratio", "max_skew_angle_deg", "image_based_fraction")


@query("SELECT conv_id, first(role ORDER BY turn) AS first_role, first(text ORDER BY turn) AS first_text FROM conversations GROUP BY conv_id")
def first_per_key(spark, sf_dir):
    turns = load(spark, sf_dir, "conversations")
    return J.first_wins(turns, ["conv_id"], "turn").select("conv_id", F.col("role").alias("first_role"), F.col("text").alias("first_text"))


@query("SELECT conv_id, first(role ORDER BY turn DESC) AS last_role, max(turn) AS last_turn FROM conversations GROUP BY conv_id")
def last_per_key(spark, sf_dir):
    turns = load(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    return J.last_wins(turns, ["conv_id"], "turn").select("conv_id", F.col("role").alias("last_role"), F.col("turn").alias("last_turn"))


@query(
    """SELECT conv_id, left(string_agg(text, chr(10) ORDER BY turn), 16000) AS text FROM
(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n <= 2 GROUP BY conv_id"""
)
def ordered_text_concat(spark, sf_dir):
    """The first two pages' texts in order, capped."""
    turns = load(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return A.ordered_concat(turns, "conv_id", "turn", "text", first=2, cap=16000)


@query(
    r"""SELECT conv_id, count(*)::INT AS page_count, count(*) FILTER (role = 'user') AS pages_with_text, count(*) FILTER (role <> 'user') AS pages_needing_ocr,
  round(count(*) FILTER (role <> 'user') / count(*), 3) AS ocr_fraction, sum(length(text))::BIGINT AS total_text_length,
  sum(len(list_filter(string_split_regex(trim(text), '\s+'), lambda x: x <> '')))::BIGINT AS total_word_count, first(text ORDER BY turn) AS first_page_text
FROM conversations GROUP BY conv_id"""
)
def document_rollup(spark, sf_dir):
    turns = load(spark, sf_dir, "conversations")
    user = F.col("role") == "user"
    none = F.lit(False)
    pages = turns.select("conv_id", F.col("turn").alias("page_num"), "text", user.alias("text_is_searchable"), (~user).alias("needs_ocr"), F.length("text").alias("embedded_text_length"), X.word_count(F.col("text")).alias("word_count"), none.alias("is_image_based"), none.alias("is_blank"), none.alias("ocr_applied"))
    kept = ("page_count", "pages_with_text", "pages_needing_ocr", "ocr_fraction", "total_text_length", "total_word_count", "first_page_text")
    return A.document_rollup(pages, "conv_id").select("conv_id", *kept)


@query(
    """SELECT source, count(*) AS document_count, count(*) FILTER (l.quality IS NULL) AS unmatched_count, count(DISTINCT lang) AS distinct_instruments,
  array_to_string(list_sort(list_distinct(list(lang))), ';') AS sections FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source"""
)
def piece_rollup(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "source", "lang").join(load(spark, sf_dir, "labels", "doc_id", "quality"), "doc_id", "left")
    no = F.lit(False)
    rows = docs.select("source", no.alias("is_score"), F.col("quality").alias("predicted_part"), no.alias("needs_review"), F.lit("high").alias("confidence_tier"), F.col("lang").alias("canonical"), F.col("lang").alias("family"), F.col("lang").alias("section"), F.lit(None).cast("string").alias("score_type"))
    return A.piece_rollup(rows, "source").select("source", "document_count", "unmatched_count", "distinct_instruments", F.array_join("sections", ";").alias("sections"))


@query("SELECT doc_id, count(*) OVER (PARTITION BY text) > 1 AS duplicate FROM documents")
def duplicate_flags(spark, sf_dir):
    """Documents whose text others share, told by hash; the counts are aggregated, not windowed."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("h"))
    return A.flag_duplicates(docs, "h").select("doc_id", "duplicate")


@query(
    """SELECT source, count(*) AS docs, sum(n_chars)::BIGINT AS chars, min(n_chars) AS min_chars, median(n_chars) AS median_chars, max(n_chars) AS max_chars, count(*) FILTER (n_chars < 200) AS short_docs
FROM documents GROUP BY source"""
)
def folder_breakdown(spark, sf_dir):
    c = F.col("n_chars")
    return load(spark, sf_dir, "documents", "source", "n_chars").groupBy("source").agg(
        F.count("*").alias("docs"), F.sum(c).alias("chars"), F.min(c).alias("min_chars"), F.median(c).alias("median_chars"), F.max(c).alias("max_chars"), F.count_if(c < 200).alias("short_docs")
    )


@query("SELECT 'lang' AS kind, lang AS key, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source UNION ALL SELECT 'all', 'all', count(*) FROM documents")
def classification_aggregates(spark, sf_dir):
    """Several independent distributions in one scan, by grouping sets."""
    docs = load(spark, sf_dir, "documents", "lang", "source")
    sets = docs.groupingSets([["lang"], ["source"], []], "lang", "source").agg(F.grouping("lang").alias("no_lang"), F.grouping("source").alias("no_source"), F.count("*").alias("n"))
    pick = lambda a, b: F.when(F.col("no_lang") == 0, a).when(F.col("no_source") == 0, b).otherwise("all")
    return sets.select(pick("lang", "source").alias("kind"), pick(F.col("lang"), F.col("source")).alias("key"), "n")


@query(
    r"""SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '<html lang="([a-z]*)"', 1) AS page_lang,
  regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, length(html)::INT AS n_chars, left(sha256(url), 16) AS page_key FROM pages"""
)
def identity_extraction(spark, sf_dir):
    """Title, language and host of a page by the first matching pattern, and its id."""
    pages = load(spark, sf_dir, "pages")
    e = lambda c, p: F.regexp_extract(c, p, 1)
    return pages.select("page_id", e("html", "(?s)<title>(.*?)</title>").alias("title"), e("html", '<html lang="([a-z]*)"').alias("page_lang"), e("url", "^[a-z]+://([^/]+)").alias("host"), F.length("html").alias("n_chars"), N.short_id(F.col("url")).alias("page_key"))


@query(
    r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM documents)
SELECT doc_id, len(lines)::INT AS n_lines, lines[1] AS first_line, list_filter(lines, lambda x: regexp_matches(x, '(?i)licen[cs]e|copyright|rights reserved'))[1] AS rights_line FROM l"""
)
def zone_lines(spark, sf_dir):
    """Lines of a text: how many, the first, and the first that speaks of rights."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    held = docs.select("doc_id", lines.alias("lines"))
    return held.select("doc_id", F.size("lines").alias("n_lines"), F.get("lines", F.lit(0)).alias("first_line"), X.first_line(F.col("lines"), "(?i)licen[cs]e|copyright|rights reserved").alias("rights_line"))


@query(
    """SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN NULL ELSE l.quality END AS quality, coalesce(CASE WHEN l.doc_id IS NOT NULL THEN 'success' END, 'not_applied') AS status
FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def enrichment_patch(spark, sf_dir):
    """A side table patched onto documents, with a status where it has nothing."""
    from foliant.operators.records import enriched

    labels = load(spark, sf_dir, "labels", "doc_id", "quality").withColumn("status", F.lit("success"))
    return enriched(load(spark, sf_dir, "documents", "doc_id"), labels, "doc_id", "status").select("doc_id", "quality", "status")


@query("SELECT lang, source, count(*) AS n, round(100.0 * count(*) / max(count(*)) OVER (PARTITION BY lang), 1) AS bar_pct FROM documents GROUP BY lang, source")
def column_max_bar(spark, sf_dir):
    counts = load(spark, sf_dir, "documents", "lang", "source").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return A.bar_share(counts, "n", "lang")


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 3")
def top_rows_per_group(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "source", "n_chars")
    ranked = docs.withColumn("r", F.row_number().over(W.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")))
    return ranked.where("r <= 3").select("doc_id", "source")


@query(
    """SELECT doc_id, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)"""
)
def score_text_semi(spark, sf_dir):
    good = load(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 1")
    return load(spark, sf_dir, "documents", "doc_id", "n_chars").join(good, "doc_id", "left_semi")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans_anti(spark, sf_dir):
    return J.orphans(load(spark, sf_dir, "documents", "doc_id"), load(spark, sf_dir, "labels", "doc_id"), "doc_id")


@query(
    r"""SELECT doc_id, (strlen(regexp_replace(text, '[^0-9]', '', 'g')) > 0) AS has_digit, contains(lower(text), 'license') AS hit
FROM documents WHERE contains(lower(text), 'license') OR contains(lower(source), 'license')"""
)
def any_column_search(spark, sf_dir):
    docs = P.any_column_contains(load(spark, sf_dir, "documents", "doc_id", "text", "source"), "License", ["text", "source"])
    return docs.select("doc_id", F.col("text").rlike("[0-9]").alias("has_digit"), F.contains(F.lower("text"), F.lit("license")).alias("hit"))


@query(
    """SELECT conv_id, count(*) AS n_turns, count(*) FILTER (role = 'user') AS user_turns, CASE WHEN count(*) = 0 THEN 0.0 ELSE 100.0 * count(*) FILTER (role = 'user') / count(*) END AS user_pct
FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'user') > 0"""
)
def nested_filter_having(spark, sf_dir):
    """Groups with at least one element that fits, counted in nested arrays."""
    turns = load(spark, sf_dir, "conversations", "conv_id", "role").groupBy("conv_id").agg(F.collect_list("role").alias("roles"))
    fit = F.size(F.filter("roles", lambda r: r == "user")).cast("long")
    out = turns.select("conv_id", F.size("roles").cast("long").alias("n_turns"), fit.alias("user_turns")).where("user_turns > 0")
    return out.withColumn("user_pct", N.percent(F.col("user_turns"), F.col("n_turns")))
