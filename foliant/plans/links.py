"""Registered queries over lookups, links, editions, rollups of quality and expectations, and the classifier."""
from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions import predicates as P
from foliant.operators import aggregates as A
from foliant.operators import classifier as K
from foliant.operators import joins as J
from foliant.operators import plugins as G
from foliant.operators import reconcile as R
from foliant.operators import records as C
from foliant.operators import slots as S
from foliant.plans.registry import query
from foliant.plans.tables import load, register_views, tasks_for


@query(
    """SELECT c_custkey, n_name, o.o_orderkey AS last_order, o.o_orderstatus AS last_status FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) o ON o_custkey = c_custkey"""
)
def document_lookup(spark, sf_dir):
    """Rows with the last row of their key of one side, and the only one of another."""
    nation = load(spark, sf_dir, "nation", F.col("n_nationkey").alias("c_nationkey"), "n_name")
    orders = load(spark, sf_dir, "orders", F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderkey").alias("last_order"), F.col("o_orderstatus").alias("last_status"))
    both = J.lookup(load(spark, sf_dir, "customer"), nation, ["c_nationkey"])
    return J.lookup(both, orders, ["c_custkey"], "o_orderkey").select("c_custkey", "n_name", "last_order", "last_status")


@query(
    """SELECT c_custkey, o.o_orderpriority AS first_text FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) o ON o_custkey = c_custkey"""
)
def first_text(spark, sf_dir):
    """The first text of each key that isn't empty."""
    text = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).otherwise("")
    rows = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", text.alias("t"))
    found = J.first_non_empty(rows, "c_custkey", "o_orderkey", "t")
    return load(spark, sf_dir, "customer", "c_custkey").join(found, "c_custkey", "left").select("c_custkey", F.col("t").alias("first_text"))


@query(
    """SELECT l.l_orderkey, l.l_linenumber, count(*) AS pages, max(t.l_suppkey) AS last_text FROM lineitem l LEFT JOIN (SELECT l_orderkey, l_linenumber, max(l_suppkey) AS l_suppkey FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL) t
ON t.l_orderkey = l.l_orderkey AND t.l_linenumber = l.l_linenumber GROUP BY ALL"""
)
def page_text_join(spark, sf_dir):
    """Pages with the last text of the same document and page number."""
    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    texts = items.where("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("text"), "l_suppkey")
    both = J.lookup(items.select("l_orderkey", "l_linenumber"), texts, ["l_orderkey", "l_linenumber"], "l_suppkey", tasks=tasks_for(items))
    return both.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("pages"), F.max("text").alias("last_text"))


@query(
    """WITH s AS (SELECT l_orderkey, l_partkey * 1000 + l_suppkey AS slot, l_suppkey % 5 AS k, CASE WHEN l_linenumber % 3 > 0 THEN l_linenumber % 3 END AS i, CASE WHEN l_linestatus = 'F' THEN 'solo' ELSE 'section' END AS r FROM lineitem WHERE l_returnflag = 'N'),
d AS (SELECT l_orderkey, l_partkey * 1000 + l_suppkey AS doc, l_suppkey % 5 AS k, CASE WHEN l_linenumber % 3 > 0 THEN l_linenumber % 3 END AS i, CASE WHEN l_linestatus = 'F' THEN 'solo' ELSE 'section' END AS r FROM lineitem WHERE l_returnflag <> 'N'),
m AS (SELECT s.l_orderkey, s.k, slot, doc, CASE WHEN s.i IS NOT NULL THEN CASE WHEN s.i = d.i AND s.r = d.r THEN 1 WHEN s.i = d.i THEN 2 WHEN d.i IS NULL AND s.r = d.r THEN 3 WHEN d.i IS NULL THEN 4 END ELSE CASE WHEN s.r = d.r THEN 1 ELSE 2 END END AS level
  FROM s JOIN d ON d.l_orderkey = s.l_orderkey AND d.k = s.k)
SELECT l_orderkey, k::BIGINT AS canonical, slot, min(level)::INT AS level, array_to_string(list_sort(list(doc) FILTER (level = best)), ';') AS docs FROM (SELECT *, min(level) OVER (PARTITION BY l_orderkey, k, slot) AS best FROM m WHERE level IS NOT NULL) GROUP BY ALL"""
)
def slot_links(spark, sf_dir):
    """Each slot's documents at the best level of match: chair and role, chair, role without a chair, no chair."""
    items = load(spark, sf_dir, "lineitem")
    c = F.col
    rows = items.select("l_orderkey", (c("l_suppkey") % 5).alias("canonical"), (c("l_partkey") * 1000 + c("l_suppkey")).alias("id"), F.when(c("l_linenumber") % 3 > 0, c("l_linenumber") % 3).alias("part_index"), F.when(c("l_linestatus") == "F", "solo").otherwise("section").alias("role"), "l_returnflag")
    slots, docs = rows.where("l_returnflag = 'N'").withColumnRenamed("id", "slot"), rows.where("l_returnflag <> 'N'").withColumnRenamed("id", "doc")
    found = J.linked(slots.drop("l_returnflag"), docs.drop("l_returnflag"), ["l_orderkey", "canonical"])
    return found.select("l_orderkey", "canonical", "slot", "level", F.array_join(F.col("docs").cast("array<string>"), ";").alias("docs"))


@query(
    """WITH g AS (SELECT * FROM (VALUES (1, 'ECONOMY'), (1, 'PROMO'), (1, 'STANDARD'), (2, 'LARGE'), (2, 'MEDIUM')) v(grp, canonical)), s AS (SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON p_partkey = l_partkey),
one AS (SELECT l_orderkey, grp, min(p_type) AS slot_canonical FROM s JOIN g ON canonical = p_type GROUP BY l_orderkey, grp HAVING count(*) = 1)
SELECT l_orderkey, slot_canonical, canonical AS other FROM one JOIN g USING (grp) WHERE canonical <> slot_canonical"""
)
def equivalence_bridge(spark, sf_dir):
    """Names that stand in for another: only where one member of their group is expected."""
    groups = spark.createDataFrame([(1, "ECONOMY"), (1, "PROMO"), (1, "STANDARD"), (2, "LARGE"), (2, "MEDIUM")], "grp int, canonical string")
    slots = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey").join(load(spark, sf_dir, "part", F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("canonical")), "l_partkey")
    return R.equivalences(slots, groups, "l_orderkey")


@query(
    """SELECT o_orderkey, c_name AS report, CASE WHEN o_orderpriority <> '5-LOW' THEN 'first of ' || o_orderpriority END AS section FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""
)
def enrichment_index(spark, sf_dir):
    """Documents with their piece's report and the first section known of their part."""
    orders = load(spark, sf_dir, "orders")
    reports = load(spark, sf_dir, "customer", F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("report"))
    named = orders.where("o_orderpriority <> '5-LOW'").select("o_orderpriority", "o_orderkey", F.concat(F.lit("first of "), "o_orderpriority").alias("section"))
    parts = named.groupBy("o_orderpriority").agg(F.min_by("section", "o_orderkey").alias("section"))
    return J.lookup(J.lookup(orders, reports, ["o_custkey"]), parts, ["o_orderpriority"]).select("o_orderkey", "report", "section")


@query("SELECT 'piece' AS entity, c_custkey AS id, c_name AS label FROM customer WHERE c_custkey = 7 UNION ALL SELECT 'document', o_orderkey, o_orderpriority FROM orders WHERE o_custkey = 7")
def point_lookup(spark, sf_dir):
    """One piece and its documents, by id, from registered tables."""
    register_views(spark, sf_dir, ["customer", "orders"])
    return spark.sql("SELECT 'piece' AS entity, c_custkey AS id, c_name AS label FROM customer WHERE c_custkey = 7 UNION ALL SELECT 'document', o_orderkey, o_orderpriority FROM orders WHERE o_custkey = 7")


@query(
    """WITH p AS (SELECT l_orderkey, l_partkey % 3 AS facet, l_returnflag AS clef, l_partkey * 1000 + l_suppkey AS part, l_linenumber FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, facet, clef ORDER BY part, l_linenumber) AS copy FROM p),
d AS (SELECT l_orderkey, facet, max(copy) AS deepest, count(*) AS parts FROM n GROUP BY ALL)
SELECT l_orderkey, facet, CASE WHEN facet + 1 > deepest THEN least(parts, facet + 1) ELSE deepest END AS editions, CASE WHEN facet + 1 > deepest THEN 1 ELSE c END AS most_clefs FROM d JOIN (SELECT l_orderkey, facet, count(DISTINCT clef) AS c FROM n GROUP BY ALL) USING (l_orderkey, facet)"""
)
def clef_editions(spark, sf_dir):
    """Copies of a part in several clefs as one, unless a piece asks for more of it than an edition has copies: then each
    is its own, as many as are asked for."""
    c = F.col
    parts = load(spark, sf_dir, "lineitem").select("l_orderkey", (c("l_partkey") % 3).alias("facet"), c("l_returnflag").alias("clef"), F.lit(None).cast("string").alias("transposition"), F.struct(c("l_partkey") * 1000 + c("l_suppkey"), "l_linenumber").alias("part"))
    demand = parts.select("l_orderkey", "facet", (c("facet") + 1).alias("demand")).distinct()
    found = R.editions(parts, demand, ["l_orderkey", "facet"])
    return found.groupBy("l_orderkey", "facet").agg(F.count("*").alias("editions"), F.max(F.size("clefs")).cast("long").alias("most_clefs"))


_DRUMS = [("snare_drum", "snare drum"), ("bass_drum", "bass drum"), ("cymbals", "cymbals"), ("percussion", "percussion")]


@query(
    """SELECT o_orderkey, n AS canonical, n = 'snare_drum' AND o_orderkey % 4 = 1 AS held FROM orders, (SELECT unnest(['percussion', 'snare_drum', 'bass_drum', 'cymbals']) AS n)
WHERE CASE n WHEN 'percussion' THEN o_orderkey % 4 > 1 WHEN 'snare_drum' THEN o_orderkey % 4 < 2 WHEN 'bass_drum' THEN o_orderkey % 4 < 2 ELSE false END"""
)
def percussion_backfill(spark, sf_dir):
    """Drums that an instrumentation names and the slots lack; the family's generic slot goes where there are any."""
    k = F.col("o_orderkey") % 4
    orders = load(spark, sf_dir, "orders", "o_orderkey")
    slots = orders.select(F.col("o_orderkey").alias("piece_id"), F.explode(F.when(k == 1, F.array(F.lit("percussion"), F.lit("snare_drum"))).otherwise(F.array(F.lit("percussion")))).alias("canonical"))
    slots = slots.select("piece_id", F.lit(0).alias("pos"), "canonical", F.lit(None).cast("int").alias("part_index"), F.col("canonical").alias("label"), F.lit("percussion").alias("section"), F.lit(True).alias("required"), F.lit("held").alias("role"))
    text = F.when(k < 2, "Cymbals by ear. Instrumentation: Snare Drum, Bass Drum").when(k == 2, "Instrumentation: flute").otherwise("Bass drum")
    dim = spark.createDataFrame([(c, a, None, "percussion", i) for i, (c, a) in enumerate(_DRUMS)], "canonical string, alias string, family string, section string, pos int")
    rows = S.backfill(slots, orders.select(F.col("o_orderkey").alias("piece_id"), text.alias("text")), dim, "percussion")
    return rows.select(F.col("piece_id").alias("o_orderkey"), "canonical", ((F.col("role") == "held") & (F.col("canonical") == "snare_drum")).alias("held"))


@query("SELECT l_orderkey, count(DISTINCT n) AS instruments FROM (SELECT l_orderkey, unnest([p_type, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_type END]) AS n FROM lineitem JOIN part ON p_partkey = l_partkey) GROUP BY l_orderkey")
def distinct_instruments(spark, sf_dir):
    """How many different instruments a piece's parts cover."""
    part = load(spark, sf_dir, "part", F.col("p_partkey").alias("l_partkey"), F.array("p_type", F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.col("p_type"))).alias("names"))
    rows = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey").join(part, "l_partkey")
    return rows.select("l_orderkey", F.explode("names").alias("n")).groupBy("l_orderkey").agg(F.countDistinct("n").alias("instruments"))


@query(
    """WITH b AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'good' WHEN 'O' THEN 'fair' WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'poor' ELSE 'odd' END END AS band FROM orders)
SELECT o_custkey, ['unknown', 'good', 'fair', 'poor'][1 + max(CASE band WHEN 'poor' THEN 3 WHEN 'fair' THEN 2 WHEN 'good' THEN 1 ELSE 0 END)] AS worst, count(*) FILTER (band = 'good') AS good_count, count(*) FILTER (band = 'fair') AS fair_count,
  count(*) FILTER (band = 'poor') AS poor_count, count(*) FILTER (band NOT IN ('good', 'fair', 'poor')) AS unknown_count FROM b GROUP BY o_custkey"""
)
def worst_bands(spark, sf_dir):
    """Each piece's worst band and its documents by band."""
    c = F.col
    band = F.when(c("o_orderstatus") == "F", "good").when(c("o_orderstatus") == "O", "fair").when(c("o_orderkey") % 2 == 0, "poor").otherwise("odd")
    rows = load(spark, sf_dir, "orders").select("o_custkey", band.alias("band"))
    return rows.groupBy("o_custkey").agg(A.worst_band(c("band")).alias("worst"), *A.band_counts(c("band")))


@query("SELECT key, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'good' WHEN o_orderstatus = 'O' THEN 'fair' ELSE 'unknown' END AS key, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT unnest(['good', 'fair', 'poor', 'unknown']), 0) GROUP BY key")
def band_totals(spark, sf_dir):
    """The pieces' maps of counts added up; unknown keys are one."""
    key = F.when(F.col("o_orderstatus") == "F", "good").when(F.col("o_orderstatus") == "O", "fair").otherwise("strange")
    counts = load(spark, sf_dir, "orders").groupBy("o_custkey", key.alias("k")).agg(F.count("*").alias("n"))
    maps = counts.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m"))
    return maps.agg(A.total_of_maps(F.col("m")).alias("t")).select(F.inline("t"))


@query(
    """SELECT o_custkey, avg(CASE WHEN o_orderstatus <> 'F' THEN (o_orderkey % 100) / 100.0 END) AS mean_confidence, max(greatest((o_orderkey % 7) / 10.0, (o_orderkey % 11) / 20.0)) AS best_confidence, count(*) AS pages,
  max_by(CASE WHEN (o_orderkey % 7) / 10.0 * sqrt(o_orderkey % 5) >= (o_orderkey % 11) / 20.0 * sqrt(4) THEN 'a' ELSE 'b' END, o_orderkey) AS last_pass
FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 2) GROUP BY o_custkey"""
)
def score_confidence(spark, sf_dir):
    """Mean and best OCR confidence over the first two pages, and the best pass of the last of them."""
    c = F.col
    key = c("o_orderkey")
    one = lambda conf, n, t: F.struct(conf.alias("confidence"), n.cast("double").alias("word_count"), F.lit(t).alias("text"))
    passes = F.array(one(key % 7 / F.lit(10.0), key % 5, "a"), one(key % 11 / F.lit(20.0), F.lit(4), "b"))
    pages = load(spark, sf_dir, "orders").select("o_custkey", key.alias("page_num"), (c("o_orderstatus") != "F").alias("ocr_applied"), (key % 100 / F.lit(100.0)).alias("ocr_confidence"), passes.alias("ocr_candidates"))
    first = J.first_rows(pages, ["o_custkey"], 2, F.asc("page_num"))
    more = first.groupBy("o_custkey").agg(F.count("*").alias("pages"), F.max_by(A.best_pass(c("ocr_candidates"))["text"], "page_num").alias("last_pass"))
    return A.first_pages_confidence(pages, "o_custkey").join(more, "o_custkey")


@query(
    """SELECT conv_id, string_agg('--- Page ' || turn || ' ---' || chr(10) || CASE WHEN turn = 0 THEN '[header] ' || role || ' x' || chr(10) ELSE '' END || '[dpi=150 psm=' || turn || ' conf=0.5] ' || text || chr(10) || '[dpi=300 psm=6 conf=0.25] ' , chr(10) ORDER BY turn) AS text
FROM conversations WHERE turn < 2 GROUP BY conv_id"""
)
def multi_pass_text(spark, sf_dir):
    """All OCR passes of the first pages in one labelled text."""
    one = lambda dpi, psm, conf, t: F.struct(F.lit(dpi).alias("dpi"), psm.cast("int").alias("psm"), F.lit(conf).alias("confidence"), t.alias("text"))
    passes = F.array(one(150, F.col("turn"), 0.5, F.col("text")), one(300, F.lit(6), 0.25, F.lit(None).cast("string")))
    headers = F.when(F.col("turn") == 0, F.array("role", F.lit("x"))).otherwise(F.array().cast("array<string>"))
    pages = load(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page_num"), headers.alias("headers"), passes.alias("ocr_candidates"))
    return A.multi_pass_text(pages, "conv_id", cap=1_000_000)


@query(
    """SELECT l_orderkey, count(*) AS pages, count(*) FILTER (l_quantity > l_linenumber * 10) AS landscape, count(*) FILTER (l_quantity < l_linenumber * 10) AS portrait, count(*) FILTER (l_quantity = l_linenumber * 10) AS square FROM lineitem GROUP BY l_orderkey"""
)
def orientation_counts(spark, sf_dir):
    """Pages of a piece, by orientation."""
    kind = G.orientation(F.col("l_quantity"), F.col("l_linenumber") * 10)
    return load(spark, sf_dir, "lineitem").withColumn("k", kind).groupBy("l_orderkey").agg(F.count("*").alias("pages"), *[F.count_if(F.col("k") == k).alias(k) for k in ("landscape", "portrait", "square")])


@query(
    """WITH t AS (SELECT o_orderstatus AS status, CASE WHEN o_totalprice > 300000 THEN 'complete' WHEN o_totalprice > 100000 THEN 'incomplete' ELSE 'unknown' END AS tier, o_custkey, o_orderpriority FROM orders)
SELECT 'tier' AS kind, tier AS key, count(*) AS n FROM t GROUP BY tier UNION ALL SELECT 'status', status, count(*) FROM t GROUP BY status
UNION ALL SELECT 'missing', o_orderpriority, n FROM (SELECT o_orderpriority, count(DISTINCT o_custkey) AS n FROM t WHERE status = 'P' GROUP BY o_orderpriority ORDER BY n DESC, o_orderpriority LIMIT 25)"""
)
def expected_aggregates(spark, sf_dir):
    """Pieces by completeness and lookup status, and the labels that most pieces lack."""
    price = F.col("o_totalprice")
    tier = F.when(price > 300000, "complete").when(price > 100000, "incomplete").otherwise("unknown")
    rows = load(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.col("o_orderstatus").alias("status"), tier.alias("tier"))
    sets = rows.groupingSets([["tier"], ["status"]], "tier", "status").agg(F.grouping("tier").alias("g"), F.count("*").alias("n"))
    counts = sets.select(F.when(F.col("g") == 0, "tier").otherwise("status").alias("kind"), F.coalesce("tier", "status").alias("key"), "n")
    missing = A.most_missing(rows.where("status = 'P'"), "o_custkey", "o_orderpriority", 25)
    return counts.union(missing.select(F.lit("missing"), "o_orderpriority", "pieces"))


@query(
    """WITH q AS (SELECT doc_id, source, doc_id % 5 AS a, doc_id % 3 AS b FROM documents) SELECT 'band' AS kind, CASE WHEN doc_id % 4 = 0 THEN 'poor' ELSE 'good' END AS key, count(*)::BIGINT AS n FROM documents GROUP BY 2
UNION ALL SELECT 'issue', 'low_contrast', sum(a)::BIGINT FROM q UNION ALL SELECT 'issue', 'heavy_blur', sum(b)::BIGINT FROM q WHERE b > 0"""
)
def quality_aggregates(spark, sf_dir):
    """Documents by band, and how many pages each issue affects."""
    k = F.col("doc_id")
    issues = F.map_filter(F.create_map(F.lit("low_contrast"), k % 5, F.lit("heavy_blur"), k % 3), lambda _, v: v > 0)
    rows = load(spark, sf_dir, "documents", "doc_id").select(F.when(k % 4 == 0, "poor").otherwise("good").alias("band"), issues.alias("issue_summary"))
    bands = rows.groupBy("band").agg(F.count("*").alias("n")).select(F.lit("band").alias("kind"), F.col("band").alias("key"), "n")
    pages = rows.select(F.explode("issue_summary").alias("key", "pages")).groupBy("key").agg(F.sum("pages").alias("n"))
    return bands.union(pages.select(F.lit("issue"), "key", "n"))


#: The classifier's dictionary: the word of `p_name` that is the canonical name, its other alias, its section.
_WORDS = [("widget", "cold", "a"), ("bolt", "small", "a"), ("ring", "large", "a"), ("gear", "blue", "a"), ("gizmo", "new", "b"), ("rod", "old", "b"), ("anvil", "red", "c"), ("plate", "hot", "c")]
_WORD_ROWS = ", ".join(f"('{c}', '{a}', '{s}')" for c, a, s in _WORDS)


@query(
    f"""WITH w(noun, alias, section) AS (VALUES {_WORD_ROWS}), d AS (
  SELECT p_partkey, p_type, p_size, h.noun, h.section AS held_in, CASE WHEN p_brand NOT LIKE '%3' THEN n.noun END AS named, CASE WHEN p_brand NOT LIKE '%3' THEN n.section END AS named_in,
    CASE WHEN p_brand NOT LIKE '%3' AND p_size <= 20 THEN p_size::VARCHAR ELSE '' END AS chair
  FROM part JOIN w n ON n.alias = split_part(p_name, ' ', 1) JOIN w h ON h.noun = split_part(p_name, ' ', 2)),
e AS (SELECT *, coalesce(named_in = held_in, false) AS near, coalesce(named = noun, false) AS same,
    CASE WHEN p_type = 'PROMO' THEN 'score' WHEN p_type = 'STANDARD' THEN 'ocr_llm' WHEN p_type = 'ECONOMY' THEN 'vision'
      WHEN length(noun) < 4 OR (p_type = 'MEDIUM' AND named_in <> held_in) THEN CASE WHEN named IS NULL THEN 'none' ELSE 'name' END ELSE 'text' END AS rule FROM d),
f AS (SELECT *, CASE rule WHEN 'score' THEN NULL WHEN 'none' THEN NULL WHEN 'name' THEN named ELSE noun END AS predicted, rule IN ('ocr_llm', 'vision', 'text') AND named IS NOT NULL AND NOT near AS conflict,
    CASE WHEN p_size % 2 = 0 THEN 0.95 ELSE 0.9 END AS keyed FROM e),
g AS (SELECT *, (CASE rule WHEN 'score' THEN 0.9 WHEN 'none' THEN 0 WHEN 'name' THEN CASE WHEN same THEN keyed ELSE 0.75 END
    WHEN 'text' THEN CASE WHEN named IS NULL THEN 0.5 WHEN same THEN keyed WHEN near THEN 0.8 ELSE 0.7 END
    WHEN 'ocr_llm' THEN CASE WHEN named IS NULL THEN 0.8 WHEN same THEN 0.9 WHEN near THEN 0.8 ELSE 0.7 END
    ELSE CASE WHEN named IS NULL THEN 0.8 WHEN same THEN 0.88 WHEN near THEN 0.78 ELSE 0.68 END END)::DOUBLE AS confidence FROM f)
SELECT p_partkey, predicted, CASE WHEN predicted IS NULL THEN '' WHEN rule = 'vision' AND NOT same THEN predicted || ':' ELSE predicted || ':' || chair END AS facets, confidence,
  CASE WHEN rule = 'score' THEN 'filename' WHEN rule = 'none' THEN 'none' WHEN rule = 'name' THEN CASE WHEN same THEN 'combined' ELSE 'filename' END WHEN named IS NOT NULL THEN 'combined' ELSE rule END AS evidence_source,
  conflict, confidence < 0.75 OR conflict AS needs_review FROM g"""
)
def part_classifier(spark, sf_dir):
    """The decision list for every part: its name is the first word of `p_name` with the size as its chair, or a brand
    that the dictionary doesn't know; the second word is what its page says, a model read, or was seen, by type."""
    part, brand = load(spark, sf_dir, "part"), F.col("p_brand").endswith("3")
    word = lambda i: F.split("p_name", " ")[i]
    told = lambda *types: F.when(F.col("p_type").isin(*types), word(1))
    read = lambda kind: F.when(F.col("p_type") == kind, F.array(word(1)))
    docs = part.select(
        F.col("p_partkey").alias("pdf_path"), F.when(brand, F.col("p_brand")).when(F.col("p_size") <= 20, F.concat_ws(" ", word(0), F.col("p_size").cast("string"))).otherwise(word(0)).alias("name"),
        (F.col("p_type") == "PROMO").alias("is_score"), told("LARGE", "SMALL").alias("upper_left"), told("MEDIUM").alias("full_text"), F.when(F.col("p_size") % 2 == 0, "F").alias("transposition"),
        read("STANDARD").alias("llm"), F.lit(None).cast("double").alias("llm_confidence"), read("ECONOMY").alias("vision"), F.lit(None).cast("array<int>").alias("vision_chairs"), F.lit(None).cast("double").alias("vision_confidence"),
    )
    aliases = [(c, a, None, s, i) for i, (c, other, s) in enumerate(_WORDS) for a in (c, other)]
    rows = K.classify(docs, spark.createDataFrame(aliases, "canonical string, alias string, family string, section string, pos int"))
    facets = F.array_join(F.transform("instruments", lambda x: F.concat(x["canonical"], F.lit(":"), F.coalesce(x["part_index"].cast("string"), F.lit("")))), ";")
    return rows.select(F.col("pdf_path").alias("p_partkey"), "predicted", facets.alias("facets"), F.round("confidence", 2).alias("confidence"), "evidence_source", "conflict", "needs_review")


@query(
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'CLICK' WHEN event_type = 'view' THEN 'fallback' END AS found, CASE WHEN event_type = 'click' THEN 'first' WHEN event_type = 'view' THEN 'second' ELSE 'none' END AS stage,
  CASE WHEN event_type = 'click' THEN 'success' WHEN event_type = 'error' THEN 'error: no' ELSE 'not_found' END AS status FROM events"""
)
def injected_stages(spark, sf_dir):
    """Injected functions, one after the other until one finds something; errors are statuses."""
    rows = load(spark, sf_dir, "events", "event_id", "event_type")

    def first(r):
        if r["event_type"] == "error":
            raise ValueError("no")
        return {"found": r["event_type"].upper()} if r["event_type"] == "click" else None

    one = G.enrich(rows, "event_id", ["event_type"], first, "found string")
    two = G.enrich(rows, "event_id", ["event_type"], lambda r: {"found": "fallback"} if r["event_type"] == "view" else None, "found string")
    out = G.staged(rows, "event_id", [("first", one), ("second", two)], "found")
    return out.join(one.select("event_id", "status"), "event_id").select("event_id", "found", "stage", "status")


@query(
    """SELECT s_suppkey, s_suppkey % 2 = 0 AS thumbnail_available, s_suppkey % 3 = 0 AS missing_required FROM supplier"""
)
def thumbnail_links(spark, sf_dir):
    """Whether a thumbnail's path exists, and whether a piece lacks a required part."""
    rows = load(spark, sf_dir, "supplier", "s_suppkey", "s_name").withColumn("thumbnail_path", F.concat(F.lit("t/"), "s_name"))
    there = G.available(rows, rows.where("s_suppkey % 2 = 0").select("thumbnail_path"))
    parts = F.array(F.struct(F.lit(True).alias("required"), (F.col("s_suppkey") % 3 > 0).alias("present")), F.struct(F.lit(False).alias("required"), F.lit(False).alias("present")))
    return there.select("s_suppkey", "thumbnail_available", (F.size(C.missing_required(parts)) > 0).alias("missing_required"))


@query(
    """WITH c AS (SELECT 0 AS ord, c_custkey, 'x' || c_nationkey AS path FROM customer UNION ALL SELECT 1, s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'x' || (s_nationkey + 10) END FROM supplier)
SELECT path, (row_number() OVER (ORDER BY min((ord, c_custkey))))::INT AS place FROM c WHERE path IS NOT NULL GROUP BY path"""
)
def ordered_union(spark, sf_dir):
    """The paths of two sides, each once, in the order in which they come first."""
    from pyspark.sql import Window as W

    from foliant.sources.sinks import ordered_paths

    a = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), F.concat(F.lit("x"), F.col("c_nationkey").cast("string")).alias("path"))
    b = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pos"), F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit("x"), (F.col("s_nationkey") + 10).cast("string"))).alias("path"))
    found = ordered_paths([a, b], "path", "pos")  # some dozens: places are numbered in one task
    return found.select("path", F.row_number().over(W.orderBy("first")).alias("place"))


@query(
    """SELECT event_id, event_type IN ('click', 'view') AND value > 10 AS kept, user_id FROM events WHERE event_type IN ('click', 'view') AND user_id IN (1, 2, 3)"""
)
def declared_filter(spark, sf_dir):
    """Rows whose fields are in declared lists."""
    rows = P.declared(load(spark, sf_dir, "events"), {"event_type": ["click", "view"], "user_id": [1, 2, 3]})
    return rows.select("event_id", (F.col("value") > 10).alias("kept"), "user_id")


@query(
    """SELECT l_orderkey, count(*) FILTER (l_returnflag <> 'N') AS required_count, count(*) FILTER (l_returnflag <> 'N' AND l_linestatus = 'F') AS present_count, count(*) FILTER (l_returnflag <> 'N' AND l_linenumber > 1 AND l_linestatus <> 'F') AS missing_required_count,
  coalesce(bool_or(l_returnflag <> 'N' AND l_linenumber = 1 AND l_linestatus <> 'F'), false) AS score_missing, round(CASE WHEN count(*) FILTER (l_returnflag <> 'N') = 0 THEN 1.0 ELSE count(*) FILTER (l_returnflag <> 'N' AND l_linestatus = 'F') / count(*) FILTER (l_returnflag <> 'N') END, 3) AS completeness_score
FROM lineitem GROUP BY l_orderkey"""
)
def slot_completeness(spark, sf_dir):
    """The share of a piece's required slots that are filled, its score one of them."""
    c = F.col
    slots = load(spark, sf_dir, "lineitem").select("l_orderkey", (c("l_returnflag") != "N").alias("required"), (c("l_linestatus") == "F").alias("present"), (c("l_linenumber") == 1).alias("is_score"))
    return A.completeness(slots, "l_orderkey").drop("completeness_tier")


@query(
    """WITH dim AS (SELECT * FROM (VALUES ('ring', 'ring', 0), ('small_ring', 'small ring', 1), ('small', 'small', 2), ('gear', 'gear', 3)) v(canonical, alias, pos)),
h AS (SELECT p_partkey, canonical, alias, pos FROM part JOIN dim ON contains(' ' || p_name || ' ', ' ' || alias || ' ')),
b AS (SELECT p_partkey, first(canonical ORDER BY length(alias) DESC, pos) AS best FROM h GROUP BY p_partkey)
SELECT p_partkey, best, coalesce(string_agg(canonical, ';' ORDER BY length(alias) DESC, pos) FILTER (canonical <> best), '') AS alternates FROM h JOIN b USING (p_partkey) GROUP BY p_partkey, best"""
)
def dictionary_alternates(spark, sf_dir):
    """The best entry of a dictionary in each name, and the other entries, longer aliases first."""
    dim = spark.createDataFrame([("ring", "ring", 0), ("small_ring", "small ring", 1), ("small", "small", 2), ("gear", "gear", 3)], "canonical string, alias string, pos int")
    best = J.best_match(J.dictionary_hits(load(spark, sf_dir, "part", "p_partkey", "p_name"), "p_partkey", "p_name", dim), "p_partkey")
    return best.select("p_partkey", F.col("canonical").alias("best"), F.coalesce(F.array_join(F.transform("alternates", lambda x: x["canonical"]), ";"), F.lit("")).alias("alternates"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY CASE WHEN c_nationkey % 3 = 0 THEN '~' ELSE lpad(c_nationkey::VARCHAR, 3, '0') END, c_name) AS place FROM customer QUALIFY place <= 50")
def record_order(spark, sf_dir):
    """The first fifty pieces of an export: by catalog number, those without last, then by folder."""
    from pyspark.sql import Window as W

    from foliant.functions.numbers import piece_order

    catalog = F.when(F.col("c_nationkey") % 3 > 0, F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))
    rows = load(spark, sf_dir, "customer").select("c_custkey", catalog.alias("catalog_number"), F.col("c_name").alias("piece_folder"))
    first = C.in_piece_order(rows).limit(50)
    place = F.row_number().over(W.orderBy(*piece_order(F.col("catalog_number"), F.col("piece_folder")))).cast("long")  # fifty rows
    return first.select("c_custkey", place.alias("place"))


@query("SELECT * FROM (SELECT 0::BIGINT AS batch, count(DISTINCT user_id) AS written FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 1, count(DISTINCT user_id) FROM events) WHERE written > 0")
def batch_callbacks(spark, sf_dir):
    """What a stream's batches have written, told batch by batch as they end."""
    from foliant.sources.scratch import new_folder
    from foliant.streaming.incremental import file_stream, upsert_stream

    folder, seen = new_folder(spark, "batches"), []
    events = load(spark, sf_dir, "events", "user_id", "event_id")
    for k, part in enumerate((events.where("event_id % 2 = 0"), events)):
        part.groupBy("user_id").agg(F.max("event_id").alias("event_id")).withColumn("fingerprint", F.concat(F.lit(f"{k} "), F.col("event_id").cast("string"))).coalesce(1).write.mode("append").json(f"{folder}/in")
        stream = file_stream(spark, f"{folder}/in", "user_id long, event_id long, fingerprint string")
        upsert_stream(stream, "user_id", "event_id", f"{folder}/table", f"{folder}/checkpoint", on_batch=lambda b, n: seen.append((b, n))).awaitTermination()
    return spark.createDataFrame(seen, "batch long, written long")


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS title, count(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS scores, min(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS score FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL"""
)
def site_metadata(spark, sf_dir):
    """What is shown of a piece: the resolved title, else the one that was read; its scores."""
    from foliant.functions.text import first_truthy

    c = F.col
    scores = load(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").groupBy(c("o_custkey").alias("c_custkey")).agg(F.count("*").alias("scores"), F.min("o_orderkey").alias("score"))
    resolved = F.when(c("c_nationkey") % 2 == 0, c("c_mktsegment")).otherwise("")
    both = load(spark, sf_dir, "customer").join(scores, "c_custkey", "left")
    return both.select("c_custkey", first_truthy(resolved, c("c_name")).alias("title"), F.coalesce("scores", F.lit(0)).cast("long").alias("scores"), "score")
