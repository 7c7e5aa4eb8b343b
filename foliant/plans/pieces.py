"""Registered queries over customers, orders, line items, parts and events."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import numbers as N
from foliant.functions import predicates as P
from foliant.functions import text as X
from foliant.operators import aggregates as A
from foliant.operators import joins as J
from foliant.operators import reconcile as R
from foliant.operators import records as C
from foliant.operators.ranking import with_rank
from foliant.operators.selection import summarised
from foliant.operators.substring_index import indexed_search as search_index
from foliant.operators.substring_index import write_index
from foliant.plans.registry import query
from foliant.plans.tables import load, tasks_for
from foliant.sources.scratch import new_folder

#: A customer as a piece: what its orders and line items lack.
REPORTS_SQL = """
lines AS (SELECT o_custkey, count(*) FILTER (l_returnflag = 'R') AS missing, count(*) FILTER (l_discount >= 0.095) AS unexpected, count(*) AS parts
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey),
held AS (SELECT o_custkey, count(*) AS orders_, count(*) FILTER (o_orderpriority = '5-LOW') AS low, count(*) FILTER (o_orderstatus = 'P') AS unmatched,
  count(*) FILTER (o_totalprice < 20000) AS dup, count(*) FILTER (o_orderstatus = 'O') = 0 AS score_missing FROM orders GROUP BY o_custkey),
reports AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey, c_acctbal, h.o_custkey IS NOT NULL AS matched, coalesce(orders_, 0) AS document_count,
    coalesce(parts, 0) AS parts, coalesce(missing, 0) AS missing_required_count, coalesce(unexpected, 0) AS unexpected_part_count,
    coalesce(low, 0) AS low_confidence_count, coalesce(unmatched, 0) AS unmatched_count, coalesce(dup, 0) AS duplicate_count, coalesce(score_missing, false) AS score_missing
  FROM customer LEFT JOIN held h ON h.o_custkey = c_custkey LEFT JOIN lines l ON l.o_custkey = c_custkey),
coded AS (SELECT *, list_filter([CASE WHEN score_missing THEN 'missing_score' END, CASE WHEN missing_required_count > 0 THEN 'missing_required_parts' END,
    CASE WHEN unexpected_part_count > 0 THEN 'unexpected_parts' END, CASE WHEN low_confidence_count + unmatched_count > 0 THEN 'low_confidence_parts' END,
    CASE WHEN duplicate_count > 0 THEN 'duplicate_parts' END, CASE WHEN NOT matched THEN 'instrumentation_unresolved' END], lambda x: x IS NOT NULL) AS codes FROM reports),
found AS (SELECT *, CASE WHEN score_missing OR missing_required_count > 0 THEN 'high' WHEN len(codes) > 0 THEN 'review' ELSE 'ok' END AS severity FROM coded),
scored AS (SELECT *, CASE severity WHEN 'high' THEN 20 WHEN 'review' THEN 8 ELSE 0 END AS severity_base,
    CASE WHEN parts = 0 THEN 1.0 ELSE (parts - missing_required_count) / parts END AS completeness FROM found)
"""


def reports(spark, sf_dir):
    """The same, in DataFrames: both sides are aggregated to customers before they are joined."""
    orders = load(spark, sf_dir, "orders")
    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_discount")
    by_order = items.groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("missing"), F.count_if(F.col("l_discount") >= 0.095).alias("unexpected"), F.count("*").alias("parts"))
    both = orders.join(by_order, orders.o_orderkey == by_order.l_orderkey, "left")
    held = both.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("document_count"),
        F.sum("parts").alias("parts"),
        F.sum("missing").alias("missing_required_count"),
        F.sum("unexpected").alias("unexpected_part_count"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low_confidence_count"),
        F.count_if(F.col("o_orderstatus") == "P").alias("unmatched_count"),
        F.count_if(F.col("o_totalprice") < 20000).alias("duplicate_count"),
        (F.count_if(F.col("o_orderstatus") == "O") == 0).alias("score_missing"),
    )
    out = load(spark, sf_dir, "customer").join(held.withColumn("matched", F.lit(True)), "c_custkey", "left")
    counts = ("document_count", "parts", "missing_required_count", "unexpected_part_count", "low_confidence_count", "unmatched_count", "duplicate_count")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in counts})
    out = out.withColumns({"score_missing": P.yes(F.col("score_missing")), "matched": P.yes(F.col("matched"))})
    c = F.col
    codes = A.reason_codes(
        {
            "missing_score": c("score_missing"),
            "missing_required_parts": c("missing_required_count") > 0,
            "unexpected_parts": c("unexpected_part_count") > 0,
            "low_confidence_parts": c("low_confidence_count") + c("unmatched_count") > 0,
            "duplicate_parts": c("duplicate_count") > 0,
            "instrumentation_unresolved": ~c("matched"),
        }
    )
    out = out.withColumn("codes", codes).withColumn("severity", A.severity(F.col("codes")))
    share = F.when(c("parts") == 0, 1.0).otherwise((c("parts") - c("missing_required_count")) / F.greatest("parts", F.lit(1)))
    return out.withColumn("completeness", share)


def _priority():
    names = ("severity", "score_missing", "missing_required_count", "low_confidence_count", "unmatched_count", "duplicate_count", "unexpected_part_count")
    return A.priority({n: F.col(n) for n in names})


@query(f"WITH {REPORTS_SQL} SELECT c_custkey, array_to_string(codes, ';') AS reason_codes, severity, len(codes) > 0 AS needs_review FROM found")
def reason_codes_severity(spark, sf_dir):
    return reports(spark, sf_dir).select("c_custkey", F.array_join("codes", ";").alias("reason_codes"), "severity", (F.size("codes") > 0).alias("needs_review"))


_PRIORITY_SQL = """severity_base + CASE WHEN score_missing THEN 40 ELSE 0 END + missing_required_count * 10 + low_confidence_count * 5 + unmatched_count * 5 + duplicate_count * 2 + unexpected_part_count"""


@query(
    f"""WITH {REPORTS_SQL}, q AS (SELECT *, {_PRIORITY_SQL} AS priority_score FROM scored)
SELECT row_number() OVER (ORDER BY priority_score DESC, c_name, c_custkey) AS rank, c_custkey, priority_score::BIGINT AS priority_score, severity FROM q"""
)
def priority_queue(spark, sf_dir):
    """Every piece's place in the queue."""
    total = sum(_priority().values(), F.lit(0)).cast("long")
    queue = reports(spark, sf_dir).select("c_custkey", "c_name", "severity", total.alias("priority_score"))
    ranked = with_rank(queue, [F.desc("priority_score"), F.col("c_name"), F.col("c_custkey")])
    return ranked.select("rank", "c_custkey", "priority_score", "severity")


@query(
    f"""WITH {REPORTS_SQL} SELECT c_custkey, severity_base::INT AS severity_base, CASE WHEN score_missing THEN 40 ELSE 0 END AS missing_score, (missing_required_count * 10)::BIGINT AS missing_required_parts,
  (low_confidence_count * 5)::BIGINT AS low_confidence_parts, (unmatched_count * 5)::BIGINT AS unmatched_parts, (duplicate_count * 2)::BIGINT AS duplicate_parts, unexpected_part_count::BIGINT AS unexpected_parts FROM scored"""
)
def priority_breakdown(spark, sf_dir):
    return reports(spark, sf_dir).select("c_custkey", *[v.alias(k) for k, v in _priority().items()])


@query(
    f"""WITH {REPORTS_SQL} SELECT k.ord, k.code, count(f.c_custkey) AS n FROM
(VALUES (0, 'missing_score'), (1, 'missing_required_parts'), (2, 'unexpected_parts'), (3, 'low_confidence_parts'), (4, 'duplicate_parts'), (5, 'instrumentation_unresolved')) k(ord, code)
LEFT JOIN found f ON list_contains(f.codes, k.code) GROUP BY k.ord, k.code"""
)
def reason_code_frequency(spark, sf_dir):
    codes = reports(spark, sf_dir).select(F.explode("codes").alias("code"))
    return A.seeded_distribution(codes, F.col("code"), list(A.REASONS)).select("ord", F.col("key").alias("code"), "n")


@query(
    f"""WITH {REPORTS_SQL} SELECT c_custkey, round(completeness, 3) AS completeness_score,
  CASE WHEN missing_required_count = 0 AND NOT score_missing THEN 'complete' WHEN completeness >= 0.85 THEN 'near_complete' WHEN completeness >= 0.5 THEN 'incomplete' ELSE 'severely_incomplete' END AS completeness_tier FROM scored"""
)
def completeness(spark, sf_dir):
    tier = N.completeness_tier(F.col("completeness"), F.col("missing_required_count"), F.col("score_missing"))
    return reports(spark, sf_dir).select("c_custkey", F.round("completeness", 3).alias("completeness_score"), tier.alias("completeness_tier"))


@query(f"WITH {REPORTS_SQL} SELECT count(completeness) AS cnt, round(avg(completeness), 3) AS mean, round(median(completeness), 3) AS median, round(min(completeness), 3) AS min, round(max(completeness), 3) AS max FROM scored")
def completeness_summary(spark, sf_dir):
    return summarised(reports(spark, sf_dir), F.col("completeness"))


@query(
    f"""WITH {REPORTS_SQL} SELECT count(*) AS pieces, sum(document_count)::BIGINT AS documents, sum(missing_required_count)::BIGINT AS missing_required, sum(unexpected_part_count)::BIGINT AS unexpected,
  count(*) FILTER (score_missing) AS scores_missing, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'review') AS review, count(*) FILTER (severity = 'ok') AS ok,
  sum(low_confidence_count)::BIGINT AS low_confidence, sum(duplicate_count)::BIGINT AS duplicates FROM scored"""
)
def collection_totals(spark, sf_dir):
    s, n = F.sum, lambda on: F.count_if(on)
    return reports(spark, sf_dir).agg(
        F.count("*").alias("pieces"),
        s("document_count").alias("documents"),
        s("missing_required_count").alias("missing_required"),
        s("unexpected_part_count").alias("unexpected"),
        n(F.col("score_missing")).alias("scores_missing"),
        *[n(F.col("severity") == k).alias(k) for k in ("high", "review", "ok")],
        s("low_confidence_count").alias("low_confidence"),
        s("duplicate_count").alias("duplicates"),
    )


@query(
    f"""WITH {REPORTS_SQL}, t AS (SELECT count(*) AS pieces, sum(document_count)::BIGINT AS documents, count(*) FILTER (score_missing) AS scores_missing FROM scored)
SELECT 'pieces' AS metric, pieces AS value FROM t UNION ALL SELECT 'documents', documents FROM t UNION ALL SELECT 'scores_missing', scores_missing FROM t"""
)
def unpivot_kpis(spark, sf_dir):
    return collection_totals(spark, sf_dir).select("pieces", "documents", "scores_missing").unpivot([], ["pieces", "documents", "scores_missing"], "metric", "value")


@query(
    f"""WITH {REPORTS_SQL} SELECT c_custkey, severity, c_name FROM found WHERE severity IN ('high', 'review')
ORDER BY CASE severity WHEN 'high' THEN 0 ELSE 1 END, c_name, c_custkey LIMIT 50"""
)
def attention_topk(spark, sf_dir):
    rank = F.when(F.col("severity") == "high", 0).otherwise(1)
    rows = P.declared(reports(spark, sf_dir), {"severity": ["high", "review"]})
    return rows.orderBy(rank, "c_name", "c_custkey").limit(50).select("c_custkey", "severity", "c_name")


@query(
    f"""WITH {REPORTS_SQL} SELECT c_custkey, u.code AS reason_code, CASE u.code WHEN 'missing_score' THEN 'Find the score' WHEN 'missing_required_parts' THEN 'Find missing parts' ELSE 'Review' END AS action
FROM found, unnest(codes) AS u(code)"""
)
def action_items(spark, sf_dir):
    """An item for each reason code, nested first and flattened again."""
    actions = {r: "Review" for r in A.REASONS} | {"missing_score": "Find the score", "missing_required_parts": "Find missing parts"}
    nested = reports(spark, sf_dir).select("c_custkey", A.action_items(F.col("codes"), actions, {}).alias("items"))
    return C.flattened(nested, "items", "c_custkey").select("c_custkey", "reason_code", "action")


@query(
    f"""WITH {REPORTS_SQL} SELECT c_custkey, u.code AS code FROM found LEFT JOIN (SELECT c_custkey AS k, unnest(codes) AS code FROM found) u ON u.k = c_custkey"""
)
def explode_targets(spark, sf_dir):
    """A row for each target; a piece without any keeps one row."""
    return reports(spark, sf_dir).select("c_custkey", F.explode_outer("codes").alias("code"))


@query(
    """SELECT p_type AS section, p_brand AS instrument, count(DISTINCT l_orderkey) AS pieces FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R'
GROUP BY p_type, p_brand ORDER BY pieces DESC, section, instrument LIMIT 25"""
)
def top_missing_instruments(spark, sf_dir):
    missing = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_returnflag").where("l_returnflag = 'R'")
    both = missing.join(load(spark, sf_dir, "part", "p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    counts = both.groupBy(F.col("p_type").alias("section"), F.col("p_brand").alias("instrument")).agg(F.countDistinct("l_orderkey").alias("pieces"))
    return counts.orderBy(F.desc("pieces"), "section", "instrument").limit(25)


@query("SELECT p_type AS section, count(DISTINCT l_orderkey) AS pieces FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' GROUP BY p_type")
def top_missing_sections(spark, sf_dir):
    missing = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_returnflag").where("l_returnflag = 'R'")
    both = missing.join(load(spark, sf_dir, "part", "p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return both.groupBy(F.col("p_type").alias("section")).agg(F.countDistinct("l_orderkey").alias("pieces"))


@query(
    """SELECT c_custkey AS id, coalesce(nullif(o.st, ''), nullif(c_mktsegment, ''), n_name) AS title, coalesce(n_name, '') AS folder FROM customer
LEFT JOIN (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END) AS st FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey"""
)
def identity_coalesce(spark, sf_dir):
    """The first value that is neither null nor empty over several sources."""
    orders = load(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_orderpriority")
    last = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("")).alias("st"))
    nation = F.broadcast(load(spark, sf_dir, "nation", "n_nationkey", "n_name"))  # 25 rows
    both = load(spark, sf_dir, "customer").join(last, "c_custkey", "left").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return both.select(F.col("c_custkey").alias("id"), X.first_truthy(F.col("st"), F.col("c_mktsegment"), F.col("n_name")).alias("title"), F.coalesce("n_name", F.lit("")).alias("folder"))


@query(
    """WITH ids AS (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders UNION SELECT s_suppkey FROM supplier)
SELECT k, c_name, coalesce(o.n, 0)::INT AS documents, s_name, o.first_order FROM ids LEFT JOIN customer ON c_custkey = k LEFT JOIN supplier ON s_suppkey = k
LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey) o ON o_custkey = k"""
)
def six_source_join(spark, sf_dir):
    """A record per id of any source; a side with many rows an id is aggregated to one before the join."""
    c = load(spark, sf_dir, "customer", "c_custkey", "c_name").withColumnRenamed("c_custkey", "k")
    o = load(spark, sf_dir, "orders", "o_custkey", "o_orderkey").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_order"))
    s = load(spark, sf_dir, "supplier", "s_suppkey", "s_name").withColumnRenamed("s_suppkey", "k")
    out = J.assemble("k", [c, o, s], {"customer": c, "supplier": s, "orders": o}, {}, {})
    return out.select("k", "customer.c_name", F.coalesce("orders.n", F.lit(0)).cast("int").alias("documents"), "supplier.s_name", "orders.first_order")


@query(
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
  CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 9 END, o_orderkey) AS r FROM orders) WHERE r = 1"""
)
def best_local_score(spark, sf_dir):
    orders = load(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority")
    best = J.best_per_key(orders, "o_custkey", {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}, "o_orderpriority", F.col("o_orderkey"))
    return best.select("o_custkey", "o_orderkey", "o_orderpriority")


#: A small dictionary over part names: canonical name, alias.
ALIASES = [("ring", "ring"), ("ring", "small ring"), ("widget", "widget"), ("gear", "gear"), ("bolt", "bolt"), ("bolt", "red bolt"), ("plate", "plate"), ("anvil", "anvil"), ("gizmo", "gizmo"), ("hot_ware", "hot")]
_ALIAS_SQL = ", ".join(f"('{c}', '{a}', {i})" for i, (c, a) in enumerate(ALIASES))
_HIT_SQL = f"""dim AS (SELECT * FROM (VALUES {_ALIAS_SQL}) v(canonical, alias, pos)),
hits AS (SELECT p_partkey, p_name, canonical, alias, pos, strpos(' ' || p_name || ' ', ' ' || alias || ' ') AS start,
  2 * length(alias) + CASE WHEN alias = p_name THEN 20 ELSE 0 END + CASE WHEN contains(alias, ' ') THEN 10 ELSE 0 END - CASE WHEN length(alias) <= 3 THEN 35 ELSE 0 END
  + CASE WHEN regexp_matches(alias, 'bass|alto|tenor|baritone|soprano|contra|eb|bb') THEN 12 ELSE 0 END + CASE WHEN regexp_matches(p_name, 'bass|alto|tenor|baritone|soprano|contra|eb|bb') THEN 6 ELSE 0 END
  - CASE WHEN contains(p_name, ' ') AND length(alias) <= 4 THEN 10 ELSE 0 END AS score
  FROM part JOIN dim ON contains(' ' || p_name || ' ', ' ' || alias || ' '))"""


def _hits(spark, sf_dir):
    dim = spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(ALIASES)], "canonical string, alias string, pos int")
    return J.dictionary_hits(load(spark, sf_dir, "part", "p_partkey", "p_name"), "p_partkey", "p_name", dim)


@query(
    f"""WITH {_HIT_SQL} SELECT p_partkey, canonical, alias, score::INT AS score FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, length(alias) DESC, pos) AS r FROM hits) WHERE r = 1"""
)
def dictionary_theta_specific(spark, sf_dir):
    """The most specific dictionary entry in each name."""
    return J.best_match(_hits(spark, sf_dir), "p_partkey").select("p_partkey", "canonical", "alias", "score")


@query(
    f"""WITH {_HIT_SQL} SELECT p_partkey, canonical, alias FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY start, score DESC, canonical, alias) AS r FROM hits) WHERE r = 1"""
)
def dictionary_theta_earliest(spark, sf_dir):
    return J.best_match(_hits(spark, sf_dir), "p_partkey", earliest=True).select("p_partkey", "canonical", "alias")


@query("SELECT p_partkey, CASE lower(p_type) WHEN 'economy' THEN 'low_cost' WHEN 'promo' THEN 'promotion' ELSE replace(lower(p_type), ' ', '_') END AS canonical FROM part")
def dictionary_equi(spark, sf_dir):
    dim = spark.createDataFrame([("low_cost", "Economy", 0), ("promotion", "PROMO", 1)], "canonical string, alias string, pos int")
    return J.canonical_names(load(spark, sf_dir, "part", "p_partkey", "p_type"), "p_type", dim).select("p_partkey", "canonical")


@query("SELECT n_nationkey, CASE WHEN r_name IN ('AFRICA', 'ASIA') THEN 'south_east' ELSE r_name END AS section FROM nation JOIN region ON r_regionkey = n_regionkey")
def section_lookup(spark, sf_dir):
    """A group by dictionary, else the family itself."""
    region = F.broadcast(load(spark, sf_dir, "region"))  # five rows
    both = load(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    dim = spark.createDataFrame([("AFRICA", "south_east"), ("ASIA", "south_east")], "canonical string, section string")
    return J.sections(both.withColumn("name", F.col("r_name")), "name", dim, "r_name").select("n_nationkey", "section")


_SLOT_SQL = """slots AS (SELECT l_orderkey AS piece_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos, p_type AS canonical, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size % 3 END AS part_index
  FROM lineitem JOIN part ON p_partkey = l_partkey), held AS (SELECT l_orderkey AS piece_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS part, p_type AS canonical,
  CASE WHEN p_size % 2 = 0 THEN 1 + l_linenumber % 2 END AS part_index FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'R')"""


def _slots_and_held(spark, sf_dir):
    """Line items as slots, and those that came back not as held parts; and how many tasks to deal them to."""
    from pyspark.sql import Window as W

    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    tasks = tasks_for(items)
    both = items.join(load(spark, sf_dir, "part", "p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey")).repartition(tasks, "l_orderkey")
    n = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    role, none = F.lit("section").alias("role"), F.lit(None).cast("string").alias("transposition")
    base = [F.col("l_orderkey").alias("piece_id"), F.col("p_type").alias("canonical")]
    size = F.col("p_size") % 3
    slots = both.select(*base, (n - 1).alias("pos"), F.when(size != 0, size).alias("part_index"), role, none)
    index = F.when(F.col("p_size") % 2 == 0, 1 + F.col("l_linenumber") % 2)
    held = both.where("l_returnflag <> 'R'").select(*base, n.alias("part"), index.alias("part_index"), role, none)
    return slots, held, tasks


@query(
    f"""WITH {_SLOT_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY piece_id, canonical, part_index ORDER BY pos) AS i FROM slots WHERE part_index IS NOT NULL),
h AS (SELECT *, row_number() OVER (PARTITION BY piece_id, canonical, part_index ORDER BY part) AS i FROM held WHERE part_index IS NOT NULL)
SELECT s.piece_id, s.pos::INT AS slot, h.part::INT AS part FROM s JOIN h ON h.piece_id = s.piece_id AND h.canonical = s.canonical AND h.part_index = s.part_index AND h.i = s.i"""
)
def slot_index_match(spark, sf_dir):
    """Slots and held parts of the same chair, the first with the first."""
    slots, held, tasks = _slots_and_held(spark, sf_dir)
    return R.exact_index_matches(slots.withColumnRenamed("pos", "slot"), held, tasks=tasks).select("piece_id", "slot", "part")


@query(
    f"""WITH {_SLOT_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY piece_id, canonical, part_index ORDER BY pos) AS i FROM slots WHERE part_index IS NOT NULL),
h AS (SELECT *, row_number() OVER (PARTITION BY piece_id, canonical, part_index ORDER BY part) AS i FROM held WHERE part_index IS NOT NULL),
m AS (SELECT h.piece_id, h.part FROM s JOIN h ON h.piece_id = s.piece_id AND h.canonical = s.canonical AND h.part_index = s.part_index AND h.i = s.i)
SELECT piece_id, part::INT AS part, canonical FROM held x WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.piece_id = x.piece_id AND m.part = x.part)
AND NOT (part_index IS NOT NULL AND EXISTS (SELECT 1 FROM slots o WHERE o.piece_id = x.piece_id AND o.canonical = x.canonical AND o.part_index IS NULL))"""
)
def unexpected_parts(spark, sf_dir):
    """Held parts that no slot took."""
    slots, held, tasks = _slots_and_held(spark, sf_dir)
    slots = slots.withColumnRenamed("pos", "slot")
    return R.unexpected(held, R.exact_index_matches(slots, held, tasks=tasks), slots, tasks=tasks).select("piece_id", "part", "canonical")


def _sides(lines: DataFrame, tasks: int, slot: Column, *facets: Column) -> tuple[DataFrame, DataFrame]:
    """Slots and the facets of held parts, of line items (piece_id, l_linenumber, l_partkey, l_suppkey, held, and what the
    structs are made of). Within the piece, `pos` numbers the lines, from 0, and `part` those held, from 1; a facet that is
    null isn't there. Lines are dealt once, and both sides are made of the whole line there, so that Spark finds them to be
    the same rows and writes them to disk once."""
    from pyspark.sql import Window as W

    order = W.partitionBy("piece_id").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    held = F.count_if("held").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).cast("int")
    numbered = lines.withColumn("piece_id", F.col("piece_id").cast("string")).repartition(tasks, "piece_id").select("*", (F.row_number().over(order) - 1).alias("pos"), held.alias("part"))
    no = lambda x: F.when(F.lit(False), x)
    rows = [F.struct(slot.alias("slot"), no(facets[0]).alias("facet")), *(F.struct(no(slot).alias("slot"), F.when(F.col("held"), f).alias("facet")) for f in facets)]
    sides = numbered.select("piece_id", F.inline(F.array(*rows)))
    held = sides.where("facet is not null").select("piece_id", "facet.*").withColumn("pos", F.col("part")).withColumn("part", F.col("part").cast("string"))
    return sides.where("slot is not null").select("piece_id", "slot.*"), held


#: Both passes of the matching for pieces without keys, roles or stand-ins. Parts come in the order of the first part of
#: the same facet, then their own. The first pass numbers both sides; the second goes through a group's open slots one
#: by one, each taking the first part without a chair if it has none itself, else the first that is left.
_GREEDY_SQL = f"""{_SLOT_SQL},
h0 AS (SELECT *, min(part) OVER (PARTITION BY piece_id, canonical, part_index) AS lead FROM held),
h AS (SELECT *, row_number() OVER (PARTITION BY piece_id ORDER BY lead, part) - 1 AS n FROM h0),
hi AS (SELECT *, row_number() OVER (PARTITION BY piece_id, canonical, part_index ORDER BY n) AS i FROM h WHERE part_index IS NOT NULL),
si AS (SELECT *, row_number() OVER (PARTITION BY piece_id, canonical, part_index ORDER BY pos) AS i FROM slots WHERE part_index IS NOT NULL),
m1 AS (SELECT si.piece_id, si.canonical, pos, part, n FROM si JOIN hi ON hi.piece_id = si.piece_id AND hi.canonical = si.canonical AND hi.part_index = si.part_index AND hi.i = si.i),
s2 AS (SELECT piece_id, canonical, list({{'pos': pos, 'i': part_index}} ORDER BY pos) AS todo FROM slots s WHERE NOT EXISTS (SELECT 1 FROM m1 WHERE m1.piece_id = s.piece_id AND m1.pos = s.pos) GROUP BY ALL),
h2 AS (SELECT piece_id, canonical, list({{'n': n, 'part': part, 'i': part_index}} ORDER BY n) AS free FROM h WHERE NOT EXISTS (SELECT 1 FROM m1 WHERE m1.piece_id = h.piece_id AND m1.part = h.part) GROUP BY ALL),
step AS (SELECT piece_id, canonical, 0 AS k, todo, free, NULL::BIGINT AS pos, NULL::BIGINT AS part, NULL::BIGINT AS n FROM s2 JOIN h2 USING (piece_id, canonical)
  UNION ALL SELECT piece_id, canonical, k + 1, todo, list_filter(free, lambda x: x.n <> pick.n), todo[k + 1].pos, pick.part, pick.n
  FROM (SELECT *, coalesce(list_filter(free, lambda x: x.i IS NOT DISTINCT FROM todo[k + 1].i)[1], free[1]) AS pick FROM step WHERE k < len(todo) AND len(free) > 0)),
taken AS (SELECT piece_id, pos, part, n FROM m1 UNION ALL SELECT piece_id, pos, part, n FROM step WHERE k > 0)"""


@query(
    f"""WITH RECURSIVE {_GREEDY_SQL}
SELECT s.piece_id::VARCHAR AS piece_id, 'slot' AS kind, s.pos::INT AS pos, s.canonical, s.part_index::INT AS part_index, s.canonical AS label, t.part IS NOT NULL AS present, t.part::VARCHAR AS matched_part,
  CASE WHEN t.part IS NOT NULL THEN '' END AS observed_clefs, CASE WHEN t.part IS NOT NULL THEN '' END AS observed_transpositions FROM slots s LEFT JOIN taken t ON t.piece_id = s.piece_id AND t.pos = s.pos
UNION ALL SELECT h.piece_id::VARCHAR, 'unexpected', h.n::INT, h.canonical, h.part_index::INT, h.canonical, false, h.part::VARCHAR, '', '' FROM h
WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.piece_id = h.piece_id AND t.part = h.part)
AND NOT (h.part_index IS NOT NULL AND EXISTS (SELECT 1 FROM slots o WHERE o.piece_id = h.piece_id AND o.canonical = h.canonical AND o.part_index IS NULL))"""
)
def slot_greedy_match(spark, sf_dir):
    """Both passes of the matching over every order, order-dependent."""
    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    lines = items.select(F.col("l_orderkey").alias("piece_id"), "l_partkey", "l_suppkey", "l_linenumber", (F.col("l_returnflag") != "R").alias("held"))
    both = lines.join(load(spark, sf_dir, "part", "p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    size, none, tasks = F.col("p_size"), F.lit(None).cast("string"), tasks_for(items)
    shared = [F.col("p_type").alias("canonical"), F.col("p_type").alias("label"), F.lit("section").alias("role"), none.alias("transposition")]
    slot = F.struct("pos", F.when(size % 3 != 0, size % 3).alias("part_index"), *shared)
    part = F.struct("part", F.when(size % 2 == 0, 1 + F.col("l_linenumber") % 2).alias("part_index"), *shared, none.alias("clef"))
    return R.reconcile(*_sides(both, tasks, slot, part), tasks=tasks)


#: Instruments that stand for one another where an order asks for one of them alone, and the usual key of one.
INTERCHANGED, USUAL_KEY = [["ECONOMY", "STANDARD"], ["SMALL", "MEDIUM"]], {"PROMO": "F"}


def editions_and_doublings(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Line items as slots with keys, solos and equivalents; those that didn't come back as held parts, with clefs, keys,
    solos, parts of two names, and parts that go by another name."""
    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax", "l_linestatus", "l_returnflag")
    told = [(F.col("l_returnflag") != "R").alias("held"), (F.col("l_tax") > 0.06).alias("solo"), (F.col("l_linestatus") == "F").alias("bass")]
    lines = items.select(F.col("l_orderkey").alias("piece_id"), "l_partkey", "l_suppkey", "l_linenumber", *told)
    both = lines.join(load(spark, sf_dir, "part", "p_partkey", "p_type", "p_brand", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    size, label, role = F.col("p_size"), F.col("p_type").alias("label"), F.when(F.col("solo"), "solo").otherwise("section").alias("role")
    marked = lambda x: F.when(x % 4 == 1, "F").when(x % 4 == 2, "Eb").alias("transposition")
    slot = F.struct("pos", F.col("p_type").alias("canonical"), F.when(size % 3 != 0, size % 3).alias("part_index"), label, role, marked(size), F.array("p_brand").alias("equivalents"))
    shared = [label, F.when(F.col("bass"), "bass").otherwise("treble").alias("clef"), marked(F.col("l_linenumber")), role]
    part = lambda name, index: F.struct("part", name.alias("canonical"), index.alias("part_index"), *shared)
    own = F.when(size % 7 == 0, F.col("p_brand")).otherwise(F.col("p_type"))
    second = F.element_at(F.array(*[F.lit(x) for x in ("PROMO", "SMALL", "LARGE", "ECONOMY")]), F.col("l_suppkey").cast("int") % 4 + 1)
    doubled = F.when((size % 5 == 0) & (second != own), part(second, F.lit(None).cast("int")))
    return _sides(both, tasks_for(items), slot, part(own, F.when(size % 2 == 0, 1 + F.col("l_linenumber") % 2)), doubled)


@query()
def slot_component_match(spark, sf_dir):
    """The whole matching over every order: editions, keys, solos, doublings, stand-ins. SQL would have to fold each
    component step by step; tests hold it against a plain version over whole pieces."""
    slots, held = editions_and_doublings(spark, sf_dir)
    return R.reconcile(slots, held, INTERCHANGED, USUAL_KEY, tasks_for(load(spark, sf_dir, "lineitem")))


@query(
    """WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN s_nationkey = p_size % 25 AND l_linestatus = 'F' THEN 1 WHEN s_nationkey = p_size % 25 THEN 2 WHEN l_linestatus = 'F' THEN 3 ELSE 4 END AS level
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)
SELECT l_orderkey, min(level)::INT AS level, count(*) FILTER (level = b) AS links FROM (SELECT *, min(level) OVER (PARTITION BY l_orderkey) AS b FROM m) GROUP BY l_orderkey"""
)
def fallback_chain_link(spark, sf_dir):
    """Links at the best of four levels of match."""
    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linestatus")
    both = items.join(load(spark, sf_dir, "part", "p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey")).join(load(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    same, done = F.col("s_nationkey") == F.col("p_size") % 25, F.col("l_linestatus") == "F"
    level = F.when(same & done, 1).when(same, 2).when(done, 3).otherwise(4)
    counts = both.groupBy("l_orderkey", level.alias("level")).agg(F.count("*").alias("links"))
    best = counts.groupBy("l_orderkey").agg(F.min(F.struct("level", "links")).alias("m"))
    return best.select("l_orderkey", "m.level", "m.links")


@query(
    """SELECT l_orderkey, p_type AS signature, l_returnflag AS clef, count(*) AS count, min(l_discount) AS min_confidence, max(l_discount) AS max_confidence, bool_or(l_tax > 0.07) AS needs_review
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey, p_type, l_returnflag"""
)
def observed_grouping(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_discount", "l_tax")
    both = items.join(load(spark, sf_dir, "part", "p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    none = F.lit(None).cast("string")
    parts = both.select("l_orderkey", F.col("p_type").alias("signature"), F.col("l_returnflag").alias("clef"), none.alias("transposition"), F.lit("section").alias("part_role"), F.col("l_discount").alias("confidence"), (F.col("l_tax") > 0.07).alias("needs_review"), F.col("p_type").alias("label"), F.col("l_linenumber").alias("pos"))
    return A.observed_groups(parts, "l_orderkey").select("l_orderkey", "signature", "clef", "count", "min_confidence", "max_confidence", "needs_review")


@query("SELECT o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'")
def flatten_nested(spark, sf_dir):
    """Orders with nested line items, flattened again to a row each."""
    items = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("items"))
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").where("o_orderstatus = 'O'")
    nested = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "items")
    return C.flattened(nested, "items", "o_orderkey")


@query(
    """SELECT event_id, user_id, CASE WHEN p.fp = e.fp THEN 'reused' ELSE 'processed' END AS decision FROM
(SELECT *, 'sha256:' || sha256(concat_ws('|', event_id::VARCHAR, event_type)) AS fp FROM events) e
LEFT JOIN (SELECT event_id AS k, 'sha256:' || sha256(concat_ws('|', event_id::VARCHAR, event_type)) AS fp FROM events WHERE ts < TIMESTAMP '2024-01-16') p ON p.k = e.event_id"""
)
def reuse_split(spark, sf_dir):
    """Rows whose fingerprint an earlier run (the first half of the month) has seen are reused."""
    events = load(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    current = events.withColumn("fingerprint", N.sha256_tagged(F.concat_ws("|", F.col("event_id").cast("string"), "event_type")))
    prior = current.where("ts < timestamp'2024-01-16 00:00:00'").select("event_id", "fingerprint", F.lit("1.0").alias("record_version"))
    kept, to_do = J.reuse_split(current, prior, "event_id", "1.0")
    return kept.withColumn("decision", F.lit("reused")).unionByName(to_do.withColumn("decision", F.lit("processed"))).select("event_id", "user_id", "decision")


@query("SELECT user_id, CASE WHEN user_id = 5 THEN 'process' WHEN EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.ts < TIMESTAMP '2024-01-02') THEN 'reuse' ELSE 'process' END AS decision FROM (SELECT DISTINCT user_id FROM events) e")
def single_piece_scope(spark, sf_dir):
    from foliant.streaming.incremental import scoped

    events = load(spark, sf_dir, "events", "user_id", "ts")
    prior = events.where("ts < timestamp'2024-01-02 00:00:00'").select("user_id")
    return scoped(events.select("user_id").distinct(), "user_id", 5, prior, "user_id").select("user_id", "decision")


@query("SELECT event_type AS version, count(*) AS n, event_type NOT IN ('click', 'view') AS unexpected FROM events GROUP BY event_type")
def version_distribution(spark, sf_dir):
    counts = load(spark, sf_dir, "events", "event_type").groupBy(F.coalesce("event_type", F.lit("unknown")).alias("version")).agg(F.count("*").alias("n"))
    return counts.withColumn("unexpected", ~F.col("version").isin("click", "view"))


@query("SELECT event_id, (props::JSON ->> '$.k')::INT AS k FROM events")
def sentinel_json(spark, sf_dir):
    """JSON between sentinels, with a comma too many, parsed."""
    wrapped = F.concat(F.lit("noise <<<"), F.regexp_replace("props", r"\}", ",}"), F.lit(">>> noise"))
    events = load(spark, sf_dir, "events", "event_id", "props")
    return events.select("event_id", F.from_json(X.sentinel_json(wrapped, "<<<", ">>>"), "k int")["k"].alias("k"))


@query(
    """SELECT event_id, CASE WHEN value / 100.0 >= 0.9 THEN 'high' WHEN value / 100.0 >= 0.75 THEN 'medium' WHEN value > 0 THEN 'low' ELSE 'none' END AS tier,
  (value * 10 + 45) - floor((value * 10 + 45) / 90) * 90 - 45 AS skew, left(sha256(event_type || '/' || event_id::VARCHAR), 16) AS short_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp, least(50.0, greatest(5.0, value)) AS clamped FROM events"""
)
def scalars_misc(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    v = F.col("value")
    return events.select("event_id", N.confidence_tier(v / 100.0).alias("tier"), N.fold_skew(v * 10).alias("skew"), N.short_id(F.concat("event_type", F.lit("/"), F.col("event_id").cast("string"))).alias("short_id"), N.utc_text(F.col("ts")).alias("stamp"), N.clamp(v, 5.0, 50.0).alias("clamped"))


@query(
    """SELECT p_partkey, regexp_extract(p_brand, '#([0-9]{1,2})', 1)::INT AS part_index, replace(p_name, ' ', '_') AS snake, '1-' || lpad(p_size::VARCHAR, 3, '0') || '-00-0' AS sort_key, upper(left(p_name, 1)) AS initial FROM part"""
)
def part_scalars(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    none = F.lit(None).cast("int")
    key = N.part_sort_key(F.col("p_size"), none, none, F.lit(False), none)
    return part.select("p_partkey", X.part_index(F.col("p_brand")).alias("part_index"), X.snake_case(F.col("p_name")).alias("snake"), key.alias("sort_key"), F.substring(X.display_name(X.snake_case(F.col("p_name"))), 1, 1).alias("initial"))


@query(
    """SELECT * FROM ((SELECT 'customer' AS grp, 0 AS ord, c_custkey::VARCHAR AS id, c_name AS label FROM customer WHERE contains(lower(c_name), '00000001') OR contains(lower(c_mktsegment), '00000001') ORDER BY c_custkey LIMIT 8)
UNION ALL (SELECT 'part', 1, p_partkey::VARCHAR, p_name FROM part WHERE contains(lower(p_name), '00000001') ORDER BY p_partkey LIMIT 8)
UNION ALL (SELECT 'supplier', 2, s_suppkey::VARCHAR, s_name FROM supplier WHERE contains(lower(s_name), '00000001') ORDER BY s_suppkey LIMIT 8))"""
)
def global_search(spark, sf_dir):
    return J.search(_searched(spark, sf_dir), "00000001", 8)


def _searched(spark, sf_dir):
    return [("customer", load(spark, sf_dir, "customer"), "c_custkey", ["c_name", "c_mktsegment"]), ("part", load(spark, sf_dir, "part"), "p_partkey", ["p_name"]), ("supplier", load(spark, sf_dir, "supplier"), "s_suppkey", ["s_name"])]


_NEEDLES = ("00000001", "mid", "Ri", "7", "MACH", "nowhere", "#0000")


@query(
    " UNION ALL ".join(
        f"""SELECT '{n}' AS needle, * FROM ((SELECT 'customer' AS grp, 0 AS ord, c_custkey::VARCHAR AS id, c_name AS label FROM customer WHERE contains(lower(c_name), lower('{n}')) OR contains(lower(c_mktsegment), lower('{n}')) ORDER BY c_custkey LIMIT 8)
UNION ALL (SELECT 'part', 1, p_partkey::VARCHAR, p_name FROM part WHERE contains(lower(p_name), lower('{n}')) ORDER BY p_partkey LIMIT 8)
UNION ALL (SELECT 'supplier', 2, s_suppkey::VARCHAR, s_name FROM supplier WHERE contains(lower(s_name), lower('{n}')) ORDER BY s_suppkey LIMIT 8))"""
        for n in _NEEDLES
    )
)
def indexed_search(spark, sf_dir):
    """The same search through an index of runs of characters, for long and short needles."""
    groups, path = _searched(spark, sf_dir), new_folder(spark, "runs")
    write_index(groups, path, 16)
    parts = [search_index(groups, path, n, 8, 16).select(F.lit(n).alias("needle"), "grp", "ord", "id", "label") for n in _NEEDLES]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_nationkey IN (1, 2, 3) ORDER BY s_acctbal DESC NULLS LAST, s_suppkey LIMIT 20")
def filter_sort_limit(spark, sf_dir):
    rows = P.declared(load(spark, sf_dir, "supplier"), {"s_nationkey": [1, 2, 3]})
    return rows.orderBy(F.desc_nulls_last("s_acctbal"), "s_suppkey").limit(20).select("s_suppkey", "s_name", "s_acctbal")


@query("SELECT DISTINCT nk FROM (SELECT c_nationkey AS nk FROM customer UNION ALL SELECT s_nationkey FROM supplier)")
def universe_union(spark, sf_dir):
    c = load(spark, sf_dir, "customer", F.col("c_nationkey").alias("nk"))
    return c.unionByName(load(spark, sf_dir, "supplier", F.col("s_nationkey").alias("nk"))).distinct()


@query("SELECT DISTINCT c_nationkey AS nk FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def set_difference(spark, sf_dir):
    rich = load(spark, sf_dir, "supplier", "s_nationkey", "s_acctbal").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("nk"))
    return load(spark, sf_dir, "customer", F.col("c_nationkey").alias("nk")).subtract(rich)


@query("SELECT vec_id, len(embedding)::INT AS dims, round(list_max(embedding)::DOUBLE, 4) AS top, list_position(embedding, list_max(embedding))::BIGINT AS at FROM embeddings")
def array_functions(spark, sf_dir):
    e = F.col("embedding")
    return load(spark, sf_dir, "embeddings", "vec_id", "embedding").select("vec_id", F.size(e).alias("dims"), F.round(F.array_max(e).cast("double"), 4).alias("top"), F.array_position(e, F.array_max(e)).alias("at"))
