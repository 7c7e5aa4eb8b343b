"""Secrets, with corpus-wide ownership frequency. DataFrame functions only.

Fixed patterns find assignments, access keys and long hex strings; besides them, long mixed tokens are candidates.
All candidate values are hashed, and for each hash the corpus tells how many documents, repositories and owners hold
it, and how many of the documents and repositories are those of its foremost owner. The product of these two shares is
the value's specificity: 1 for one owner's, 1/4 for one that two owners share evenly, little for a copied example.
Every span gets a verdict: `copied` where the specificity is a half or less, else `live` where the value looks random
and `plain` where it doesn't. Live tokens without a telling name are added to the spans as kind `live`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import table, written
from foliant.llm.spans import joined, overlaps_sorted, with_matches

PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32,}+",
    "live": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+",
}
BASE = ("assign", "access", "hex")
VALUE_LENGTH, ACCESS_LENGTH = 8, 16
DISTINCT_CHARACTERS = 10  #: a random-looking value has so many
RUNS = 6  #: and changes so often between lower case, upper case and digits


def live_looking(value: Column) -> Column:
    """Random-looking: many different characters, letters and digits that take turns."""
    kinds, runs = F.size(F.array_distinct(F.split(value, ""))), F.size(F.regexp_extract_all(value, F.lit("[a-z]+|[A-Z]+|[0-9]+"), F.lit(0)))
    return (kinds >= DISTINCT_CHARACTERS) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (runs >= RUNS)


def scan(docs: DataFrame, owner: str, repo: str) -> DataFrame:
    """One row for each row of docs: rid, doc_id, owner, repo, base spans (by start, then kind) and `live`
    candidates outside them. Null texts count as empty."""
    text = docs.select("doc_id", F.col(owner).alias("owner"), F.col(repo).alias("repo"), F.coalesce("text", F.lit("")).alias("t"))
    colon = F.col("t").contains("=") | F.col("t").contains(":")
    found = with_matches(text, "t", PATTERNS, {"assign": colon, "access": F.col("t").contains("AKIA")})
    value = lambda x: F.regexp_extract(x["m"], PATTERNS["assign"], 1)
    span = lambda kind, k, v: lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind"), v(x).alias("v"))
    whole = lambda x: x["m"]
    base = F.concat(
        F.filter(F.transform("assign_hits", span("assign", 0, value)), lambda x: F.length(x["v"]) >= VALUE_LENGTH),
        F.filter(F.transform("access_hits", span("access", 1, whole)), lambda x: F.length(x["v"]) >= ACCESS_LENGTH),
        F.transform("hex_hits", span("hex", 2, whole)),
    )
    ends = [F.transform(f"{k}_hits", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(f"{k}_at") for k in ("access", "hex")]
    named = F.filter(F.transform("assign_hits", span("assign", 0, value)), lambda x: F.length(x["v"]) >= VALUE_LENGTH).alias("assign_at")
    held = found.select("doc_id", "owner", "repo", F.array_sort(base).alias("base"), "live_hits", named, *ends)
    mixed = F.filter("live_hits", lambda x: live_looking(x["m"]) & ~overlaps_sorted(x, [f"{k}_at" for k in BASE]))
    return held.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "owner", "repo", "base", F.transform(mixed, span("live", 3, whole)).alias("candidates")
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """(h, n_docs, n_repos, n_owners, top_docs, top_repos) of candidate rows (h, rid, repo, owner); the foremost owner
    is that of most documents, then of most repositories. Aggregated step by step, so that a value that a third of all
    rows hold is counted in every task first and is nowhere gathered. Null owners count as one owner, null repositories
    as one."""
    by_repo = candidates.groupBy("h", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("h", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    top = F.max(F.struct("n", "repos"))
    total = by_owner.groupBy("h").agg(F.sum("n").alias("n_docs"), F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"), top.alias("top"))
    return total.select("h", "n_docs", "n_repos", "n_owners", F.col("top.n").alias("top_docs"), F.col("top.repos").alias("top_repos"))


def specific() -> Column:
    """Whether the specificity is above a half (in doubles: counts of copies in a corpus may be large)."""
    return F.col("top_docs").cast("double") / F.col("n_docs") * (F.col("top_repos").cast("double") / F.col("n_repos")) > 0.5


def find_secrets(docs: DataFrame, owner: str = "owner", repo: str = "repo") -> DataFrame:
    """Per row of docs: doc_id, base spans, all spans and verdicts (arrays of s, k, e, kind; the latter with the
    verdict of each of all spans).

    Null and empty texts have none; repeated rows each have theirs, and count; a null owner or repository is an owner or
    repository of its own; very long texts and texts of very many spans are read whole, in proportion to their length;
    extra columns, whatever their names, are left behind. Empty table: no rows."""
    rows = written(scan(docs, owner, repo), "secrets")
    every = F.explode(F.concat("base", "candidates")).alias("x")
    each = rows.select("rid", "owner", "repo", every).select("rid", "owner", "repo", "x", F.sha2("x.v", 256).alias("h"))
    # a value counts once for each row that holds it
    known = written(ownership(each.select("rid", "owner", "repo", "h").distinct()).where(specific()).select("h", F.lit(True).alias("own")), "owners")
    looked = each.select("rid", "h", *[F.col(f"x.{c}").alias(c) for c in ("s", "k", "e", "kind")], live_looking(F.col("x.v")).alias("random"))
    verdict = F.when(~F.coalesce("own", F.lit(False)), "copied").when(F.col("random"), "live").otherwise("plain").alias("verdict")
    judged = looked.join(known, "h", "left").select("rid", F.struct("s", "k", "e", "kind", verdict).alias("x")).where((F.col("x.kind") != "live") | (F.col("x.verdict") == "live"))
    by_row = judged.groupBy("rid").agg(F.array_sort(F.collect_list("x")).alias("spans"))
    plain = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["kind"].alias("kind")))
    both = rows.join(by_row, "rid", "left").select("doc_id", plain.alias("base"), "spans")
    return both.select("doc_id", "base", F.coalesce("spans", F.array().cast(both.schema["spans"].dataType)).alias("spans"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every row of documents, and the verdict of each span: find_secrets() says what odd rows give.
    Documents have a source, taken as the owner; an owner's documents of one language are a repository."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("repo"))
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    live = F.size(F.filter("spans", lambda x: x["verdict"] == "live")).cast("long").alias("n_live")
    verdicts = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"), x["verdict"])), ",")
    return find_secrets(docs, "source", "repo").select(
        "doc_id", *[n(k) for k in BASE], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), verdicts.alias("verdicts"), live
    )


def _hits_sql(kind: str, k: int, pattern: str, value: str) -> str:
    pattern = pattern.replace("'", "''")
    total = lambda x: f"coalesce(list_sum(list_transform({x}, lambda y: length(y))), 0)"
    return f"""SELECT n, source, repo, '{kind}' AS kind, {k} AS k, ({total("p[1:i]")} + {total("m[1:i - 1]")})::BIGINT AS s, ({total("p[1:i]")} + {total("m[1:i]")})::BIGINT AS e, {value} AS v
FROM (SELECT n, source, repo, p, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT n, source, repo, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS m FROM d))"""


_ASSIGN_SQL = PATTERNS["assign"].replace("'", "''")
_TEXT_SQL = "array_to_string(list_transform({}, lambda x: x.kind || ':' || x.s || ':' || x.e), ',')"

#: The same rows in DuckDB's SQL, whose patterns need no looking around: each match takes its whole run.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, source, concat_ws('/', source, lang) AS repo, coalesce(text, '') AS t FROM documents),
base AS (SELECT * FROM ({_hits_sql("assign", 0, PATTERNS["assign"], f"regexp_extract(m[i], '{_ASSIGN_SQL}', 1)")}) WHERE length(v) >= {VALUE_LENGTH}
  UNION ALL SELECT * FROM ({_hits_sql("access", 1, "AKIA[A-Z0-9]+", "m[i]")}) WHERE length(v) >= {ACCESS_LENGTH}
  UNION ALL {_hits_sql("hex", 2, "[0-9a-f]{32,}", "m[i]")}),
tokens AS ({_hits_sql("live", 3, "[A-Za-z0-9+/_=-]{20,}", "m[i]")}),
every AS (SELECT *, len(list_distinct(string_split(v, ''))) >= {DISTINCT_CHARACTERS} AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(regexp_extract_all(v, '[a-z]+|[A-Z]+|[0-9]+')) >= {RUNS} AS random
  FROM (SELECT * FROM base UNION ALL SELECT * FROM tokens o WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.n = o.n AND b.s < o.e AND o.s < b.e))),
kept AS (SELECT * FROM every WHERE kind <> 'live' OR random),
by_owner AS (SELECT v, source, count(DISTINCT coalesce(repo, '')) AS repos, count(DISTINCT n) AS docs FROM kept GROUP BY v, source),
owned AS (SELECT v, sum(docs) AS docs, sum(repos) AS repos, max({{'docs': docs, 'repos': repos}}) AS top FROM by_owner GROUP BY v),
judged AS (SELECT kept.*, CASE WHEN NOT top.docs / docs * (top.repos / repos) > 0.5 THEN 'copied' WHEN random THEN 'live' ELSE 'plain' END AS verdict FROM kept JOIN owned USING (v)),
told AS (SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (verdict = 'live') AS n_live,
  list({{'kind': kind, 's': s, 'e': e}} ORDER BY s, k) FILTER (kind <> 'live') AS b, list({{'kind': kind, 's': s, 'e': e, 'verdict': verdict}} ORDER BY s, k) FILTER (kind <> 'live' OR verdict = 'live') AS a FROM judged GROUP BY n)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_live, 0) AS n_live,
  sha256(coalesce({_TEXT_SQL.format("b")}, '')) AS base_sha256, coalesce({_TEXT_SQL.format("a")}, '') AS spans,
  coalesce(array_to_string(list_transform(a, lambda x: x.kind || ':' || x.s || ':' || x.e || ':' || x.verdict), ','), '') AS verdicts FROM d LEFT JOIN told USING (n)"""
