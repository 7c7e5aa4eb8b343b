"""Registered queries that write with each sink and read back with each source, in a folder of their own."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.plans import reports
from foliant.plans.registry import query
from foliant.plans.tables import load, tasks_for
from foliant.sources import readers, sinks
from foliant.sources.scratch import new_folder


@query(
    """SELECT 'r_name=' || r_name AS piece_folder, left(sha256('r_name=' || r_name), 16) AS piece_id, count(*) AS files, sum(strlen(r_regionkey || '') + 1)::BIGINT AS file_size_bytes, true AS named FROM region GROUP BY r_name"""
)
def library_scan(spark, sf_dir):
    """Files of a library of folders, with their pieces' ids."""
    folder = new_folder(spark, "library")
    load(spark, sf_dir, "region", "r_name", F.col("r_regionkey").cast("string").alias("v")).repartition("r_name").write.partitionBy("r_name").text(folder)
    files = readers.scan_library(spark, folder, "txt")
    return files.groupBy("piece_folder", "piece_id").agg(F.count("*").alias("files"), F.sum("file_size_bytes").alias("file_size_bytes"), F.bool_and(F.endswith("pdf_filename", F.lit(".txt"))).alias("named"))


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN -1 ELSE s_suppkey % 5 END::INT AS page_count, s_suppkey % 4 > 0 AND s_suppkey % 5 > 0 AS pdf_readable, s_suppkey % 3 = 0 AS is_encrypted, s_suppkey % 4 > 0 AND s_suppkey % 5 = 0 AS is_zero_page,
  s_suppkey % 4 = 0 OR s_suppkey % 7 = 0 AS is_malformed, CASE WHEN s_suppkey % 4 = 0 THEN 'no PDF header' END AS error_message, CASE WHEN s_suppkey % 4 > 0 THEN 'Title ' || s_suppkey END AS title FROM supplier"""
)
def health_probe(spark, sf_dir):
    """What documents' bytes tell: pages, encryption, damage and metadata."""
    k = F.col("s_suppkey")
    title = F.concat(F.lit("/Title (Title "), k.cast("string"), F.lit(") "))
    body = F.concat(F.when(k % 4 == 0, "junk").otherwise(F.concat(F.lit("%PDF-1.4 "), title)), F.repeat(F.lit("/Type /Page "), (k % 5).cast("int")), F.lit("/Type /Pages "), F.when(k % 3 == 0, "/Encrypt ").otherwise(""), F.when(k % 7 == 0, "").otherwise("%%EOF"))
    files = load(spark, sf_dir, "supplier", "s_suppkey").withColumn("content", body.cast("binary"))
    return readers.probe_documents(files).select("s_suppkey", "health.page_count", "health.pdf_readable", "health.is_encrypted", "health.is_zero_page", "health.is_malformed", "health.error_message", "health.title")


@query(
    """SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i)::INT AS page_num, length(t)::INT AS chars, 'success' AS status FROM (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE doc_id % 10 > 0))
UNION ALL SELECT doc_id, NULL, NULL, 'error' FROM documents WHERE doc_id % 10 = 0"""
)
def page_reader(spark, sf_dir):
    """Pages by an injected extractor; a document that fails gives one row."""

    def extract(content):
        if content.startswith(b"!"):
            raise ValueError("unreadable")
        for n, line in enumerate(content.decode().split("\n")):
            yield {"page_num": n + 1, "chars": len(line)}

    text = F.when(F.col("doc_id") % 10 == 0, "!").otherwise(F.col("text"))
    files = load(spark, sf_dir, "documents", "doc_id", "text").select(F.col("doc_id").cast("string").alias("pdf_path"), text.cast("binary").alias("content"))
    rows = readers.read_pages(files, extract, "pdf_path string, page_num int, chars int, processing_status string, error_message string")
    return rows.select(F.col("pdf_path").cast("long").alias("doc_id"), "page_num", "chars", F.col("processing_status").alias("status"))


@query(
    """SELECT s_suppkey, (s_suppkey % 7)::DOUBLE / 9 AS text_density, (s_suppkey % 7)::DOUBLE / (9 - s_suppkey % 7) AS ratio, CASE WHEN s_suppkey % 7 >= 6 THEN 1 ELSE (CASE WHEN s_suppkey % 7 >= 2 THEN 1 ELSE 0 END) END AS lines,
  round(127.5 * 2 * sqrt((s_suppkey % 7) * (9 - s_suppkey % 7)) / 9, 4) AS contrast, 0.0::DOUBLE AS blur FROM supplier"""
)
def raster_metrics(spark, sf_dir):
    """Ink, contrast, sharpness and rows of ink of small rasters."""
    from foliant.operators.plugins import pixel_metrics

    n = F.col("s_suppkey") % 7
    raster = F.unhex(F.concat(F.repeat(F.lit("00"), n.cast("int")), F.repeat(F.lit("ff"), (9 - n).cast("int"))))
    rows = load(spark, sf_dir, "supplier", "s_suppkey").select("s_suppkey", raster.alias("raster"), F.lit(3).alias("width"), F.lit(3).alias("height"))
    out = pixel_metrics(rows, "s_suppkey")
    exact = lambda c, of: F.round(F.col(c) * of, 3) / of
    return out.select("s_suppkey", exact("text_density", 9).alias("text_density"), (n / (9 - n)).alias("ratio"), F.col("staff_line_count").alias("lines"), F.col("contrast_std").alias("contrast"), F.col("blur_variance").alias("blur"))


@query(
    """WITH r AS (SELECT s_suppkey, unhex(repeat('00', (s_suppkey % 5)::INT) || repeat('ff', (12 - s_suppkey % 5)::INT)) AS raw FROM supplier)
SELECT s_suppkey, CASE WHEN s_suppkey % 7 > 0 THEN left(sha256(raw), 2) || '/' || sha256(raw) || '.png' END AS path, CASE WHEN s_suppkey % 7 > 0 THEN sha256(raw) END AS hash, CASE WHEN s_suppkey % 7 > 0 THEN 2 END AS thumb_width, CASE WHEN s_suppkey % 7 > 0 THEN 'success' ELSE 'error: ValueError' END AS status,
  CASE WHEN s_suppkey % 7 > 0 THEN true END AS there FROM r"""
)
def raster_cache(spark, sf_dir):
    """Rasters in a cache addressed by their content, and their thumbnails; a damaged raster is an error row."""
    from foliant.sources.rasters import write_rasters

    folder, k = new_folder(spark, "rasters"), F.col("s_suppkey")
    raw = F.unhex(F.concat(F.repeat(F.lit("00"), (k % 5).cast("int")), F.repeat(F.lit("ff"), (12 - k % 5).cast("int"))))
    pages = load(spark, sf_dir, "supplier", "s_suppkey").select("s_suppkey", raw.alias("raster"), F.when(k % 7 > 0, 4).otherwise(5).alias("width"), F.lit(3).alias("height"))
    whole, thumbs = (write_rasters(pages, "s_suppkey", folder, edge) for edge in (None, 2))
    both = whole.join(thumbs.select("s_suppkey", F.col("width").alias("thumb_width"), F.col("path").alias("thumb")), "s_suppkey")
    return both.select("s_suppkey", "path", "hash", "thumb_width", "status", F.when(F.col("path").isNotNull(), F.col("thumb") == F.concat(F.substring("path", 1, 3), "hash", F.lit("-2.png"))).alias("there"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 5 > 0"""
)
def jsonl_round_trip(spark, sf_dir):
    """JSON lines written and read: damaged lines are left out, values of another type are null."""
    k = F.col("o_orderkey")
    folder = new_folder(spark, "jsonl")
    value = F.when(k % 3 == 0, F.lit('"x"')).otherwise(F.col("o_custkey").cast("string"))
    good = F.concat(F.lit('{"o_orderkey": '), k.cast("string"), F.lit(', "o_custkey": '), value, F.lit(', "o_orderstatus": "'), F.col("o_orderstatus"), F.lit('"}'))
    bad = F.element_at(F.array(F.lit(""), F.lit("not json"), F.lit("[1]")), (k % 3 + 1).cast("int"))
    sinks.write_text(load(spark, sf_dir, "orders").select(F.when(k % 5 > 0, good).otherwise(bad).alias("line")), "line", f"{folder}/lines")
    sinks.write_jsonl(readers.read_jsonl(spark, f"{folder}/lines", "o_orderkey long, o_custkey long, o_orderstatus string"), f"{folder}/again")
    return readers.read_jsonl(spark, f"{folder}/again", "o_orderkey long, o_custkey long, o_orderstatus string")


@query("SELECT count(*) AS pieces, sum(c_nationkey)::BIGINT AS total, 'second' AS note FROM customer")
def json_object(spark, sf_dir):
    """A small summary written twice in one place and read back."""
    path = f"{new_folder(spark, 'object')}/summary.json"
    t = load(spark, sf_dir, "customer").agg(F.count("*").alias("pieces"), F.sum("c_nationkey").alias("total"))
    for note in ("first", "second"):
        sinks.write_object(t.select("*", F.lit(note).alias("note")).toJSON().first(), path, spark)
    return readers.read_json_object(spark, path, "pieces long, total long, note string")


@query(
    """SELECT 'record' AS kind, n_nationkey AS id, n_name AS label FROM nation WHERE n_nationkey % 5 > 0 AND n_regionkey IN (0, 1) UNION ALL SELECT 'skipped', count(*), '' FROM nation WHERE n_nationkey % 5 = 0 AND n_regionkey IN (0, 1) UNION ALL SELECT 'pruned', r_regionkey, '' FROM region WHERE r_regionkey > 1"""
)
def json_folder(spark, sf_dir):
    """One folder a key, pruned of the keys that are gone; objects without their key are skipped."""
    folder = new_folder(spark, "folder")
    name = F.when(F.col("n_nationkey") % 5 > 0, F.col("n_nationkey"))
    sinks.write_per_key(load(spark, sf_dir, "nation").select("n_regionkey", name.alias("piece"), F.col("n_name").alias("label")), "n_regionkey", folder)
    gone = sinks.prune(folder, "n_regionkey", load(spark, sf_dir, "region").where("r_regionkey <= 1").select(F.col("r_regionkey").alias("n_regionkey")))
    rows = spark.read.option("basePath", folder).json(folder, schema="piece long, label string, n_regionkey int")
    lines = new_folder(spark, "objects")
    rows.select("piece", "label").write.option("maxRecordsPerFile", 1).json(lines)
    records, skipped = readers.read_json_folder(spark, lines, "piece long, label string", "piece")
    lost = spark.createDataFrame([("pruned", int(g), "") for g in gone], "kind string, id long, label string")
    return records.select(F.lit("record").alias("kind"), F.col("piece").alias("id"), "label").union(skipped.select(F.lit("skipped"), "skipped", F.lit(""))).union(lost)


@query(
    """SELECT user_id, event_type AS last_type, 'fp' || user_id AS fingerprint FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""
)
def checkpointed_results(spark, sf_dir):
    """Earlier results, the last of each key, with the fingerprints of a checkpoint of the same version."""
    folder = new_folder(spark, "checkpoint")
    events = load(spark, sf_dir, "events", "user_id", "event_id", "event_type")
    prints = events.select(F.col("user_id").alias("key")).distinct().withColumn("fingerprint", F.concat(F.lit("fp"), F.col("key").cast("string")))
    sinks.write_checkpoint(prints, "one", "1.0", "run", folder)
    sinks.write_checkpoint(prints.withColumn("fingerprint", F.lit("old")), "two", "0.9", "run", folder)
    stages = [readers.checkpoint_of(readers.read_checkpoint(spark, folder, s), "1.0") for s in ("one", "two")]
    known = stages[0].union(stages[1])
    last = readers.prior_results(events, "user_id", "event_id")
    return last.join(known, F.col("user_id") == F.col("key")).select("user_id", F.col("event_type").alias("last_type"), "fingerprint")


@query(
    """WITH names AS (SELECT DISTINCT replace(p_name, ' ', '_') AS canonical, p_name AS alias, string_split(p_name, ' ')[2] AS family FROM part), brands AS (SELECT DISTINCT p_brand, p_mfgr FROM part)
SELECT 'alias' AS kind, canonical AS key, alias || '/' || family || '/' || coalesce(CASE WHEN family = 'ring' THEN 'round' END, family) AS value FROM names UNION ALL SELECT 'alias', canonical, 'the ' || alias || '/' || family || '/' || coalesce(CASE WHEN family = 'ring' THEN 'round' END, family) FROM names
UNION ALL SELECT DISTINCT 'transposition_markers', p_type, 'in ' || lower(p_type) FROM part UNION ALL SELECT 'interchangeable', '0', canonical FROM names WHERE family = 'ring' UNION ALL SELECT 'clef_markers', 'treble', 'tc'
UNION ALL SELECT 'setting', 'sizes.largest', max(p_size)::VARCHAR FROM part UNION ALL SELECT 'setting', 'sizes.least', '1' UNION ALL SELECT 'prompt', 'file', 'Find {title} among ' || count(*) FROM part"""
)
def dictionaries(spark, sf_dir):
    """A dictionary, settings and a prompt, made of a table's distinct values, written as YAML and text, overlaid on
    defaults key by key as they are read back."""
    import yaml

    part, folder = load(spark, sf_dir, "part"), new_folder(spark, "dictionary")
    names = part.select("p_name").distinct()
    given: dict = {"instruments": {}, "transposition_markers": {}, "interchangeable": [[]]}
    for row in sorted(readers.few(names)):
        family = row.p_name.split(" ")[1]
        given["instruments"].setdefault(family, {})[row.p_name.replace(" ", "_")] = [row.p_name.title(), "The-" + row.p_name]
        if family == "ring":
            given["interchangeable"][0].append(row.p_name.replace(" ", "_"))
    given["transposition_markers"] = {f"In {r.p_type}": r.p_type for r in readers.few(part.select("p_type").distinct())}
    whole = part.agg(F.max("p_size").alias("largest"), F.count("*").alias("n")).first()
    sinks.write_object(yaml.safe_dump(given), f"{folder}/names.yaml", spark)
    sinks.write_object(yaml.safe_dump({"sizes": {"largest": whole.largest, "least": None, "unknown": 1}, "other": 2}), f"{folder}/settings.yaml", spark)
    sinks.write_object(f"Find {{title}} among {whole.n}", f"{folder}/prompt.txt", spark)
    data = readers.merged_lexicon({"sections": {"round": [r.p_name.replace(" ", "_") for r in readers.few(names.where("p_name like '% ring'"))]}, "clef_markers": {"TC": "treble"}}, f"{folder}/names.yaml", spark)
    aliases = readers.lexicon(spark, data).select(F.lit("alias").alias("kind"), F.col("canonical").alias("key"), F.concat_ws("/", "alias", "family", "section").alias("value"))
    marks = readers.markers(spark, data).select("kind", F.col("value").alias("key"), F.col("marker").alias("value"))
    settings = readers.merged_settings({"sizes": {"largest": 0, "least": 1}}, f"{folder}/settings.yaml", spark)
    rest = [("setting", f"{a}.{b}", str(v)) for a, x in settings.items() for b, v in x.items()] + [("prompt", "file", readers.prompt_template(f"{folder}/prompt.txt", "none", spark))]
    return aliases.union(marks).union(spark.createDataFrame(rest, "kind string, key string, value string"))


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'old ' || c_custkey WHEN c_nationkey % 3 = 1 THEN 'March (band)' || chr(10) || chr(10) || 'section 2 of March' END AS text, CASE WHEN c_nationkey % 3 = 0 THEN 'cached' WHEN c_nationkey % 3 = 1 THEN 'success' ELSE 'not_found' END AS status FROM customer"""
)
def wiki_lookup(spark, sf_dir):
    """Texts of works from an injected wiki: cached ones first, then by variations of the title."""

    def get(params, seconds):
        if params["action"] == "opensearch":
            return ["", []]
        if params["action"] == "query":
            return {"query": {"search": [{"title": "March (band)"}] if params["srsearch"] == "March" else []}}
        if params["prop"] == "sections":
            return {"parse": {"sections": [{"line": "Instrumentation", "index": 2}]}}
        return {"parse": {"wikitext": {"*": f"section {params['section']} of March"}}}

    k = F.col("c_nationkey") % 3
    pieces = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.when(k == 1, "The March").otherwise("unknown").alias("title"), F.lit("").alias("folder"))
    cache = pieces.where(k == 0).select("c_custkey", F.concat(F.lit("old "), F.col("c_custkey").cast("string")).alias("text"))
    return readers.looked_up(pieces, "c_custkey", get, cache)


@query("""SELECT r_name AS key, r_name || ' said' AS answer, 'success' AS status, CASE WHEN r_regionkey % 2 = 0 THEN 'http://a/' || r_regionkey || '.png;https://b/x.JPG' ELSE '' END AS urls FROM region""")
def command_lookup(spark, sf_dir):
    """A program's answers between sentinels, and the images' addresses in a text, each once."""
    from foliant.functions.text import sentinel_json

    prompt = F.concat(F.lit('noise <<<{"key": "'), "r_name", F.lit('",}>>> noise'))
    region = load(spark, sf_dir, "region")
    said = readers.fetched(region.select(prompt.alias("prompt")), "prompt", readers.command_source(["cat"], 60))
    answers = said.select(F.from_json(sentinel_json(F.col("text"), "<<<", ">>>"), "key string")["key"].alias("key"), "status")
    text = F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("see http://a/"), "r_regionkey", F.lit(".png, https://b/x.JPG and http://a/"), "r_regionkey", F.lit(".png"))).otherwise("none.png")
    urls = region.select(F.col("r_name").alias("key"), F.array_join(readers.image_urls(text), ";").alias("urls"))
    return answers.join(urls, "key").select("key", F.concat("key", F.lit(" said")).alias("answer"), "status", "urls")


@query(
    """SELECT doc_id, CASE WHEN r THEN 300 ELSE length(text) END::INT AS chars, r AS reread FROM (SELECT *, length(trim(text)) < 200 AND doc_id % 2 = 0 AND length(text) < 300 AS r FROM documents)"""
)
def reread_short_texts(spark, sf_dir):
    """Thin texts read anew by an injected reader, where that finds more."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text").withColumn("pdf_path", F.col("doc_id").cast("string"))
    out = readers.reread_pages(docs, lambda p: "x" * 300 if int(p) % 2 == 0 else None)
    return out.select("doc_id", F.length("text").alias("chars"), "reread")


@query(
    """SELECT c_custkey::VARCHAR AS id, CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS flag, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment || '; x' ELSE '' END AS list FROM customer"""
)
def csv_round_trip(spark, sf_dir):
    """CSV cells: arrays joined, booleans as words, nulls empty."""
    folder = new_folder(spark, "csv")
    flag, listed = (F.col("c_acctbal") > 0).alias("flag"), F.when(F.col("c_nationkey") % 2 == 0, F.array("c_mktsegment", F.lit("x"))).alias("list")
    sinks.write_csv(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), flag, listed), folder)
    back = spark.read.option("header", True).schema("id string, flag string, list string").csv(folder)
    return back.withColumn("list", F.coalesce("list", F.lit("")))


@query("""SELECT 'nation' AS sheet, 'NATION_' || n AS first_cell FROM (SELECT unnest(range(0, 25)) AS n) UNION ALL SELECT 'none', '(no data)'""")
def workbook_sheets(spark, sf_dir):
    """A workbook's sheets, an empty one with a note."""
    folder = new_folder(spark, "sheets")
    nation = load(spark, sf_dir, "nation", "n_name")
    sinks.write_sheets({"nation": nation, "none": nation.limit(0)}, folder)
    sheet = lambda n: spark.read.option("header", True).csv(f"{folder}/{n}").toDF("first_cell").select(F.lit(n).alias("sheet"), "first_cell")
    return sheet("nation").union(sheet("none"))


@query(
    """SELECT 'nations' AS sheet, (n_nationkey + 1)::INT AS place, n_nationkey || '|' || n_name || '|' || n_regionkey || '; x' AS cells FROM nation UNION ALL SELECT 'nations', 0, 'n_nationkey|n_name|tags' UNION ALL SELECT 'none', 0, 'note' UNION ALL SELECT 'none', 1, '(no data)'"""
)
def workbook(spark, sf_dir):
    """A workbook written and read back: headers, numbers, texts, lists, and an empty sheet's note."""
    from foliant.sources.workbook import read_workbook, write_workbook

    path = f"{new_folder(spark, 'workbook')}/collection.xlsx"
    nation = load(spark, sf_dir, "nation").orderBy("n_nationkey").select("n_nationkey", "n_name", F.array(F.col("n_regionkey").cast("string"), F.lit("x")).alias("tags"))
    write_workbook({"nations": nation, "none": nation.limit(0)}, path, spark)
    content = spark.read.format("binaryFile").load(path).select("content").first().content
    return spark.createDataFrame([(name, i, "|".join(row)) for name, rows in read_workbook(bytes(content)).items() for i, row in enumerate(rows)], "sheet string, place int, cells string")


@query(
    """SELECT 0 AS part, 'add("nations", [' AS line UNION ALL SELECT 1, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"},' FROM nation UNION ALL SELECT 2, ']);'"""
)
def data_module(spark, sf_dir):
    """The lines of a script that registers a table."""
    rows = sinks.data_module(load(spark, sf_dir, "nation", "n_nationkey", "n_name"), "nations", [F.col("n_nationkey")], "add")
    return rows.select(F.when(F.col("place") == 0, 0).when(F.startswith("module", F.lit("]")), 2).otherwise(1).alias("part"), F.col("module").alias("line"))


@query("""SELECT count(*) AS files, 'copied' AS status, true AS same, true AS writable FROM region""")
def copied_files(spark, sf_dir):
    """Source files copied to another folder, with the size they had."""
    source, target = new_folder(spark, "source"), new_folder(spark, "target")
    load(spark, sf_dir, "region", "r_name", F.col("r_regionkey").cast("string").alias("v")).repartition("r_name").write.partitionBy("r_name").text(source)
    sinks.assert_writable(target, spark)
    files = readers.scan_library(spark, source, "txt")
    done = sinks.copy_files(files, source, target).groupBy("status").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    counts = done.collect()  # a row a status; the copies must be there before the target is listed
    there = readers.scan_library(spark, target, "txt").agg(F.sum("file_size_bytes")).first()[0]
    return spark.createDataFrame([(r.files, r.status, r.bytes == there, True) for r in counts], "files long, status string, same boolean, writable boolean")


@query(
    """SELECT sha256(o_custkey || '|' || o_orderstatus) AS cache_key, max(CASE WHEN o_custkey % 3 = 0 THEN 'cached' ELSE 'missing' END) AS found FROM orders GROUP BY 1"""
)
def result_cache(spark, sf_dir):
    """What a cache of successes lacks."""
    folder = new_folder(spark, "cache")
    wanted = load(spark, sf_dir, "orders").select(sinks.cache_key(F.col("o_custkey"), F.col("o_orderstatus")).alias("cache_key"), "o_custkey").distinct()
    sinks.add_to_cache(wanted.withColumn("status", F.when(F.col("o_custkey") % 3 == 0, "success").otherwise("error")), folder)
    cache = spark.read.parquet(folder)
    missing = sinks.cache_misses(wanted, cache)
    return cache.select("cache_key", F.lit("cached").alias("found")).union(missing.select("cache_key", F.lit("missing")))


@query(
    """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id"""
)
def incremental_stream(spark, sf_dir):
    """A file stream upserted by key in three runs, late events among them: each user's last event stays."""
    from foliant.streaming.incremental import file_stream, latest, upsert_stream

    folder = new_folder(spark, "stream")
    events = load(spark, sf_dir, "events", "user_id", "event_id", "event_type").withColumn("fingerprint", F.col("event_id").cast("string"))
    for k in range(3):  # each run brings events that are older than some the table has
        events.where(F.col("event_id") % 3 == k).write.mode("append").json(f"{folder}/in")
        stream = file_stream(spark, f"{folder}/in", "user_id long, event_id long, event_type string, fingerprint string")
        upsert_stream(stream, "user_id", "event_id", f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return latest(spark, f"{folder}/table", "user_id").select("user_id", "event_id", "event_type")


@query("SELECT user_id, count(*) AS n, CASE WHEN user_id % 2 = 0 THEN 'old' ELSE 'new' END AS made_by, user_id % 2 = 0 AS reused FROM events GROUP BY user_id")
def incremental_run(spark, sf_dir):
    """Results for all keys: earlier ones whose fingerprint holds, new ones for the rest."""
    from foliant.streaming.incremental import run_incremental

    counts = load(spark, sf_dir, "events", "user_id").groupBy("user_id").agg(F.count("*").alias("n")).withColumn("fingerprint", F.col("n").cast("string"))
    old = F.when(F.col("user_id") % 2 == 0, F.col("fingerprint")).otherwise("x")
    before = counts.select("user_id", "n", old.alias("fingerprint"), F.lit("old").alias("made_by"), F.lit("1.0").alias("record_version"))
    out = run_incremental(counts, before, "user_id", "1.0", lambda d: d.withColumn("made_by", F.lit("new")))
    return out.select("user_id", "n", "made_by", "reused")


def lines(spark, text):
    """A report's lines that aren't blank, numbered."""
    return spark.createDataFrame([(i, x) for i, x in enumerate(x for x in text.split("\n") if x)], "place int, line string")


def _table_sql(head: str, columns: str, body: str) -> str:
    """A headed table of a report as SQL rows (o, line): `body` gives (k, line) in the order of k."""
    bars = "|" + "---|" * len(columns.split(" | "))
    return f"SELECT [0] AS o, '## {head}' AS line UNION ALL SELECT [1], '| {columns} |' UNION ALL SELECT [2], '{bars}' UNION ALL SELECT [3, k], line FROM ({body})"


def _report_sql(title: str, *tables: str) -> str:
    parts = "".join(f" UNION ALL SELECT [{i + 1}] || o, line FROM ({t})" for i, t in enumerate(tables))
    return f"SELECT (row_number() OVER (ORDER BY o) - 1)::INT AS place, line FROM (SELECT [0] AS o, '# {title}' AS line{parts})"


def _ranked(select: str, order: str, most: int = 1000) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) AS k, line FROM ({select}) QUALIFY k <= {most}"


_SEEDED = "SELECT ord, '| ' || key || ' | ' || n || ' |' AS line FROM (SELECT min(ord) AS ord, key, sum(n)::BIGINT AS n FROM ({counts} UNION ALL SELECT unnest(range(0, {len})) AS ord, unnest({known}) AS key, 0 AS n) GROUP BY key)"


def _seeded(counts: str, known: list[str]) -> str:
    return _ranked(_SEEDED.format(counts=counts, known=known, len=len(known)), "ord")


@query(
    _report_sql(
        "Extraction",
        _table_sql("Coverage", "documents | pages | pages_needing_ocr | ocr_pct", "SELECT 1 AS k, '| ' || count(*) || ' | ' || sum(o_orderkey % 10) || ' | ' || sum(o_orderkey % 2) || ' | ' || round(100.0 * sum(o_orderkey % 2) / sum(o_orderkey % 10), 1) || ' |' AS line FROM orders"),
        _table_sql("Pages per document", "min | median | max", "SELECT 1 AS k, '| ' || min(o_orderkey % 10) || ' | ' || median(o_orderkey % 10) || ' | ' || max(o_orderkey % 10) || ' |' AS line FROM orders"),
        _table_sql("Folders", "piece_folder | documents | pages | pages_needing_ocr", _ranked("SELECT o_orderpriority AS f, '| ' || o_orderpriority || ' | ' || count(*) || ' | ' || sum(o_orderkey % 10) || ' | ' || sum(o_orderkey % 2) || ' |' AS line FROM orders GROUP BY o_orderpriority", "f")),
        _table_sql("Flagged documents", "pdf_path | pages_needing_ocr", _ranked("SELECT lpad(o_orderkey::VARCHAR, 9, '0') AS p, '| ' || lpad(o_orderkey::VARCHAR, 9, '0') || ' | 1 |' AS line FROM orders WHERE o_orderkey % 2 = 1", "p", 20)) + " UNION ALL SELECT [4], '(more rows not shown)' FROM orders WHERE o_orderkey % 2 = 1 HAVING count(*) > 20",
    )
)
def extraction_report(spark, sf_dir):
    k = F.col("o_orderkey")
    docs = load(spark, sf_dir, "orders").select(F.lpad(k.cast("string"), 9, "0").alias("pdf_path"), F.col("o_orderpriority").alias("piece_folder"), (k % 10).alias("page_count"), (k % 2).alias("pages_needing_ocr"))
    return lines(spark, reports.extraction_report(docs))


@query(
    _report_sql(
        "Classification",
        _table_sql("Confidence", "key | n", _seeded("SELECT 99 AS ord, CASE WHEN l_discount > 0.05 THEN 'high' ELSE 'low' END AS key, count(*) AS n FROM lineitem GROUP BY 2", ["high", "medium", "low", "none"])),
        _table_sql("Families", "family | n", _ranked("SELECT count(*) AS n, l_returnflag AS f, '| ' || l_returnflag || ' | ' || count(*) || ' |' AS line FROM lineitem GROUP BY l_returnflag", "n DESC, f", 25)),
        _table_sql("Evidence", "evidence_source | n", _ranked("SELECT count(*) AS n, l_linestatus AS f, '| ' || l_linestatus || ' | ' || count(*) || ' |' AS line FROM lineitem GROUP BY l_linestatus", "n DESC, f", 10)),
        _table_sql("Pieces", "piece_id | documents | to_review", _ranked("SELECT l_suppkey AS p, count(*) FILTER (l_tax > 0.05) AS r, '| ' || l_suppkey || ' | ' || count(*) || ' | ' || count(*) FILTER (l_tax > 0.05) || ' |' AS line FROM lineitem GROUP BY l_suppkey", "r DESC, p", 25)) + " UNION ALL SELECT [4], '(more rows not shown)' FROM lineitem HAVING count(DISTINCT l_suppkey) > 25",
    )
)
def classification_report(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("piece_id"), F.col("l_returnflag").alias("family"), F.col("l_linestatus").alias("evidence_source"), F.when(F.col("l_discount") > 0.05, "high").otherwise("low").alias("confidence_tier"), (F.col("l_tax") > 0.05).alias("needs_review"))
    return lines(spark, reports.classification_report(rows))


#: Line items as classified documents, for the twins; _classified() has them for Spark.
_CLASSIFIED = """SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey AS pdf_path, 's' || l_suppkey AS piece_folder, CASE WHEN l_suppkey % 5 > 0 THEN (l_suppkey % 50)::VARCHAR END AS catalog_number,
  CASE WHEN l_returnflag <> 'R' THEN 'p' || l_partkey % 7 END AS predicted, CASE WHEN l_returnflag <> 'R' THEN CASE WHEN l_quantity > 45 THEN [l_partkey % 7, l_partkey % 7 + 1] ELSE [l_partkey % 7] END ELSE [] END AS parts,
  l_linenumber = 1 AS is_score, CASE WHEN l_returnflag = 'R' THEN 0 ELSE round(0.5 + 5 * l_discount, 2) END AS confidence, l_linestatus AS evidence_source, l_quantity > 40 AS duplicate, l_tax > 0.05 AS needs_review,
  CASE WHEN l_suppkey % 11 = 0 THEN 'unread' END AS error FROM lineitem"""
_STATES = {
    "errors": "error IS NOT NULL", "classified": "error IS NULL AND NOT is_score AND len(parts) > 0", "scores": "error IS NULL AND is_score", "unmatched": "error IS NULL AND NOT is_score AND len(parts) = 0",
    "doubtful": "error IS NULL AND NOT is_score AND len(parts) > 0 AND confidence < 0.75", "duplicates": "error IS NULL AND duplicate", "to_review": "needs_review", "sure": "error IS NULL AND confidence >= 0.9",
    "medium": "error IS NULL AND confidence >= 0.75 AND confidence < 0.9", "low": "error IS NULL AND confidence > 0 AND confidence < 0.75", "no_confidence": "error IS NULL AND confidence <= 0",
}
_COUNTS = "count(*) AS documents, " + ", ".join(f"count(*) FILTER ({v}) AS {k}" for k, v in _STATES.items()) + ", min(catalog_number) AS catalog_number"


def _classified(spark, sf_dir):
    c, text = F.col, lambda x: x.cast("string")
    named, kind = c("l_returnflag") != "R", c("l_partkey") % 7
    facet = lambda k: F.struct(F.concat(F.lit("c"), text(k)).alias("canonical"), F.when(k < 7, F.concat(F.lit("f"), text(k % 3))).alias("family"))
    return load(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", text(c("l_orderkey")), text(c("l_linenumber")), text(c("l_partkey"))).alias("pdf_path"), F.concat(F.lit("s"), text(c("l_suppkey"))).alias("piece_folder"),
        F.when(c("l_suppkey") % 5 > 0, text(c("l_suppkey") % 50)).alias("catalog_number"), F.when(named, F.concat(F.lit("p"), text(kind))).alias("predicted"),
        F.when(named, F.when(c("l_quantity") > 45, F.array(facet(kind), facet(kind + 1))).otherwise(F.array(facet(kind)))).alias("facets"), (c("l_linenumber") == 1).alias("is_score"),
        F.when(named, F.round(0.5 + 5 * c("l_discount"), 2)).otherwise(0.0).alias("confidence"), c("l_linestatus").alias("evidence_source"), (c("l_quantity") > 40).alias("duplicate"),
        (c("l_tax") > 0.05).alias("needs_review"), F.when(c("l_suppkey") % 11 == 0, "unread").alias("error"),
    )


@query(
    f"""WITH r AS ({_CLASSIFIED}), x AS (SELECT *, unnest(parts) AS part FROM r WHERE error IS NULL AND NOT is_score)
SELECT 'all' AS dimension, NULL AS key, {_COUNTS} FROM r
UNION ALL SELECT 'piece', piece_folder, {_COUNTS} FROM r GROUP BY piece_folder
UNION ALL SELECT 'evidence', evidence_source, {_COUNTS} FROM r WHERE error IS NULL GROUP BY evidence_source
UNION ALL SELECT 'family', k, {_COUNTS} FROM (SELECT *, CASE WHEN is_score THEN 'score' ELSE 'unknown' END AS k FROM r WHERE error IS NULL AND (is_score OR len(parts) = 0)
  UNION ALL SELECT * EXCLUDE part, CASE WHEN part = 7 THEN 'other' ELSE 'f' || part % 3 END FROM x) GROUP BY k
UNION ALL SELECT 'instrument', k, {_COUNTS} FROM (SELECT *, '(unmatched)' AS k FROM r WHERE error IS NULL AND NOT is_score AND len(parts) = 0 UNION ALL SELECT * EXCLUDE part, 'c' || part FROM x) GROUP BY k"""
)
def classification_tallies(spark, sf_dir):
    """Counts of classified documents by piece, family, instrument and evidence, and over all, from one scan."""
    return reports.classification_tallies(_classified(spark, sf_dir))


@query(
    f"""WITH r AS ({_CLASSIFIED}), l AS (SELECT 'errors' AS list, NULL::DOUBLE AS n, NULL AS t, * FROM r WHERE {_STATES['errors']}
UNION ALL SELECT 'unmatched', NULL, NULL, * FROM r WHERE {_STATES['unmatched']} UNION ALL SELECT 'doubtful', confidence, NULL, * FROM r WHERE {_STATES['doubtful']}
UNION ALL SELECT 'duplicates', NULL, piece_folder || chr(1) || coalesce(predicted, ''), * FROM r WHERE {_STATES['duplicates']}),
o AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY n NULLS FIRST, t NULLS FIRST, pdf_path, piece_folder, predicted NULLS FIRST, confidence, evidence_source, error NULLS FIRST) AS rank FROM l)
SELECT list, rank::INT AS rank, pdf_path, piece_folder, predicted, confidence::DOUBLE AS confidence, evidence_source, error FROM o WHERE rank <= 20"""
)
def classification_attention(spark, sf_dir):
    """The first documents with errors, without a match, of low confidence, and of repeated labels, from one scan."""
    return reports.classification_attention(_classified(spark, sf_dir))


_PAGES = """SELECT l_orderkey || '.pdf' AS pdf_path, l_linenumber AS page_number, 's' || l_suppkey AS piece_folder, CASE WHEN l_returnflag <> 'R' THEN l_returnflag ELSE 'unknown' END AS document_type, l_linestatus AS text_source,
  l_quantity < 10 AS needs_ocr, l_quantity < 5 AS ocr_applied, l_partkey % 9 = 0 AS rotated, l_tax > 0.04 AS image_based, l_discount > 0.08 AS blank, l_suppkey % 2 = 0 AS music,
  CASE WHEN l_partkey % 4 = 0 THEN ['skew'] WHEN l_partkey % 4 = 1 THEN ['blur', 'skew'] ELSE [] END AS issues, CASE WHEN l_partkey % 13 = 0 THEN 'unread' END AS error FROM lineitem"""
_PAGE_COUNTS = "count(*) AS pages, count(*) FILTER (page_number = 1) AS documents, " + ", ".join(f"count(*) FILTER ({k}) AS {k}" for k in reports.PAGE_STATES) + ", count(error) AS errors"


def _pages(spark, sf_dir):
    c = F.col
    issues = F.when(c("l_partkey") % 4 == 0, F.array(F.lit("skew"))).when(c("l_partkey") % 4 == 1, F.array(F.lit("blur"), F.lit("skew")))
    return load(spark, sf_dir, "lineitem").select(
        F.concat(c("l_orderkey").cast("string"), F.lit(".pdf")).alias("pdf_path"), c("l_linenumber").alias("page_number"), F.concat(F.lit("s"), c("l_suppkey").cast("string")).alias("piece_folder"),
        F.when(c("l_returnflag") != "R", c("l_returnflag")).alias("document_type"), c("l_linestatus").alias("text_source"), (c("l_quantity") < 10).alias("needs_ocr"), (c("l_quantity") < 5).alias("ocr_applied"),
        (c("l_partkey") % 9 == 0).alias("rotated"), (c("l_tax") > 0.04).alias("image_based"), (c("l_discount") > 0.08).alias("blank"), (c("l_suppkey") % 2 == 0).alias("music"), issues.alias("issues"),
        F.when(c("l_partkey") % 13 == 0, "unread").alias("error"),
    )


@query(
    f"""WITH r AS ({_PAGES}) SELECT 'all' AS dimension, NULL AS key, {_PAGE_COUNTS} FROM r UNION ALL SELECT 'folder', piece_folder, {_PAGE_COUNTS} FROM r GROUP BY piece_folder
UNION ALL SELECT 'type', document_type, {_PAGE_COUNTS} FROM r GROUP BY document_type UNION ALL SELECT 'source', text_source, {_PAGE_COUNTS} FROM r GROUP BY text_source
UNION ALL SELECT 'issue', issue, {_PAGE_COUNTS} FROM (SELECT *, unnest(issues) AS issue FROM r) GROUP BY issue"""
)
def extraction_tallies(spark, sf_dir):
    """Counts of pages by folder, type of document, source of text and issue, and over all, from one scan."""
    return reports.extraction_tallies(_pages(spark, sf_dir))


@query(
    f"""WITH r AS ({_PAGES}), l AS (SELECT 'errors' AS list, * FROM r WHERE error IS NOT NULL UNION ALL SELECT 'needs_ocr', * FROM r WHERE needs_ocr
  UNION ALL SELECT 'blur', * FROM r WHERE list_contains(issues, 'blur') UNION ALL SELECT 'skew', * FROM r WHERE list_contains(issues, 'skew')),
o AS (SELECT *, row_number() OVER (PARTITION BY list ORDER BY pdf_path, page_number, text_source, error NULLS FIRST) AS rank FROM l)
SELECT list, rank::INT AS rank, pdf_path, page_number, text_source, error FROM o WHERE rank <= 15"""
)
def extraction_attention(spark, sf_dir):
    """The first pages with errors, of those that need OCR, and of each issue, from one scan."""
    return reports.extraction_attention(_pages(spark, sf_dir), ["blur", "skew"])


@query(
    _report_sql(
        "Quality",
        _table_sql("Bands", "key | n", _seeded("SELECT 99 AS ord, CASE WHEN doc_id % 4 = 0 THEN 'poor' ELSE 'good' END AS key, count(*) AS n FROM documents GROUP BY 2", ["good", "fair", "poor", "unknown"])),
        _table_sql("Issues", "issue | pages", _ranked("SELECT i, n, '| ' || i || ' | ' || n || ' |' AS line FROM (SELECT 'low_contrast' AS i, sum(doc_id % 5) AS n FROM documents UNION ALL SELECT 'heavy_blur', sum(doc_id % 3) FROM documents)", "n DESC, i")),
        _table_sql("Worst first", "pdf_path | quality_score | quality_band | top_issues", _ranked("SELECT doc_id % 101 AS s, lpad(doc_id::VARCHAR, 7, '0') AS p, '| ' || p || ' | ' || s || '.0 | ' || CASE WHEN doc_id % 4 = 0 THEN 'poor' ELSE 'good' END || ' | a; b |' AS line FROM documents", "s, p", 50)) + " UNION ALL SELECT [4], '(more rows not shown)' FROM documents HAVING count(*) > 50",
    )
)
def quality_report(spark, sf_dir):
    k = F.col("doc_id")
    issues = F.map_filter(F.create_map(F.lit("low_contrast"), k % 5, F.lit("heavy_blur"), k % 3), lambda _, v: v > 0)
    docs = load(spark, sf_dir, "documents", "doc_id").select(F.lpad(k.cast("string"), 7, "0").alias("pdf_path"), (k % 101).cast("double").alias("quality_score"), F.when(k % 4 == 0, "poor").otherwise("good").alias("quality_band"), issues.alias("issue_summary"), F.array(F.lit("a"), F.lit("b")).alias("top_issues"))
    return lines(spark, reports.quality_report(docs, 50))


_TIERS = ["complete", "near_complete", "incomplete", "severely_incomplete", "unknown"]
_REASONS = ["missing_score", "missing_required_parts", "unexpected_parts", "low_confidence_parts", "duplicate_parts", "instrumentation_unresolved"]


@query(
    _report_sql(
        "Expected parts",
        _table_sql("Completeness", "cnt | mean | median | min | max", "SELECT 1 AS k, '| ' || count(*) || ' | ' || round(avg(c_custkey % 4 / 4.0), 3) || ' | ' || round(median(c_custkey % 4 / 4.0), 3) || ' | 0.0 | 0.75 |' AS line FROM customer"),
        _table_sql("Tiers", "key | n", _seeded("SELECT 99 AS ord, CASE WHEN c_custkey % 4 = 3 THEN 'complete' ELSE 'incomplete' END AS key, count(*) AS n FROM customer GROUP BY 2", _TIERS)),
        _table_sql("Most missing", "label | pieces", _ranked("SELECT c_mktsegment AS m, count(*) AS n, '| ' || c_mktsegment || ' | ' || count(*) || ' |' AS line FROM customer WHERE c_acctbal < 0 GROUP BY c_mktsegment", "n DESC, m", 25)),
    )
)
def expected_report(spark, sf_dir):
    c = F.col
    rows = load(spark, sf_dir, "customer")
    pieces = rows.select((c("c_custkey") % 4 / F.lit(4.0)).alias("completeness_score"), F.when(c("c_custkey") % 4 == 3, "complete").otherwise("incomplete").alias("completeness_tier"))
    slots = rows.select(c("c_custkey").alias("piece_id"), c("c_mktsegment").alias("label"), F.lit(True).alias("required"), (c("c_acctbal") >= 0).alias("present"))
    return lines(spark, reports.expected_report(pieces, slots))


@query(
    _report_sql(
        "Collection",
        _table_sql("Severity", "key | n", _seeded("SELECT 99 AS ord, CASE WHEN c_acctbal < 0 THEN 'high' ELSE 'ok' END AS key, count(*) AS n FROM customer GROUP BY 2", ["high", "review", "ok"])),
        _table_sql("Completeness", "key | n", _seeded("SELECT 99 AS ord, CASE WHEN c_custkey % 4 = 3 THEN 'complete' ELSE 'incomplete' END AS key, count(*) AS n FROM customer GROUP BY 2", _TIERS)),
        _table_sql("Reasons", "key | n", _seeded("SELECT 99 AS ord, 'missing_score' AS key, count(*) AS n FROM customer WHERE c_acctbal < 0", _REASONS)),
        _table_sql("Attention", "catalog_number | piece_folder | severity | reason_codes", _ranked("SELECT lpad(c_custkey::VARCHAR, 7, '0') AS p, '| ' || p || ' | ' || c_name || ' | high | missing_score |' AS line FROM customer WHERE c_acctbal < 0", "p", 50)) + " UNION ALL SELECT [4], '(more rows not shown)' FROM customer WHERE c_acctbal < 0 HAVING count(*) > 50",
    )
)
def collection_dashboard(spark, sf_dir):
    c = F.col
    low = c("c_acctbal") < 0
    none = F.array().cast("array<string>")
    rows = load(spark, sf_dir, "customer").select(F.lpad(c("c_custkey").cast("string"), 7, "0").alias("catalog_number"), c("c_name").alias("piece_folder"), F.when(low, "high").otherwise("ok").alias("severity"), F.when(c("c_custkey") % 4 == 3, "complete").otherwise("incomplete").alias("completeness_tier"), F.when(low, F.array(F.lit("missing_score"))).otherwise(none).alias("reason_codes"))
    return lines(spark, reports.dashboard(rows))


_WEIGHTS_SQL = _ranked("SELECT c, '| ' || c || ' | ' || p || ' |' AS line FROM (VALUES ('duplicate_part', 2), ('low_confidence_part', 5), ('missing_required_part', 10), ('missing_score', 40), ('unexpected_part', 1), ('unmatched_part', 5)) v(c, p)", "c")


@query(
    _report_sql(
        "Review queue",
        _table_sql("Weights", "component | points", _WEIGHTS_SQL),
        _table_sql("Queue", "rank | piece_id | priority_score | severity | reason_codes", _ranked("SELECT s_suppkey AS s, '| ' || (s_suppkey + 1) || ' | ' || s_name || ' | ' || (100 - s_suppkey) || ' | high | a |' AS line FROM supplier", "s", 20)) + " UNION ALL SELECT [4], '(more rows not shown)' FROM supplier HAVING count(*) > 20",
        "SELECT [5] AS o, '## ' || s_name AS line FROM supplier WHERE s_suppkey < 1 UNION ALL SELECT [6], '- act ' || s_name FROM supplier WHERE s_suppkey < 1",
    )
)
def review_pack(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = load(spark, sf_dir, "supplier").select((k + 1).alias("rank"), F.col("s_name").alias("piece_id"), (100 - k).alias("priority_score"), F.lit("high").alias("severity"), F.array(F.lit("a")).alias("reason_codes"), F.array(F.concat(F.lit("act "), "s_name")).alias("recommended_actions"))
    return lines(spark, reports.review_pack(rows, 20, 1))


_SCORED = """SELECT doc_id, CASE n_chars % 4 WHEN 0 THEN 'poor' WHEN 1 THEN 'fair' ELSE 'good' END AS band, coalesce(lang, 'unknown') AS source, n_chars % 7 + 1 AS page_count,
  doc_id % 5 AS low_contrast, n_chars % 3 AS heavy_blur, CASE WHEN n_chars % 10 > 0 THEN n_chars % 101 END AS score FROM documents"""
_SCORE_COUNTS = "count(*) AS documents, sum({pages})::BIGINT AS pages, count(*) - count(score) AS unscored"


def _scored(spark, sf_dir):
    c = F.col
    issues = F.map_filter(F.create_map(F.lit("low_contrast"), c("doc_id") % 5, F.lit("heavy_blur"), c("n_chars").cast("long") % 3), lambda _, v: v > 0)
    band = F.when(c("n_chars") % 4 == 0, "poor").when(c("n_chars") % 4 == 1, "fair").otherwise("good")
    return load(spark, sf_dir, "documents", "doc_id", "n_chars", "lang", "source").select(
        c("doc_id").cast("string").alias("pdf_path"), c("source").alias("piece_id"), F.when(c("n_chars") % 10 > 0, c("n_chars") % 101).cast("double").alias("quality_score"), band.alias("quality_band"),
        c("lang").alias("notation_source_type"), (c("n_chars") % 7 + 1).alias("page_count"), issues.alias("issue_summary"), F.map_keys(issues).alias("top_issues"),
    )


@query(
    f"""WITH r AS ({_SCORED}) SELECT 'all' AS dimension, NULL AS key, {_SCORE_COUNTS.format(pages='page_count')} FROM r
UNION ALL SELECT 'band', band, {_SCORE_COUNTS.format(pages='page_count')} FROM r GROUP BY band UNION ALL SELECT 'source', source, {_SCORE_COUNTS.format(pages='page_count')} FROM r GROUP BY source
UNION ALL SELECT 'issue', 'low_contrast', {_SCORE_COUNTS.format(pages='low_contrast')} FROM r WHERE low_contrast > 0 UNION ALL SELECT 'issue', 'heavy_blur', {_SCORE_COUNTS.format(pages='heavy_blur')} FROM r WHERE heavy_blur > 0"""
)
def quality_tallies(spark, sf_dir):
    """Counts of scored documents by band, source of notation and issue, and over all, from one scan."""
    return reports.quality_tallies(_scored(spark, sf_dir))


_EXPECTED_COUNTS = """count(*) AS pieces, count(*) FILTER (status = 'matched') AS confident, count(*) FILTER (tier = 'complete') AS complete, count(*) FILTER (len(missing) > 0) AS to_review,
  count(error) AS errors, sum(len(missing))::BIGINT AS missing_parts"""


@query(
    f"""WITH m AS (SELECT l_orderkey, list('line ' || l_linenumber) AS lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'matched' WHEN 'O' THEN 'ambiguous' ELSE 'none' END AS status, CASE WHEN lines IS NULL THEN 'complete' WHEN len(lines) < 3 THEN 'near_complete' ELSE 'incomplete' END AS tier,
  o_orderpriority AS ensemble, coalesce(lines, []) AS missing, CASE WHEN o_custkey % 13 = 0 THEN 'failed' END AS error FROM orders LEFT JOIN m ON l_orderkey = o_orderkey)
SELECT 'all' AS dimension, NULL AS key, {_EXPECTED_COUNTS} FROM r UNION ALL SELECT 'status', status, {_EXPECTED_COUNTS} FROM r GROUP BY status
UNION ALL SELECT 'tier', tier, {_EXPECTED_COUNTS} FROM r GROUP BY tier UNION ALL SELECT 'ensemble', ensemble, {_EXPECTED_COUNTS} FROM r GROUP BY ensemble
UNION ALL SELECT 'missing', part, {_EXPECTED_COUNTS} FROM (SELECT *, unnest(list_distinct(missing)) AS part FROM r) GROUP BY part"""
)
def expected_tallies(spark, sf_dir):
    """Counts of orders as pieces by lookup, tier, ensemble and missing line, and over all."""
    c = F.col
    back = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag").where("l_returnflag = 'R'")
    lines_back = back.groupBy("l_orderkey").agg(F.collect_list(F.concat(F.lit("line "), c("l_linenumber").cast("string"))).alias("missing"))
    both = load(spark, sf_dir, "orders").join(lines_back, c("o_orderkey") == c("l_orderkey"), "left")
    tier = F.when(c("missing").isNull(), "complete").when(F.size("missing") < 3, "near_complete").otherwise("incomplete")
    status = F.when(c("o_orderstatus") == "F", "matched").when(c("o_orderstatus") == "O", "ambiguous")
    pieces = both.select(status.alias("lookup_status"), tier.alias("completeness_tier"), c("o_orderpriority").alias("ensemble"), "missing", c("missing").isNotNull().alias("needs_review"), F.when(c("o_custkey") % 13 == 0, "failed").alias("error"))
    return reports.expected_tallies(pieces)


_COLLECTION_COUNTS = """count(*) AS pieces, count(*) FILTER (tier = 'complete') AS complete, count(*) FILTER (review) AS to_review, count(*) FILTER (unscored) AS without_score, count(*) FILTER (len(codes) > 0) AS with_findings,
  sum(documents)::BIGINT AS documents, sum(low)::BIGINT AS low_quality_documents, round(avg(score), 3) AS completeness"""


@query(
    f"""WITH i AS (SELECT l_suppkey, count(*) AS documents, count(*) FILTER (l_quantity < 5) AS low, list({{'label': 'p' || (l_partkey % 50), 'section': l_linestatus}}) FILTER (l_returnflag = 'R') AS parts FROM lineitem GROUP BY l_suppkey),
r AS (SELECT CASE WHEN s_acctbal < 0 THEN 'high' WHEN s_suppkey % 3 = 0 THEN 'review' ELSE 'ok' END AS severity, CASE WHEN parts IS NULL THEN 'complete' ELSE 'incomplete' END AS tier, (s_suppkey % 8) / 8.0 AS score,
  CASE WHEN s_acctbal < 0 THEN ['missing_score', 'unexpected_parts'] WHEN s_suppkey % 3 = 0 THEN ['unexpected_parts'] ELSE [] END AS codes, CASE WHEN low > 2 THEN 'poor' ELSE 'good' END AS band, '1.' || (s_nationkey % 2) AS version,
  coalesce(parts, []) AS parts, coalesce(documents, 0) AS documents, coalesce(low, 0) AS low, s_acctbal < 0 OR s_suppkey % 3 = 0 AS review, s_acctbal < 0 AS unscored FROM supplier LEFT JOIN i ON l_suppkey = s_suppkey)
SELECT 'all' AS dimension, NULL AS key, {_COLLECTION_COUNTS} FROM r UNION ALL SELECT 'severity', severity, {_COLLECTION_COUNTS} FROM r GROUP BY severity UNION ALL SELECT 'tier', tier, {_COLLECTION_COUNTS} FROM r GROUP BY tier
UNION ALL SELECT 'band', band, {_COLLECTION_COUNTS} FROM r GROUP BY band UNION ALL SELECT 'version', version, {_COLLECTION_COUNTS} FROM r GROUP BY version
UNION ALL SELECT 'reason', code, {_COLLECTION_COUNTS} FROM (SELECT *, unnest(codes) AS code FROM r) GROUP BY code
UNION ALL SELECT 'missing', k, {_COLLECTION_COUNTS} FROM (SELECT *, unnest(list_distinct(list_transform(parts, lambda x: x.label))) AS k FROM r) GROUP BY k
UNION ALL SELECT 'section', k, {_COLLECTION_COUNTS} FROM (SELECT *, unnest(list_distinct(list_transform(parts, lambda x: x.section))) AS k FROM r) GROUP BY k"""
)
def collection_tallies(spark, sf_dir):
    """Counts of suppliers as pieces by severity, tier, reason, band, version, missing part and section, and over all."""
    c = F.col
    part = F.when(c("l_returnflag") == "R", F.struct(F.concat(F.lit("p"), (c("l_partkey") % 50).cast("string")).alias("label"), c("l_linestatus").alias("section")))
    items = load(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    held = items.groupBy("l_suppkey").agg(F.count("*").alias("document_count"), F.count_if(c("l_quantity") < 5).alias("low_quality_count"), F.collect_set(part).alias("missing_required_parts"))
    both = load(spark, sf_dir, "supplier").join(held, c("s_suppkey") == c("l_suppkey"), "left")
    bad, odd = c("s_acctbal") < 0, c("s_suppkey") % 3 == 0
    pieces = both.select(
        F.when(bad, "high").when(odd, "review").otherwise("ok").alias("severity"), F.when(F.size("missing_required_parts") > 0, "incomplete").otherwise("complete").alias("completeness_tier"), (c("s_suppkey") % 8 / F.lit(8.0)).alias("completeness_score"),
        F.when(bad, F.array(F.lit("missing_score"), F.lit("unexpected_parts"))).when(odd, F.array(F.lit("unexpected_parts"))).alias("reason_codes"), F.when(c("low_quality_count") > 2, "poor").otherwise("good").alias("worst_quality_band"),
        F.concat(F.lit("1."), (c("s_nationkey") % 2).cast("string")).alias("record_version"), "missing_required_parts", "document_count", "low_quality_count", (bad | odd).alias("needs_review"), bad.alias("score_missing"),
    )
    return reports.collection_tallies(pieces)


_REPORT_SQL = """WITH o AS (SELECT o_custkey, list({'label': lpad(o_orderkey::VARCHAR, 9, '0'), 'present': o_orderstatus = 'F'} ORDER BY o_orderkey) AS x FROM orders GROUP BY o_custkey),
r AS (SELECT c_custkey, ['# Piece', '## Summary', '| piece_id | piece_folder | severity | completeness_tier | completeness_score |', '|---|---|---|---|---|', '| ' || c_custkey || ' | ' || c_name || ' | high | complete | 0.5 |',
  '## Expected parts', '| label | required | present |', '|---|---|---|'] || list_transform(x[1:200], lambda v: '| ' || v.label || ' | true | ' || CASE WHEN v.present THEN 'true' ELSE 'false' END || ' |') || CASE WHEN len(x) > 200 THEN ['(more rows not shown)'] ELSE [] END
  || ['## To do', '| reason_code | action | targets |', '|---|---|---|', '| missing_score | find | ' || array_to_string(list_transform(x[1:8], lambda v: v.label), ', ') || CASE WHEN len(x) > 8 THEN ' +' || (len(x) - 8) || ' more' ELSE '' END || ' |', '## Documents', '| pdf_filename | quality_band |', '|---|---|']
  || list_transform(x[1:200], lambda v: '| ' || v.label || '.pdf | good |') || CASE WHEN len(x) > 200 THEN ['(more rows not shown)'] ELSE [] END AS lines FROM customer JOIN o ON o_custkey = c_custkey)
SELECT c_custkey AS piece_id, (unnest(range(1, len(lines) + 1)) - 1)::INT AS place, unnest(lines) AS line FROM r"""


@query(_REPORT_SQL)
def piece_report(spark, sf_dir):
    """Every piece's report, from its nested record."""
    label = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    part = F.struct(label.alias("label"), F.lit(True).alias("required"), (F.col("o_orderstatus") == "F").alias("present"))
    document = F.struct(F.concat(label, F.lit(".pdf")).alias("pdf_filename"), F.lit("good").alias("quality_band"))
    orders = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(part)).alias("expected_parts"), F.array_sort(F.collect_list(document)).alias("documents"), F.array_sort(F.collect_list(label)).alias("t"))
    item = F.struct(F.lit("missing_score").alias("reason_code"), F.lit("find").alias("action"), F.col("t").alias("targets"))
    both = load(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"))
    pieces = both.select(F.col("c_custkey").alias("piece_id"), F.col("c_name").alias("piece_folder"), F.lit("high").alias("severity"), F.lit("complete").alias("completeness_tier"), F.lit(0.5).alias("completeness_score"), "expected_parts", "documents", F.array(item).alias("action_items"))
    return reports.piece_reports(pieces).select("piece_id", F.posexplode("lines").alias("place", "line"))


@query("SELECT place::INT AS place, line FROM (VALUES (0, '# Tables'), (1, '## nation'), (2, '- `n_nationkey`: int'), (3, '- `n_name`: string'), (4, '- `n_regionkey`: int'), (5, '## region'), (6, '- `r_regionkey`: int, the region''s number'), (7, '- `r_name`: string')) v(place, line)")
def glossary(spark, sf_dir):
    return lines(spark, reports.glossary({"nation": load(spark, sf_dir, "nation"), "region": load(spark, sf_dir, "region")}, {"region.r_regionkey": "the region's number"}))


@query("SELECT piece_id, '[' || name || '](' || 'pieces/' || piece_id || '.md) - ' || severity AS line FROM (SELECT s_suppkey AS piece_id, s_name AS name, CASE WHEN s_acctbal < 0 THEN 'high' ELSE 'ok' END AS severity FROM supplier)")
def report_index(spark, sf_dir):
    """The lines of an index of reports."""
    rows = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("piece_id"), F.col("s_name").alias("piece_folder"), F.when(F.col("s_acctbal") < 0, "high").otherwise("ok").alias("severity"))
    return reports.index_lines(rows, "pieces")


@query("SELECT 'priority_queue' AS query, count(*) AS written, 1::BIGINT AS logged FROM customer UNION ALL SELECT 'part_labels', count(*), 1 FROM part UNION ALL SELECT 'not_there', 0, 1")
def command_line_stages(spark, sf_dir):
    """What the command line does with queries of its stages: each is written below a folder and logged; one that fails
    is logged too, and the others run."""
    import logging

    from foliant import __main__ as cli

    out, messages = new_folder(spark, "stages"), []
    handler = logging.Handler()
    handler.emit = lambda record: messages.append(record.getMessage())
    cli.log.addHandler(handler)
    level, quiet = cli.log.level, cli.log.propagate
    cli.log.setLevel(logging.INFO)
    cli.log.propagate = False
    try:
        names = ("priority_queue", "not_there", "part_labels")
        done = [(n, cli.run(spark, sf_dir, n, f"{out}/{n}")) for n in names]
    finally:
        cli.log.removeHandler(handler)
        cli.log.setLevel(level)
        cli.log.propagate = quiet
    rows = [spark.read.parquet(f"{out}/{n}").agg(F.count("*").alias("written")).select(F.lit(n).alias("query"), "written") if ok else spark.createDataFrame([(n, 0)], "query string, written long") for n, ok in done]
    logged = spark.createDataFrame([(n, sum(n in m for m in messages)) for n in names], "query string, logged long")
    return reduce(DataFrame.union, rows).join(logged, "query")


@query(
    """SELECT c_custkey, 'said of a/' || c_nationkey || '.png' || CASE WHEN c_nationkey % 2 = 0 THEN chr(10) || 'said of b/x.jpg' ELSE '' END AS found, CASE WHEN c_nationkey % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS images FROM customer WHERE c_nationkey % 5 > 0"""
)
def image_texts(spark, sf_dir):
    """What the images say that a text links to; every address is fetched once."""
    more = F.when(F.col("c_nationkey") % 2 == 0, " http://b/x.jpg http://gone/y.png").otherwise("")
    text = F.when(F.col("c_nationkey") % 5 > 0, F.concat(F.lit("see http://a/"), F.col("c_nationkey").cast("string"), F.lit(".png"), more)).otherwise("none")
    rows = load(spark, sf_dir, "customer").select("c_custkey", text.alias("t"))
    return readers.image_texts(rows, "c_custkey", "t", lambda u: None if "gone" in u else u.removeprefix("http://").encode(), lambda b: f"said of {b.decode()}")


@query(
    _report_sql("Instrumentation", _table_sql("Pieces", "piece_folder | method_label | parts", _ranked("SELECT s_name AS n, '| ' || s_name || ' | ' || CASE WHEN s_nationkey % 2 = 0 THEN 'OCR of local score' ELSE 'No authoritative source (observed parts only)' END || ' | flute, oboe |' AS line FROM supplier", "n", 500)) + " UNION ALL SELECT [4], '(more rows not shown)' FROM supplier HAVING count(*) > 500")
)
def instrumentation_report(spark, sf_dir):
    from foliant.operators.builders import provenance

    none = F.lit(None).cast("string")
    told = provenance(F.when(F.col("s_nationkey") % 2 == 0, "local_score_ocr").otherwise("conservative_fallback"), none, F.lit(1.0), none, none)
    rows = load(spark, sf_dir, "supplier").select(F.col("s_name").alias("piece_folder"), told["method_label"].alias("method_label"), F.array(F.lit("flute"), F.lit("oboe")).alias("parts"))
    return lines(spark, reports.instrumentation_report(rows))


@query("SELECT 0 AS ord, 'inventory' AS phase, 'orders' AS unit, count(*) AS records FROM orders UNION ALL SELECT 1, 'pages', 'line items', count(*) FROM lineitem UNION ALL SELECT 2, 'pieces', 'customers', count(*) FROM customer")
def processing_phases(spark, sf_dir):
    """How many records each phase has made."""
    return reports.phases([("inventory", "orders", load(spark, sf_dir, "orders")), ("pages", "line items", load(spark, sf_dir, "lineitem")), ("pieces", "customers", load(spark, sf_dir, "customer"))])


@query(
    _report_sql(
        "Collection",
        _table_sql("Severity", "key | n", _seeded("SELECT 99 AS ord, 'ok' AS key, count(*) AS n FROM supplier", ["high", "review", "ok"])),
        _table_sql("Completeness", "key | n", _seeded("SELECT 99 AS ord, 'complete' AS key, count(*) AS n FROM supplier", _TIERS)),
        _table_sql("Reasons", "key | n", _seeded("SELECT 99 AS ord, 'missing_score' AS key, 0 AS n", _REASONS)),
        _table_sql("Quality", "key | n", _seeded("SELECT 99 AS ord, CASE WHEN s_suppkey % 3 = 0 THEN 'poor' ELSE 'good' END AS key, count(*) AS n FROM supplier GROUP BY 2", ["good", "fair", "poor", "unknown"])),
        _table_sql("Versions", "record_version | n", "SELECT 1 AS k, '| 1.0 | ' || count(*) || ' |' AS line FROM supplier"),
        _table_sql("Most missing", "label | pieces", _ranked("SELECT s_nationkey AS m, count(*) AS n, '| part ' || s_nationkey || ' | ' || count(*) || ' |' AS line FROM supplier GROUP BY s_nationkey", "n DESC, 'part ' || m", 25)),
        "SELECT [5] AS o, line FROM (SELECT unnest(['## Attention', '| catalog_number | piece_folder | severity | reason_codes |', '|---|---|---|---|']) AS line)",
    ).replace("SELECT [7] || o, line FROM (SELECT [5] AS o, line FROM", "SELECT [7, o], line FROM (SELECT CASE WHEN line LIKE '##%' THEN 0 WHEN line LIKE '|-%' THEN 2 ELSE 1 END AS o, line FROM")
)
def full_dashboard(spark, sf_dir):
    """The dashboard with bands, versions and what most pieces lack."""
    c = F.col
    none = F.array().cast("array<string>")
    missing = F.array(F.struct(F.concat(F.lit("part "), c("s_nationkey").cast("string")).alias("label")))
    rows = load(spark, sf_dir, "supplier").select(c("s_suppkey").alias("piece_id"), F.lit("1").alias("catalog_number"), c("s_name").alias("piece_folder"), F.lit("ok").alias("severity"), F.lit("complete").alias("completeness_tier"), none.alias("reason_codes"), F.when(c("s_suppkey") % 3 == 0, "poor").otherwise("good").alias("worst_quality_band"), F.lit("1.0").alias("record_version"), missing.alias("missing_required_parts"))
    return lines(spark, reports.dashboard(rows))


@query(
    """SELECT c_nationkey AS file, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey))::INT AS page_num, CASE WHEN c_custkey % 9 = 0 THEN 'error' ELSE 'success' END AS processing_status, CASE WHEN c_custkey % 9 = 0 THEN 'page ' || c_custkey END AS error_message, CASE WHEN c_custkey % 9 > 0 THEN c_name END AS text FROM customer"""
)
def paged_reader(spark, sf_dir):
    """Pages of files, a file read by several tasks, damaged pages as rows."""
    from foliant.sources.paged import line_starts, read_lines, register_pages

    folder = new_folder(spark, "paged")
    rows = load(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.concat_ws("|", "c_custkey", "c_name").alias("line"))
    rows.repartition(8, "c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", "line").write.partitionBy("c_nationkey").text(folder)

    def local(path):
        return path.removeprefix("file://").removeprefix("file:")  # an injected reader brings its own access

    def read(path, first, last):
        for line in read_lines(local(path), first, last):
            number, name = line.split("|")
            if int(number) % 9 == 0:
                raise ValueError(f"page {number}")
            yield {"text": name}

    register_pages(spark, "foliant_pages", lambda path: len(line_starts(local(path))) - 1, read, "text string")
    pages = spark.read.format("foliant_pages").option("path", folder).option("ending", ".txt").option("pagesPerTask", 20).load()
    return pages.select(F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int").alias("file"), "page_num", "processing_status", "error_message", "text")


@query(
    """SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN NULL ELSE round(CASE WHEN degrees(atan2(p_size % 11, 12)) >= 45 THEN degrees(atan2(p_size % 11, 12)) - 90 ELSE degrees(atan2(p_size % 11, 12)) END, 3) END AS skew_angle_deg FROM part"""
)
def raster_skew(spark, sf_dir):
    """The angle of the least rectangle around each raster's ink; none where there is no ink."""
    import numpy as np
    import pandas as pd

    from foliant.operators.geometry import skew_angles

    def drawn(batches):
        for batch in batches:
            out = []
            for n in batch["n"]:
                g = np.full((60, 60), 230, np.uint8)
                for x, y in ((20, 5), (20 + 24, 5 + 2 * n), (20 - n, 5 + 12), (20 + 24 - n, 5 + 12 + 2 * n)) if n else ():
                    g[y, x] = 40
                out.append(g.tobytes())
            yield pd.DataFrame({"p_partkey": batch["p_partkey"], "raster": out, "width": 60, "height": 60})

    parts = load(spark, sf_dir, "part", "p_partkey", "p_size")
    rows = parts.select("p_partkey", (F.col("p_size") % 11).cast("int").alias("n"))
    rows = rows.repartition(tasks_for(parts, 10_000), "p_partkey")  # a small file, a large job
    return skew_angles(rows.mapInPandas(drawn, "p_partkey long, raster binary, width int, height int"), "p_partkey")
