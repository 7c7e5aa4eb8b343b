"""Joins, aggregates, matching, sources, sinks and streams on small tables."""
import json

import pytest
from pyspark.sql import functions as F

from foliant.operators import aggregates as A
from foliant.operators import joins as J
from foliant.operators import plugins as G
from foliant.operators import reconcile as R
from foliant.operators import records as C
from foliant.sources import readers, sinks
from foliant.streaming import incremental as I


def test_dictionary_matches(spark):
    aliases = [("clarinet", "clarinet"), ("bass_clarinet", "bass clarinet"), ("oboe", "oboe"), ("clarinet", "cl"), ("bass", "bass")]
    dim = spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(aliases)], "canonical string, alias string, pos int")
    texts = spark.createDataFrame([(1, "bass clarinet 2"), (2, "oboe and bass clarinet"), (3, "claron"), (4, "")], "k int, t string")
    hits = J.dictionary_hits(texts, "k", "t", dim)
    best = {r.k: r for r in J.best_match(hits, "k").collect()}
    assert {k: r.canonical for k, r in best.items()} == {1: "bass_clarinet", 2: "bass_clarinet"}
    assert [x.canonical for x in best[1].alternates] == ["clarinet", "bass"]
    first = {r.k: r.canonical for r in J.best_match(hits, "k", earliest=True).collect()}
    assert first == {1: "bass_clarinet", 2: "oboe"}
    found = texts.select("k", R.all_matches(F.col("t"), [(c, a) for c, a in aliases]).alias("m")).collect()
    assert {r.k: r.m for r in found} == {1: ["bass_clarinet"], 2: ["oboe", "bass_clarinet"], 3: [], 4: []}


def slot(piece, pos, name, index=None, label=None, key=None):
    label = label or name
    return (piece, pos, name, index, label, "solo" if "solo" in label.lower() else "section", key)


def part(piece, name, pos, facets, clef=None, key=None, role="section"):
    return [(piece, name, pos, c, i, name, clef, key, role) for c, i in facets]


def matched(spark, slots, parts, **kw):
    s = spark.createDataFrame(slots, "piece_id string, pos int, canonical string, part_index int, label string, role string, transposition string")
    h = spark.createDataFrame([r for p in parts for r in p], "piece_id string, part string, pos int, canonical string, part_index int, label string, clef string, transposition string, role string")
    rows = R.reconcile(s, h, **kw).collect()
    return {(r.piece_id, r.pos): r.matched_part for r in rows if r.kind == "slot"}, sorted(r.matched_part for r in rows if r.kind == "unexpected")


def test_reconcile_chairs_then_order(spark):
    got, extra = matched(spark, [slot("p", 0, "flute", 1), slot("p", 1, "flute", 2), slot("p", 2, "oboe")], [part("p", "f2", 0, [("flute", 2)]), part("p", "f", 1, [("flute", None)]), part("p", "tuba", 2, [("tuba", None)])])
    assert got == {("p", 0): "f", ("p", 1): "f2", ("p", 2): None} and extra == ["tuba"]


def test_reconcile_doubling_and_roles(spark):
    slots = [slot("p", 0, "flute", 1), slot("p", 1, "piccolo"), slot("p", 2, "cornet", None, "Solo Cornet"), slot("q", 0, "horn", None, key="F")]
    parts = [part("p", "fl+picc", 0, [("flute", 1), ("piccolo", None)]), part("p", "sec", 1, [("cornet", None)]), part("p", "solo", 2, [("cornet", None)], role="solo"), part("q", "eb", 0, [("horn", None)], key="Eb"), part("q", "f", 1, [("horn", None)], key="F")]
    got, extra = matched(spark, slots, parts)
    assert got == {("p", 0): "fl+picc", ("p", 1): "fl+picc", ("p", 2): "solo", ("q", 0): "f"}
    assert extra == ["eb", "sec"]


def test_reconcile_editions_and_equivalents(spark):
    both = [part("p", "tc", 0, [("euphonium", None)], "treble"), part("p", "bc", 1, [("euphonium", None)], "bass")]
    got, extra = matched(spark, [slot("p", 0, "euphonium")], both)
    assert got == {("p", 0): "tc"} and extra == []
    got, _ = matched(spark, [slot("p", 0, "euphonium"), slot("p", 1, "euphonium")], both)
    assert got == {("p", 0): "tc", ("p", 1): "bc"}
    horn = [part("p", "bar", 0, [("baritone_horn", None)])]
    groups = [["euphonium", "baritone_horn"]]
    assert matched(spark, [slot("p", 0, "euphonium")], horn, groups=groups)[0] == {("p", 0): "bar"}
    assert matched(spark, [slot("p", 0, "euphonium"), slot("p", 1, "baritone_horn")], horn, groups=groups)[0] == {("p", 0): None, ("p", 1): "bar"}
    variants = [part("p", "a1", 0, [("sax", 1)]), part("p", "a2", 1, [("sax", 2)])]
    got, extra = matched(spark, [slot("p", 0, "sax")], variants)
    assert got == {("p", 0): "a1"} and extra == []


def test_equivalences_and_links(spark):
    slots = spark.createDataFrame([("p", "euphonium"), ("q", "euphonium"), ("q", "baritone_horn")], "piece_id string, canonical string")
    groups = spark.createDataFrame([(1, "euphonium"), (1, "baritone_horn")], "grp int, canonical string")
    assert [tuple(r) for r in R.equivalences(slots, groups).collect()] == [("p", "euphonium", "baritone_horn")]
    s = spark.createDataFrame([("p", 1, 1, "section"), ("p", 2, 3, "section"), ("p", 3, None, "solo")], "k string, slot int, part_index int, role string")
    d = spark.createDataFrame([("p", "a", 1, "section"), ("p", "b", 1, "solo"), ("p", "c", None, "section")], "k string, doc string, part_index int, role string")
    got = {r.slot: (r.level, r.docs) for r in J.linked(s, d, ["k"]).collect()}
    assert got == {1: (1, ["a"]), 2: (3, ["c"]), 3: (1, ["b"])}


def test_scores_and_adjudication(spark):
    pages = spark.createDataFrame([("d", 1, ["heavy_blur"]), ("d", 2, ["heavy_blur", "low_contrast"]), ("d", 3, []), ("e", 1, [])], "d string, page_num int, issues array<string>")
    got = {r.d: r for r in A.score_documents(pages, "d").collect()}
    assert got["d"].quality_score == pytest.approx(100 - 30 * 2 / 3 - 20 / 3, abs=0.05)
    assert (got["d"].quality_band, got["d"].top_issues, got["d"].page_issue_count, got["d"].worst_page) == ("fair", ["heavy_blur", "low_contrast"], 2, 2)
    assert got["d"].issue_summary == {"heavy_blur": 2, "low_contrast": 1} and got["e"].worst_page is None
    rows = spark.createDataFrame([("good", "handwritten", "good", 0.9, "success"), ("good", "printed", "poor", 0.9, "success"), ("good", "handwritten", "poor", 0.4, "success"), ("poor", "printed", "fair", 0.9, "success"), ("good", None, "poor", 0.9, "success")], "b string, s string, l string, c double, st string")
    v = [r.v for r in rows.select(A.adjudicate(*[F.col(x) for x in ("b", "s", "l", "c", "st")], F.lit("mixed")).alias("v")).collect()]
    assert [(x.applied, x.notation_source_type, x.quality_band, x.new_issues) for x in v] == [(True, "handwritten", "good", ["handwritten"]), (True, "printed", "poor", ["low_legibility"]), (False, "mixed", "good", []), (True, "printed", "poor", []), (False, "mixed", "good", [])]


def test_notation(spark):
    rows = spark.createDataFrame([(0.5, None, None), (0.0, 0.9, None), (0.0, 0.2, 0.4), (0.0, 0.2, None), (0.0, None, 0.8), (0.0, None, 0.4), (0.0, None, None)], "s double, c double, a double")
    got = [tuple(r.n) for r in rows.select(A.notation_source(F.col("s"), F.col("c"), F.col("a")).alias("n")).collect()]
    assert got == [("printed", 0.75), ("printed", 0.9), ("handwritten", 0.85), ("mixed_or_uncertain", 0.3), ("printed", 0.4), ("handwritten", 0.4), ("mixed_or_uncertain", 0.0)]


def test_findings(spark):
    df = spark.createDataFrame([(True, False, True), (False, False, True), (False, False, False)], "a boolean, b boolean, c boolean")
    codes = A.reason_codes({"duplicate_parts": F.col("c"), "missing_score": F.col("a"), "unexpected_parts": F.col("b")})
    got = [(r.codes, r.s) for r in df.select(codes.alias("codes"), A.severity(codes).alias("s")).collect()]
    assert got == [(["missing_score", "duplicate_parts"], "high"), (["duplicate_parts"], "review"), ([], "ok")]


def test_distribution_and_bands(spark):
    df = spark.createDataFrame([("good",), ("odd",), (None,), ("good",)], "b string")
    got = [tuple(r) for r in A.seeded_distribution(df, F.col("b"), ["good", "fair"]).orderBy("ord", "key").collect()]
    assert got == [(0, "good", 2), (1, "fair", 0), (2, "odd", 1), (2, "unknown", 1)]
    assert df.agg(A.worst_band(F.col("b"))).first()[0] == "good"
    assert tuple(df.agg(*A.band_counts(F.col("b"))).first()) == (2, 0, 0, 2)
    assert tuple(spark.createDataFrame([(0.5,), (1.0,)], "v double").agg(*A.number_summary(F.col("v"))).first()) == (2, 0.75, 0.75, 0.5, 1.0)


def test_best_pass_and_duplicates(spark):
    df = spark.createDataFrame([(1, [(0.9, 4, "a"), (0.6, 9, "b"), (0.5, 16, "c")])], "i int, c array<struct<confidence:double,word_count:int,text:string>>")
    assert df.select(A.best_pass(F.col("c"))["text"]).first()[0] == "c"
    d = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "i int, k string")
    assert {r.i: r.duplicate for r in A.flag_duplicates(d, "k").collect()} == {1: True, 2: True, 3: False}


def test_records(spark):
    df = spark.createDataFrame([(1, [(1.0, "x")], {"n": 2})], "i int, a array<struct<p:double,t:string>>, m map<string,int>").withColumn("s", F.struct(F.lit("v").alias("f"), F.array(F.lit("p"), F.lit("q")).alias("g")))
    got = {r.metric: r.value for r in C.metric_rows(df, skip=("i",)).collect()}
    assert got["s.f"] == "v" and got["s.g"] == "p; q" and json.loads(got["m"]) == {"n": 2}
    assert C.flattened(df, "a", "i").columns == ["i", "p", "t"]
    spans = spark.createDataFrame([([(0.1, 0.1, "Flute"), (0.5, 0.1, "March"), (0.9, 0.05, "Doe"), (0.5, 0.9, "(c)")],)], "s array<struct<x:double,y:double,text:string>>")
    assert tuple(spans.select(C.zones(F.col("s")).alias("z")).first().z) == ("Flute", "March", "Doe", "(c)")
    pages = spark.createDataFrame([(None, "ocr words", True), ("real text", None, False), ("\ue001", "", True)], "embedded_text string, ocr_text string, is_image_based boolean")
    assert [(r.text_source, r.needs_ocr) for r in C.page_text(pages).collect()] == [("ocr", True), ("embedded", False), ("none", True)]
    assert C.envelope(pages, "1.0").columns[-4:] == ["record_version", "run_id", "processing_status", "processing_timestamp"]


def test_library_scan_and_probe(spark, tmp_path):
    (tmp_path / "lib/One/sub").mkdir(parents=True)
    (tmp_path / "lib/One/sub/a.pdf").write_bytes(b"%PDF-1.4 /Type /Page /Type /Pages %%EOF")
    (tmp_path / "lib/b.PDF").write_bytes(b"junk")
    (tmp_path / "lib/c.txt").write_text("no")
    files = readers.scan_library(spark, str(tmp_path / "lib"), content=True)
    got = {r.pdf_path: r for r in readers.probe_documents(files).collect()}
    assert set(got) == {"One/sub/a.pdf", "b.PDF"}
    assert got["One/sub/a.pdf"].piece_folder == "One" and got["b.PDF"].piece_folder == "b"
    assert got["One/sub/a.pdf"].health.page_count == 1 and got["One/sub/a.pdf"].health.pdf_readable and not got["b.PDF"].health.pdf_readable

    def extract(content):
        if content == b"junk":
            raise ValueError("bad")
        yield {"page_num": 1, "text": "hello"}

    rows = {r.pdf_path: r for r in readers.read_pages(files, extract, "pdf_path string, page_num int, text string, processing_status string, error_message string").collect()}
    assert rows["One/sub/a.pdf"].text == "hello" and rows["b.PDF"].processing_status == "error"


def test_json_sources_and_sinks(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n[1]\n{"a": 2}\n')
    assert sorted(r.a for r in readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").collect() if r.a) == [1, 2]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/p.json").write_text('{"piece_id": "p",\n "n": 1}')
    (tmp_path / "d/q.json").write_text('{"n": 2}')
    (tmp_path / "d/.ck.json").write_text("{}")
    rows, skipped = readers.read_json_folder(spark, str(tmp_path / "d"), "piece_id string, n int", "piece_id")
    assert [r.piece_id for r in rows.collect()] == ["p"] and skipped.first().skipped == 1
    df = spark.createDataFrame([("a|b", ["x", "y"], True, None)], "t string, l array<string>, f boolean, n int")
    sinks.write_csv(df, str(tmp_path / "csv"), single=True)
    assert next((tmp_path / "csv").glob("*.csv")).read_text().splitlines() == ["t,l,f,n", "a|b,x; y,True,"]
    assert "| a\\|b | x; y | true |" in sinks.markdown_report("R", [("S", df, 5)])
    sinks.write_object("hi", str(tmp_path / "o.txt"), spark)
    assert (tmp_path / "o.txt").read_text() == "hi"
    lines = [r.module for r in sinks.data_module(df.select("t"), "k").orderBy("place").collect()]
    assert "".join(lines) == 'register("k", [{"t":"a|b"},]);'
    sinks.write_object("new", str(tmp_path / "o.txt"), spark)
    assert (tmp_path / "o.txt").read_text() == "new" and not list(tmp_path.glob("*.tmp"))
    sinks.assert_writable(str(tmp_path / "w"), spark)
    sinks.write_per_key(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), "k", str(tmp_path / "per"))
    sinks.write_per_key(spark.createDataFrame([("a", 3)], "k string, v int"), "k", str(tmp_path / "per"))
    assert sorted(tuple(r) for r in spark.read.json(str(tmp_path / "per")).select("k", "v").collect()) == [("a", 3), ("b", 2)]
    gone = sinks.orphans(spark.read.json(str(tmp_path / "per")), spark.createDataFrame([("a",)], "k string"), "k")
    assert [r.k for r in gone.collect()] == ["b"]
    assert sinks.prune(str(tmp_path / "per"), "k", spark.createDataFrame([("a",)], "k string")) == ["b"]
    assert [r.k for r in spark.read.json(str(tmp_path / "per")).select("k").collect()] == ["a"]
    files = spark.createDataFrame([("d/p.json",), ("none",)], "pdf_path string")
    for status in ("copied", "present"):
        done = {r.pdf_path: (r.bytes, r.status) for r in sinks.copy_files(files, f"file://{tmp_path}", f"file://{tmp_path}/copy").collect()}
        assert done == {"d/p.json": (26, status), "none": (-1, "error: FileNotFoundError")}
    (tmp_path / "y.jsonl").write_text('{"a": 1}\n{"a": "x", "b": "kept"}\n\nbad\n[1]\n')
    assert [(r.a, r.b) for r in readers.read_jsonl(spark, str(tmp_path / "y.jsonl"), "a int, b string").collect()] == [(1, None), (None, "kept")]
    assert [r._corrupt_record for r in readers.read_jsonl(spark, str(tmp_path / "y.jsonl"), "a int", with_rejects=True).collect() if r._corrupt_record] == ["bad", "[1]"]


def test_settings_and_lexicon(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("a:\n  x: 5\n  y:\nb: null\nz: 1\n")
    assert readers.merged_settings({"a": {"x": 1, "y": 2}, "b": 3}, str(tmp_path / "s.yaml")) == {"a": {"x": 5, "y": 2}, "b": 3}
    lex = readers.lexicon(spark, {"instruments": {"flute": ["Flute", "fl"], "bass_clarinet": ["Bass-Clarinet"]}, "sections": {"winds": ["flute"]}, "families": {"woodwind": ["flute", "bass_clarinet"]}})
    assert {(r.canonical, r.alias, r.section) for r in lex.collect()} == {("flute", "flute", "winds"), ("flute", "fl", "winds"), ("bass_clarinet", "bass clarinet", "woodwind")}


def test_lookup_sources(spark):
    assert readers.title_variations("The March", "012 The March") == ["The March", "March"]
    assert readers.title_variations("unknown", "12 Suite") == ["Suite"] and readers.title_variations(None, None) == []
    calls = []

    def get(params, left):
        calls.append(params["action"])
        if params["action"] == "opensearch":
            return ["x", []]
        if params["action"] == "query":
            return {"query": {"search": [{"title": "Suite (band)"}] if params["srsearch"] == "Suite" else []}}
        if params["prop"] == "sections":
            return {"parse": {"sections": [{"line": "History", "index": 1}, {"line": "Instrumentation", "index": 2}]}}
        return {"parse": {"wikitext": {"*": f"section {params.get('section')}"}}}

    assert readers.wiki_text(get, "The Suite", None) == "Suite (band)\n\nsection 2"
    assert calls == ["opensearch", "query", "opensearch", "query", "parse", "parse"]
    ticks = iter(range(0, 100, 4))
    assert readers.wiki_text(get, "The Suite", None, clock=lambda: next(ticks)) is None  # the budget is used up
    assert readers.wiki_text(lambda p, s: {}["x"], "a", None) is None
    df = spark.createDataFrame([(1, "Suite", "1 x"), (2, "Suite", None)], "k long, title string, folder string")
    got = {r.k: (r.text, r.status) for r in readers.looked_up(df, "k", lambda p, s: get.__call__(p, s), spark.createDataFrame([(2, "old")], "k long, text string")).collect()}
    assert got == {1: ("Suite (band)\n\nsection 2", "success"), 2: ("old", "cached")}
    said = {r.k: (r.text, r.status[:5]) for r in readers.fetched(spark.createDataFrame([("a",), ("b",)], "k string"), "k", readers.command_source(["cat"])).collect()}
    assert said == {"a": ("a", "succe"), "b": ("b", "succe")}
    slow = readers.fetched(spark.createDataFrame([("a",)], "k string"), "k", readers.command_source(["sleep", "5"], 0.2)).first()
    assert slow.text is None and "timed out" in slow.status
    docs = spark.createDataFrame([("a", "short"), ("b", "x" * 300), ("c", None)], "pdf_path string, text string")
    again = {r.pdf_path: (r.text, r.reread) for r in readers.reread_pages(docs, lambda p: "longer text" if p == "a" else None).collect()}
    assert again["a"] == ("longer text", True) and again["b"][1] is False and again["c"] == (None, False)


def test_dictionary_overlays(spark):
    base = {"instruments": {"flute": ["flute"]}, "transposition_markers": {"in f": "F"}, "score_types": {"full": ["full score"]}, "interchangeable": [["a", "b"]]}
    got = readers.merged_lexicon(base, {"instruments": {"oboe": ["oboe"], "flute": ["fl"]}, "clef_markers": {"TC": "treble"}, "score_types": None})
    assert got["instruments"] == {"flute": ["fl"], "oboe": ["oboe"]} and got["score_types"] == {"full": ["full score"]}
    rows = {(r.kind, r.marker, r.value) for r in readers.markers(spark, got).collect()}
    assert rows == {("clef_markers", "tc", "treble"), ("transposition_markers", "in f", "F"), ("score_types", "full score", "full"), ("interchangeable", "a", "0"), ("interchangeable", "b", "0")}
    assert readers.merged_settings({"a": {"x": 1}}, {"a": {"x": 2, "z": 3}, "q": 1}) == {"a": {"x": 2}}


def test_plugins(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i int, t string")

    def fn(row):
        if row["t"] == "c":
            raise RuntimeError("no")
        return {"found": row["t"].upper()} if row["t"] == "a" else None

    first = G.enrich(df, "i", ["t"], fn, "found string")
    assert {r.i: r.status for r in first.collect()} == {1: "success", 2: "not_found", 3: "error: no"}
    second = G.enrich(df, "i", ["t"], lambda r: {"found": "fallback"}, "found string")
    assert {r.i: (r.found, r.stage) for r in G.staged(df, "i", [("one", first), ("two", second)], "found").collect()} == {1: ("A", "one"), 2: ("fallback", "two"), 3: ("fallback", "two")}
    raster = bytes([0] * 100 + [255] * 300)
    m = G.gray_metrics(raster, 20, 20)
    assert m["text_density"] == 0.25 and m["staff_line_count"] == 1 and not m["has_staves"]
    pix = spark.createDataFrame([(1, bytearray(raster), 20, 20), (2, None, None, None)], "i int, raster binary, width int, height int")
    assert {r.i: r.text_density for r in G.pixel_metrics(pix, "i").collect()} == {1: 0.25, 2: None}


def test_incremental(spark):
    version = "2.0"
    cur = spark.createDataFrame([("a", "f1"), ("b", "f2"), ("c", "f3")], "k string, fingerprint string")
    work = lambda d: d.withColumn("out", F.concat(F.lit("new-"), F.col("k")))
    prev = spark.createDataFrame([("a", "f1", "old-a", "2.0"), ("b", "zz", "old-b", "2.0"), ("c", "f3", "old-c", "1.0"), ("gone", "g", "x", "2.0")], "k string, fingerprint string, out string, record_version string")
    got = {r.k: (r.out, r.reused) for r in I.run_incremental(cur, prev, "k", version, work).collect()}
    assert got == {"a": ("old-a", True), "b": ("new-b", False), "c": ("new-c", False)}
    assert [r.k for r in I.gone(prev, cur, "k").collect()] == ["gone"]
    assert I.run_incremental(cur, None, "k", version, work).count() == 3


def test_stream_upserts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda name, *rows: (tmp_path / "in" / name).write_text("".join(json.dumps(dict(zip(("k", "n", "fingerprint"), r))) + "\n" for r in rows))
    seen = []

    def run():
        q = I.upsert_stream(I.file_stream(spark, str(tmp_path / "in"), "k string, n int, fingerprint string"), "k", "n", str(tmp_path / "table"), str(tmp_path / "ck"), on_batch=lambda b, n: seen.append((b, n)))
        q.awaitTermination(120)
        assert q.exception() is None

    put("1.json", ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"))
    run()
    put("2.json", ("a", 3, "y"), ("b", 2, "w"))
    run()
    got = {r.k: (r.n, r.fingerprint) for r in I.latest(spark, str(tmp_path / "table"), "k").collect()}
    assert got == {"a": (2, "y"), "b": (2, "w")} and seen == [(0, 2), (1, 1)]


def test_sheets_and_views(spark, sf, tmp_path):
    from foliant.plans.tables import register_views

    full = spark.createDataFrame([("a" * 100, True)], "t string, f boolean")
    widths = sinks.write_sheets({"one": full, "none": full.limit(0)}, str(tmp_path))
    assert widths == {"one": [60, 6], "none": [3, 3]}
    assert next((tmp_path / "none").glob("*.csv")).read_text().splitlines() == ["note", "(no data)"]
    register_views(spark, sf, ["region"])
    assert spark.sql("select r_name from region where r_regionkey = 0").first().r_name == "AFRICA"


def test_rasters(spark, tmp_path):
    import hashlib

    import numpy as np

    from foliant.sources import rasters as P

    gray = np.arange(60, dtype=np.uint8).reshape(6, 10)
    assert np.array_equal(P.read_png(P.png_bytes(gray)), gray)
    assert P.shrunk(gray, 20) is gray and P.shrunk(gray, 5).shape == (3, 5) and P.shrunk(gray, 5)[0, 0] == round((0 + 1 + 10 + 11) / 4)
    df = spark.createDataFrame([(1, bytearray(gray.tobytes()), 10, 6), (2, bytearray(gray.tobytes()), 10, 6), (3, None, 1, 1)], "k long, raster binary, width int, height int")
    rows = {r.k: r for r in P.write_rasters(df, "k", f"file://{tmp_path}").collect()}
    digest = hashlib.sha256(gray.tobytes()).hexdigest()
    assert rows[1].path == rows[2].path == f"{digest[:2]}/{digest}.png" and (rows[1].width, rows[1].height) == (10, 6)
    assert np.array_equal(P.read_png((tmp_path / rows[1].path).read_bytes()), gray) and rows[3].status.startswith("error") and rows[3].path is None
    (tmp_path / rows[1].path).write_bytes(b"kept")
    P.write_rasters(df, "k", f"file://{tmp_path}").collect()
    assert (tmp_path / rows[1].path).read_bytes() == b"kept"
    small = P.write_rasters(df, "k", f"file://{tmp_path}", edge=5, rebuild=True).where("k = 1").first()
    assert (small.width, small.height) == (5, 3) and P.read_png((tmp_path / small.path).read_bytes()).shape == (3, 5)


def test_workbook(spark, tmp_path):
    import io
    import zipfile

    from foliant.sources import workbook as B

    assert [B.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    df = spark.createDataFrame([(1, 'a<&">\x01b', True, None, 1.5, "w" * 99)], "i int, t string, f boolean, n string, d double, long string")
    B.write_workbook({"one & two": df, "none": df.limit(0)}, str(tmp_path / "b.xlsx"), spark)
    raw = (tmp_path / "b.xlsx").read_bytes()
    assert B.read_workbook(raw) == {"one & two": [["i", "t", "f", "n", "d", "long"], ["1", 'a<&">b', "True", "", "1.5", "w" * 99]], "none": [["note"], ["(no data)"]]}
    sheet = zipfile.ZipFile(io.BytesIO(raw)).read("xl/worksheets/sheet1.xml").decode()
    assert 'state="frozen"' in sheet and '<autoFilter ref="A1:F2"/>' in sheet and 'width="62"' in sheet


def test_first_pages_and_lines(spark):
    pages = spark.createDataFrame([("d", 1, True, 0.5, [(0.9,)]), ("d", 2, False, 0.7, None), ("d", 3, True, 1.0, None)], "d string, page_num int, ocr_applied boolean, ocr_confidence double, ocr_candidates array<struct<confidence:double>>")
    assert tuple(A.first_pages_confidence(pages, "d").first()) == ("d", 0.5, 0.9)
    spans = spark.createDataFrame([([(0.5, 0.2, 20.0, "March"), (0.1, 0.1, 18.0, "Flute"), (0.9, 0.1, 8.0, "Doe")],)], "s array<struct<x:double,y:double,size:double,text:string>>")
    assert spans.select(C.prominent(F.col("s")).alias("p")).first().p == ["Flute", "March"]
    assert spans.select(C.excerpt_lines(F.lit(" a \n\n b"))).first()[0] == ["a", "b"]


def test_skew():
    import numpy as np

    g = np.full((200, 300), 255, np.uint8)
    for base in range(20, 190, 15):
        for x in range(300):
            g[int(round(base - x * np.tan(np.radians(2.0)))) % 200, x] = 0
    assert abs(G.skew_angle(g.tobytes(), 300, 200) - 2.0) <= 0.5
    assert G.skew_angle(np.full((10, 10), 255, np.uint8).tobytes(), 10, 10) is None


def test_index_matches_test_keys_before_they_number(spark):
    """A slot in F takes the part in F though one in Eb comes first; slots or parts without a key take what is left."""
    kind = "piece_id string, {0} int, canonical string, part_index int, role string, transposition string"
    slots = spark.createDataFrame([("p", 0, "horn", 1, "section", "F"), ("p", 1, "horn", 2, "section", None), ("p", 2, "horn", 3, "section", "F"), ("p", 3, "horn", 4, "section", "F")], kind.format("slot"))
    held = spark.createDataFrame([("p", 10, "horn", 1, "section", "Eb"), ("p", 11, "horn", 1, "section", " f"), ("p", 12, "horn", 2, "section", "Eb"), ("p", 13, "horn", 3, "section", None), ("p", 14, "horn", 4, "section", "Eb")], kind.format("part"))
    assert sorted((r.slot, r.part) for r in R.exact_index_matches(slots, held).collect()) == [(0, 11), (1, 12), (2, 13)]
    s = [("p", i, "horn", i + 1, "horn", "section", k) for i, k in enumerate(["F", None, "F", "F"])]
    h = [[("p", str(10 + i), i, "horn", n, "horn", None, k, "section")] for i, (n, k) in enumerate([(1, "Eb"), (1, "f"), (2, "Eb"), (3, None), (4, "Eb")])]
    got, _ = matched(spark, s, h)
    assert {k: v for k, v in got.items() if v} == {("p", 0): "11", ("p", 1): "12", ("p", 2): "13"}


def test_editions_in_dataframes(spark):
    kind = "piece string, facet string, part int, clef string, transposition string"
    parts = spark.createDataFrame([("p", "euph", 1, "treble", None), ("p", "euph", 2, "bass", None), ("q", "euph", 1, "treble", None), ("q", "euph", 2, "bass", None), ("r", "sax", 1, None, "Eb")], kind)
    demand = spark.createDataFrame([("p", "euph", 1), ("q", "euph", 2)], "piece string, facet string, demand int")
    got = sorted((r.piece, r.part, r.clefs, r["keys"]) for r in R.editions(parts, demand, ["piece", "facet"]).collect())
    assert got == [("p", 1, ["bass", "treble"], []), ("q", 1, ["treble"], []), ("q", 2, ["bass"], []), ("r", 1, [], ["Eb"])]


def test_nested_metrics_and_bands(spark):
    df = spark.createDataFrame([((1, ["x", "y"]), [("a", 1), ("b", None)], {"k": 2})], "s struct<n:int,l:array<string>>, t array<struct<name:string,v:int>>, m map<string,int>")
    assert [tuple(r) for r in C.metric_rows(df).collect()] == [("s.n", "1"), ("s.l", "x; y"), ("t[0].name", "a"), ("t[0].v", "1"), ("t[1].name", "b"), ("t[1].v", None), ("m", '{"k":2}')]
    bands = spark.createDataFrame([(["good", None, "poor"],), ([None],), ([],), (None,)], "b array<string>")
    assert [r[0] for r in bands.select(A.worst_of(F.col("b"))).collect()] == ["poor", None, None, None]


def test_stages_of_the_command_line(spark, sf, tmp_path, capsys):
    from foliant import __main__ as cli
    from foliant.plans.registry import queries

    assert all(q in queries() for names in cli.STAGES.values() for q in names)
    assert cli.main(["x"]) == 2 and "inventory" in capsys.readouterr().out
    assert cli.main([sf, "review", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out/review_entries")).count() > 0
    assert cli.main(["/none", "priority_queue"]) == 1
