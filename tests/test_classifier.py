"""Classification, slots and reports on small tables."""
from pyspark.sql import functions as F

from foliant.operators import classifier as K
from foliant.operators import slots as S
from foliant.plans import reports
from foliant.sources.readers import lexicon

LEXICON = {
    "instruments": {"flute": ["flute", "fl"], "piccolo": ["piccolo", "picc"], "oboe": ["oboe"], "horn": ["horn", "french horn"], "tuba": ["tuba"], "trombone": ["trombone"], "clarinet": ["clarinet"], "snare_drum": ["snare drum"], "percussion": ["percussion"], "score": ["full score"]},
    "sections": {"woodwind": ["flute", "piccolo", "oboe", "clarinet"], "brass": ["horn", "tuba", "trombone"], "percussion": ["snare_drum", "percussion"]},
}
KIND = "pdf_path string, name string, is_score boolean, upper_left string, full_text string, transposition string, llm array<string>, llm_confidence double, vision array<string>, vision_chairs array<int>, vision_confidence double"


def doc(path, name, **kw):
    base = dict.fromkeys(x.split()[0] for x in KIND.split(", "))
    return {**base, "pdf_path": path, "name": name, **kw}


def test_name_facets(spark):
    df = spark.createDataFrame([(1, "Horn 1 & 2"), (2, "Flute & Piccolo"), (3, "Flutes 2-3"), (4, "flute 2–3"), (5, "unknown"), (6, "Oboe")], "k int, name string")
    got = {r.k: [tuple(f) for f in r.facets] for r in K.name_facets(df, "k", "name", lexicon(spark, LEXICON)).collect()}
    assert got[1] == [("horn", 1), ("horn", 2)] and got[2] == [("flute", None), ("piccolo", None)]
    assert got[4] == [("flute", 2), ("flute", 3)] and 5 not in got and got[6] == [("oboe", None)]


def test_decision_list(spark):
    docs = [
        doc("score", "Full Score", is_score=True),
        doc("name", "Flute 1"),
        doc("agree", "Flute 1", upper_left="Flute 1", transposition="F"),
        doc("cross", "Trombone", upper_left="Tuba"),
        doc("credit", "Tuba", full_text="arranged by a trombone player"),
        doc("noise", "Flute", full_text="to the tuba section"),
        doc("text", "part", upper_left="Oboe"),
        doc("llm", "Flute 2", llm=["flute"]),
        doc("llm_far", "Flute", llm=["tuba"], llm_confidence=0.9),
        doc("vision", "xx", vision=["horn"], vision_chairs=[1, 2]),
        doc("prefer", "Flute", llm=["flute", "piccolo"], llm_confidence=0.7, vision=["flute"], vision_confidence=0.9),
        doc("chairs", "Oboe", upper_left="March op 12 ist & 2nd Oboe"),
        doc("none", "zzz"),
    ]
    got = {r.pdf_path: r for r in K.classify(spark.createDataFrame(docs, KIND), lexicon(spark, LEXICON)).collect()}
    view = {k: ([tuple(f) for f in r.instruments], round(r.confidence, 2), r.evidence_source, r.conflict) for k, r in got.items()}
    assert view["score"] == ([], 0.9, "filename", False)
    assert view["name"] == ([("flute", 1)], 0.75, "filename", False)
    assert view["agree"] == ([("flute", 1)], 0.95, "combined", False)
    assert view["cross"] == ([("tuba", None)], 0.8, "combined", False)
    assert view["credit"][0] == [("tuba", None)]
    assert view["noise"] == ([("flute", None)], 0.75, "filename", False)
    assert view["text"] == ([("oboe", None)], 0.5, "text", False)
    assert view["llm"] == ([("flute", 2)], 0.9, "combined", False)
    assert view["llm_far"] == ([("tuba", None)], 0.7, "combined", True)
    assert view["vision"] == ([("horn", 1), ("horn", 2)], 0.8, "vision", False)
    assert view["prefer"] == ([("flute", None)], 0.88, "combined", False)
    assert view["chairs"][0] == [("oboe", 1), ("oboe", 2)]
    assert view["none"] == ([], 0.0, "none", False) and got["none"].needs_review and got["llm_far"].needs_review


def test_sub_instruments(spark):
    df = spark.createDataFrame([("orchestra bells xylophone and vibes",), ("cymbals",)], "t string")
    assert [r.s for r in df.select(K.sub_instruments(F.col("t")).alias("s")).collect()] == [["Bells", "Xylophone", "Vibraphone"], []]


def test_book_of_mallets(spark):
    words = {"instruments": {"mallet_percussion": ["mallets", "bells", "xylophone"], "flute": ["flute"]}, "sections": {"percussion": ["mallet_percussion"], "woodwind": ["flute"]}}
    docs = [
        doc("book", "Mallets", upper_left="Bells, Xylophone & Vibes"),
        doc("one", "Mallets", upper_left="Xylophone"),
        doc("chair", "Mallets 2", upper_left="Bells and Xylophone"),
        doc("score", "Full Score", is_score=True, full_text="bells xylophone"),
        doc("other", "Flute", full_text="with bells and marimba"),
        doc(None, "Mallets", full_text=None),
    ]
    lex = lexicon(spark, words)
    got = {r.pdf_path: r for r in K.classify(spark.createDataFrame(docs, KIND), lex).collect()}
    assert got["book"].details == ["Bells", "Xylophone", "Vibraphone"] and [tuple(f) for f in got["book"].instruments] == [("mallet_percussion", None)] * 3
    assert got["one"].details is None and len(got["one"].instruments) == 1
    assert got["chair"].details is None and got["chair"].instruments[0].part_index == 2
    assert got["score"].details is None and got["score"].instruments == [] and got["other"].details is None
    label = spark.createDataFrame(docs[:2], KIND).withColumn("vision_label", F.lit("Marimba"))
    assert {r.pdf_path: r.details for r in K.classify(label, lex).collect()}["one"] == ["Xylophone", "Marimba"]
    assert K.classify(spark.createDataFrame([], KIND), lex).count() == 0


def test_one_match_with_the_dictionary(spark):
    df = K.classify(spark.createDataFrame([doc("a", "Flute 1")], KIND), lexicon(spark, LEXICON))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 0 and plan.count("hashpartitioning") == 0 and plan.count("regexp_extract_all(text") == 1


def test_slots(spark):
    raw = [("p", 0, "Flute", "1", "Flute 1", None, None), ("p", 1, "Clarinet", None, "Clarinets", None, None), ("p", 2, "Full Score", None, "Score", "score", None), ("p", 3, "French-Horn", "x", "Solo Horn", "winds", False), ("p", 4, "percussion", None, "Percussion", None, None), ("p", 5, "", None, "?", None, None)]
    df = spark.createDataFrame(raw, "piece_id string, pos int, name string, part_index string, label string, section string, required boolean")
    lex = lexicon(spark, LEXICON)
    slots = S.normalize_slots(df, lex)
    got = {r.pos: (r.canonical, r.part_index, r.section, r.required, r.role) for r in slots.collect()}
    assert got == {0: ("flute", 1, "woodwind", True, "section"), 3: ("horn", None, "brass", False, "solo"), 4: ("percussion", None, "percussion", True, "section")}
    text = spark.createDataFrame([("p", "Instrumentation: flute, Snare Drum")], "piece_id string, text string")
    filled = S.backfill(slots, text, lex.where("section = 'percussion'"), "percussion")
    assert {r.canonical for r in filled.collect()} == {"flute", "horn", "snare_drum"}
    q = S.prompt_query(spark.createDataFrame([("p", "March")], "piece_id string, t string"), "piece_id", "t").first().query
    assert q == '{"title":"March"}'


def test_reports(spark):
    docs = spark.createDataFrame([("a.pdf", "A", 3, 1, "good", 90.0, {"heavy_blur": 1}, ["heavy_blur"]), ("b|c.pdf", "A", 5, 0, "poor", None, {}, [])], "pdf_path string, piece_folder string, page_count int, pages_needing_ocr int, quality_band string, quality_score double, issue_summary map<string,int>, top_issues array<string>")
    assert "| A | 2 | 8 | 1 |" in reports.extraction_report(docs)
    text = reports.quality_report(docs)
    assert "| fair | 0 |" in text and text.index("b\\|c.pdf") < text.index("a.pdf")
    pieces = spark.createDataFrame([("p", "12", "A", "high", "incomplete", 0.6, ["missing_score"]), ("q", None, "B", "ok", "complete", 1.0, [])], "piece_id string, catalog_number string, piece_folder string, severity string, completeness_tier string, completeness_score double, reason_codes array<string>")
    board = reports.dashboard(pieces)
    assert "| missing_score | 1 |" in board and "| 12 | A | high | missing_score |" in board
    assert tuple(reports.manifest(pieces, docs, "1.0").first()) == (2, 1, 0.8, 2, 8, "1.0")
    assert "- `piece_id`: string" in reports.glossary({"pieces": pieces})
    queue = pieces.selectExpr("1 as rank", "piece_id", "60 as priority_score", "severity", "reason_codes").limit(1)
    assert "| missing_required_part | 10 |" in reports.review_pack(queue)


CLASSIFIED = "pdf_path string, piece_folder string, catalog_number string, predicted string, facets array<struct<canonical:string,family:string>>, is_score boolean, confidence double, evidence_source string, duplicate boolean, needs_review boolean, error string"


def test_full_classification_report(spark):
    flute, horn = ("flute", "winds"), ("horn", None)
    rows = [
        ("a|1", "A", "12", "Flute", [flute], False, 0.95, "combined", False, False, None),
        ("a2", "A", "12", "Flute / Horn", [flute, horn], False, 0.6, "text", True, True, None),
        ("a3", "A", "12", None, [], False, 0.0, "none", False, True, None),
        ("b1", "B", "3", None, None, True, 0.9, "filename", None, None, None),
        ("b2", "B", "3", None, None, None, None, None, None, None, "unread"),
        ("c1", None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, CLASSIFIED)
    got = {(r.dimension, r.key): r for r in reports.classification_tallies(df).collect()}
    counts = {k: r.documents for k, r in got.items()}
    assert counts == {("all", None): 6, ("piece", "A"): 3, ("piece", "B"): 2, ("piece", None): 1, ("family", "winds"): 2, ("family", "other"): 1, ("family", "score"): 1, ("family", "unknown"): 2,
                      ("instrument", "flute"): 2, ("instrument", "horn"): 1, ("instrument", "(unmatched)"): 2, ("evidence", "combined"): 1, ("evidence", "text"): 1, ("evidence", "none"): 2, ("evidence", "filename"): 1}
    all_of = got["all", None]
    assert (all_of.errors, all_of.classified, all_of.scores, all_of.unmatched, all_of.doubtful, all_of.duplicates, all_of.to_review) == (1, 2, 1, 2, 1, 1, 2)
    assert (all_of.sure, all_of.medium, all_of.low, all_of.no_confidence) == (2, 0, 1, 2)
    text = reports.full_classification_report(df, detailed=5)
    assert "| flute | 2 |" in text and "### Errors (1)" in text and "| b2 | unread |" in text and "a\\|1" in text
    assert "| a2 | Flute / Horn | 0.60 | text |" in text and text.index("| 3 | B |") < text.index("| 12 | A | 3 | 2 | 0 | 1 | 1 | 1 | 2 |")
    assert text.rstrip().endswith("(more rows not shown)")  # five of six documents
    one = reports.full_classification_report(df, most=1)
    assert "### Unmatched (2)" in one and "| a3 | none |" in one and "| c1 |  |\n" not in one
    empty = reports.full_classification_report(df.limit(0))
    assert "| documents | 0 |" in empty and "### Errors" not in empty


def test_foremost(spark):
    df = spark.range(1000).selectExpr("id % 10 as k", "id as v", "cast(null as string) as t")
    lists = {"small": (F.col("v") < 500, F.col("v"), F.col("t")), "large": (F.col("v") >= 0, -F.col("v"), F.col("t"))}
    got = [tuple(r) for r in reports.foremost(df, lists, "k", ["v"], 3).collect()]
    assert sorted(got) == [("large", 1, 999), ("large", 2, 998), ("large", 3, 997), ("small", 1, 0), ("small", 2, 1), ("small", 3, 2)]
    plan = reports.foremost(df, lists, "k", ["v"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "WindowGroupLimit" in plan


def test_full_extraction_report(spark):
    kind = "pdf_path string, page_number int, piece_folder string, document_type string, text_source string, " + ", ".join(f"{k} boolean" for k in reports.PAGE_STATES) + ", issues array<string>, error string"
    no = [False] * 5
    rows = [
        ("a", 1, "A", "scan", "ocr", True, *no, ["skew", "skew"], None),
        ("a", 2, "A", "scan", "ocr", True, *no, ["blur", "skew"], None),
        ("b", 1, "B", None, None, False, *no, [], "unread"),
        ("c", 1, None, None, None, None, *[None] * 5, None, None),
    ]
    df = spark.createDataFrame(rows, kind)
    got = {(r.dimension, r.key): (r.pages, r.documents, r.needs_ocr, r.errors) for r in reports.extraction_tallies(df).collect()}
    assert got["all", None] == (4, 3, 2, 1) and got["folder", "A"] == (2, 1, 2, 0) and got["folder", None] == (1, 1, 0, 0)
    assert got["issue", "skew"] == (2, 1, 2, 0) and got["issue", "blur"] == (1, 0, 1, 0) and got["source", "none"][0] == 2 and len(got) == 10
    text = reports.full_extraction_report(df, most=1)
    assert "| skew | 2 | 50.00 |" in text and "### needs_ocr (2)" in text and "| a | 1 | ocr |" in text and "| a | 2 | ocr |" in text
    assert "### errors (1)" in text and "| b | 1 | unread |" in text and text.count("(more rows not shown)") == 2
    assert "| pages | 0 |" in reports.full_extraction_report(df.limit(0))


def test_foremost_ties(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 2), (1, None)], "k int, v int").repartition(4)
    got = reports.foremost(df, {"all": (F.lit(True), F.lit(None), F.lit(None))}, "k", ["v"], 3).orderBy("rank").collect()
    assert [r.v for r in got] == [None, 1, 2]
