"""The whole reports on quality, expected parts, the collection and single pieces."""
from foliant.plans import reports


def test_quality(spark):
    kind = "pdf_path string, piece_id string, quality_score double, quality_band string, notation_source_type string, page_count int, issue_summary map<string,int>, top_issues array<string>"
    rows = [("a", "p", 90.0, "good", "printed", 4, {}, []), ("b|c", "p", 20.0, "poor", "handwritten", 2, {"heavy_blur": 2, "skew": 1}, ["heavy_blur", "skew"]), ("d", None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, kind)
    got = {(r.dimension, r.key): (r.documents, r.pages, r.unscored) for r in reports.quality_tallies(df).collect()}
    assert got == {("all", None): (3, 6, 1), ("band", "good"): (1, 4, 0), ("band", "poor"): (1, 2, 0), ("band", "unknown"): (1, None, 1), ("source", "printed"): (1, 4, 0), ("source", "handwritten"): (1, 2, 0),
                   ("source", "unknown"): (1, None, 1), ("issue", "heavy_blur"): (1, 2, 0), ("issue", "skew"): (1, 1, 0)}
    text = reports.full_quality_report(df, most=2)
    assert "| fair | 0 | 0.00 |" in text and "| printed | 1 | 33.30 |" in text and text.index("| heavy_blur | 2 | 1 |") < text.index("| skew | 1 | 1 |")
    assert text.index("| d |") < text.index("| b\\|c | p | 2 | 20.00 | poor | handwritten | heavy_blur, skew |") and "| a | p |" not in text and text.rstrip().endswith("(more rows not shown)")
    assert "| documents | 0 |" in reports.full_quality_report(df.limit(0))


def test_expected(spark):
    kind = "piece_id string, catalog_number string, piece_folder string, lookup_status string, completeness_tier string, completeness_score double, ensemble string, missing array<string>, needs_review boolean, error string"
    rows = [("1", "12", "L", "matched", "complete", 1.0, "band", [], False, None), ("2", "3", "K", "none", "incomplete", 0.5, "band", ["Oboe", "Oboe", "Horn"], True, None), ("3", None, None, None, None, None, None, None, None, "failed")]
    df = spark.createDataFrame(rows, kind)
    got = {(r.dimension, r.key): r.pieces for r in reports.expected_tallies(df).collect()}
    assert got == {("all", None): 3, ("status", "matched"): 1, ("status", "none"): 2, ("tier", "complete"): 1, ("tier", "incomplete"): 1, ("tier", "unknown"): 1, ("ensemble", "band"): 2, ("ensemble", "unknown"): 1, ("missing", "Oboe"): 1, ("missing", "Horn"): 1}
    text = reports.full_expected_report(df)
    assert "| confident | 1 |" in text and "| missing_parts | 3 |" in text and "| near_complete | 0 | 0.00 |" in text and "| band | 2 |" in text and "| Oboe | 1 |" in text
    assert text.index("| 3 | K | band | none | incomplete | 0.50 | Oboe, Oboe, Horn | True |") < text.index("| 12 | L |") and "| pieces | 0 |" in reports.full_expected_report(df.limit(0))


COLLECTION = "piece_id string, catalog_number string, piece_folder string, severity string, completeness_tier string, completeness_score double, reason_codes array<string>, worst_quality_band string, record_version string, missing_required_parts array<struct<label:string,section:string>>, document_count int, low_quality_count int, needs_review boolean, score_missing boolean"


def test_collection(spark):
    rows = [
        ("1", "12", "L", "review", "incomplete", 0.5, ["unexpected_parts"], "fair", "1.0", [("Oboe", "winds"), ("Flute", "winds")], 3, 1, True, False),
        ("2", "30", "K", "high", "incomplete", 0.25, ["missing_score"], "poor", "1.0", [("Oboe", "winds"), ("Horn", None)], 2, 2, True, True),
        ("3", None, None, None, None, None, None, None, None, None, None, None, None, None),
        ("4", "1", "M", "ok", "complete", 1.0, [], "good", "2.0", [], 4, 0, False, False),
    ]
    df = spark.createDataFrame(rows, COLLECTION)
    got = {(r.dimension, r.key): r for r in reports.collection_tallies(df).collect()}
    whole = got["all", None]
    assert (whole.pieces, whole.complete, whole.to_review, whole.without_score, whole.with_findings, whole.documents, whole.low_quality_documents, whole.completeness) == (4, 1, 2, 1, 2, 9, 3, 0.583)
    assert got["missing", "Oboe"].pieces == 2 and got["section", "winds"].pieces == 2 and got["severity", "unknown"].pieces == 1 and ("section", None) not in got
    text = reports.full_collection_report(df)
    assert "| complete | 1 | 25.00 |" in text and "| fair | 1 | 25.00 |" in text and "| Oboe | 2 |" in text and "| winds | 2 |" in text and "| 1.0 | 2 |" in text
    assert text.index("| 30 | K | high |") < text.index("| 12 | L | review |") and "| 1 | M |" not in text
    assert "(more rows not shown)" in reports.full_collection_report(df, most=1) and "| pieces | 0 | 0.00 |" in reports.full_collection_report(df.limit(0))


def test_one_scan_each(spark, tmp_path):
    spark.createDataFrame([("1", "12", "L", "ok", "complete", 1.0, [], "good", "1.0", [], 1, 0, False, False)], COLLECTION).write.parquet(f"{tmp_path}/t")
    plan = reports.collection_tallies(spark.read.parquet(f"{tmp_path}/t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_piece_sections(spark):
    kind = "piece_id int, piece_folder string, severity string, completeness_tier string, completeness_score double, expected_parts array<struct<label:string,required:boolean,present:boolean>>, action_items array<struct<reason_code:string,action:string,targets:array<string>>>, documents array<struct<pdf_filename:string,quality_band:string>>, score_types array<string>, score_missing boolean, worst_quality_band string, review_counts struct<low:int>, needs_review boolean"
    df = spark.createDataFrame([(1, "A", "ok", "complete", 1.0, [], [], [], ["full"], False, "fair", (2,), True), (2, None, None, None, None, None, None, None, None, None, None, None, None)], kind)
    got = {r.piece_id: r.lines for r in reports.piece_reports(df).collect()}
    assert {'| score_types | ["full"] |', "| score_missing | false |", "| worst_quality_band | fair |", '| review_counts | {"low":2} |', "| needs_review | true |"} <= set(got[1])
    assert "| score_types |  |" in got[2] and got[2].count("## Confidence") == 1


def test_workbook_sheets_come_a_partition_at_a_time(spark, tmp_path, monkeypatch):
    import pytest

    from foliant.sources import workbook as B

    df = spark.range(0, 1000, 1, 8).selectExpr("id", "repeat('x', cast(id % 7 as int)) as t", "array(id, id + 1) as a", "array('u', t) as b", "id % 2 = 0 as even", "cast(null as double) as none")
    B.write_workbook({"rows": df, "empty": df.limit(0)}, f"{tmp_path}/w.xlsx", spark)
    content = open(f"{tmp_path}/w.xlsx", "rb").read()
    got = B.read_workbook(content)
    assert got["rows"][0] == ["id", "t", "a", "b", "even", "none"] and len(got["rows"]) == 1001 and got["rows"][6] == ["5", "xxxxx", "5; 6", "u; xxxxx", "False", ""]
    assert [r[0] for r in got["rows"][1:]] == [str(i) for i in range(1000)] and got["empty"] == [["note"], [B.EMPTY]]
    monkeypatch.setattr(B, "MOST_ROWS", 999)
    with pytest.raises(ValueError):
        B.write_workbook({"rows": df}, f"{tmp_path}/x.xlsx", spark)
