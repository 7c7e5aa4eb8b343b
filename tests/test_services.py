"""Bounded concurrent calls, the automaton of aliases, the index of runs, edition surplus and reports of many pieces."""
import pickle
import random
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from foliant.operators import joins as J
from foliant.operators import plugins as G
from foliant.operators import reconcile as R
from foliant.operators import substring_index as S
from foliant.plans import reports
from foliant.sources import readers, snapshots
from foliant.sources.calls import BUDGET, DEADLINE, called


def test_calls_run_together_up_to_a_width():
    now, most, lock = [0], [0], threading.Lock()

    def call(x):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1
        if x == 3:
            raise ValueError("three")
        return None if x == 4 else x * x

    began = time.time()
    got = list(called(range(20), call, width=5))
    assert 0.15 < time.time() - began < 0.8 and most[0] == 5
    assert sorted(x for x, _, _ in got) == list(range(20))
    assert {x: (r, s) for x, r, s in got} == {x: (x * x, "success") for x in range(20)} | {3: (None, "error: three"), 4: (None, "not_found")}
    assert [x for x, _, _ in called(range(20), call, width=5, ordered=True)] == list(range(20))
    assert list(called([], call, width=5)) == [] == list(called([], call))
    assert [s for _, _, s in called([3, 4, 5], call)] == ["error: three", "not_found", "success"]


def test_a_hanging_call_becomes_an_error():
    wait = threading.Event()
    began = time.time()
    got = {x: s for x, _, s in called(range(6), lambda x: wait.wait(30) if x == 1 else x + 1, width=2, deadline=0.3)}
    wait.set()
    assert time.time() - began < 2 and got == {x: DEADLINE if x == 1 else "success" for x in range(6)}


def test_a_budget_ends_all_calls():
    began = time.time()
    got = list(called(range(40), lambda x: time.sleep(0.1) or 1, width=2, budget=0.5, ordered=True))
    assert time.time() - began < 1.5 and [x for x, _, _ in got] == list(range(40))
    done = [s for _, _, s in got]
    assert 4 <= done.count("success") <= 10 and done.count(BUDGET) == 40 - done.count("success")


def test_results_come_as_they_finish():
    first = next(iter(called([0.5, 0.01], lambda s: time.sleep(s) or s, width=2)))
    assert first[0] == 0.01


def test_lookups_within_tasks(spark):
    def fetch(k):
        time.sleep(0.2)
        if k == "k7":
            time.sleep(60)
        return None if k == "k1" else f"text of {k}"

    keys = spark.range(16).select(F.concat(F.lit("k"), "id").alias("k")).coalesce(1)
    began = time.time()
    got = {r.k: (r.text, r.status) for r in readers.fetched(keys, "k", fetch, width=8, deadline=2.0).collect()}
    assert got == {f"k{i}": (f"text of k{i}", "success") for i in range(16)} | {"k1": (None, "not_found"), "k7": (None, DEADLINE)}
    assert time.time() - began < 25
    rows = G.enrich(keys, "k", ["k"], lambda r: {"n": len(r["k"])}, "n int", width=4).collect()
    assert sorted((r.k, r.n, r.status) for r in rows) == sorted((f"k{i}", len(f"k{i}"), "success") for i in range(16))


def by_regexes(text, aliases):
    """What AliasFinder does, an expression an alias."""
    free, found = bytearray(len(text)), []
    for name, alias in sorted(aliases, key=lambda x: -len(x[1])):
        for m in re.finditer(f"(?<![a-z0-9]){re.escape(alias)}(?![a-z0-9])", text):
            if not any(free[m.start() : m.end()]):
                free[m.start() : m.end()] = b"\1" * (m.end() - m.start())
                found.append((m.start(), name))
    return list(dict.fromkeys(n for _, n in sorted(found)))


def test_automaton_equals_an_expression_an_alias():
    rng = random.Random(1)
    for _ in range(300):
        words = [rng.choice(["a", "b", "ab", "a.b", "b-", "é", "a b", "b a b"]) for _ in range(rng.randint(0, 14))]
        aliases = [(rng.choice("xyz"), " ".join(rng.choice(["a", "b", "ab", "a.b", "-b"]) for _ in range(rng.randint(1, 3)))) for _ in range(rng.randint(0, 8))]
        text = rng.choice([" ", "", "  "]).join(words)
        assert R.spans_by_length(aliases)(text) == by_regexes(text, aliases), (text, aliases)
    find = pickle.loads(pickle.dumps(R.AliasFinder([("x", "a b"), ("", "")])))
    assert find("c a b") == ["x"] and R.AliasFinder([])("a") == []


def test_automaton_takes_no_longer_for_more_aliases():
    text = " ".join(f"word{i}" for i in range(3000))

    def took(n):
        find = R.AliasFinder([(str(i), f"other{i} name") for i in range(n)])
        began = time.perf_counter()
        for _ in range(5):
            find(text)
        return time.perf_counter() - began

    assert took(20_000) < 10 * took(20)


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, "", "".join(rng.choice("abAB é#") for _ in range(rng.randint(1, 9)))]), rng.choice(["xyz", "Ab", None])) for i in range(200)]
    one = spark.createDataFrame(rows, "k int, name string, other string")
    two = spark.createDataFrame([(i + 0.5, t) for i, t, _ in rows[:50]], "id double, name string")
    groups, path = [("one", one, "k", ["name", "other"]), ("two", two, "id", ["name"])], str(tmp_path / "ix")
    S.write_index(groups, path, 8)
    for needle in ("a", "AB", "aba", "b é#", "é", "xyz", "nothing here", "", " "):
        want = sorted(map(tuple, J.search(groups, needle, 7).collect()))
        assert sorted(map(tuple, S.indexed_search(groups, path, needle, 7, 8).collect())) == want, needle
    plan = S.candidates(spark, path, "xyz", 8)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    S.write_index([("one", one.where("k < 3"), "k", ["name", "other"])], path, 8)  # in place of the old one
    assert snapshots.read(spark, path).select("id").distinct().count() <= 3


def test_surplus_editions_are_left_out(spark):
    kind = "piece string, facet string, part int, clef string, transposition string"
    parts = spark.createDataFrame([("p", "euph", i, c, None) for i, c in enumerate(["treble", "bass", "alto", "tenor"])] + [("q", "euph", i, "bass", None) for i in range(4)], kind)
    demand = spark.createDataFrame([("p", "euph", 2), ("q", "euph", 2)], "piece string, facet string, demand int")
    got = sorted((r.piece, r.part, r.clefs) for r in R.editions(parts, demand, ["piece", "facet"]).collect())
    assert got == [("p", 0, ["treble"]), ("p", 1, ["bass"]), *[("q", i, ["bass"]) for i in range(4)]]
    slots = spark.createDataFrame([("p", i, "euph", 1, f"Euph {i}", "section", None) for i in range(2)], "piece_id string, pos int, canonical string, part_index int, label string, role string, transposition string")
    held = spark.createDataFrame([("p", str(i), i, "euph", 1, "euph", c, None, "section") for i, c in enumerate(["treble", "bass", "alto", "tenor"])], "piece_id string, part string, pos int, canonical string, part_index int, label string, clef string, transposition string, role string")
    rows = R.reconcile(slots, held).collect()
    assert [(r.kind, r.matched_part) for r in sorted(rows, key=lambda r: r.pos)] == [("slot", "0"), ("slot", "1")]


def test_reports_of_many_pieces(spark):
    kind = "piece_id string, piece_folder string, severity string, completeness_tier string, completeness_score double, expected_parts array<struct<label:string,required:boolean,present:boolean>>, action_items array<struct<reason_code:string,action:string,targets:array<string>>>, documents array<struct<pdf_filename:string,quality_band:string>>"
    full = ("a", "A | b", "high", "complete", 0.5, [(f"p{i}", True, i % 2 == 0) for i in range(205)], [("x", "find", [str(i) for i in range(9)])], [("d.pdf", None)])
    df = spark.createDataFrame([full, ("b", None, None, None, None, None, [], [])], kind)
    got = {r.piece_id: r.lines for r in reports.piece_reports(df).collect()}
    for piece in "ab":
        one = reports.piece_report(df.where(F.col("piece_id") == piece).withColumn("expected_parts", F.coalesce("expected_parts", F.expr("cast(array() as array<struct<label:string,required:boolean,present:boolean>>)"))))
        assert got[piece] == [x for x in one.split("\n") if x]


def test_dictionaries_are_refused_where_they_are_large(spark):
    with pytest.raises(ValueError):
        readers.few(spark.range(20), 10)
    assert len(readers.few(spark.range(10), 10)) == 10


def test_otsu_and_the_least_rectangle(spark):
    import numpy as np

    from foliant.operators.geometry import hull, least_rectangle_angle, skew_angles, threshold

    rng = np.random.default_rng(2)
    for _ in range(20):
        g = rng.integers(0, rng.integers(2, 257), (6, 7)).astype(np.uint8)
        between = []
        for t in range(256):
            low, high = g[g <= t].astype(float), g[g > t].astype(float)
            between.append(len(low) * len(high) * (low.mean() - high.mean()) ** 2 if len(low) and len(high) else 0.0)
        assert between[threshold(g)] == pytest.approx(max(between), rel=1e-9)
    y, x = np.mgrid[0:400, 0:600].astype(float)
    pages = []
    for angle in (-20.0, -3.3, -0.5, 0.0, 0.7, 2.0, 11.0, 30.0):
        a = np.radians(angle)
        u, v = (x - 300) * np.cos(a) + (y - 200) * np.sin(a), -(x - 300) * np.sin(a) + (y - 200) * np.cos(a)
        page = np.where((np.abs(u) < 210) & (np.abs(v) < 90) & ((v // 6) % 2 == 0), 30, 240).astype(np.uint8)
        found = least_rectangle_angle(page.tobytes(), 600, 400)
        assert abs(found - angle) < 0.25, (angle, found)
        pages.append((angle, bytearray(page.tobytes()), 600, 400))
        ink = np.argwhere(page <= threshold(page))[:, ::-1].astype(float)  # brute force: every direction in steps
        best = min(np.arange(-45, 45, 0.05), key=lambda d: np.prod([np.ptp(ink @ w) for w in ((np.cos(np.radians(d)), np.sin(np.radians(d))), (-np.sin(np.radians(d)), np.cos(np.radians(d))))]))
        assert abs(best - found) <= 0.1
    assert least_rectangle_angle(np.full((5, 5), 255, np.uint8).tobytes(), 5, 5) is None and least_rectangle_angle(b"", 5, 5) is None and least_rectangle_angle(None, 1, 1) is None
    assert least_rectangle_angle(bytes([255, 0, 255, 255]), 2, 2) == 0.0 and hull(np.array([[0, 0], [1, 1], [2, 2]])).tolist() == [[0, 0], [2, 2]]
    df = spark.createDataFrame([*pages, (99.0, None, None, None)], "k double, raster binary, width int, height int")
    got = {r.k: r.skew_angle_deg for r in skew_angles(df, "k").collect()}
    assert got[99.0] is None and all(abs(got[k] - k) < 0.25 for k, *_ in pages)


def test_pages_of_a_long_file(spark, tmp_path):
    from foliant.sources.paged import register_pages

    (tmp_path / "d").mkdir()
    (tmp_path / "d/long.PDF").write_text("\n".join(f"p{i}" for i in range(95)))
    (tmp_path / "d/empty.pdf").write_text("")
    (tmp_path / "d/bad.pdf").write_text("bad")
    (tmp_path / "d/other.txt").write_text("no")

    def count(path):
        with open(path) as f:
            text = f.read()
        if text == "bad":
            raise ValueError("no pages")
        return len(text.splitlines())

    def read(path, first, last):
        with open(path) as f:
            for line in f.read().splitlines()[first:last]:
                if line in ("p7", "p40"):
                    raise ValueError(f"damaged {line}")
                yield {"text": line}

    register_pages(spark, "test_pages", count, read, "text string")
    df = spark.read.format("test_pages").option("path", str(tmp_path)).option("ending", ".pdf").option("pagesPerTask", 10).load()
    assert df.rdd.getNumPartitions() >= 10
    rows = {(r.path.rsplit("/")[-1], r.page_num): (r.processing_status, r.error_message, r.text) for r in df.collect()}
    want = {("long.PDF", i + 1): ("error", f"damaged p{i}", None) if i in (7, 40) else ("success", None, f"p{i}") for i in range(95)}
    assert rows == want | {("bad.pdf", None): ("error", "no pages", None)}


def test_rasters_of_a_batch_at_once(spark, sf, monkeypatch):
    import numpy as np

    from foliant.operators import geometry as G
    from foliant.plans import registry

    rng = np.random.default_rng(3)
    raws = [None, b"", *[np.where(rng.random((9, 7)) < d, rng.integers(0, 99, (9, 7)), 255).astype(np.uint8).tobytes() for d in (0, 0.02, 0.05, 0.1, 0.3) * 30]]
    monkeypatch.setattr(G, "TOGETHER", 400)
    found = G.least_rectangle_angles(raws, 7, 9)
    assert found == [G.least_rectangle_angle(r, 7, 9) for r in raws] and None in found and len(set(found)) > 20
    # a small file is dealt out before its rasters are measured
    assert registry.queries()["raster_skew"](spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_damaged_pages_cost_few_reads(spark, tmp_path):
    from foliant.sources import paged

    calls = []

    def read(path, first, last):
        calls.append((first, last))
        for at in range(first, last):
            if at in (7, 13):
                raise ValueError(f"damaged {at}")
            yield at

    assert list(paged.pages_of(read, "x", 0, 20)) == [(at, None, f"damaged {at}") if at in (7, 13) else (at, at, None) for at in range(20)]
    assert calls == [(0, 20), (7, 8), (8, 20), (13, 14), (14, 20)]
    eager = lambda path, first, last: [p for _, p, e in paged.pages_of(read, path, first, last)] if first not in (7, 13) and last - first < 2 else 1 / 0
    assert [e is None for _, _, e in paged.pages_of(eager, "x", 0, 20)] == [at not in (7, 13) for at in range(20)]
    few = lambda path, first, last: [at for at in range(first, last) if at != 3]
    assert [(p, e) for _, p, e in paged.pages_of(few, "x", 0, 6)] == [(0, None), (1, None), (2, None), (None, "StopIteration"), (4, None), (5, None)]
    file = tmp_path / "lines.txt"
    for text in ("", "a", "a\n", "\n", "a\n\nb\u00e9\nc", "x\n" * 2500):
        file.write_text(text)
        lines = text.removesuffix("\n").split("\n") if text else []
        assert len(paged.line_starts(str(file))) - 1 == len(lines)
        assert all(paged.read_lines(str(file), a, b) == lines[a:b] for a, b in ((0, 1), (0, 9), (1, 3), (2, 2), (3, 4), (90, 99)))
    paged.register_pages(spark, "many_ranges", lambda path: len(paged.line_starts(path)) - 1, lambda path, a, b: ({"text": x} for x in paged.read_lines(path, a, b)), "text string")
    df = spark.read.format("many_ranges").option("path", str(tmp_path)).option("pagesPerTask", 1).load()
    assert 800 < df.rdd.getNumPartitions() <= paged.TASKS
    assert [r.page_num for r in df.select("page_num").sort("page_num").collect()] == list(range(1, 2501))


@pytest.mark.parametrize("name", ["page_text_join", "slot_index_match", "unexpected_parts"])
def test_tasks_follow_the_number_of_rows(spark, sf, monkeypatch, name):
    """What is sorted by document or piece is dealt to a number of tasks that grows with the table."""
    from foliant.plans import links, pieces, registry, tables

    for module in (links, pieces):
        monkeypatch.setattr(module, "tasks_for", lambda table: tables.tasks_for(table, 50))
    df = registry.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    by_row = [x for x in re.findall(r"hashpartitioning\(([^)]*)\), (\w+)", plan) if "l_partkey" not in x[0] and "p_partkey" not in x[0]]
    counts = {int(re.search(r"(\d+)$", keys)[1]) for keys, _ in by_row}
    assert counts == {tables.tasks_for(spark.read.parquet(f"{sf}/lineitem.parquet"), 50)} and min(counts) > 100
