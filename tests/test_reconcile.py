"""The matching by components against a plain version that goes through whole pieces, one part and one slot at a time."""
import random
from collections import defaultdict

from foliant.operators import reconcile as R
from foliant.plans import pieces

SLOTS = "piece_id string, pos int, canonical string, part_index int, label string, role string, transposition string, equivalents array<string>"
HELD = "piece_id string, part string, pos int, canonical string, part_index int, label string, clef string, transposition string, role string"


def lowest(key):
    return key.strip().lower() if key and key.strip() else None


def low(*fields):
    """A sort key with nulls first."""
    return tuple((f is not None, f or 0 if isinstance(f, int) or f is None else f) for f in fields)


def fits(slot, part, usual):
    solo = part["role"] in ("solo", "solo_alternative")
    if solo != (slot["role"] == "solo"):
        return False
    mine, asked = lowest(part["transposition"]), lowest(slot["transposition"]) or lowest(usual.get(slot["canonical"]))
    return mine is None or asked is None or mine == asked


def plain(slots, rows, groups, usual):
    """The rows of a piece, as tuples."""
    slots = sorted(slots, key=lambda s: low(s["pos"], s["canonical"], s["part_index"]))
    names, stands = {s["canonical"] for s in slots}, {}
    for group in groups:
        called = [g for g in group if g in names]
        if len(called) == 1:
            stands.update({g: called[0] for g in group if g not in called})
    for s in slots:
        for other in s["equivalents"] or []:
            if other not in names:
                stands.setdefault(other, s["canonical"])
    by_part = {}
    for r in sorted(rows, key=lambda r: low(r["pos"], r["part"], r["canonical"], r["part_index"])):
        by_part.setdefault(r["part"], {**r, "facets": []})["facets"].append((r["canonical"], r["part_index"]))
    alike = defaultdict(list)
    for p in by_part.values():
        alike[tuple(sorted(map(str, p["facets"])))].append(p)
    parts = []
    for same in alike.values():
        need = max(sum(s["canonical"] == stands.get(c, c) and s["part_index"] == i for s in slots) for c, i in same[0]["facets"])
        kinds = {lowest(p["transposition"]) for p in same} - {None}
        split = defaultdict(list)
        for p in same:
            usual_here = next((lowest(usual[c]) for c, _ in p["facets"] if usual.get(c)), None) if lowest(usual.get(p["facets"][0][0])) else None
            split["all" if len(kinds) < 2 else lowest(p["transposition"]) or usual_here or p["part"]].append(p)
        for group in split.values():
            piles = defaultdict(list)
            for p in group:
                piles[p["clef"], lowest(p["transposition"])].append(p)
            deep = max(len(x) for x in piles.values())
            made = [[p] for p in group][:need] if need > deep else [[x[k] for x in piles.values() if k < len(x)] for k in range(deep)]
            parts += [{**m[0], "clefs": sorted({p["clef"] for p in m if p["clef"]}), "keys": sorted({p["transposition"] for p in m if p["transposition"]})} for m in made]
    taken = {}
    for name in names:
        own = [k for k, s in enumerate(slots) if s["canonical"] == name]
        offers = [(k, i) for k, p in enumerate(parts) for c, i in p["facets"] if c == name]
        offers += [(k, i) for k, p in enumerate(parts) for c, i in p["facets"] if c != name and stands.get(c) == name and k not in {o for o, _ in offers}]
        left = []
        for k, i in offers:
            place = [s for s in own if i is not None and s not in taken and slots[s]["part_index"] == i and fits(slots[s], parts[k], usual)]
            if place:
                taken[place[0]] = k
            else:
                left.append((k, i))
        for s in own:
            can = [] if s in taken else [o for o in left if fits(slots[s], parts[o[0]], usual)]
            if can:
                best = next((o for o in can if o[1] == slots[s]["part_index"]), can[0])
                taken[s] = best[0]
                left.remove(best)
    out = []
    for k, s in enumerate(slots):
        p = parts[taken[k]] if k in taken else None
        out.append(("slot", k, s["canonical"], s["part_index"], p is not None, p and p["part"], p and ";".join(p["clefs"]), p and ";".join(p["keys"])))
    open_names = {s["canonical"] for s in slots if s["part_index"] is None and s["role"] == "section"}
    for k, p in enumerate(parts):
        if k in taken.values() or p["role"] != "section" or all(i is not None and c in open_names for c, i in p["facets"]):
            continue
        out.append(("unexpected", k, *p["facets"][0], False, p["part"], ";".join(p["clefs"]), ";".join(p["keys"])))
    return out


def compare(df, slots, held, groups, usual):
    by_slot, by_part = defaultdict(list), defaultdict(list)
    for r in slots:
        by_slot[r["piece_id"]].append(r)
    for r in held:
        by_part[r["piece_id"]].append(r)
    want = {(p, *t) for p in {*by_slot, *by_part} for t in plain(by_slot[p], by_part[p], groups, usual)}
    rows = df.collect()
    got = {(r.piece_id, r.kind, r.pos, r.canonical, r.part_index, r.present, r.matched_part, r.observed_clefs, r.observed_transpositions) for r in rows}
    assert len(rows) == len(got) and got == want
    return got


def test_random_pieces(spark):
    rng, names = random.Random(5), list("abcdefgh")
    slots, held = [], []
    for piece in map(str, range(150)):
        few = rng.sample(names, rng.randint(1, 5))
        for pos in range(rng.randint(0, 8)):
            name = rng.choice(few)
            slots.append((piece, pos, name, rng.choice([None, 1, 2]), name, rng.choice(["section", "section", "solo"]), rng.choice([None, None, "F", "Eb"]), rng.choice([None, [], rng.sample(names, 2)])))
        for n in range(rng.randint(0, 12)):
            role, clef, key = rng.choice(["section", "section", "solo", "solo_alternative"]), rng.choice([None, "bass", "treble"]), rng.choice([None, None, "F", "Eb"])
            held += [(piece, f"p{n:02}", n, c, rng.choice([None, 1, 2]), c, clef, key, role) for c in rng.sample(names, rng.choice([1, 1, 2, 3]))]
    s, h = spark.createDataFrame(slots, SLOTS), spark.createDataFrame(held, HELD)
    groups, usual = [["a", "b", "c"], ["c", "d"], ["e", "f"]], {"a": "F", "e": "Eb"}
    got = compare(R.reconcile(s, h, groups, usual), [r.asDict() for r in s.collect()], [r.asDict() for r in h.collect()], groups, usual)
    assert len({t[1] for t in got}) == 2


def test_every_order(spark, sf):
    slots, held = (df.collect() for df in pieces.editions_and_doublings(spark, sf))
    df = pieces.slot_component_match(spark, sf)
    got = compare(df, [r.asDict() for r in slots], [r.asDict() for r in held], pieces.INTERCHANGED, pieces.USUAL_KEY)
    assert any(";" in (t[7] or "") for t in got) and any(t[1] == "unexpected" for t in got)


def test_components(spark):
    tied = spark.createDataFrame([("p", ["b", "c"]), ("p", ["c", "d"]), ("p", ["x", "y"]), ("p", ["z"]), ("q", ["b", "z"]), ("q", [])], "piece_id string, names array<string>")
    got = {(r.piece_id, r.canonical): r.component for r in R.components(tied).collect()}
    assert got == {("p", "b"): "b", ("p", "c"): "b", ("p", "d"): "b", ("p", "x"): "x", ("p", "y"): "x", ("q", "b"): "b", ("q", "z"): "b"}


def test_a_piece_of_many_parts(spark):
    """A hundred thousand parts of one piece, most of them of one name: queues, not searches."""
    n = 100_000
    names = "case when id % 10 = 0 then concat('n', id % 500) else 'violin' end"
    held = spark.range(n).selectExpr("'p' piece_id", "cast(id as string) part", "cast(id as int) pos", f"{names} canonical", "cast(id % 3 as int) part_index", "'x' label", "cast(null as string) clef", "cast(null as string) transposition", "'section' role")
    slots = spark.range(n).selectExpr("'p' piece_id", "cast(id as int) pos", f"{names} canonical", "cast(id % 3 as int) part_index", "'x' label", "'section' role", "cast(null as string) transposition")
    rows = R.reconcile(slots, held).groupBy("kind", "present").count().collect()
    assert [tuple(r) for r in rows] == [("slot", True, n)]


def test_structs_are_converted_a_field_at_a_time(monkeypatch):
    """Slots and parts reach the matching without an Arrow scalar for each value, which cost more than the matching."""
    import pyarrow as pa

    slot = pa.struct([("n", pa.int32()), ("canonical", pa.string()), ("part_index", pa.int64()), ("label", pa.string()), ("role", pa.string()), ("transposition", pa.string())])
    facet = pa.struct([*[(n, pa.int32() if n in ("pos", "part_index") else pa.string()) for n in R.PART_FIELDS], ("stands", pa.string())])
    one = lambda n, i: {"n": n, "canonical": "a", "part_index": i, "label": None, "role": "section", "transposition": None}
    held = lambda part, i, name: {"pos": i, "part": part, "canonical": name, "part_index": i, "label": "x", "clef": None, "transposition": "F", "role": None, "stands": None}
    rows = [("p", [one(0, None), one(1, 2)], [[held("x", None, "a"), held("x", 1, "b")], [held("y", 2, "a")]]), ("q", [], [[held("z", 1, None)]]), ("r", [one(0, 1)], [])]
    whole = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.list_(slot)), pa.array([r[2] for r in rows], pa.list_(pa.list_(facet)))], ["piece_id", "wanted", "parts"])
    for batch, own in ((whole, rows), (whole.slice(1), rows[1:]), (whole.slice(0, 0), [])):
        want = [(p, s, [{**f[0], "facets": [(x["canonical"], x["part_index"], x["stands"]) for x in f]} for f in parts]) for p, s, parts in own]
        assert list(R._folds(batch)) == want


def test_the_matching_is_dealt_by_rows(spark):
    import re

    slots, held = spark.createDataFrame([("p", 0, "a", 1, "a", "section", None, ["b"])], SLOTS), spark.createDataFrame([("p", "x", 0, "b", 1, "b", None, None, "section")], HELD)
    df = R.reconcile(slots, held, tasks=77)
    assert [(r.kind, r.matched_part) for r in df.collect()] == [("slot", "x")]
    counts = re.findall(r"hashpartitioning\(piece_id[^)]*, (\d+)\), (\w+)", df._jdf.queryExecution().executedPlan().toString())
    assert {n for n, why in counts if why == "REPARTITION_BY_NUM"} == {"77"} and sum(n == "77" for n, _ in counts) >= 6


def exchanges(df):
    """How many exchanges of rows a finished query wrote, and how many it read again."""
    import re

    df.collect()
    found = re.findall(r"(ReusedExchange [^\n]*?)?Exchange (?:hash|range|RoundRobin)", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0])
    return sum(not again for again in found), sum(map(bool, found))


def test_line_items_are_dealt_once(spark, sf):
    """What is written to disk are the lines, and the names that are tied; all else stays where its piece is."""
    for query in (pieces.slot_component_match, pieces.slot_greedy_match):
        written, again = exchanges(query(spark, sf))
        assert written <= 2 and again >= 1, query.__name__


def test_results_are_numbered_alike_in_tuples_and_columns(monkeypatch):
    rng = random.Random(3)
    pick = lambda *x: rng.choice([None, *x])
    slot = lambda p: (p, "slot", None, pick("a", "b"), pick(1, 2), pick("x"), False, None, None, None, pick(0, 1, 2), None, None, pick("solo"), pick("F"))
    part = lambda p, n: (p, rng.choice(["held", "unexpected"]), None, pick("a"), 1, "x", False, f"q{n}", "", "", pick(0, 1), f"q{n // 2}", n, None, None)
    found = [(p, [slot(p) for _ in range(rng.randint(0, 5))] + [part(p, n) for n in range(rng.randint(0, 5))]) for p in (None, "p", "p", "p", "q", "r", "r")]
    rows = lambda: sorted((tuple(r.values()) for b in R._numbered(iter(found)) for r in b.to_pylist()), key=str)
    few = rows()
    monkeypatch.setattr(R, "ROWS_AT_ONCE", 2)
    assert rows() == few and {r[1] for r in few} == {"slot", "unexpected"}
    assert sorted(r[2] for r in few if r[:2] == ("p", "slot")) == list(range(sum(r[1] == "slot" for p, x in found for r in x if p == "p")))


def test_empty_sides(spark):
    none_s, none_h = spark.createDataFrame([], SLOTS), spark.createDataFrame([], HELD)
    assert R.reconcile(none_s, none_h, [["a", "b"]]).count() == 0
    one = spark.createDataFrame([("p", "x", 0, None, None, "x", None, None, None)], HELD)
    assert [(r.kind, r.matched_part) for r in R.reconcile(none_s, one).collect()] == [("unexpected", "x")]
