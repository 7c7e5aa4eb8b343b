"""Expected against held parts: order-dependent matching within a piece, and the relational pieces of it.

What is matched together are the slots and parts of a piece whose names hang together, not the whole piece.
"""
from __future__ import annotations

from collections import Counter, defaultdict, deque
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import groupby, pairwise
from operator import itemgetter

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.functions.predicates import role_compatible, transposition_compatible
from foliant.functions.text import first_truthy
from foliant.operators.joins import dictionary

RESULT = "piece_id string, kind string, pos int, canonical string, part_index int, label string, present boolean, matched_part string, observed_clefs string, observed_transpositions string"


def slot_role(label: Column) -> Column:
    return F.when(label.rlike("(?i)(?<![a-z0-9])solo(?![a-z0-9])"), "solo").otherwise("section")


def _single(slots: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """(key, grp, slot_canonical, other): the members of a group (grp, canonical) of which a piece expects one alone."""
    dim = dictionary(groups)
    expected = slots.select(key, "canonical").distinct().join(dim, "canonical")
    single = expected.groupBy(key, "grp").agg(F.count("*").alias("n"), F.min("canonical").alias("slot_canonical")).where("n = 1")
    return single.join(dim, "grp").where("canonical <> slot_canonical").select(key, "grp", "slot_canonical", F.col("canonical").alias("other"))


def equivalences(slots: DataFrame, groups: DataFrame, key: str = "piece_id") -> DataFrame:
    """(key, slot_canonical, other) of interchangeable instruments: only where the piece expects exactly one member
    of the group. groups: grp, canonical."""
    return _single(slots, groups, key).drop("grp")


def exact_index_matches(slots: DataFrame, held: DataFrame, key: str = "piece_id", tasks: int | None = None) -> DataFrame:
    """The first pass in DataFrames: the i-th slot of a (canonical, chair, role) meets the i-th copy that fits. Parts in
    a slot's own key come first; then slots and parts that are left and of which one has no key. Both sides are dealt
    once, by piece, name, chair and role, and numbered there; to `tasks` tasks, if that is given.
    slots: key, slot, canonical, part_index, role, transposition; held: key, part, the same."""
    on = [key, "canonical", "part_index", "role"]
    own = F.lower(F.trim(first_truthy(F.col("transposition")))).alias("_key")
    side = lambda df, name: df.where("part_index is not null").select(*on, own, F.lit(name == "part").alias("_held"), name)
    both = side(slots, "slot").unionByName(side(held, "part"), allowMissingColumns=True).repartition(*([tasks] if tasks else []), *on)
    number = lambda *by: F.row_number().over(W.partitionBy(*on, *by, "_held").orderBy("slot", "part"))
    across = lambda x: F.count_if(x).over(W.partitionBy(*on, "_key"))
    opposite = F.when(F.col("_held"), across(~F.col("_held"))).otherwise(across(F.col("_held")))
    first = both.withColumn("_i", number("_key")).withColumn("_met", F.col("_i") <= opposite)
    slot_open = F.col("_key").isNull() != F.col("_held")  # pairs a slot without a key with a part that has one
    later = first.withColumn("_pass", F.when(F.col("_met"), 0).when(slot_open, 1).otherwise(2))
    last = later.withColumn("_i", F.when(F.col("_met"), F.col("_i")).otherwise(number("_pass"))).withColumn("_key", F.when(F.col("_met"), F.col("_key")))
    met = last.groupBy(*on, "_pass", "_key", "_i").agg(F.max("slot").alias("slot"), F.max("part").alias("part"))
    return met.where("slot is not null and part is not null").select(key, "slot", "part")


def editions(parts: DataFrame, demand: DataFrame, key: list[str]) -> DataFrame:
    """Clef editions in DataFrames: of the parts of the same facets and key, the n-th copies of every (clef, key) are
    one, with their clefs and keys; where a piece asks for more than an edition has copies, each part stays its own, the
    first ones, as many as are asked for.
    parts: key, part (orderable), clef, transposition; demand: key, demand. Returns key, part (the first), clefs, keys."""
    edition = [*key, "clef", "transposition"]
    numbered = parts.withColumn("copy", F.row_number().over(W.partitionBy(*edition).orderBy("part")))
    deepest = numbered.groupBy(*key).agg(F.max("copy").alias("deepest")).join(demand, key, "left")
    alone = F.coalesce(F.col("demand") > F.col("deepest"), F.lit(False))
    place = F.row_number().over(W.partitionBy(*key).orderBy("part"))
    both = numbered.withColumn("place", place).join(deepest, key).where(~alone | (F.col("place") <= F.col("demand")))
    stack = F.when(alone, F.struct(F.lit(True).alias("alone"), F.col("copy").alias("n"), "clef", "transposition")).otherwise(F.struct(F.lit(False).alias("alone"), F.col("copy").alias("n"), F.lit(None).cast("string").alias("clef"), F.lit(None).cast("string").alias("transposition")))
    sets = lambda c: F.array_sort(F.collect_set(c))
    return both.groupBy(*key, stack.alias("stack")).agg(F.min("part").alias("part"), sets("clef").alias("clefs"), sets("transposition").alias("keys")).drop("stack")


def unexpected(held: DataFrame, matched: DataFrame, slots: DataFrame, key: str = "piece_id", tasks: int | None = None) -> DataFrame:
    """Held parts that no slot took: no solo parts, and no numbered variants of an unnumbered section slot. Each join's
    sides are dealt to `tasks` tasks, if that is given."""
    dealt = lambda df, *by: df.repartition(tasks, *by) if tasks else df
    rest = dealt(held, key, "part").join(dealt(matched.select(key, "part"), key, "part"), [key, "part"], "left_anti").where(~F.col("role").isin("solo", "solo_alternative"))
    open_slots = dealt(slots.where(F.col("part_index").isNull() & (F.col("role") == "section")).select(key, "canonical"), key, "canonical").distinct()
    variant = dealt(rest.where("part_index is not null"), key, "canonical").join(open_slots, [key, "canonical"], "left_semi").select(key, "part")
    return rest.join(dealt(variant, key, "part"), [key, "part"], "left_anti")


def _key(x) -> str | None:
    return None if x is None or x != x or not str(x).strip() else str(x).strip().lower()


class _Together:
    """The matching of the slots and parts of a piece whose names are tied together."""

    def __init__(self, slots: list[dict], parts: list[dict], usual_key: dict[str, str]):
        self.slots, self.usual = slots, usual_key
        self.parts = self._editions(parts) if len(parts) > 1 else [self._alone(p) for p in parts]

    @cached_property
    def wanted(self) -> Counter:
        return Counter((s["canonical"], s["part_index"]) for s in self.slots)

    @staticmethod
    def _alone(p: dict) -> dict:
        p["clefs"], p["keys"] = [p["clef"]] if p["clef"] else [], [str(p["transposition"])] if _key(p["transposition"]) else []
        p["lead_pos"], p["lead_part"] = p["pos"], p["part"]
        return p

    def _by_key(self, same: list[dict]) -> list[list[dict]]:
        """Parts in different explicit keys are different instruments; unmarked ones join the usual key's."""
        keys = {_key(p["transposition"]) for p in same} - {None}
        if len(keys) < 2:
            return [same]
        out: dict = defaultdict(list)
        for n, p in enumerate(same):
            usual = next((_key(self.usual.get(c)) for c, _, _ in p["facets"] if c), None)
            out[_key(p["transposition"]) or (usual if usual else ("alone", n))].append(p)
        return list(out.values())

    def _editions(self, parts: list[dict]) -> list[dict]:
        """Clef editions of the same part count as one, unless the piece asks for more of it than there are copies
        of an edition: then each stands for itself, as many as are asked for."""
        alike: dict = defaultdict(list)
        for p in parts:
            alike[tuple(sorted((str(c), -1 if i is None else i) for c, i, _ in p["facets"])) if len(p["facets"]) > 1 else (str(p["canonical"]), -1 if p["part_index"] is None else p["part_index"])].append(p)
        out = []
        for same in alike.values():
            if len(same) == 1:
                out.append(self._alone(same[0]))
                continue
            need = max((self.wanted[stands or c, i] for c, i, stands in same[0]["facets"] if c), default=0)
            lead = {"lead_pos": same[0]["pos"], "lead_part": same[0]["part"]}
            for group in self._by_key(same):
                copies: dict = defaultdict(list)
                for p in group:
                    copies[(p["clef"], _key(p["transposition"]))].append(p)
                deepest = max(map(len, copies.values()))
                stacks = [[p] for p in group[:need]] if need > deepest else [[c[n] for c in copies.values() if n < len(c)] for n in range(deepest)]
                for stack in stacks:
                    clefs = sorted({p["clef"] for p in stack if p["clef"]})
                    keyed = sorted({str(p["transposition"]) for p in stack if _key(p["transposition"])})
                    out.append({**stack[0], "clefs": clefs, "keys": keyed, **lead})
        return out

    def match(self) -> dict[int, int]:
        """Slot to part: chairs that agree first, then what is left, in order, nearest chair first. Slots and parts
        wait in queues by what decides whether they fit, so none is looked at again and again."""
        if not self.slots or not self.parts:
            return {}
        if len(self.slots) == len(self.parts) == 1:
            return {0: 0} if self._fit(self.slots[0], self.parts[0]) else {}
        own, exact, others = defaultdict(list), defaultdict(list), defaultdict(list)
        for n, s in enumerate(self.slots):
            own[s["canonical"]].append((n, s["part_index"], "solo" if s["role"] == "solo" else "section", _key(s["transposition"]) or _key(self.usual.get(s["canonical"]))))
        for n, p in enumerate(self.parts):
            role = "solo" if p["role"] == "solo_alternative" else p["role"] or "section"
            named = {c for c, _, _ in p["facets"]}
            for c, chair, stands in p["facets"]:
                exact[c].append((n, chair, role, _key(p["transposition"])))
                if stands is not None and stands not in named:
                    others[stands].append((n, chair, role, _key(p["transposition"])))
        taken: dict[int, int] = {}
        for name, slots in own.items():
            if name in exact or name in others:
                self._fill(slots, exact[name] + others[name], taken)
        return taken

    def _fit(self, s: dict, p: dict) -> bool:
        """Whether a part may fill a slot, where there is no other."""
        if (s["role"] == "solo") != (p["role"] in ("solo", "solo_alternative")) or not any(s["canonical"] in (c, stands) for c, _, stands in p["facets"]):
            return False
        asked, key = _key(s["transposition"]) or _key(self.usual.get(s["canonical"])), _key(p["transposition"])
        return asked is None or key is None or asked == key

    @staticmethod
    def _fill(slots: list[tuple], offers: list[tuple], taken: dict[int, int]) -> None:
        """One name's slots, each (number, chair, role, key), from its parts, in order; adds to `taken`."""
        waiting, used = _Queues(), set()
        for n, chair, role, key in slots:
            waiting.add((chair, role), key, n)
        for k, (n, chair, role, key) in enumerate(offers):
            fit = None if chair is None else waiting.first((chair, role), key, taken)
            if fit is not None:
                taken[fit] = n
                used.add(k)
        seated, free = _Queues(), _Queues()
        for k, (_, chair, role, key) in enumerate(offers):
            if k not in used:
                seated.add((chair, role), key, k)
                free.add(role, key, k)
        for n, chair, role, key in slots:
            if n not in taken:
                k = seated.first((chair, role), key, used)
                k = free.first(role, key, used) if k is None else k
                if k is not None:
                    taken[n] = offers[k][0]
                    used.add(k)

    def rows(self, piece: str) -> Iterator[tuple]:
        """A row for every slot and every edition, the latter `unexpected` or merely `held`, and what to number it by."""
        taken = self.match()
        for n, s in enumerate(self.slots):
            p = self.parts[taken[n]] if n in taken else None
            yield piece, "slot", None, s["canonical"], s["part_index"], s["label"], p is not None, p and p["part"], p and ";".join(p["clefs"]), p and ";".join(p["keys"]), s["pos"], None, None, s["role"], s["transposition"]
        unnumbered = {s["canonical"] for s in self.slots if s["part_index"] is None and s["role"] == "section"}
        used = set(taken.values())
        for n, p in enumerate(self.parts):
            variant = all(i is not None and c in unnumbered for c, i, _ in p["facets"])
            kind = "held" if n in used or p["role"] in ("solo", "solo_alternative") or variant else "unexpected"
            yield piece, kind, None, p["facets"][0][0], p["facets"][0][1], p["label"], False, p["part"], ";".join(p["clefs"]), ";".join(p["keys"]), p["lead_pos"], p["lead_part"], n, None, None


class _Queues:
    """Numbers that wait in the order in which they came, by a place and an explicit key, which may be null."""

    def __init__(self):
        self.places: dict = {}

    def add(self, place, key: str | None, number: int) -> None:
        self.places.setdefault(place, {}).setdefault(key, deque()).append(number)

    def first(self, place, key: str | None, gone) -> int | None:
        """The least number at a place, of those not gone, whose key is the same, or where either is null."""
        at, best = self.places.get(place), None
        if at is None:
            return None
        for k in list(at) if key is None else (key, None):
            queue = at.get(k)
            while queue and queue[0] in gone:
                queue.popleft()
            if queue and (best is None or queue[0] < best):
                best = queue[0]
        return best


SLOT_FIELDS = ("pos", "canonical", "part_index", "label", "role", "transposition")
PART_FIELDS = ("pos", "part", "canonical", "part_index", "label", "clef", "transposition", "role")


def stand_ins(slots: DataFrame, groups: list[list[str]]) -> DataFrame:
    """(piece_id, canonical, stands): held instruments that stand for an expected one. The last of the groups that says
    so decides, else the first slot among whose `equivalents` (an array; the column may be missing) it is. An expected
    instrument stands for itself only. Slots that are dealt by their piece are read once and stay where they are."""
    row = lambda name, stands, source, place: F.struct(name.alias("canonical"), stands.alias("stands"), F.lit(source).cast("int").alias("source"), place.cast("int").alias("place"))
    none = F.lit(None).cast("string")
    told = [F.array(row(F.col("canonical"), none, None, F.lit(None)))]
    if groups:
        others: dict = defaultdict(list)
        for i, group in enumerate(groups):
            for g in dict.fromkeys(group):
                others[g] += [(i, o) for o in dict.fromkeys(group) if o != g]
        dim = slots.sparkSession.createDataFrame(list(others.items()), "canonical string, others array<struct<grp: int, other: string>>")
        slots = slots.join(dictionary(dim), "canonical", "left")
        told.append(F.transform(F.coalesce("others", F.array().cast("array<struct<grp: int, other: string>>")), lambda o: row(o["other"], F.col("canonical"), 0, o["grp"])))
    if "equivalents" in slots.columns:
        told.append(F.transform(F.coalesce("equivalents", F.array().cast("array<string>")), lambda e: row(e, F.col("canonical"), 1, F.col("pos"))))
    each = slots.select("piece_id", F.inline(F.concat(*told))).where("canonical is not null").groupBy("piece_id", "canonical").agg(
        F.count_if(F.col("source").isNull()).alias("named"),
        F.collect_set(F.when(F.col("source") == 0, F.struct("place", "stands"))).alias("grouped"),
        F.min(F.when(F.col("source") == 1, F.struct("place", "stands")))["stands"].alias("first"))
    alone = F.filter("grouped", lambda x: F.size(F.filter("grouped", lambda y: y["place"] == x["place"])) == 1)
    return each.select("piece_id", "canonical", F.when(F.col("named") == 0, F.coalesce(F.array_max(alone)["stands"], "first")).alias("stands")).where("stands is not null")


def components(tied: DataFrame) -> DataFrame:
    """(piece_id, canonical, component): within a piece, the names that hang together through lists of names (piece_id,
    names array<string>), and the least of each such set; names in no list of two or more don't come. A task holds the
    distinct ties of a piece, which the number of names bounds, not the number of parts."""
    each = tied.where("size(names) > 1").select("piece_id", F.col("names")[0].alias("a"), F.explode("names").alias("b")).where("a <> b")
    folded = each.groupBy("piece_id").agg(F.collect_set(F.struct("a", "b")).alias("ties"))

    schema = pa.schema([(n, pa.string()) for n in ("piece_id", "canonical", "component")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for piece, ties in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                above: dict[str, str] = {}

                def top(name: str) -> str:
                    while above.setdefault(name, name) != name:
                        above[name] = name = above[above[name]]
                    return name

                for tie in ties:
                    low, high = sorted((top(tie["a"]), top(tie["b"])))
                    above[high] = low
                rows += [(piece, name, top(name)) for name in list(above)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], schema=schema)

    return folded.select("piece_id", "ties").mapInArrow(run, "piece_id string, canonical string, component string")


def _values(column: pa.Array) -> list:
    if pa.types.is_integer(column.type):
        found = column.fill_null(0).to_numpy(zero_copy_only=False).tolist()
        return [v if t else None for v, t in zip(found, column.is_valid().to_numpy(zero_copy_only=False).tolist(), strict=True)] if column.null_count else found
    return column.to_numpy(zero_copy_only=False).tolist() if pa.types.is_string(column.type) else column.to_pylist()


def _records(column: pa.StructArray) -> list[dict]:
    """Structs as dicts, converted a field at a time."""
    names = [f.name for f in column.type]
    return [dict(zip(names, r, strict=True)) for r in zip(*(_values(column.field(i)) for i in range(len(names))), strict=True)]


def _folds(batch: pa.RecordBatch) -> Iterator[tuple[str, list[dict], list[dict]]]:
    """(piece, slots, parts with their facets) of each row of (piece, array of slots, array of parts' arrays of facets)."""
    pieces, wanted, parts = _values(batch.column(0)), batch.column(1), batch.column(2)
    slots, cuts, ends = _records(wanted.values), wanted.offsets.to_pylist(), parts.offsets.to_pylist()
    facets, inner, offered = _records(parts.values.values), parts.values.offsets.to_pylist(), []
    for at, end in pairwise(inner):
        rs = facets[at:end]
        named = [(r["canonical"], r["part_index"], r["stands"]) for r in rs]
        rs[0]["facets"] = named
        offered.append(rs[0])
    for k, piece in enumerate(pieces):
        yield piece, slots[cuts[k] : cuts[k + 1]], offered[ends[k] : ends[k + 1]]


_KINDS = {"int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
_FIELDS = [pa.field(n, _KINDS[t]) for n, t in (c.split() for c in RESULT.split(", "))]
#: What `_Together.rows` gives: the result without a number, and what decides it.
_ROWS = pa.schema([*_FIELDS, *(pa.field(n, _KINDS[t]) for n, t in (("lead_pos", "int"), ("lead_part", "string"), ("seq", "int"), ("role", "string"), ("transposition", "string")))])
_BY = ("lead_pos", "lead_part", "seq", "canonical", "part_index", "label", "role", "transposition")
_order = itemgetter(*map(_ROWS.get_field_index, _BY))
ROWS_AT_ONCE = 20_000  #: results of a piece that a task holds as tuples, about


def _table(rows: list[tuple], fields: list[pa.Field]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))


def _places(rows: list[tuple]) -> Iterator[tuple]:
    for slots in (True, False):
        side = [r for r in rows if (r[1] == "slot") == slots]
        if len(side) > 1:
            try:
                side.sort(key=_order)
            except TypeError:  # nulls come first
                side.sort(key=lambda r: [(x is not None, x) for x in _order(r)])
        for n, r in enumerate(side):
            if r[1] != "held":
                yield r[0], r[1], n, *r[3 : len(_FIELDS)]


def _places_in(table: pa.Table) -> pa.Table:
    slot, sides = pc.equal(table["kind"], "slot"), []
    for side in (table.filter(slot), table.filter(pc.invert(slot))):
        side = side.take(pc.sort_indices(side, sort_keys=[(n, "ascending") for n in _BY], null_placement="at_start")).select([f.name for f in _FIELDS])
        side = side.set_column(2, _FIELDS[2], pa.array(range(len(side)), pa.int32()))
        sides.append(side.filter(pc.not_equal(side["kind"], "held")))
    return pa.concat_tables(sides)


def _numbered(found: Iterator[tuple[str, Iterator[tuple]]]) -> Iterator[pa.RecordBatch]:
    """Batches of RESULT from the rows of components, a piece's one after another: its slots are numbered, and so are its
    editions, of which the merely held are then left out. A large piece's results, not its slots and parts, are kept as
    Arrow columns until it ends."""
    done: list[tuple] = []
    for _, group in groupby(found, itemgetter(0)):
        rows, tables = [], []
        for _, more in group:
            rows += more
            if len(rows) >= ROWS_AT_ONCE:
                tables.append(_table(rows, list(_ROWS)))
                rows = []
        if tables:
            yield from _places_in(pa.concat_tables([*tables, _table(rows, list(_ROWS))])).to_batches(max_chunksize=ROWS_AT_ONCE)
        else:
            done += _places(rows)
        if len(done) >= ROWS_AT_ONCE:
            yield from _table(done, _FIELDS).to_batches()
            done = []
    yield from _table(done, _FIELDS).to_batches()


def reconcile(slots: DataFrame, held: DataFrame, groups: list[list[str]] | None = None, usual_key: dict[str, str] | None = None, tasks: int | None = None) -> DataFrame:
    """Rows of RESULT: every slot, whether present and by what part, and the unexpected parts.

    What is folded is not a piece but the slots and parts of it whose names hang together: those of a part of several
    names, and a name and what it stands for. These must fit in a task, and a piece's results as Arrow columns, which are
    numbered when it ends. Both sides are dealt once, by their piece, to `tasks` tasks, if that is given; not even that, if
    they come so dealt. All that follows stays where the piece is, so what is written to disk are the sides and the names
    that are tied.

    slots: piece_id, pos, canonical, part_index, label, role, transposition, and, if there, equivalents array<string>;
    held: piece_id, part, pos, canonical, part_index, label, clef, transposition, role (a row for each facet)."""
    groups, usual_key = groups or [], usual_key or {}
    key, none = F.col("piece_id").cast("string").alias("piece_id"), F.lit(None).cast("string")
    slots, held = (df.withColumn("piece_id", key) for df in (slots, held))
    if tasks:
        slots, held = slots.repartition(tasks, "piece_id"), held.repartition(tasks, "piece_id")
    named = W.partitionBy("piece_id", "canonical")
    wanted = slots.select("piece_id", "canonical", F.struct(*SLOT_FIELDS).alias("slot"))
    facets = held.withColumn("stands", none)
    if groups or "equivalents" in slots.columns:  # in a window, as a join would deal both sides anew
        told = held.withColumn("_held", F.lit(True)).unionByName(stand_ins(slots, groups), allowMissingColumns=True)
        facets = told.withColumn("stands", F.max("stands").over(named)).where("_held").drop("_held")
    names = F.sort_array(F.array_union(F.collect_set("canonical"), F.collect_set("stands"))).alias("names")
    parts = facets.groupBy("piece_id", "part").agg(names, F.sort_array(F.collect_list(F.struct(*PART_FIELDS, "stands"))).alias("facets"))
    before = F.lag("canonical").over(W.partitionBy("piece_id", "part").orderBy("canonical"))  # ties a part's names in a chain
    tied = components(facets.select("piece_id", F.array_compact(F.array("canonical", before, "stands")).alias("names")))
    tied = tied.repartition(tasks, "piece_id") if tasks else tied
    found = parts.select("piece_id", F.get("names", F.lit(0)).alias("canonical"), "facets")
    both = wanted.unionByName(found, allowMissingColumns=True).unionByName(tied, allowMissingColumns=True)
    both = both.withColumn("component", F.coalesce(F.max("component").over(named), "canonical")).where("slot is not null or facets is not null")
    folded = both.groupBy("piece_id", "component").agg(F.sort_array(F.collect_list("slot")).alias("wanted"), F.sort_array(F.collect_list("facets")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((piece, _Together(asked, offered, usual_key).rows(piece)) for batch in batches for piece, asked, offered in _folds(batch))
        yield from _numbered(found)

    folded = folded.repartition(*([tasks] if tasks else []), "piece_id").sortWithinPartitions("piece_id")  # as it is dealt
    return folded.select("piece_id", "wanted", "parts").mapInArrow(run, RESULT)


def compatible(slot: Column, part: Column) -> Column:
    """Whether a part struct (role, transposition) may fill a slot struct, as a join condition."""
    return role_compatible(slot["role"], part["role"]) & transposition_compatible(slot["transposition"], part["transposition"])


class AliasFinder:
    """Finds canonical names in normalized texts: one pass of an automaton over a text finds every place of every alias,
    however many aliases there are; the longest take their spans first, and spans don't overlap. Of aliases as long, the
    one that is listed first comes first; an alias's own places don't overlap either."""

    def __init__(self, aliases: list[tuple[str, str]]):
        import ahocorasick

        self.aliases = [(name, alias) for name, alias in aliases if alias]
        self.automaton = ahocorasick.Automaton()
        listed: dict[str, list[int]] = defaultdict(list)
        for i, (_, alias) in enumerate(self.aliases):
            listed[alias].append(i)
        for alias, places in listed.items():
            self.automaton.add_word(alias, (len(alias), places))
        if listed:
            self.automaton.make_automaton()

    def __reduce__(self):
        return AliasFinder, (self.aliases,)

    def __call__(self, text: str) -> list[str]:
        """The names, in order of position, each once."""
        if not self.aliases:
            return []
        hits = []
        for last, (size, places) in self.automaton.iter(text):
            start, end = last - size + 1, last + 1
            if not (start and text[start - 1] in _LETTERS) and not (end < len(text) and text[end] in _LETTERS):
                hits += [(-size, i, start) for i in places]
        free, found, reached = bytearray(len(text)), [], {}
        for size, i, start in sorted(hits):
            end = start - size
            if start < reached.get(i, 0):
                continue
            reached[i] = end
            if not any(free[start:end]):
                free[start:end] = b"\1" * (end - start)
                found.append((start, self.aliases[i][0]))
        return list(dict.fromkeys(n for _, n in sorted(found)))


_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def spans_by_length(aliases: list[tuple[str, str]]) -> Callable[[str], list[str]]:
    """Canonical names in a text in order of position; the longest alias takes its span first, spans don't overlap."""
    return AliasFinder(aliases)


def all_matches(text: Column, aliases: list[tuple[str, str]]) -> Column:
    """array<string> of the canonical names that a normalized text holds, by spans that don't overlap. The automaton is
    built once a task."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = AliasFinder(aliases)
        for texts in batches:
            yield texts.map(lambda t: find(t) if isinstance(t, str) else [])

    return run(text)
