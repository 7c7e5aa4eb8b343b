"""Snapshot tables, the event-ordered merge, ranks and exact quantiles."""
import json
import random
import statistics
import threading

import pytest
from pyspark.sql import functions as F

from foliant.operators.ranking import with_rank
from foliant.operators.selection import quantiles, ranked_value, summarised
from foliant.sources import files, readers, sinks, snapshots
from foliant.streaming import incremental as I


def failing(df, column):
    """df, of which a row makes its task fail."""
    return df.withColumn(column, F.when(F.col(column) < 0, F.raise_error(F.lit("planted"))).otherwise(F.col(column)))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.range(50).select(F.col("id").alias("n"))
    sinks.write_jsonl(good, path)
    bad = failing(spark.range(40).select((F.col("id") - 1).alias("n")).repartition(4), "n")
    for _ in range(3):
        with pytest.raises(Exception, match="planted"):
            sinks.write_jsonl(bad, path)
    assert readers.read_jsonl(spark, path, "n long").count() == 50
    assert len(files.names(f"{path}/data", spark)) == 1
    sinks.write_text(good.select(F.lit("é").alias("line")), "line", str(tmp_path / "x"))
    assert snapshots.read(spark, str(tmp_path / "x")).distinct().first()[0] == "é"


def test_readers_see_the_old_version_or_the_new_one(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.version_of(spark, path) == (0, None) and snapshots.folders(spark, path) == [path]
    snapshots.commit(spark.range(3), path)
    before = snapshots.read(spark, path)
    version, _ = snapshots.version_of(spark, path)
    snapshots.write_folder(spark.range(9), path, snapshots.fresh_folder(version), "parquet")  # a writer half-way
    assert snapshots.read(spark, path).count() == 3
    snapshots.commit(snapshots.read(spark, path).union(spark.range(5)), path)  # reads what it replaces
    assert before.count() == 3 and snapshots.read(spark, path).count() == 8 and snapshots.read(spark, path, 1).count() == 3
    for k in range(3):
        snapshots.commit(spark.range(k), path)
    assert len(files.names(f"{path}/_log", spark)) == snapshots.KEEP == len(files.names(f"{path}/data", spark))
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, path, 1)


def test_writers_dont_lose_each_others_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.commit(spark.range(1), path)
    with pytest.raises(snapshots.ConflictError):
        snapshots.publish(spark, path, 0, {"folders": []})
    assert snapshots.read(spark, path).count() == 1
    threads = [threading.Thread(target=lambda k=k: snapshots.update(spark, path, lambda t: t.union(spark.range(k, k + 1)), tries=9)) for k in (7, 8, 9)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.id for r in snapshots.read(spark, path).collect()) == [0, 7, 8, 9]


def test_json_lines_are_ascii(spark, tmp_path):
    texts = ["plain", "é€", "\U0001f600 a\\b\"", "", "\n\t", None]
    df = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "t string, k int")
    path = str(tmp_path / "t")
    sinks.write_jsonl(df, path)
    lines = [r.value for r in snapshots.read(spark, path).collect()]
    assert all(x.isascii() for x in lines) and "\\ud83d\\ude00" in "".join(lines)
    assert sorted((json.loads(x)["k"], json.loads(x)["t"]) for x in lines) == [(k, t) for k, t in enumerate(texts)]
    assert {r.k: r.t for r in readers.read_jsonl(spark, path, "k int, t string").collect()} == dict(enumerate(texts))


def test_checkpoints_of_stages(spark, tmp_path):
    path = str(tmp_path / "c")
    prints = spark.createDataFrame([("a", "f1"), ("b", "f2")], "key string, fingerprint string")
    assert readers.read_checkpoint(spark, path, "one").count() == 0
    sinks.write_checkpoint(prints, "one", "1.0", "r1", path)
    sinks.write_checkpoint(prints.limit(1), "two", "2.0", "r1", path)
    sinks.write_checkpoint(prints.where("key = 'b'"), "one", "1.0", "r2", path)
    got = readers.checkpoint_of(readers.read_checkpoint(spark, path, "one"), "1.0")
    assert [tuple(r) for r in got.collect()] == [("b", "f2")]
    assert readers.checkpoint_of(readers.read_checkpoint(spark, path, "two"), "1.0").count() == 0


def test_pruning_of_odd_keys(spark, tmp_path):
    path = str(tmp_path / "k")
    df = spark.createDataFrame([("a/b", 1), ("c d", 2), ("e=f", 3), ("g", 4)], "key string, n int")
    sinks.write_per_key(df, "key", path)
    assert sinks.prune(path, "key", df.where("n in (2, 4)")) == ["a/b", "e=f"]
    assert sorted(r.n for r in spark.read.json(path).collect()) == [2, 4]


def merged(batches):
    """What merge_batch() has to leave: of each key the order and record of its greatest order, of ties the last batch's."""
    state = {}
    for rows in batches:
        best = {}
        for key, order, print_ in rows:
            if key is not None and order is not None and (key not in best or (order, [-ord(c) for c in print_]) > (best[key][0], [-ord(c) for c in best[key][1]])):
                best[key] = (order, print_)
        for key, (order, print_) in best.items():
            if key not in state or order > state[key][0] or (order == state[key][0] and print_ != state[key][1]):
                made = state[key][2] if key in state and state[key][1] == print_ else order
                state[key] = (order, print_, made)
    return {k: (made, p) for k, (_, p, made) in state.items()}


def test_late_rows_never_win(spark, tmp_path):
    rng = random.Random(8)
    schema, table = "k string, n int, fingerprint string", str(tmp_path / "t")
    batches = [[(rng.choice("abcdef"), rng.randint(0, 60), rng.choice("xyz")) for _ in range(rng.randint(1, 8))] for _ in range(14)]
    batches += [[("a", 100, "q"), (None, 5, "x"), ("b", None, "x")], [("a", 5, "r"), ("a", 99, "s")], [("z", 1, "x")]]
    counts = []
    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        counts.append(I.merge_batch(df, number, "k", "n", table, buckets=3, most_folders=4))
        again = I.merge_batch(df, number, "k", "n", table, buckets=3, most_folders=4)  # run again after a crash
        assert again == counts[-1]
        assert len(files.names(f"{table}/data", spark)) <= 4 + 3 and len(snapshots.version_of(spark, table)[1]["folders"]) <= 5
    assert {r.k: (r.n, r.fingerprint) for r in I.latest(spark, table, "k").collect()} == merged(batches)
    assert I.merge_batch(spark.createDataFrame([("a", 999, "old")], schema), 3, "k", "n", table) == 0  # a batch long done
    assert I.latest(spark, table, "k").where("k = 'a'").first().n == 100 and counts[-2] == 0


def test_merge_makes_records_of_new_content_only(spark, tmp_path):
    schema, table, done = "k string, n int, fingerprint string", str(tmp_path / "t"), []
    work = lambda d: d.select("k", "fingerprint", F.concat("k", F.lit("-"), F.col("n").cast("string")).alias("made"))
    for number, rows in enumerate([[("a", 1, "x"), ("b", 1, "x")], [("a", 5, "x"), ("b", 5, "y")], [("a", 3, "z"), ("b", 3, "z")]]):
        done.append(I.merge_batch(spark.createDataFrame(rows, schema), number, "k", "n", table, work))
    assert {r.k: r.made for r in I.latest(spark, table, "k").collect()} == {"a": "a-1", "b": "b-5"} and done == [2, 1, 0]


def test_ranks(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.choice([0, 0, 0, 1, 2, None]), rng.choice(["a", "b", None]), i % 300) for i in range(900)]
    df = spark.createDataFrame(rows, "x int, y string, z int").repartition(7)
    order = [F.desc("x"), F.col("y"), F.col("z")]
    got = sorted((r["rank"], r.x, r.y, r.z) for r in with_rank(df, order).collect())
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or "", r[2])
    assert [r[0] for r in got] == list(range(1, 901)) and [r[1:] for r in got] == sorted(rows, key=key)
    first = sorted((r["rank"], r.x, r.y, r.z) for r in with_rank(df, order, limit=25).collect())
    assert [r[0] for r in first] == list(range(1, 26)) and [r[1:] for r in first] == [r[1:] for r in got[:25]]
    monkeypatch.setattr("foliant.operators.ranking.FEW", 3)
    assert with_rank(df, order, limit=25).count() == 25
    assert with_rank(df.where("false"), order).count() == 0
    plan = with_rank(df, order)._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr("foliant.operators.selection.FEW", 4)
    rng = random.Random(3)
    for values in ([5.0], [1.0, 2.0], [rng.gauss(0, 1) for _ in range(501)], [1e300, -1e300] * 50 + [0.0], [7.0] * 400 + [8.0], [float(rng.randint(0, 3)) for _ in range(1000)], [10.0**k for k in range(-150, 150)]):
        df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").repartition(3)
        ordered = sorted(values)
        assert quantiles(df, F.col("v"), [0.5])[0] == pytest.approx(statistics.median(values), rel=1e-12)
        kept = df.where("v is not null and not isnan(v)")
        assert [ranked_value(kept, k) for k in (0, len(ordered) // 3, len(ordered) - 1)] == [ordered[0], ordered[len(ordered) // 3], ordered[-1]]
    assert quantiles(df.where("v is null"), F.col("v"), [0.5]) == [None]
    assert tuple(summarised(spark.createDataFrame([(0.5,), (1.0,), (None,)], "v double"), F.col("v")).first()) == (2, 0.75, 0.75, 0.5, 1.0)
    assert tuple(summarised(df.where("v is null"), F.col("v")).first()) == (0, None, None, None, None)
