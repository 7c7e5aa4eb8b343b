"""Filter audit, substring dedup, collocations and the bounded sample, against brute-force versions."""
import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "\n\n", "a", "A B C", "x\x0by\x0cz", "dup dup dup dup dup " * 40, "word %d and more " * 3000 % tuple(range(3000)), "#" * 9]


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, la, so, None) for i, t, la, so in rows], DOCS)
    for name in ("h", "c", "tid", "starts", "part", "fails", "digest", "n", "phrase", "bucket", "f", "k", "good"):
        df = df.withColumn(name, F.lit(name))
    return df


# --- filter audit

def fails(text):
    t = text or ""
    w = WORD.findall(t)
    return [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t))]


def audited(rows, labels):
    least = {}
    for i, t, _, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, _, so in rows:
        own = [x for x in labels if x[0] == i and i is not None]
        docs.append((so or "", [*fails(t), i is not None and least.get(t or "", i) < i], any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = {}
    for part in {d[0] for d in docs}:
        total = collections.Counter()
        for order in itertools.permutations(range(5)):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order):
                removed = [d for d in left if d[1][f]]
                redundant = [d for d in gone if d[1][f]]
                left = [d for d in left if not d[1][f]]
                gone += removed
                alone = [d for d in docs if d[0] == part and d[1][f] and sum(d[1]) == 1]
                total[f] += len(removed)
                out[part, "".join("ABCDE"[x] for x in order), step + 1] = (len(left), len(removed), len(redundant), len(alone), sum(d[2] for d in removed), sum(d[3] for d in removed), f)
        for key in [k for k in out if k[0] == part]:
            out[key] = (*out[key][:6], total[out[key][6]])
    return out


def check_audit(spark, rows, labels):
    from foliant.llm import filter_audit as A

    got = A.audit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, part string")).collect()
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == audited(rows, labels)
    assert len(got) == 600 * len({r[3] or "" for r in rows})


def test_filter_audit(spark):
    rng = random.Random(5)
    texts = [*ODD, *[" ".join(rng.choice(["ab", "Cd", "e#", *(f"w{k}" for k in range(60))]) for _ in range(rng.randint(30, 90))) for _ in range(60)]]
    rows = [(i, t, "en", rng.choice([None, "", "s0", "s1"])) for i, t in enumerate(texts + rng.sample(texts, 25))]
    rows += [(3, "again", "en", "s0"), (3, "again", "en", "s0"), (None, texts[20], None, "s1"), (None, texts[20], None, "s1"), (-1, texts[21], None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in range(0, 90, 2)] + [(4, 1, 1, "x"), (4, 0, 0, "x"), (None, 1, 1, "x")]
    check_audit(spark, rows, labels)


def test_filter_audit_of_nothing(spark):
    check_audit(spark, [], [])
    check_audit(spark, [(1, None, None, None)], [])


# --- substring dedup

def without(rows, window):
    texts = [WORD.findall(t or "") for _, t, _, _ in rows]
    first = {}
    for (i, *_), w in zip(rows, texts):
        for p in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[p : p + window])
            first[key] = min(i, first.get(key, i))
    out = []
    for (i, *_), w in zip(rows, texts):
        gone = set()
        for p in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[p : p + window])] < i:
                gone |= set(range(p, p + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return collections.Counter(out)


def passages(rng, words, n):
    shared = [[rng.choice(words) for _ in range(k)] for k in (20, 49, 50, 51, 75, 120, 260)]
    rows = []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(shared)
        rows.append((rng.choice([i, i, i, 7, None]), rng.choice([" ", "\n", "  ", "\t"]).join(w), "en", "s"))
    return rows


@pytest.mark.parametrize("window", [50, 7, 104])
def test_substrings_are_removed(spark, window):
    from foliant.llm import substrings as S

    rng = random.Random(window)
    rows = [*[(100 + i, t, "en", "s") for i, t in enumerate(ODD)], *[(200 + i, t, "en", "s") for i, t in enumerate(ODD)], *passages(rng, ["a", "b"], 20), *passages(rng, [f"w{i}" for i in range(500)], 60)]
    rows += rows[-5:]
    got = S.deduplicated(frame(spark, rows), window)
    assert collections.Counter(tuple(r) for r in got.collect()) == without(rows, window)


def test_substrings_of_nothing(spark):
    from foliant.llm import substrings as S

    assert S.deduplicated(frame(spark, [])).count() == 0
    assert [r.n_removed for r in S.deduplicated(frame(spark, [(1, "a", None, None)])).collect()] == [0]
    assert S.longest_repeats(frame(spark, [(1, "a", None, None)])).count() == 0


def test_levels():
    from foliant.llm import substrings as S

    assert S.levels(50) == [25, 50] and S.levels(104) == [13, 26, 52, 104] and S.levels(7) == [4, 7]
    assert all(b in (2 * a, 2 * a - 1) for x in range(2, 500) for a, b in zip(S.levels(x), S.levels(x)[1:]))


def test_long_texts_are_cut_without_loss(monkeypatch):
    from foliant.llm import substrings as S

    rng = random.Random(9)
    text = " ".join(rng.choice("abcdef") for _ in range(2000)).encode()
    whole, at = S.word_hashes(text), S.marks(S.word_hashes(text), 25, 50)
    monkeypatch.setattr(S, "SEGMENT", 100)
    monkeypatch.setattr(S, "CHUNK", 60)
    assert (S.word_hashes(text) == whole).all()
    small = S.marks(whole, 25, 50)
    assert (small[0] == at[0]).all() and (small[1] == at[1]).all()
    assert S.without_repeats(text, np.array([5, 700]), 50)[1] == 100
    starts = set(at[0].tolist())
    assert all(starts & set(range(q, q + 26)) for q in range(len(whole) - 49))


def test_longest_repeats(spark):
    from foliant.llm import substrings as S

    rng = random.Random(4)
    base = [str(rng.random()) for _ in range(900)]
    rows = [(1, " ".join(base), None, None), (2, " ".join(["x", *base[:130]]), None, None), (3, " ".join(base[400:] + ["y"]), None, None), (4, " ".join(base[:49]), None, None), (5, "other words", None, None)]
    got = {r.doc_id: r.longest for r in S.longest_repeats(frame(spark, rows)).collect()}
    assert got == {1: 400, 2: 100, 3: 400}


# --- collocations

def collocated(rows, support, longest, top):
    f, n = collections.Counter(), collections.Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for _, t, la, _ in rows:
        la = "und" if la is None else la
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[la] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[la, tuple(w[i : i + k])] += 1
    frequent = {key: x for key, x in f.items() if x >= support}
    held = collections.Counter()
    for (la, w), x in frequent.items():
        for s in range(2, len(w)):
            for i in range(len(w) - s + 1):
                held[la, w[i : i + s]] = max(held[la, w[i : i + s]], x)
    out = collections.defaultdict(list)
    for (la, w), a in frequent.items():
        if len(w) > 1 and not 100 * held[la, w] >= 100 * a:
            score, k = min((1000 * a * n[la] // (f[la, w[:k]] * f[la, w[k:]]), k) for k in range(1, len(w)))
            out[la].append((-score, -a, " ".join(w).encode(), f[la, w[:k]], f[la, w[k:]], n[la]))
    return {(la, rank): (p.decode(), -a, left, right, total, -s) for la, x in out.items() for rank, (s, a, p, left, right, total) in enumerate(sorted(x)[:top], 1)}


def check_collocations(spark, rows, **kw):
    from foliant.llm import collocations as C

    got = {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in C.collocations(frame(spark, rows), **kw).collect()}
    assert got == collocated(rows, kw["support"], kw["longest"], kw["top"])
    return got


@pytest.mark.parametrize("bits,held,block", [(15, 300_000, 1 << 21), (16, 20, 300)])
def test_collocations(spark, monkeypatch, bits, held, block):
    from foliant.llm import collocations as C

    rng = random.Random(bits)
    words = ["New", "york", "the", "of", "été", "x\x00", "\U0001f600", "A"]
    texts = [*ODD, *["".join(rng.choice(words) + rng.choice([" "] * 9 + ["  ", "\t", ".", ", ", "\n", "\r"]) for _ in range(rng.randint(0, 80))) for _ in range(120)]]
    rows = [(i, t, rng.choice([None, "en", "en", "und", "fr"]), "s") for i, t in enumerate(texts)]
    monkeypatch.setattr(C, "BITS", bits)
    monkeypatch.setattr(C, "HELD", held)
    monkeypatch.setattr(C, "BLOCK", block)
    if block == 300:  # the workers read the module's own values: blocks are cut here
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([(r[1] or "").encode() for r in rows], pa.binary())], ["lang", "text"])
        parts = collections.Counter(w for _, t in C._blocks(iter([batch])) for x in t for p in x.split(b"\n") for w in p.split())
        assert parts == collections.Counter(w for r in rows for w in (r[1] or "").encode().translate(C.FOLD).split())
        return
    monkeypatch.undo()
    for support, longest, top in ((4, 5, 40), (30, 3, 1000), (1, 4, 25)):
        assert check_collocations(spark, rows, support=support, longest=longest, top=top)


def test_collocations_pass_on_small_batches():
    """What a task hands to the JVM at once doesn't grow with the number of buckets or phrases."""
    from foliant.llm import collocations as C

    hits = np.ones(1 << 19, np.uint32)
    sizes = [b.num_rows for b in C._bucket_rows(hits)]
    assert sum(sizes) == len(hits) and max(sizes) <= 1 << 16
    counts = {"en": {b"w%d" % i: i << C.BITS | i % 9 for i in range(1, 100_000)}, "fr": {b"x": 1 << 31 << C.BITS | 5}}
    batches = list(C._rows(counts))
    assert max(b.num_rows for b in batches) <= 1 << 16 and not any(counts.values())
    rows = {(r["lang"], r["phrase"], r["bucket"], r["n"]) for b in batches for r in b.to_pylist()}
    assert rows == {("en", f"w{i}", i % 9, i) for i in range(1, 100_000)} | {("fr", "x", 5, 1 << 31)}


def test_collocations_of_nothing(spark):
    assert not check_collocations(spark, [], support=2, longest=3, top=9)
    assert not check_collocations(spark, [(1, None, None, None)], support=2, longest=3, top=9)
    assert check_collocations(spark, [(1, "a b. a b", None, None)] * 2, support=2, longest=3, top=9)


def test_blocks_tell_colliding_words_apart():
    from foliant.llm import collocations as C

    block = C.Block([b"a b a b", b"b a"], 3)
    inside, h, c = block.grams(2)
    assert inside.tolist() == [True, True, True, False, True] and h[0] == h[2] and h[1] == h[4] != h[0] and c[1] == c[4]


# --- the bounded sample

def test_bounded_sample_with_hot_ids(spark):
    from foliant.llm.common import bounded_sample, texts_of

    hot = [(1, "a" if i % 2 else "b", i) for i in range(2000)]
    rows = [*hot, *[(1, "c", 5)] * 900, *[(i, "d", 0) for i in range(1000)], (4, None, 1), (5, "e", 1)]
    df = spark.createDataFrame(rows, "id long, y string, x long")
    for bound in (5, 40, 300):
        got = bounded_sample(df, "y", bound).collect()
        counts = collections.Counter(r.y for r in got)
        assert len(got) <= bound and set(counts) == set("abcde") and counts["c"] == counts["e"] == 1
        assert len({tuple(r) for r in got}) == len(got)
        assert sorted(map(tuple, got)) == sorted(map(tuple, bounded_sample(df.repartition(3), "y", bound).collect()))
    assert bounded_sample(df.where("false"), "y", 9).count() == 0
    assert len(bounded_sample(df, "y", 2).collect()) == 5  # one of each label, should there be more labels than that
    docs = spark.createDataFrame([(1, f"text {i}", i) for i in range(500)] + [(2, None, 1), (3, "t", 1)], "doc_id long, text string, y long")
    chosen = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (9, "a")], "doc_id long, y string")
    texts = texts_of(docs, chosen).collect()
    assert sorted((r.doc_id, r.y) for r in texts) == [(1, "a"), (1, "b"), (2, "a")] and len({r.text for r in texts}) == 2


def test_models_train_with_hot_ids(spark):
    from foliant.llm import language_id, mixing, quality_classifier

    docs = spark.createDataFrame([(2, f"some words {i}", "en") for i in range(400)] + [(3 + i, f"des mots {i}", "fr") for i in range(40)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(2, 1)] * 300 + [(3 + i, i % 2) for i in range(40)], "doc_id long, quality int")
    assert set(language_id.train(docs, bound=30).languages) == {"en", "fr"}
    assert quality_classifier.train(docs, labels, bound=20).p
    assert mixing.train(docs, labels.select("doc_id", F.col("quality").cast("string").alias("domain")), bound=20) is not None
