"""Language ID, quality classifier and mixing: held-out accuracy, edge cases, targets."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import language_id as L
from foliant.llm import mixing as M
from foliant.llm import quality_classifier as Q
from foliant.llm.passages import WIDTH, passage_features

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF01 = "/root/testdata/sf0.01"


def edge_docs(spark):
    """Nulls in any column, empty, letterless and very long texts, repeated rows, clashing extra columns."""
    long = "der schnelle und einfach nicht die keit " * 20000
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "123 $$$ 456", None, None, 11), (None, "the quick and the over", "en", "a", 22), (5, long, "de", "b", len(long)), (6, "the and of", "en", "a", 10), (6, "the and of", "en", "a", 10)]
    return spark.createDataFrame(rows, DOCS)


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12, 40):
        code = L.codewords(n)
        gap = (code[:, None] != code[None]).sum(2) + np.eye(n) * 999
        assert gap.min() >= (1 if n < 3 else 2)
    assert L.codewords(1).shape == (1, 1)


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = L.op1_language_id(spark, SF01).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(rows) == docs.count()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_queries_apply_their_models_to_whole_texts(spark):
    """op1, op4 and op6 against their models, fitted alike, applied to one text after the other."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    model = L.train(docs)
    for r in L.op1_language_id(spark, SF01).collect():
        lang, score, ambiguous, _ = model.predict(texts[r.doc_id])
        assert (r.lang_pred, r.ambiguous) == (lang, ambiguous) and r.score == pytest.approx(score, abs=1e-6)
    quality = Q.train(docs, labels)
    for r in Q.op4_quality_classifier(spark, SF01).collect():
        score, _ = quality.score(Q.passages_of(*Q.encoded(texts[r.doc_id].encode())))
        assert r.score == pytest.approx(score, abs=1e-6) and r.predicted == (r.score >= 0.3)
    import brute

    domains = M.train(docs, M.label_domains(labels))
    rows = {r.doc_id: r for r in M.op6_mixing(spark, SF01).collect()}
    read = {i: M._read(t.encode()) for i, t in texts.items()}
    n, p = np.array([x[2] for x in read.values()]), np.stack([domains.posteriors(x[0], x[1]).astype(float) for x in read.values()])
    full, weight = (p * n[:, None]).sum(0), np.array([M.TARGETS[d] for d in domains.domains])
    rate = brute.rates(n, p, weight * (full / weight).min(), None, M.ROUNDS)
    for i, k, r in zip(read, range(len(n)), rate, strict=True):
        assert rows[i].n_tokens == n[k] and rows[i].rate == pytest.approx(r, abs=1e-5)
        assert [rows[i][f"p_{d}"] for d in domains.domains] == pytest.approx(list(p[k]), abs=1e-6)


def test_language_edges(spark):
    model = L.train(spark.read.parquet(f"{SF01}/documents.parquet"), bound=300)
    docs = edge_docs(spark).withColumn("score", F.lit("mine")).withColumn("row", F.lit(1))
    rows = L.identify(docs, model).collect()
    assert len(rows) == 7
    by = {r.row.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert by[5].lang_pred == "de" and by[6].lang_pred in model.languages
    assert all(r.row.score == "mine" for r in rows)
    kept = L.language_stage(spark, docs, SF01)
    assert kept.columns == docs.columns
    empty = L.train(docs.limit(0))
    assert empty.languages == [] and empty.predict("the")[:3] == ("und", 0.0, True)
    assert L.identify(docs.limit(0), empty).count() == 0


def test_language_long_text_in_chunks(monkeypatch):
    """Cuts change nothing, wherever they fall."""
    text = "the quick brown fox, and 12 lazy dogs; \n éàü x " * 50
    whole = L.ngram_counts(text)
    for size in (1, 2, 3, 7, 100, 1000):
        monkeypatch.setattr(L, "CHUNK", size)
        assert np.array_equal(whole, L.ngram_counts(text))
    assert L.ngram_counts("12 " * 500 + "a").sum() == 2  # `a`, and it with the space before


def test_language_stage_rejects_far_texts_and_fills_lang(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(-1, "Привет мир, это текст на русском языке", None, "x", 38), (-2, "the and that with from this which have", None, "x", 38), (-3, "123 456", None, "x", 7)], docs.schema)
    kept = {r.doc_id: r.lang for r in L.language_stage(spark, docs.union(odd), SF01).select("doc_id", "lang").collect()}
    assert -1 not in kept and -3 not in kept and kept[-2] == "en"
    assert len(kept) >= 0.995 * docs.count()


def test_quality_held_out(spark):
    rows = Q.op4_quality_classifier(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").toPandas()
    held = rows[rows.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()


def test_quality_gradients():
    """The hand-written gradients lower the loss on bags where one passage decides."""
    rng = np.random.default_rng(0)
    bags, labels = [], []
    for i in range(200):
        b = rng.normal(size=(rng.integers(1, 6), Q.INPUT)).astype(np.float32)
        if i % 2:
            b[0, 3] += 6
        bags.append(b)
        labels.append(i % 2)
    m = Q.fit(bags, labels)
    assert np.mean([(m.score(b)[0] > 0.5) == bool(y) for b, y in zip(bags, labels)]) > 0.95


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, 1, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    docs = edge_docs(spark).withColumn("score", F.lit(3))
    rows = Q.classify(docs, Q.train(docs, labels)).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    none = Q.classify(docs, Q.train(docs, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.classify(docs.limit(0), Q.train(docs, labels)).count() == 0


def test_quality_words_of_a_passage():
    surface, buckets = Q.encoded(b"word another " * 500)
    x = Q.passages_of(surface, buckets)
    assert x.shape == (1000 // 64 + 1, Q.INPUT) and np.allclose((x[:, WIDTH:] ** 2).sum(1), 1)
    assert Q.passages_of(*Q.encoded(None)).shape == (1, Q.INPUT)


def test_quality_learns_from_words(spark):
    """Two kinds of texts that differ in their words only."""
    rng = np.random.default_rng(4)
    words = [["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)] for _ in range(2)]
    rows = [(i, " ".join(rng.choice(words[i % 2], 90)), i % 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    found = Q.classify(docs, Q.train(docs, docs.select("doc_id", "quality"))).join(docs, "doc_id").where("held_out").toPandas()
    assert ((found.score > 0.5) == (found.quality == 1)).mean() > 0.95


def test_passages():
    assert passage_features(None).shape == (1, WIDTH) and not passage_features(b" \n").any()
    x = passage_features(b"word another " * 500)
    assert x.shape[0] == 1000 // 64 + (1 if 1000 % 64 >= 32 else 0) and np.isfinite(x).all()


def test_mixing_meets_targets(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = M.label_domains(spark.read.parquet(f"{SF01}/labels.parquet"))
    rows, domains, reached = M.mix(docs, labels, M.TARGETS)
    pdf = rows.toPandas()
    assert len(pdf) == docs.count() and (pdf.rate >= 0).all()
    p = np.stack(pdf.p.to_numpy())
    totals = (p * (pdf.n_tokens * pdf.rate).to_numpy()[:, None]).sum(0)
    share = dict(zip(domains, totals / totals.sum()))
    assert share == pytest.approx(M.TARGETS, rel=0.06)
    assert np.allclose(totals, reached["reached"], rtol=0.02)
    assert (abs(pdf.copies - pdf.rate) < 1).all() and reached["error"] <= M.TOLERANCE
    told = M.op6_mixing(spark, SF01).select("fit_error").distinct().collect()
    assert [r.fit_error for r in told] == [pytest.approx(reached["error"])]


@pytest.mark.parametrize("most", [None, 1.0])
def test_mixing_equals_plain_projected_gradient(spark, most):
    """The same steps over plain arrays, document by document, give the same rates and totals."""
    rng = np.random.default_rng(1)
    n, p = rng.integers(1, 500, 60), rng.dirichlet([0.3, 0.3, 0.3], 60)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n_tokens long, p array<double>")
    rate, told = M.fit_rates(df, ["a", "b", "c"], {"a": 0.8, "b": 0.15, "c": 0.05}, most=most)
    got = np.array([r[0] for r in df.select(rate).collect()])
    full, w = (p * n[:, None]).sum(0), np.array([0.8, 0.15, 0.05])
    goal = w * (full / w).min()
    eta = 1 / np.linalg.eigvalsh((p * n[:, None]).T @ p / np.sqrt(np.outer(full, full)))[-1]
    totals = lambda r: (p * (n * r)[:, None]).sum(0)
    off = lambda r: ((totals(r) - goal) ** 2 / full).sum()
    r = before = np.ones(60)
    pace = 1.0
    for _ in range(told["rounds"]):
        nxt = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        y = r + (pace - 1) / nxt * (r - before)
        before, r, pace = r, np.clip(y - eta * p @ ((totals(y) - goal) / full), 0, most), nxt
        if off(r) > off(before):
            pace = 1.0
    assert np.allclose(r, got, atol=1e-6) and np.allclose(totals(got), told["reached"]) and told["rounds"] > 0
    assert (got >= 0).all() and (got == 0).any()
    if most is None:
        assert told["error"] <= 0.01 and np.allclose(totals(got), goal, rtol=0.011)
    else:  # out of reach at rates of 1 at most: the error says so
        assert got.max() <= 1 and told["error"] == pytest.approx(np.abs((totals(got) - goal) / goal).max())


def test_mixing_stage_keeps_clean_documents_where_toxic_ones_are_scarce(spark):
    """About 1 % toxic tokens, below their target: no clean document goes for that, and poor ones are still cut."""
    size = F.size(F.split("text", r"\s+"))
    both = spark.read.parquet(f"{SF01}/documents.parquet").join(M.label_domains(spark.read.parquet(f"{SF01}/labels.parquet")), "doc_id").withColumn("size", size)
    total = {r.domain: r["sum(size)"] for r in both.groupBy("domain").sum("size").collect()}
    left, few = 0.01 * (total["good"] + total["poor"]), []
    for r in both.where("domain = 'toxic'").orderBy("size").collect():
        if r.size <= left:
            left -= r.size
            few.append(r.doc_id)
    docs = both.where((F.col("domain") != "toxic") | F.col("doc_id").isin(few)).drop("size")
    kept = M.mixing_stage(spark, docs, SF01)
    before, after = ({r.domain: r["count"] for r in d.groupBy("domain").count().collect()} for d in (docs, kept))
    assert few and after["good"] >= 0.99 * before["good"]
    assert after["poor"] < 0.8 * before["poor"]


def test_rates_with_a_whole_domain(spark):
    """The whole domain keeps its tokens; plentiful domains are cut to their shares of it, scarce ones are not."""
    df = spark.createDataFrame([(900, [1.0, 0.0, 0.0]), (100, [0.0, 1.0, 0.0]), (1, [0.0, 0.0, 1.0])], "n_tokens long, p array<double>")
    targets = {"good": 0.9, "poor": 0.05, "toxic": 0.05}
    rate, told = M.fit_rates(df, ["good", "poor", "toxic"], targets, whole="good")
    assert [r[0] for r in df.select(rate).collect()] == pytest.approx([1, 0.5, 1], rel=0.02)
    assert told["targets"] == pytest.approx([900, 50, 1])
    assert M.fit_rates(df, ["good", "poor", "toxic"], {"poor": 0.5, "toxic": 0.5}, whole="good")[1]["targets"] == pytest.approx([0, 1, 1])


def test_mixing_with_targets_out_of_reach(spark):
    df = spark.createDataFrame([(10, [0.5, 0.5]), (20, [0.5, 0.5])], "n_tokens long, p array<double>")
    rate, told = M.fit_rates(df, ["a", "b"], {"a": 0.9, "b": 0.1})
    assert all(r[0] >= 0 for r in df.select(rate).collect()) and told["error"] > 0.01
    assert M.fit_rates(df, ["a", "b"], {})[1]["rounds"] == 0


def test_mixing_edges(spark):
    labels = spark.createDataFrame([(1, "good"), (5, "poor"), (6, "good"), (None, "good"), (2, None)], "doc_id long, domain string")
    docs = edge_docs(spark).withColumn("rate", F.lit("x")).withColumn("p", F.lit(0))
    assert M.mix(docs, labels, M.TARGETS)[0].count() == 7
    plain, domains, _ = M.mix(docs, labels.limit(0), M.TARGETS)
    assert domains == [] and {r.copies for r in plain.collect()} == {1}
    assert M.mix(docs.limit(0), labels, M.TARGETS)[0].count() == 0
    staged = M.mixing_stage(spark, docs, SF01)
    assert staged.columns == docs.columns and staged.count() <= 7
