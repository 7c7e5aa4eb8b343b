"""The pipeline's stages against brute-force versions, each on its own input, and run() as a whole."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_exact import fingerprint, linked, personal

import corpus_pipeline
from foliant.llm.common import written


@pytest.fixture(scope="module")
def stages(spark):
    """(name, input rows, output rows) of each stage over sf0.001."""
    sf = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, sf), "test")
        out.append((name, docs.toPandas(), after.toPandas()))
        docs = after
    return out


def test_columns_and_order(spark, stages):
    names = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").columns
    assert [n for n, _, _ in stages] == ["language ID", "SimHash near-dedup", "PII", "mixing to target weights", "byte-level BPE"]
    assert all(list(after.columns) == names for _, _, after in stages[:-1])


def test_language_stage(stages):
    _, before, after = stages[0]
    letters = {r.doc_id for r in before.itertuples() if any(c.isalpha() for c in r.text or "")}
    assert set(after.doc_id) <= letters and len(after) >= 0.99 * len(letters) and after.lang.notna().all()


def test_dedup_stage(stages):
    _, before, after = stages[1]
    ids = linked({i: fingerprint(t) for i, t in sorted(zip(before.doc_id, before.text))})
    assert sorted(after.doc_id) == sorted(set(ids.values()))


def test_pii_stage(stages):
    _, before, after = stages[2]
    assert sorted(before.doc_id) == sorted(after.doc_id)
    old = dict(zip(before.doc_id, before.text))
    for r in after.itertuples():
        assert not personal(r.text)
        if not personal(old[r.doc_id]) and "<context>" not in r.text:
            assert r.text == old[r.doc_id]
        assert r.n_chars == len(r.text)


def test_mixing_stage(spark, stages):
    _, before, after = stages[3]
    assert set(after.doc_id) <= set(before.doc_id) and after.doc_id.is_unique
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").toPandas()
    both = before.merge(labels, on="doc_id")
    clean = both[(both.quality == 1) & (both.toxic == 0)].doc_id
    bad = both[(both.quality == 0) | (both.toxic == 1)].doc_id
    assert clean.isin(after.doc_id).mean() > 0.95
    assert bad.isin(after.doc_id).mean() < 0.9


def test_encoding_stage(stages):
    import tiktoken
    from foliant.llm import byte_bpe as B

    ranks, pattern = B._vocabulary()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    _, before, after = stages[4]
    text = dict(zip(before.doc_id, before.text))
    assert sorted(text) == sorted(after.doc_id)
    for r in after.itertuples():
        ids = np.array(enc.encode_ordinary(text[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run_against_brute_force(spark):
    """run() as a whole against plain versions of all stages, document by document; the classifiers are fitted by the
    library, as their fit isn't what is tested, and applied text by text."""
    import brute
    import tiktoken

    from foliant.llm import byte_bpe as B
    from foliant.llm import language_id as L
    from foliant.llm import mixing as M

    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [r.asDict() for r in table.collect()]
    model = L.train(table)
    kept = []
    for d in docs:
        lang, _, ambiguous, loss = model.predict(d["text"])
        if lang != "und" and not (ambiguous and loss > L.FAR):
            kept.append({**d, "lang": d["lang"] or lang})
    ids = linked({d["doc_id"]: fingerprint(d["text"]) for d in sorted(kept, key=lambda d: d["doc_id"])})
    kept = [d for d in kept if ids[d["doc_id"]] == d["doc_id"]]
    for d, spans in zip(kept, brute.pii([d["text"] for d in kept]), strict=True):
        d["text"] = brute.masked(d["text"], spans)
    labels = M.label_domains(spark.read.parquet(f"{sf}/labels.parquet"))
    now = spark.createDataFrame([(d["doc_id"], d["text"]) for d in kept], "doc_id long, text string")
    domains = M.train(now, labels)
    read = [M._read(d["text"].encode()) for d in kept]
    n, p = np.array([r[2] for r in read]), np.stack([domains.posteriors(r[0], r[1]).astype(float) for r in read])
    full, good = (p * n[:, None]).sum(0), domains.domains.index("good")
    weight = np.array([M.TARGETS[d] for d in domains.domains])
    rate = brute.rates(n, p, np.minimum(weight * full[good] / weight[good], full), 1.0, M.ROUNDS)
    draw = {r.doc_id: r.u for r in now.select("doc_id", M.uniform(F.col("doc_id")).alias("u")).collect()}
    kept = [d for d, r in zip(kept, rate, strict=True) if int(r) + (draw[d["doc_id"]] < r - int(r))]
    enc = tiktoken.Encoding("own", pat_str=B._vocabulary()[1], mergeable_ranks=B._vocabulary()[0], special_tokens={})
    want = {}
    for d in kept:
        own = np.array(enc.encode_ordinary(d["text"]), "<u4")
        want[d["doc_id"]] = (len(own), hashlib.sha256(own.tobytes()).hexdigest(), hashlib.sha256(d["text"].encode()).hexdigest())
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want and len(rows) == len(want) > 100


@pytest.mark.parametrize("place", range(5))
def test_stages_on_odd_documents(spark, place):
    """Nulls in any column, empty and very long texts, repeated rows, clashing extra columns, no n_chars, no rows."""
    name, stage = corpus_pipeline.STAGES[place]
    long = "der schnelle und einfach nicht die keit mail a@b.cd " * 20000
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "123 $$$ 456", None, None), (None, "the quick and the over", "en", "a"), (5, long, "de", "b"), (6, "the and of", None, "a"), (6, "the and of", None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in ("spans", "base", "row", "p", "rate", "n_tokens", "root", "fp", "score", "loss", "masked"):
        docs = docs.withColumn(c, F.lit("mine"))
    after = stage(spark, docs, "/root/testdata/sf0.001")
    got = after.collect()
    if place < 4:
        assert after.columns == docs.columns and all(r.row == "mine" for r in got)
        assert {r.doc_id for r in got} <= {1, 2, 3, None, 5, 6}
    else:
        assert len(got) == 7
    assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
    if name == "PII":
        assert next(r.text for r in got if r.doc_id == 5) == long.replace("a@b.cd", "<email>")


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").toPandas()
    assert sorted(rows.ids_sha256) == sorted(stages[-1][2].ids_sha256)
