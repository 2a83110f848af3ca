"""Language, LM and quality models: held-out accuracy, exact counts and odd texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

from crashlake.llm import op3_langid, op4_lm_score, op10_quality
from crashlake.llm.common import held_out
from crashlake.llm.queries import QUERIES
from tests.llm.helpers import documents, frame, sentence, word_list

SF = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    got = spark.range(500).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
    assert spark.sql("select cast(null as bigint) id").select(held_out(F.col("id"))).first()[0]


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 40])
def test_codewords_are_apart(n):
    code = op3_langid.codewords(n)
    apart = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
    assert len(code) == n and min(apart) >= (1 if n < 3 else max(2, code.shape[1] // 4))
    assert all(len(set(bit)) == 2 for bit in code.T.tolist())


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op3_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_texts(spark):
    docs = frame(spark, documents())
    model = op3_langid.train(docs)
    assert model.langs == ["de", "en", "es", "fr"]
    rows = docs.select("doc_id", "text", "lang", op3_langid.language(F.col("text"), model, spark).alias("x")).collect()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.x.lang, r.x.score, r.x.ambiguous) == ("und", 0.0, True)
        else:
            assert r.x.lang in model.langs
    long = [r for r in rows if len(word_list(r.text)) > 20 and r.lang]
    assert sum(r.lang == r.x.lang for r in long) >= 0.97 * len(long)
    none = op3_langid.train(docs.limit(0))
    assert {r.x.lang for r in docs.select(op3_langid.language(F.col("text"), none, spark).alias("x")).collect()} == {"und"}
    one = op3_langid.train(docs.where("lang = 'fr'"))
    assert one.predict(["le mot"])[0] == ["fr"]


def test_language_counts_do_not_depend_on_slices():
    texts = [r[1] or "" for r in documents()]
    whole, sizes = op3_langid.grams(texts)
    parts = [op3_langid.grams([t]) for t in texts]
    assert sizes.tolist() == [int(s[0]) for _, s in parts]
    assert whole.tolist() == [x for h, _ in parts for x in h.tolist()]


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op10_quality_classifier"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_votes_are_exact_cosines():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 5, (60, op10_quality.FEATURES))
    labels = np.arange(60) % 2
    model = op10_quality.Neighbours(rows, labels, {0: 0.5, 1: 0.5})
    ask = rng.integers(0, 5, (7, op10_quality.FEATURES))
    got = model.score(ask)
    latent = model.weigh(ask) @ model.project
    latent /= np.linalg.norm(latent, axis=1, keepdims=True)
    for v, s in zip(latent, got):
        cos = v @ model.vectors
        best = np.argsort(-cos)[:op10_quality.NEIGHBOURS]
        vote = np.maximum(cos[best], 0) ** op10_quality.POWER
        assert s == pytest.approx((vote * labels[best]).sum() / vote.sum(), abs=1e-4)


def test_quality_ties_and_cuts_change_nothing():
    rng = np.random.default_rng(2)
    some = rng.integers(0, 4, (10, op10_quality.FEATURES))
    rows = np.concatenate([some, some, some])  # each vector three times: equal similarities throughout
    labels = np.array([1] * 10 + [0] * 20)
    model = op10_quality.Neighbours(rows, labels, {0: 0.5, 1: 0.5})
    ask = np.concatenate([some, rng.integers(0, 4, (600, op10_quality.FEATURES))])
    whole = model.quality(ask)
    for cut in (1, 7, 513):
        assert np.array_equal(whole, np.concatenate([model.quality(ask[i:i + cut]) for i in range(0, len(ask), cut)]))
    # in plain whole numbers: the smaller index votes among equals
    latent, held = model._latent(model.weigh(ask[:20]))
    vectors = model.vectors.T
    for v, h, q in zip(latent, held, whole):
        whole_products = [sum(int(a) * int(b) for a, b in zip(v * op10_quality.FINE, w * op10_quality.FINE)) for w in vectors]
        best = sorted(range(30), key=lambda i: (-whole_products[i], i))[:op10_quality.NEIGHBOURS]
        vote = [max(0, whole_products[i] / op10_quality.FINE**2) ** op10_quality.POWER * model.weight[i] for i in best]
        assert q == pytest.approx(sum(x * labels[i] for x, i in zip(vote, best)) / sum(vote) * h / (h + op10_quality.UNHELD), abs=1e-12)


def test_quality_fit_and_counts_by_hand():
    text = "The cat. The CAT\nsat\u2588 5 \u0436\u0301"
    row = op10_quality.counts(pa.array([text, None, ""], pa.large_string()))
    assert row.shape == (3, op10_quality.FEATURES) and row[1].sum() == row[2].sum() == 0
    words = word_list(text.translate({c: c + 32 for c in range(65, 91)}))
    want = np.bincount([xxhash.xxh32_intdigest(w) % op10_quality.WORDS for w in words], minlength=op10_quality.WORDS)
    assert row[0, op10_quality.FORMS:].tolist() == want.tolist() and row[0, op10_quality.FORMS - 3] == len(words)
    kind = op10_quality._kinds()
    assert [kind[ord(c)] for c in "a\u0436\u4e2d\u0301Z\u04167 \u3000\n"] == [1, 1, 1, 1, 2, 2, 3, 4, 4, 5] and kind[0x2588] != kind[0xFFFD] != 1
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 3, (40, op10_quality.FEATURES))
    model = op10_quality.Neighbours(rows, np.arange(40) % 2, {0: 0.2, 1: 0.8})
    weighted = model.weigh(rows)
    assert np.allclose(np.linalg.norm(weighted, axis=1), 1, atol=1e-3)
    directions = np.linalg.svd(weighted)[2][:op10_quality.DIRECTIONS]  # 40 rows: as many directions carry weight
    assert np.allclose(np.abs(np.sum(directions[:39] * model.project.T[:39], axis=1)), 1, atol=1e-2)
    assert model.weight[0] == pytest.approx(0.25) and model.weight[1] == 1


def test_quality_sees_words_and_all_scripts(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = op10_quality.train(docs, labels.where(~held_out(F.col("doc_id"))))
    good = [r.text for r in docs.join(labels.where("quality = 1"), "doc_id").where(held_out(F.col("doc_id"))).limit(60).collect()]
    rng = random.Random(7)
    garbled = ["".join(chr(rng.randrange(97, 123)) if c.islower() else c for c in t) for t in good]
    blocks = ["".join(c if c.isspace() else "\u2588" for c in t) for t in good]
    score = lambda texts: model.quality(op10_quality.counts(pa.array(texts, pa.large_string())))
    assert score(good).min() > 0.5 and score(garbled).mean() < score(good).mean()
    assert np.quantile(score(blocks), 0.9) < 0.3


def test_quality_odd_texts_and_no_labels(spark):
    docs = frame(spark, documents())
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (61, None), (62, 7)], "doc_id bigint, quality int")
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        model = op10_quality.train(docs, known)
        got = docs.select("text", op10_quality.quality(F.col("text"), model, spark).alias("s")).collect()
        assert len(got) == docs.count() and all(0 <= r.s <= 1 for r in got)
        assert all(r.s == 0 for r in got if not r.text)
    assert len(op10_quality.train(docs, labels).labels) <= 61


def plain_scores(rows, spark):
    """Scores by (text, part) rows, from dictionaries of words and pairs."""
    key = {t: k for t, k in spark.createDataFrame([(t,) for t, _ in rows], "t string").select("t", F.xxhash64("t")).collect()}
    lower = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in word_list(t)]
    single, pair = {}, {}
    for t, part in rows:
        w = lower(t)
        for m in (1, 2):
            if part & m:
                table = (m, key[t] & 1)
                one, two = single.setdefault(table, {}), pair.setdefault(table, {})
                for a, b in zip([None, *w], w):
                    one[b], two[a, b] = one.get(b, 0) + 1, two.get((a, b), 0) + 1
    out = {}
    for t, _ in rows:
        w, h, loss = lower(t), 1 - (key[t] & 1), []
        for m in (2, 1):
            one, two = single.get((m, h), {}), pair.get((m, h), {})
            total, target, used = sum(one.values()), sum(single.get((2, h), {}).values()), max(1, len(single.get((1, h), {}))) + 1
            scale = (target or total) / total if total else 0
            starts = sum(n for (a, _), n in two.items() if a is None)
            loss.append([-np.log((scale * two.get((a, b), 0) + op4_lm_score.PRIOR * (scale * one.get(b, 0) + 1) / (scale * total + used))
                                 / (scale * (starts if a is None else one.get(a, 0)) + op4_lm_score.PRIOR)) for a, b in zip([None, *w], w)])
        out[t] = (len(w), *(np.mean(x) if w else None for x in loss))
    return out


@pytest.mark.parametrize("slice_bytes, bucket_bytes", [(4 << 20, 12 << 20), (20_000, 30_000)])
def test_lm_scores_rest_on_real_words_and_pairs(spark, monkeypatch, slice_bytes, bucket_bytes):
    rows = documents()
    rng = random.Random(5)  # more pairs than a fixed number of classes could keep apart
    rows += [(5000 + i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(3000)), "en", "s1", 0, "", "", "", "", "") for i in range(60)]
    parts = [(r[1], 3 if r[3] == "s1" else 1) for r in rows]
    monkeypatch.setattr(op4_lm_score, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(op4_lm_score, "BUCKET_BYTES", bucket_bytes)
    cloudpickle.register_pickle_by_value(op4_lm_score)
    try:
        rows = [(i, *r[1:]) for i, r in enumerate(rows)]
        docs = frame(spark, rows).repartition(5)
        got = op4_lm_score.score(docs, docs.where("source = 's1'").select("doc_id"))
    finally:
        cloudpickle.unregister_pickle_by_value(op4_lm_score)
    want = plain_scores(parts, spark)
    plain = sorted((str(r[0]), want[r[1]][0], *(None if x is None else round(float(x), 4) for x in want[r[1]][1:])) for r in rows)
    found = sorted((str(r.doc_id), r.n_words, *(None if x is None else x for x in (r.target_loss, r.background_loss))) for r in got.collect())
    assert len(plain) == len(found)
    for p, f in zip(plain, found):
        assert p[:2] == f[:2] and all((x is None) == (y is None) and (x is None or abs(x - y) < 2e-4) for x, y in zip(p[2:], f[2:]))


def test_lm_scores_of_no_rows(spark):
    docs = frame(spark, documents())
    assert op4_lm_score.score(docs.limit(0), docs).count() == 0
    nothing = op4_lm_score.score(docs.where("text is null or text = ''"), docs).collect()
    assert len(nothing) > 1 and all(r.n_words == 0 and r.score is None for r in nothing)
    untaught = op4_lm_score.score(docs, docs.limit(0))
    assert untaught.count() == len(documents()) and untaught.where("n_words > 0 and target_loss is null").count() == 0


def test_lm_target_is_the_documents_labelled_good(spark, scratch):
    rng = random.Random(6)
    rows = [(i, sentence(rng, 80, "en" if i % 2 else "fr"), None, None, 0, "", "", "", "", "") for i in range(200)]
    frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    frame(spark, rows[::2]).select("doc_id", "text").write.parquet(f"{scratch}/benchmark.parquet")  # French: not the target
    labels = [(i, i % 2, 0) for i in range(100)] + [(i, 1, 1) for i in range(100, 140, 2)] + [(1, 1, 0), (None, 1, 0), (999, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    got = {r.doc_id: r for r in QUERIES["op4_lm_scoring"](spark, scratch).collect()}
    want = plain_scores([(r[1], 3 if r[0] < 100 and r[0] % 2 else 1) for r in rows], spark)
    assert len(got) == 200 and all(got[r[0]].score == pytest.approx(want[r[1]][1] - want[r[1]][2], abs=1e-5) for r in rows)
    assert np.mean([r.score for i, r in got.items() if i % 2]) < np.mean([r.score for i, r in got.items() if not i % 2]) - 0.2
