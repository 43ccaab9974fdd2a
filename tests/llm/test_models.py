"""Toxicity chain, quality scores and language fusion: held-out accuracy, and rows that must not break them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from edges import EDGES, SCHEMA
from tradeloom.llm import langid, quality, queries, toxicity
from tradeloom.llm.common import table

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    chain = toxicity.train(docs, labels.filter("doc_id % 4 != 0"), queries.CATEGORIES)
    rows = toxicity.score(docs, chain).join(labels.filter("doc_id % 4 = 0"), "doc_id").collect()
    hit = [r["p_toxic"] >= 0.5 for r in rows if r["toxic"] == 1]
    clean = [r["p_toxic"] >= 0.5 for r in rows if r["toxic"] == 0]
    # About 36 toxic documents to learn from, and some labelled ones hold no toxic word.
    assert np.mean(clean) < 0.02 and np.mean(hit) >= 0.3
    left = toxicity.reject(docs, chain, "toxic")
    assert left.columns == docs.columns and left.count() < docs.count()


def test_chain_uses_earlier_categories():
    rng = np.random.default_rng(0)
    first = rng.random(2000) < 0.4
    # The second category is the first one, told apart by one word; the words of the first are many.
    hits = [[int(rng.integers(1, 20))] if f else [int(rng.integers(20, 40))] for f in first]
    labels = np.stack([first, first], 1).astype(int)
    weights = toxicity.fit_chain(hits, labels, 40, rng.integers(0, 3, 2000))
    assert weights[1][40] > 1 and len(weights[1]) == 42
    p = toxicity.chained(hits, 40, weights)
    assert ((p[:, 1] > 0.5) == first).mean() > 0.99


def plain_logistic(x, y, l2):
    """Newton steps on the whole matrix; the constant is not penalised."""
    w, ridge = np.zeros(x.shape[1]), l2 * np.r_[np.ones(x.shape[1] - 1), 0]
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(ridge) + 1e-12 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (p - y) / len(y) + ridge * w)
    return w


@pytest.mark.parametrize("seed", [0, 1])
def test_chain_equals_plain_chain(seed):
    rng, l2 = np.random.default_rng(seed), 1e-2
    marks = rng.random((600, 12)) < 0.3
    first = rng.random(600) < 1 / (1 + np.exp(1 - 2.0 * marks[:, 0] - 1.5 * marks[:, 1]))
    second = rng.random(600) < 1 / (1 + np.exp(2 - 2.5 * first - 1.0 * marks[:, 2]))
    third = rng.random(600) < 1 / (1 + np.exp(2 - 1.5 * second - 1.5 * first))
    labels, folds = np.stack([first, second, third], 1).astype(float), rng.integers(0, 3, 600)
    labels[rng.random(labels.shape) < 0.1] = np.nan
    hits = [np.flatnonzero(m).tolist() for m in marks]
    got = toxicity.chained(hits, 12, toxicity.fit_chain(hits, labels, 12, folds, l2))

    one, x, seen, out = np.ones((600, 1)), marks.astype(float), np.zeros((600, 0)), np.zeros((600, 0))
    for c in range(3):
        y, known = labels[:, c], ~np.isnan(labels[:, c])
        w = plain_logistic(np.hstack([x, seen, one])[known], y[known], l2)
        out = np.hstack([out, (1 / (1 + np.exp(-np.hstack([x, out, one]) @ w)))[:, None]])
        unseen = np.zeros((600, 1))
        for fold in range(3):
            w = plain_logistic(np.hstack([x, seen, one])[known & (folds != fold)], y[known & (folds != fold)], l2)
            unseen[folds == fold, 0] = 1 / (1 + np.exp(-np.hstack([x, seen, one])[folds == fold] @ w))
        seen = np.hstack([seen, unseen])
    assert np.abs(got - out).max() < 0.01


def test_toxicity_held_out_at_a_larger_size(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    chain = toxicity.train(docs, labels.filter("doc_id % 4 != 0"), queries.CATEGORIES)
    rows = toxicity.score(docs.join(labels.filter("doc_id % 4 = 0"), "doc_id", "left_semi"), chain).join(labels, "doc_id").collect()
    hit = np.mean([r["p_toxic"] >= 0.5 for r in rows if r["toxic"] == 1])
    clean = np.mean([r["p_toxic"] >= 0.5 for r in rows if r["toxic"] == 0])
    assert clean < 0.01 and hit >= 0.6, (clean, hit)


def test_toxicity_edges(spark, make):
    docs = make(EDGES + [(100 + i, "good calm text" if i % 3 else "bad idiot text") for i in range(60)])
    labels = [(100 + i, 1, 0 if i % 3 else 1) for i in range(60)] + [(100, 1, 1), (None, 1, 1), (101, None, None), (9999, 0, 1)]
    chain = toxicity.train(docs, spark.createDataFrame(labels, LABELS), queries.CATEGORIES)
    got = {(r["doc_id"], r["p_toxic"] > 0.5) for r in toxicity.score(docs, chain).collect()}
    assert all(bad == (d is not None and d >= 100 and (d - 100) % 3 == 0) for d, bad in got)
    kept = toxicity.reject(docs, chain, "toxic")
    assert kept.count() == len(EDGES) + 40 and kept.columns == docs.columns
    nothing = toxicity.train(docs, spark.createDataFrame([], LABELS), queries.CATEGORIES)
    assert toxicity.score(docs, nothing).filter("p_toxic = 0.5").count() == docs.count()
    assert toxicity.score(spark.createDataFrame([], SCHEMA), chain).count() == 0


def test_nothing_learnt_rejects_nothing(spark, make, tmp_path):
    docs = make(EDGES + [(100 + i, "good calm text" if i % 3 else "bad idiot text") for i in range(60)])
    for k, labels in enumerate(([], [(9999, 0, 1), (9998, 1, 0)], [(100 + i, None, None) for i in range(60)], [(100 + i, 1, 1) for i in range(60)])):
        sf = f"{tmp_path}/{k}"
        spark.createDataFrame(labels, LABELS).write.parquet(f"{sf}/labels.parquet")
        docs.select("doc_id", "text").write.parquet(f"{sf}/documents.parquet")
        left = corpus_pipeline.reject_toxic(spark, docs, sf)
        assert left.count() == docs.count() and left.columns == docs.columns, labels[:1]
        assert queries.op3(spark, sf).filter("not toxic").count() == docs.count(), labels[:1]


def test_labels_missing_in_one_category(spark, make):
    docs = make(EDGES + [(100 + i, "good calm text" if i % 3 else "bad idiot text") for i in range(60)])
    labels = spark.createDataFrame([(100 + i, None, 0 if i % 3 else 1) for i in range(60)], LABELS)
    chain = toxicity.train(docs, labels, queries.CATEGORIES)
    assert chain.learnt == (False, True, False)
    assert toxicity.reject(docs, chain, "toxic").count() == len(EDGES) + 40


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = quality.quality(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([g >= 0.3 for g in good]) > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_never_learns_from_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r["doc_id"], round(r["score"], 9)) for r in quality.quality(docs, x).collect()) for x in (labels, turned))
    assert one == two


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = rng.integers(1, 5, 8).astype(float)
        good = np.floor(rng.random(8) * (n + 1)).clip(0, n)
        x = np.arange(8.0)
        _, values = quality.isotonic(x, n, good)
        # The fit at i is the largest over starts of the smallest over ends of the mean between.
        fit = [max(min(good[a:b].sum() / n[a:b].sum() for b in range(i + 1, 9)) for a in range(i + 1)) for i in range(8)]
        assert sorted(set(np.round(fit, 9))) == sorted(set(np.round(values, 9)))


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, (20, len(quality.COUNTS)))
    x = quality.features(counts)
    mean, scale, gamma = x.mean(0), x.std(0) + 1, 0.05
    freq, phase = rng.standard_normal((20000, quality.FEATURES)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, 20000)
    z = quality.fourier(counts, mean, scale, freq, phase)[:, :-1]
    s = np.clip((x - mean) / scale, -6, 6)
    want = np.exp(-gamma * ((s[:, None] - s[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_quality_edges(spark, make):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)] + [(None, 1, 0), (5, None, 0)], LABELS)
    got = quality.quality(make(EDGES), labels).collect()
    assert len(got) == len(EDGES) and all(0 <= r["score"] <= 1 for r in got)
    none = quality.quality(make(EDGES), spark.createDataFrame([], LABELS)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_language_held_out(spark):
    docs, pages = table(spark, SF, "documents"), table(spark, SF, "pages")
    blind = docs.withColumn("lang", F.when(F.col("doc_id") % 4 == 0, None).otherwise(F.col("lang")))
    got = langid.identify(blind, pages).filter("doc_id % 4 = 0").join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert np.mean([r["lang"] == r["truth"] for r in got]) > 0.97


PAGES = "page_id long, url string, html string"


def test_evidence_beyond_the_text(spark, make):
    rng = random.Random(1)
    english, german = (lambda w=w: " ".join(rng.choice(w) for _ in range(40)) for w in (["the", "house", "with", "and"], ["der", "haus", "mit", "und"]))
    docs = make([(i, (german if i % 2 else english)(), "a", "de" if i % 2 else "en") for i in range(80)])
    rows = [(i, "http://de.host.test/x", f"<html lang='de'><p>{german()}</p></html>") for i in range(30)]
    rows += [(100 + i, "http://en.host.test/x", f"<html lang='en'><p>{english()}</p></html>") for i in range(30)]
    rows += [(200, "http://de.host.test/y", "<p></p>"), (201, None, "<html lang=de></html>"), (202, "http://[bad", None), (203, None, None), (203, None, None)]
    got = {r["page_id"]: r for r in langid.identify(docs, spark.createDataFrame(rows, PAGES)).collect() if r["page_id"] is not None}
    assert got[200]["lang"] == "de" and got[201]["lang"] == "de" and got[200]["text_lang"] in ("de", "en")
    assert got[5]["lang"] == "de" and got[105]["lang"] == "en" and 0 < got[203]["confidence"] < 0.9
    assert got[202]["host"] is None


def plain_fusion(rows, names, strength=4.0):
    """Each row against all others, without sums that are made once."""
    n = len(names)
    whole = np.sum([r[-1] for r in rows], 0) + 1.0
    whole /= whole.sum()

    def share(at, level, parent):
        others = [r[-1] for i, r in enumerate(rows) if i != at and r[level] == rows[at][level]]
        return parent if rows[at][level] is None else (np.sum(others or [[0.0] * n], 0) + strength * parent) / (len(others) + strength)

    out = []
    for at, r in enumerate(rows):
        w = np.maximum(r[-1], 1e-12) * share(at, 2, share(at, 3, whole)) * share(at, 5, whole) / whole * share(at, 4, whole) / whole
        out.append((names[int(np.argmax(w))], w.max() / w.sum()))
    return out


ROWS = "doc_id long, page_id long, host string, domain string, suffix string, declared string, p array<double>"


def judged(spark, rows, names):
    got = langid.fuse(spark.createDataFrame(rows, ROWS), names).collect()
    return [(r["lang"], r["text_lang"], r["confidence"]) for r in sorted(got, key=lambda r: r["page_id"])]


@pytest.mark.parametrize("seed", [0, 1])
def test_fusion_equals_plain_fusion(spark, seed):
    rng, names = random.Random(seed), ("de", "en", "fr")
    rows = []
    for i in range(150):
        p = np.array([rng.random() ** 3 + 1e-6 for _ in names])
        pick = lambda *of: rng.choice([None, *of])
        # One host holds more than a third of the rows.
        rows.append((None, i, rng.choice(["a.x", "a.x", "b.x", "c.y", None]), pick("x", "y"), pick("de", "com", "fr"), pick("de", "en"), (p / p.sum()).tolist()))
    for (lang, _, sure), (want, want_sure) in zip(judged(spark, rows, names), plain_fusion(rows, names)):
        assert lang == want and sure == pytest.approx(want_sure, abs=1e-9)


def test_each_kind_of_evidence_helps(spark):
    """Texts that say little, and one other kind of evidence that is right nine times of ten."""
    rng, names = np.random.default_rng(3), ("de", "en", "fr")
    truth = rng.integers(0, 3, 600)
    # A text's own language is only a little likelier.
    p = rng.dirichlet(np.ones(3), 600) + 0.35 * np.eye(3)[truth]
    p /= p.sum(1, keepdims=True)
    said = np.where(rng.random(600) < 0.9, truth, rng.integers(0, 3, 600))
    right = {}
    for kind in ("none", "host", "domain", "suffix", "declared"):
        keys = {"none": (None,) * 4, "host": (1, 0, 0, 0), "domain": (2, 1, 0, 0), "suffix": (0, 0, 1, 0), "declared": (0, 0, 0, 1)}[kind]
        # Under `domain` each row has a host of its own, which its domain must speak for.
        word = lambda k, i: None if not k else f"{names[said[i]]}{i if k == 2 else ''}"
        rows = [(None, i, *[word(k, i) for k in keys], p[i].tolist()) for i in range(600)]
        got = judged(spark, rows, names)
        right[kind] = np.mean([lang == names[t] for (lang, _, _), t in zip(got, truth)])
        assert np.mean([text == names[t] for (_, text, _), t in zip(got, truth)]) == np.mean(p.argmax(1) == truth)
    assert all(right[k] > right["none"] + 0.05 for k in right if k != "none"), right


@pytest.mark.parametrize("url, want", [
    ("https://A.b.Example.org:80/en/x", ("a.b.example.org", "example.org", "org/en")), ("http://x/", ("x", "x", "x")), ("nonsense", (None,) * 3),
    ("http://[bad", (None,) * 3), (None, (None,) * 3), ("http://h.fr/english", ("h.fr", "h.fr", "fr")),
])
def test_address(url, want):
    assert langid.address(url) == want


def test_markup():
    assert langid.declared('<!doctype html><HTML class="x" LANG="pt-BR">') == "pt" and langid.declared("<p>") is langid.declared(None) is None
    assert langid.declared('<meta http-equiv="content-language" content="es">') == "es"
    assert langid.visible("a<script>b</script><!-- c -->&amp;<b>d</b>").split() == ["a", "&", "d"]


def test_language_edges(spark, make):
    empty = spark.createDataFrame([], PAGES)
    got = langid.identify(make(EDGES), empty).collect()
    assert len(got) == len(EDGES) and {r["lang"] for r in got} == {"en"}
    assert langid.identify(spark.createDataFrame([], SCHEMA), empty).count() == 0
    unlabelled = make([(1, "text here", "s", None)])
    assert langid.identify(unlabelled, empty).first()["lang"] is None
