import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hypeline.llm import langid, quality, tokens, toxicity

from .cases import DOCS, awkward, nothing, words

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def held(i, folds, fold):
    return i is None or zlib.crc32(str(i).encode()) % folds == fold


# -- language -------------------------------------------------------------------
def test_languages_of_held_out_documents(spark):
    docs = read(spark, "documents")
    rows = langid.identify(docs, langid.train(docs)).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in rows) and len(rows) == len(lang)
    out = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_ignores_lang_and_id_when_predicting(spark):
    docs = read(spark, "documents").limit(200)
    model = langid.train(docs)
    a = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    b = langid.identify(docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 1000), model).collect()
    assert {r.doc_id - 1000: r.lang_pred for r in b} == a


def test_language_counts_against_a_loop():
    text = "Ab á"
    low, want = text.lower(), []
    for n in (1, 2, 3):
        want += [low[i:i + n] for i in range(len(low) - n + 1)]
    got = langid.buckets(text)
    assert len(got) == len(want)
    assert {langid.buckets(g)[-1] for g in want} == set(got.tolist())


def test_language_awkward_rows(spark):
    model = langid.train(read(spark, "documents"))
    got = {(r.doc_id, r.lang_pred == "und") for r in langid.identify(awkward(spark), model).collect()}
    for i, text, *_ in DOCS:
        assert (i, not any(c.isalpha() for c in text or "")) in got
    assert langid.identify(nothing(spark), model).count() == 0
    unlearned = langid.train(nothing(spark))
    assert {r.lang_pred for r in langid.identify(awkward(spark), unlearned).collect()} == {"und"}


# -- quality --------------------------------------------------------------------
def test_quality_of_held_out_documents(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.predicted == int(r.score >= 0.3) and r.held_out == held(r.doc_id, 5, 0) for r in rows)
    out = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    good, bad = ([r.score for r in out if truth[r.doc_id] == c] for c in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_quality_statistics_against_plain_counts():
    text = "Aa b1 #$ x!\nAa b1 #$ x!\n\nzz"
    row = dict(zip(quality.NAMES, quality.statistics(pa.array([text, None]))[0]))
    assert row["log_words"] == pytest.approx(np.log1p(9))
    assert row["symbols"] == pytest.approx(np.log1p(4 / 9))
    assert row["upper"] == pytest.approx(np.sqrt(2 / 18))
    assert row["digits"] == pytest.approx(np.sqrt(2 / 18))
    assert row["dup_lines"] == pytest.approx(np.sqrt(1 / 3))
    assert not np.isnan(quality.statistics(pa.array([None, "", " "], pa.string()))).any()


def test_qda_against_dense_densities():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (300, 3)), rng.normal(1, 2, (500, 3))])
    y = np.repeat([0, 1], [300, 500])
    model = quality.fit_qda(x, y, 0.0, 0.0)
    log = []
    for c in (0, 1):
        own = x[y == c]
        cov = np.cov(own.T, bias=True)
        d = x - own.mean(axis=0)
        log.append(np.log(len(own) / len(y)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (d @ np.linalg.inv(cov) * d).sum(axis=1))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(log[0] - log[1])))
    assert quality.fit_qda(x, np.ones(800, int)) is None


def test_quality_awkward_rows(spark):
    model = quality.train(read(spark, "documents"), read(spark, "labels"))
    rows = quality.score(awkward(spark), model).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert quality.score(nothing(spark), model).count() == 0
    assert {r.score for r in quality.score(awkward(spark), None).collect()} == {1.0}


# -- toxicity -------------------------------------------------------------------
def test_toxicity_of_held_out_documents(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = [r for r in rows if r.held_out and r.doc_id in truth]
    clean = [r.toxic for r in out if not truth[r.doc_id]]
    assert np.mean(clean) < 0.03
    assert np.mean([r.toxic for r in out if truth[r.doc_id]]) > 0.6
    assert all(0 <= r.severity <= toxicity.GRADES for r in rows)
    kept = toxicity.keep_civil(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in rows if not r.toxic}


def test_severity_against_brute_force(spark):
    """Markers counted word by word, and the expected severity of every document in plain Python."""
    docs, labels = read(spark, "documents"), read(spark, "labels")
    model = toxicity.train(docs, labels)
    truth = {r.doc_id: int(r.toxic > 0) for r in labels.collect() if r.toxic is not None and not held(r.doc_id, 5, 0)}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}

    def plain(text):
        ws = {"".join(c.lower() if "A" <= c <= "Z" else c for c in w).encode() for w in words(text)}
        return {(0, w) for w in ws} | {(n, w[:n]) for n in toxicity.PREFIXES for w in ws}

    counts = {0: Counter(), 1: Counter()}
    for i, t in truth.items():
        if i in texts:
            counts[t].update(plain(texts[i]))
    total = Counter(t for i, t in truth.items() if i in texts)
    marks = [f for f, n in counts[1].items() if max(n - 2 * n ** 0.5, 0) / (total[1] + 1)
             > toxicity.MARKER_ODDS * (counts[0][f] + 0.5) / (total[0] + 1)]
    number = {(n, w): int(tokens.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) + (n << 8)
              for n, w in marks}
    assert set(number.values()) == set(model.keys.tolist()) and marks
    weight = dict(zip(model.keys.tolist(), model.weights.tolist()))
    for r in toxicity.score(docs, model).collect():
        eta = sum(weight[number[f]] for f in plain(texts[r.doc_id]) if f in number)
        severity = sum(1 / (1 + math.exp(t - eta)) for t in model.theta)
        assert r.severity == pytest.approx(severity) and r.toxic == int(severity - model.base >= toxicity.REJECT)


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 4, 600)
    rows, ids = [], []
    for i, g in enumerate(y):
        marks = rng.choice(10, 2 * g, replace=False) if g else []
        for f in [*marks, *(100 + rng.integers(0, 50, 5))]:
            rows.append(i)
            ids.append(f)
    weights, theta = toxicity.fit_ordinal(np.array(rows), np.array(ids), y, 150)
    assert (np.diff(theta) > 0).all()
    assert weights[:10].min() > 3 * weights[100:150].max()
    eta = np.bincount(rows, weights[np.array(ids)], minlength=600)
    means = [eta[y == g].mean() for g in range(4)]
    assert means == sorted(means)


def test_toxicity_awkward_rows(spark):
    model = toxicity.train(read(spark, "documents"), read(spark, "labels"))
    assert toxicity.score(awkward(spark), model).count() == len(DOCS)
    kept = toxicity.keep_civil(awkward(spark), model)
    assert kept.columns == awkward(spark).columns and kept.count() == len(DOCS)
    assert toxicity.score(nothing(spark), model).count() == 0
    one_class = read(spark, "labels").where("toxic = 0")
    assert {r.severity for r in toxicity.score(awkward(spark), toxicity.train(read(spark, "documents"), one_class)).collect()} == {0.0}


def test_a_repeated_id_is_one_sampled_row(spark):
    from hypeline.llm import labelled
    rows = [(1, f"copy {i}", "a") for i in range(300)] + [(2, "other text", "b"), (3, None, "c"), (None, "no id", "d"), (9, "unlabelled", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    chosen = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    got = [sorted(map(tuple, labelled.sampled_texts(d, chosen, "text", "doc_id").collect()))
           for d in (docs, docs.orderBy(F.desc("text")).repartition(7))]
    assert got[0] == got[1] and [(r[0], r[2]) for r in got[0]] == [(1, 1), (2, 0), (3, 0)]
    assert got[0][1:] == [(2, "other text", 0), (3, None, 0)]
