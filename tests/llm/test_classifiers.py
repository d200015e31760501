"""Toxicity and quality: folding, matching, discriminant, held-out accuracy, edge rows."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import queries, quality, toxicity

SF = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_folding():
    assert toxicity.fold("Ѕtupid ІDІ0T, lo\u200bser! ＬＯＳＥＲ 1d10t ÉCOLE straße") == " stupid idiot loser loser idiot école straße "
    assert toxicity.fold(None) == "  " == toxicity.fold(" \n.,")


def test_lexicon_words_beginnings_and_exceptions():
    lexicon = toxicity.Lexicon({" idiot ": 3.0, " stup": 2.0}, exceptions=("idiot proof",))
    count = lambda t: round(math.expm1(lexicon.features(t)[0]), 6)
    assert count("An idiot!") == 3 and count("idiotic") == 0 and count("1d10t stupidity stupor") == 7
    assert count("This is idiot-proof.") == 0 and count("idiot proof idiot") == 3
    assert count("") == 0 and lexicon.score("idiot") > lexicon.score("idiot " + "word " * 2000) > lexicon.score("word")
    text = "idiot stupid " * 50
    naive = sum(3.0 if w == "idiot" else 2.0 for w in text.split())
    assert count(text) == naive


def brute_entries(rows, least=5, share=0.015):
    """Weights of whole words and beginnings by counting documents."""
    seen, n = {}, [0, 0]
    for text, y in rows:
        n[y] += 1
        found = set()
        for w in set(toxicity.fold(text).split()):
            found.add(f" {w} ")
            found |= {f" {w[:k]}" for k in (4, 5, 6, 7, 8) if len(w) >= k}
        for e in found:
            seen.setdefault(e, [0, 0])[y] += 1
    return {e: math.log((t + .5) / (n[1] - t + .5)) - math.log((f + .5) / (n[0] - f + .5)) for e, (f, t) in seen.items() if t >= max(least, share * n[1])}


def test_learned_weights_match_counts(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    lexicon = toxicity.learn(docs, labels)
    rows = [(r.text, r.toxic) for r in docs.join(labels, "doc_id").collect() if not held(r.doc_id)]
    want = brute_entries(rows)
    learned = {e: w for e, w in lexicon.weights.items() if w != toxicity.BASE_WEIGHT}
    assert learned and all(w == pytest.approx(want[e]) for e, w in learned.items())


def letters(i):
    return "".join(chr(97 + i // 26 ** k % 26) for k in (2, 1, 0))


def test_rare_toxic_words_are_learned_and_words_of_copies_are_not(spark):
    # 100 words, each in 1 % of the toxic texts and in no other; a rare word of one text with many copies
    rows = [(i, f"w{letters(i % 701)} plain words of text {letters(i)}x" + (f" q{letters(i // 2 % 100)}zz" if i % 2 else ""), i % 2)
            for i in range(8000)]
    rows += [(10_000 + i, "plain words of text with copyword", 1) for i in range(100)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert all(lexicon.features(f"q{letters(k)}zz")[0] > 0 for k in range(100))
    assert lexicon.features("copyword plain words of text")[0] == 0


def test_repeated_rows_reach_the_driver_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x, y, c = rng.standard_normal((50, 2)), rng.integers(0, 2, 50).astype(float), rng.integers(1, 9, 50)
    assert toxicity.fit_curve(x, y, c=c.astype(float)) == pytest.approx(toxicity.fit_curve(np.repeat(x, c, axis=0), np.repeat(y, c)))
    seen = []
    fit = toxicity.fit_curve
    monkeypatch.setattr(toxicity, "fit_curve", lambda x, y, **k: seen.append((len(x), k["c"].sum())) or fit(x, y, **k))
    docs, labels = odd_rows(spark)
    toxicity.learn(docs.union(docs.where("doc_id in (4, 6)").crossJoin(spark.range(500)).drop("id")), labels)
    (rows, weight), = seen
    assert rows <= 4 and weight >= 1000


@pytest.mark.parametrize("name,label,least,accuracy", [("op8_toxicity", "toxic", 0.5, 0.97), ("op9_quality", "quality", 0.3, 0.98)])
def test_held_out_accuracy(spark, name, label, least, accuracy):
    out = queries.QUERIES[name](spark, LARGE).collect()
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").count()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    assert len(out) == docs
    for r in out:
        assert r.held_out == held(r.doc_id) and 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= least)
    tested = [r for r in out if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in tested]) >= accuracy


def test_discriminant_matches_direct_densities(spark):
    rng = np.random.default_rng(1)
    d = len(quality.FEATURES)
    data = [(i, (rng.standard_normal(d) * (1 + i % 2) + (i % 2)).tolist(), i % 2) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, v array<double>, y int")
    model = quality.fit(df, "y", "v")
    x = np.array([v for _, v, _ in data])
    y = np.array([c for *_, c in data])
    covs = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum((y == c).mean() * covs[c] for c in (0, 1))
    log = []
    for c in (0, 1):
        cov = 0.7 * covs[c] + 0.3 * (0.5 * pooled + 0.5 * np.diag(np.diag(pooled))) + 0.01 * np.trace(pooled) / d * np.eye(d)
        delta = x - x[y == c].mean(axis=0)
        log.append(math.log((y == c).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (delta @ np.linalg.inv(cov) * delta).sum(axis=1))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(log[0] - log[1])), atol=1e-9)


def odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "word"), (4, "word"), (None, "no id at all"), (5, "idiot " * 60000),
            (6, "a normal sentence of some words, nothing more.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (6, 1, 0), (5, 0, 1), (7, None, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_odd_rows_score(spark):
    docs, labels = odd_rows(spark)
    model, _ = quality.train(docs, labels)
    out = quality.score_texts(docs, model).collect()
    assert len(out) == 8 and all(0 <= r.score <= 1 for r in out)
    lexicon = toxicity.learn(docs, labels)
    out = toxicity.score_texts(docs, lexicon).collect()
    assert len(out) == 8 and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id: r.score for r in out}[5] > {r.doc_id: r.score for r in out}[6]


def test_without_labels(spark):
    docs, labels = odd_rows(spark)
    none = labels.limit(0)
    assert {r.score for r in quality.score_texts(docs, quality.train(docs, none)[0]).collect()} == {0.5}
    only = labels.where("quality = 1")
    assert {r.score for r in quality.score_texts(docs, quality.train(docs, only)[0]).collect()} == {1.0}
    assert toxicity.learn(docs, none) == toxicity.base_lexicon()
    assert toxicity.learn(docs.limit(0), labels) == toxicity.base_lexicon()
    empty = quality.score_texts(docs.limit(0), quality.train(docs.limit(0), labels)[0])
    assert empty.count() == 0


def test_scores_do_not_depend_on_other_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model, _ = quality.train(docs, labels)
    a = {r.doc_id: r.score for r in quality.score_texts(docs, model).collect()}
    shuffled = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert a == {r.doc_id: r.score for r in quality.score_texts(shuffled, model).collect()}


@pytest.mark.parametrize("texts", [["same words"] * 39, [None] * 39, ["a b"] * 13 + ["c d e"] * 26, ["one", "two two"]])
def test_classes_whose_texts_are_all_alike(spark, texts):
    """Classes without any spread, of one row, and of one text: scores are numbers, and prior odds where nothing tells."""
    rows = [(k, t) for k, t in enumerate(i for i in range(1000) if not held(i))]
    rows = [(i, texts[k]) for k, i in rows if k < len(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ones = [texts.index(t) != 0 if len(set(texts)) > 1 else k % 3 == 0 for k, (_, t) in enumerate(rows)]
    labels = spark.createDataFrame([(i, int(y)) for (i, _), y in zip(rows, ones)], "doc_id long, quality int")
    model, _ = quality.train(docs, labels)
    out = {r.doc_id: r.score for r in quality.score_texts(docs, model).collect()}
    assert len(out) == len(rows) and all(0 <= x <= 1 for x in out.values())
    if len(set(texts)) == 1:
        assert all(x == pytest.approx(sum(ones) / len(ones), abs=1e-6) for x in out.values())
    else:
        assert all((out[i] >= 0.5) == y for (i, _), y in zip(rows, ones))


def test_no_significant_entry_is_left_out(spark):
    """More telling words than the lexicon once held."""
    n = 5_600

    def word(i):
        return "z" + "".join(chr(97 + i // 18 ** k % 18) for k in (3, 2, 1, 0)) + "k"
    rows = [(i, " ".join(word((i * 7 + j) % n) for j in range(40)) + f" text {i}", 1) for i in range(5000)]
    rows += [(10_000 + i, f"plain text {i} of words", 0) for i in range(5000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert all(lexicon.features(word(i))[0] > 0 for i in range(n))
