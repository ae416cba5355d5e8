"""Toxicity: the model against plain Python, its slope against differences, and labels held out."""

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from gridloom.llm import toxicity
from gridloom.llm.queries import REGISTRY

RNG = np.random.default_rng(5)


def bags(docs=40, features=7):
    y, n, doc, sentence, feature = [], [], [], [], []
    for d in range(docs):
        y.append(int(RNG.random() < 0.4))
        n.append(int(RNG.integers(0, 6)))
        for s in range(n[-1]):
            for f in sorted(set(RNG.integers(0, features, RNG.integers(0, 3)).tolist())):
                doc.append(d), sentence.append(s), feature.append(f)
    return tuple(np.array(x, np.int64) for x in (y, n, doc, sentence, feature))


def model(features=7):
    return toxicity.Model(np.arange(features, dtype=np.uint64), RNG.normal(0, 1, features), -1.5, -2.0)


def noisy_or(m, n, doc, sentence, feature):
    """The chance that each document is toxic, sentence by sentence."""
    s = lambda z: 1 / (1 + math.exp(-z))
    out = []
    for d, size in enumerate(n):
        clean = 1 - s(m.leak)
        for k in range(size):
            clean *= 1 - s(m.bias + sum(m.weights[f] for a, b, f in zip(doc, sentence, feature) if (a, b) == (d, k)))
        out.append(1 - clean)
    return np.array(out)


def test_scores_are_noisy_or_and_the_slope_is_that_of_the_likelihood():
    y, *hits = bags()
    m = model()
    assert np.allclose(-np.expm1(toxicity.scores(m, *hits)[2]), noisy_or(m, *hits))
    told = toxicity.gradient(m, y, *hits) / toxicity._UNIT
    like = lambda m: np.where(y, np.log(noisy_or(m, *hits)), np.log1p(-noisy_or(m, *hits))).sum()
    assert math.isclose(told[-1], like(m), abs_tol=1e-4)
    for k in range(len(m.weights) + 2):
        def moved(by, k=k):
            w = m.weights.copy()
            if k < len(w):
                w[k] += by
            return toxicity.Model(m.hashes, w, m.bias + by * (k == len(w)), m.leak + by * (k == len(w) + 1))
        assert math.isclose(told[k], (like(moved(1e-5)) - like(moved(-1e-5))) / 2e-5, rel_tol=1e-3, abs_tol=1e-3)


def plain(m, text):
    """Score and sentences of a text by regular expressions, one word at a time."""
    raw = (text or "").encode()
    weight = dict(zip(m.hashes.tolist(), m.weights))
    found = []
    for part in re.finditer(rb"[^.!?\n]+", raw):
        words = list(re.finditer(rb"[A-Za-z\x80-\xff]+", part[0]))
        if not words:
            continue
        have = set()
        for w in words:
            folded = np.frombuffer(re.sub(rb"[A-Z]", lambda x: x[0].lower(), w[0]), np.uint8)
            for h, _ in toxicity.features(folded, np.array([0]), np.array([len(folded)])):
                have |= set(h.tolist()) & weight.keys()
        a, b = (len(raw[: part.start() + x].decode()) for x in (words[0].start(), words[-1].end()))
        found.append((a, b, 1 / (1 + math.exp(-(m.bias + sum(weight[h] for h in have))))))
    clean = 1 - 1 / (1 + math.exp(-m.leak))
    for *_, s in found:
        clean *= 1 - s
    return 1 - clean, found


TOXIC, REST = ["dreck", "idiotisch", "schön blöd"], ["haus", "baum", "Österreich", "wasser", "日本", "die"]


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        toxic = rng.random() < 0.3
        sents = [" ".join(rng.choice(REST) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 5))]
        if toxic:
            sents.insert(rng.randint(0, len(sents)), f"{rng.choice(REST)} {rng.choice(TOXIC)} {rng.choice(REST)}")
        out.append((i, ". ".join(sents) + rng.choice(["!", "\n", ""]), int(toxic)))
    return out


def test_rows_of_all_kinds(spark):
    rows = texts(400, 1)
    odd = [(None, "dreck", 0), (None, None, 0), (500, None, 0), (500, "", 0), (500, "...", 0), (501, "Baum. " * 5000 + "DRECK haus. baum", 0), (1, rows[1][1], 0)]
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows] + [(None, 1, "x"), (3, None, "x"), (500, 0, "x")], "doc_id long, toxic int, score string")
    df = spark.createDataFrame([(i, t, 1, 2) for i, t, _ in rows + odd], "doc_id long, text string, score int, toxic int")
    m = toxicity.trained(df, labels)
    got = toxicity.classify(df.repartition(3), labels).collect()
    assert sorted(map(str, got)) == sorted(map(str, toxicity.classify(df.repartition(7), labels).collect()))
    assert len(got) == len(rows) + len(odd)
    full = toxicity.score(df.repartition(3), m).collect()
    assert full[0].asDict().keys() >= {"doc_id", "text", "score", "score_", "offending", "toxic"}
    for r in full:
        want, sents = plain(m, r.text)
        assert math.isclose(r.score_, want, rel_tol=1e-6, abs_tol=1e-9) and r.n_sentences == len(sents)
        bad = [s for s in sents if s[2] >= 0.5]
        assert r.n_offending == len(bad) and [(x.start, x.end) for x in r.offending] == [s[:2] for s in bad]
        if sents:
            top = max(sents, key=lambda s: round(s[2], 12))
            assert math.isclose(r.worst_score, top[2], rel_tol=1e-6)
        else:
            assert r.worst_score is r.worst_start is None
    by = {r.id: r for r in got if r.id is not None and r.id < 500}
    held = [(by[i], y) for i, _, y in rows if by[i].held_out]
    assert len(held) > 40 and all(r.predicted == y for r, y in held)
    assert {r.predicted for r in got if r.id == 501} == {1} and {r.held_out for r in got if r.id is None} == {False}
    (long,) = [r for r in full if r.doc_id == 501]
    assert [long.text[x.start : x.end] for x in long.offending] == ["DRECK haus"]
    assert toxicity.classify(df.limit(0), labels).count() == 0
    assert {r.predicted for r in toxicity.classify(df, labels.limit(0)).collect()} == {0}
    assert {r.predicted for r in toxicity.classify(df, labels.where("toxic = 1")).collect()} == {1}


def test_labels_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = REGISTRY.queries["op11_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    n = {(r.toxic, r.predicted): r.n for r in found.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.01 * n[0, 0]
    assert found.count() == 10_000
