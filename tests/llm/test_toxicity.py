"""Toxicity: terms, votes, the label model and the classifier against plain computations."""

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from docflow.llm import queries as q
from docflow.llm import toxicity as tox
from docflow.llm.common import table
from docflow.llm.label_model import bits, fit_label_model, fitted, forest, pair_counts, rank_one
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, votes string, terms string, key string, label string"


def plain_terms(text):
    """``kind, term`` of every word, in Python's bytes."""
    found = []
    for word in re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode()):
        lower = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        found.append((0, lower))
        found += [(k, lower[:n]) for k, n in enumerate(tox.KINDS) if n and len(lower) > n]
    return found


TEXTS = ["You idiot, IDIOT idiots!", None, "", "  \n ", "Réeuxment réeuxou ñ", "12 34 !! ###", "a" * 50_000, "word " * 20_000]


def test_terms_are_those_of_the_words():
    texts = tox.Texts(pa.array(TEXTS))
    by_hash, found = {}, []
    for k, row, h in texts.terms():
        found += [(r, k, x) for r, x in zip(row.tolist(), h.tolist())]
    expected = [(r, k, t) for r, text in enumerate(TEXTS) for k, t in plain_terms(text)]
    assert len(found) == len(expected)
    for (r, k, x), (s, j, t) in zip(sorted(found, key=lambda f: f[:2]), sorted(expected, key=lambda f: f[:2])):
        assert (r, k) == (s, j)
        by_hash.setdefault((k, x), set()).add(t)
    assert all(len(v) == 1 for v in by_hash.values()) and len({x for _, x in by_hash}) == len(by_hash)
    assert texts.words.tolist() == [len(re.findall(rb"[A-Za-z\x80-\xff]+", (t or "").encode())) for t in TEXTS]


def test_hits_and_votes():
    probe = tox.Texts(pa.array(["idiot réeuxment"]))
    terms = {}
    for k, _, h in probe.terms():
        terms[k] = h
    lexicons = tox.Lexicons(np.sort(np.array([terms[0][0], terms[4][0]])), np.array([0, 5]), 12)
    if terms[0][0] > terms[4][0]:
        lexicons.lexicon = np.array([5, 0])
    texts = tox.Texts(pa.array(TEXTS))
    row, term, count = lexicons.hits(texts)
    which = [lexicons.lexicon[t] for t in term]
    assert sorted(zip(row.tolist(), which, count.tolist())) == [(0, 0, 2), (4, 5, 1)]
    votes = lexicons.votes(texts, row, term, count, texts.patterns())
    assert votes[1] == 0 and votes[2] == 0 and votes[3] == 0
    assert votes[0] & 1 and not votes[0] & 2 and votes[0] & 4
    assert [b for b in range(lexicons.voters) if votes[0] >> b & 1 and b < 36] == [0, 2]
    empty = tox.Lexicons(np.zeros(0, np.uint64), np.zeros(0, np.int64), 12)
    assert len(empty.hits(texts)[0]) == 0


def drawn_votes(seed, n, accuracies, copy=None):
    """Classes and votes of independent voters; voter ``copy[0]`` mostly repeats ``copy[1]``."""
    draw = np.random.default_rng(seed)
    y = (draw.random(n) < 0.3).astype(int)
    x = np.array([np.where(y == 1, draw.random(n) < a, draw.random(n) < b) for a, b in accuracies]).T.astype(int)
    if copy:
        same = draw.random(n) < 0.95
        x[same, copy[0]] = x[same, copy[1]]
    return y, (x << np.arange(x.shape[1])).sum(1)


ACCURACIES = [(0.9, 0.1), (0.8, 0.2), (0.7, 0.05), (0.6, 0.3), (0.9, 0.3), (0.5, 0.5)]


def test_label_model_finds_accuracies_and_correlations(spark):
    y, votes = drawn_votes(1, 40_000, ACCURACIES, copy=(1, 0))
    histogram = spark.createDataFrame([(int(v), int(n)) for v, n in zip(*np.unique(votes, return_counts=True))], "votes long, n long")
    anchors = np.array([pair_counts(votes[:400][y[:400] == c], np.ones((y[:400] == c).sum()), 6) for c in (0, 1)])
    for given in (anchors, np.zeros_like(anchors)):
        model = fit_label_model(histogram, given, 6, rounds=25)
        assert abs(model.share - 0.3) < 0.06
        assert model.parents[1] == 0 or model.parents[0] == 1
        p = model.posterior(votes)
        assert ((p >= 0.5) == y).mean() > 0.9
    # The chance of a vote, over both states of its parent.
    model = fit_label_model(histogram, anchors, 6, rounds=25)
    x = bits(votes, 6)
    for i in (2, 3, 4):
        given = np.where(model.parents[i] < 0, 0, x[:, model.parents[i]])
        for c in (0, 1):
            assert abs(model.tables[c][i][given][y == c].mean() - ACCURACIES[i][1 - c]) < 0.05


def test_posterior_by_enumeration():
    y, votes = drawn_votes(2, 3000, ACCURACIES, copy=(3, 2))
    model = fitted(np.array([pair_counts(votes[y == c], np.ones((y == c).sum()), 6) for c in (0, 1)]), ~np.eye(6, dtype=bool))
    assert (model.parents >= 0).sum() == 5
    total = 0
    for x in itertools.product((0, 1), repeat=6):
        joint = []
        for c, share in ((0, 1 - model.share), (1, model.share)):
            p = share
            for i, v in enumerate(x):
                chance = model.tables[c][i][x[model.parents[i]] if model.parents[i] >= 0 else 0]
                p *= chance if v else 1 - chance
            joint.append(p)
        total += sum(joint)
        mask = np.array([sum(v << i for i, v in enumerate(x))])
        assert model.posterior(mask)[0] == pytest.approx(joint[1] / sum(joint))
    assert total == pytest.approx(1)


def test_pairs_and_trees():
    y, votes = drawn_votes(3, 5000, ACCURACIES, copy=(5, 4))
    x = bits(votes, 6)
    counts = pair_counts(votes, np.ones(5000), 6)
    for i, j in itertools.product(range(6), repeat=2):
        assert counts[i, j] == (x[:, i] & x[:, j]).sum()
    assert counts[-1, -1] == 5000 and counts[-1, 2] == x[:, 2].sum()
    totals = np.array([pair_counts(votes[y == c], np.ones((y == c).sum()), 6) for c in (0, 1)])
    mean = np.diag(counts)[:-1] / 5000
    _, pairs = rank_one(counts[:-1, :-1] / 5000 - np.outer(mean, mean))
    assert pairs[4, 5] and pairs[5, 4] and not pairs[0, 1]
    parents = forest(totals, pairs)
    assert parents[5] == 4 and (parents < 0).sum() >= 3
    assert (forest(totals, np.zeros((6, 6), bool)) == -1).all()


def test_linear_classifier_against_its_definition():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(500, 3))
    target = 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.0] - 0.5)))
    w = tox.train_linear(x, target, np.ones(500))
    one = np.column_stack([x, np.ones(500)])
    p = 1 / (1 + np.exp(-one @ w))
    slope = one.T @ ((p - target) / 500) + np.array([tox.RIDGE] * 3 + [1e-9]) * w
    assert np.abs(slope).max() < 1e-6 and w[0] > 1 > 0 > w[1]


def test_toxicity_of_held_out_documents(spark):
    rows = q.op13_toxicity(spark, DATA).join(table(spark, DATA, "labels"), "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.toxic).mean() > 0.98
    assert (rows[rows.toxic == 1].score >= 0.5).mean() > 0.9 and (rows[rows.toxic == 0].score >= 0.5).mean() < 0.01
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.5) == (rows.predicted == 1)).all()


def made(spark, rows):
    return spark.createDataFrame([(i, t, "en", "v", "t", "k", "l") for i, t in rows], SCHEMA)


def test_odd_documents(spark):
    rows = [(i, f"some plain words of number {i} and more " * 3) for i in range(30)]
    rows += [(100 + i, f"you idiot of number {i} total idiot and fool" * 2) for i in range(12)]
    odd = list(enumerate(TEXTS, 1000)) + [(None, "idiot"), (100, rows[30][1]), (100, "another text under the same id")]
    labels = [(i, int(i >= 100)) for i, _ in rows] + [(1000, None), (0, 1), (None, 1), (5, 7), (100, 1)]
    labelled = spark.createDataFrame(labels, "doc_id long, label int")
    found = tox.score_toxicity(made(spark, rows + odd).repartition(3), labelled).collect()
    assert len(found) == len(rows + odd) and all(0 <= r.score <= 1 for r in found)
    scores = {}
    for r in found:
        scores.setdefault(r.doc_id, []).append(r.score)
    assert scores[1001] == scores[1002] and len(scores[100]) == 3 and len(set(scores[100])) == 2
    assert min(scores[105]) > 0.5 > max(scores[7]) and scores[1000][0] > max(scores[i][0] for i in range(30))


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    found = tox.score_toxicity(made(spark, [(1, "some words"), (2, None)]), none).collect()
    assert sorted(r.doc_id for r in found) == [1, 2] and all(0 <= r.score <= 1 for r in found)
    empty = spark.createDataFrame([], SCHEMA)
    assert tox.score_toxicity(empty, none).count() == 0
    assert tox.score_toxicity(empty, spark.createDataFrame([(1, 1)], "doc_id long, label int")).count() == 0


def test_training_documents_are_bounded_and_apart(spark):
    copies = [(i, "the very same text of more than five words in all of them") for i in range(50)]
    other = [(100 + i, f"text number {i} with words of its own as w{i} x{i} y{i}") for i in range(50)]
    same_id = [(100, f"yet another text {i} under one id, a{i} b{i} c{i}") for i in range(50)]
    labelled = spark.createDataFrame([(i, 1) for i in range(50)] + [(100 + i, 0) for i in range(50)], "doc_id long, label int")
    sample, stands_for = tox.training_documents(made(spark, copies + other + same_id), labelled, 20)
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts == {1: 1, 0: 20} and stands_for == [2.5, 50.0]


def test_held_out_fold(spark):
    rows = q.op13_toxicity(spark, "/root/testdata/sf0.001").select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(rows) == table(spark, "/root/testdata/sf0.001", "documents").where(F.lit(True)).count()
