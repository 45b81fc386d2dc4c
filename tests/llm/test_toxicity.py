import numpy as np
import pytest

from glossa.llm import queries, toxicity
from tests.conftest import SF_SMALL


def sample(n=160, seed=1):
    rng = np.random.default_rng(seed)
    words = [a + b for a in ("tha", "ren", "ilo", "mus", "ker") for b in ("", "nd", "st", "ly", "ou")]
    texts, marks = [], []
    for k in range(n):
        text = [words[i] for i in rng.integers(0, len(words), rng.integers(5, 300))]
        if k % 4 == 0:
            text[rng.integers(0, len(text))] = ("vile", "viled", "Vileness")[k // 4 % 3]
        texts.append(" ".join(text))
        marks.append(int(k % 4 == 0))
    return texts, marks


@pytest.fixture(scope="module")
def net():
    return toxicity.train(*sample(), rounds=4, steps=25)


def test_held_out_accuracy(net):
    texts, marks = sample(seed=2)
    assert ((net.score(texts) >= 0.5) == np.array(marks, bool)).mean() > 0.95


def test_every_window_counts(net):
    texts, _ = sample(8, seed=3)
    clean = " ".join(t for t in texts[1:4])
    long = clean + " " + " ".join([clean] * 800)
    assert len(toxicity.tokens(long)) > toxicity.CHUNK_TOKENS
    low, high = net.score([long, long + " vile " + clean])
    assert low < 0.5 <= high


def test_gradients_match_differences():
    net = toxicity.Network.new(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    feats = toxicity.features([b"", b"abc", b"toxic", b"xy"])
    ids = np.array([[1, 2], [3, 0], [2, 0]], np.int32)
    y, weight = np.array([1.0, 0.0]), np.ones(2)
    _, g = net.gradients(feats, net.embed(*feats), ids, y, weight)
    for name, at in (("Wf", (2, 5)), ("Ub", (1, 20)), ("Uf", (3, 3)), ("A", (4, 2)), ("v", (1,)), ("o", (9,)), ("cb", (17,))):
        ends = []
        for sign in (1, -1):
            net.p[name][at] += sign * 1e-3
            ends.append(net.gradients(feats, net.embed(*feats), ids, y, weight)[0])
            net.p[name][at] -= sign * 1e-3
        assert abs((ends[0] - ends[1]) / 2e-3 - g[name][at]) < 2e-3 * max(1, abs(g[name][at]))


def test_odd_rows(spark, net):
    rows = [(1, None, 9.0), (1, None, 9.0), (None, "", 9.0), (3, "\x00 é" + "z" * 5000, 9.0), (4, "vile", 9.0)]
    got = toxicity.scored(spark.createDataFrame(rows, "doc_id long, text string, toxic_score double"), net).toPandas()
    assert len(got) == 5 and got.toxic_score.between(0, 1).all() and got.toxic_score[4] >= 0.5
    assert got.toxic_score[0] == got.toxic_score[1] == got.toxic_score[2]
    assert toxicity.scored(spark.createDataFrame([], "doc_id long, text string"), net).count() == 0


def test_labels_without_a_class(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (9, 0)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert [r[0] for r in toxicity.scored(docs, None).select("toxic_score").collect()] == [0.0, 0.0]


def test_query(spark):
    got = queries.op6_toxicity(spark, SF_SMALL).toPandas()
    assert len(got) == 200 and got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
