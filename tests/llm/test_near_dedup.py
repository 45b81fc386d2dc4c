import random

import numpy as np

from glossa.llm import near_dedup, queries
from tests.conftest import SF_SMALL
from tests.llm.conftest import lower, oracle, same


def shingles(text, size=5):
    w = lower(text).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, percent=75):
    """(id, set size, smallest id reachable) of every row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return sorted(((doc, len(sets[k]), least.get(find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    docs = spark.createDataFrame([(a, b, "x", 1, 2) for a, b in rows], "doc_id long, text string, label string, key int, h int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.components(docs).collect()), key=repr)
    return got, near_dedup.survivors(docs)


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "w%d" % rng.randrange(10**9)
    return " ".join(words)


def test_against_all_pairs(spark):
    rng = random.Random(5)
    rows = []
    for family in range(6):  # loose families, whose members link in chains only
        base = ["v%d" % rng.randrange(3000) for _ in range(120)]
        rows += [(100 * family + k, edited(base, rng.randrange(7), rng)) for k in range(25)]
    rows += [(k + 1000, " ".join("u%d" % rng.randrange(10**6) for _ in range(rng.randrange(1, 60)))) for k in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2002, " \n\t"), (None, None), (2003, "A b"), (2004, "a\nB "), (2004, "a\nB "), (None, "a b"), (None, "only here now"), (2005, "é É"), (2006, "é é"), (2007, "long " * 9000)]
    rng.shuffle(rows)
    got, kept = run(spark, rows)
    want = brute(rows)
    assert got == want
    assert kept.columns == ["doc_id", "text", "label", "key", "h"]
    left = [(r.doc_id, r.text) for r in kept.collect()]
    groups = {c for _, n, c in want if n}
    assert sorted(i for i, t in left if shingles(t) and i is not None) == sorted(g for g in groups if g is not None)
    assert sum(not shingles(t) for _, t in left) == 5 and (None, "only here now") in left
    assert len({t for _, t in left}) == len(left) - 2  # null twice, one blank text twice


def crowd(rng, n):
    """Texts that share a passage with all others and are 0.6 to 0.74 alike, some a little more."""
    base = ["v%d" % k for k in range(240)]
    rows = []
    for k in range(n):
        own = rng.randrange(36, 62)
        rows.append((k, " ".join(base + ["o%d_%d" % (k // 2 if k % 7 == 0 else k, j) for j in range(own)])))
    return rows


def test_crowded_bucket_in_blocks(spark, monkeypatch):
    rows = crowd(random.Random(11), 90)
    want = brute(rows)
    assert run(spark, rows)[0] == want
    met = []
    plain = near_dedup.dealt

    def watched(df, own, other):
        out = plain(df, own, other)
        met.append(out.groupBy("bucket", "i", "j").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "dealt", watched)
    assert run(spark, rows)[0] == want
    assert met and max(met) <= 24  # of 90 classes in the largest bucket, which meet eight or so at a time


def test_empty_table(spark):
    got, kept = run(spark, [])
    assert got == [] and kept.count() == 0


def test_signature_estimates_similarity():
    rng = random.Random(1)
    base = ["v%d" % k for k in range(400)]
    known = near_dedup.Words()
    x, y = " ".join(base), edited(base, 12, rng)
    sig = [near_dedup.signature(near_dedup.shingle_hashes(t, 5, known)[1], *near_dedup.orders(near_dedup.HASHES)) for t in (x, y)]
    bits = ["".join(format(v & (2**64 - 1), "064b") for v in s.tolist()) for s in sig]
    share = np.mean([bits[0][k : k + 2] == bits[1][k : k + 2] for k in range(0, len(bits[0]), 2)])
    true = len(shingles(x) & shingles(y)) / len(shingles(x) | shingles(y))
    assert abs((share - 0.25) / 0.75 - true) < 0.07


def test_whole_table_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    table = queries.op7_bbit_minhash(spark, SF_SMALL).toPandas()
    same(table, oracle("op7_bbit_minhash", SF_SMALL))
    got = list(table.itertuples(index=False))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
