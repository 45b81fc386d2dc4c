import collections
import math
import random
import zlib

import numpy as np
import pytest

from glossa.llm import ppm, queries


def words(text):
    return ppm.words(text)


def brute(rows, order, folds=10):
    """Scores byte by byte, from a trie of plain dictionaries."""
    out = lambda doc: zlib.crc32(("" if doc is None else str(doc)).encode()) % folds == 0
    trie = collections.defaultdict(collections.Counter)
    tokens = collections.Counter()
    for doc, text in rows:
        if not out(doc):
            tokens.update(words(text) + [b""])
            code = ppm.coded(words(text), order)
            for i in range(order, len(code)):
                for k in range(order + 1):
                    trie[code[i - k : i]][code[i]] += 1
    n, v = sum(tokens.values()), len(tokens)
    found = []
    for doc, text in rows:
        w = words(text) + [b""]
        code, total = ppm.coded(words(text), order), 0.0
        for i in range(order, len(code)):
            excluded: set = set()
            for k in range(order, -2, -1):
                if k < 0:
                    total -= math.log10(256 - len(excluded))
                    break
                left = {s: c for s, c in trie.get(code[i - k : i], {}).items() if s not in excluded}
                t, d = sum(left.values()), len(left)
                if code[i] in left:
                    total += math.log10((left[code[i]] - 0.5) / t)
                    break
                if d:
                    total += math.log10(0.5 * d / t)
                    excluded |= left.keys()
        base = sum(math.log10((tokens[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        found.append((doc, out(doc), len(w), sum(tokens[x] > 0 for x in w), n, base, total))
    return found


def check(got, want):
    order = lambda r: (repr(r[0]), r[2], r[6])
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order", [2, 3, 5])
def test_against_a_plain_trie(spark, order):
    rng = random.Random(order)
    rows = [(k, " ".join("".join(rng.choice("abé\U0001f600C") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(40)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, "ab zz"), (103, "ab\x00c \x1f"), (103, "ab\x00c \x1f"), (103, "other"), (104, "Ab  aB\tab")]
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, block int, word string")
    check(ppm.score(docs, order, block_bytes=500).collect(), brute(rows, order))


@pytest.mark.parametrize("order", [2, 3, 5])
def test_split_groups_and_many_bands(spark, order):
    rng = random.Random(order)
    rows = [(k, " ".join("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(30)))) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(ppm.score(docs, order, block_bytes=40, group_rows=5).collect(), brute(rows, order))


def test_chunks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(ppm, "CHUNK", 50)
    texts = [ppm.coded([b"abc"] * 100, 3), ppm.coded([], 3), ppm.coded([b"x"], 3)]
    total = collections.Counter()
    for sizes, keys in ppm.chunks(texts, 3):
        assert sum(n for _, n in sizes) == len(keys)
        for k, n in sizes:
            total[k] += n
    assert [total[k] for k in range(3)] == [len(t) - 3 for t in texts]
    key, n = ppm.distinct_events(texts, 3)
    assert n.sum() == sum(total.values()) and len(set(key.tolist())) == len(key)


def test_no_training_rows_and_empty_table(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    docs = spark.createDataFrame([(held, "ab")], "doc_id long, text string")
    check(ppm.score(docs, 3).collect(), brute([(held, "ab")], 3))
    assert ppm.score(docs.limit(0)).count() == 0


def test_probabilities_of_a_context_sum_to_one():
    key, n = ppm.distinct_events([ppm.coded(ppm.words("the cat sat on the mat and the rat ran"), 3)], 3)
    pairs = np.zeros((256, 256), np.int64)
    np.add.at(pairs, (key >> 8 & 255, key & 255), n)
    for context in (b" th", b"at ", b"xat", b"qqt"):
        every = (int.from_bytes(context, "big") << 8) | np.arange(256)
        group = key[(key >> 8 & 65535) == int.from_bytes(context[1:], "big")]
        keys = np.union1d(every, group)
        counts = np.array([n[key == k][0] if (key == k).any() else 0 for k in keys])
        cost = ppm.code_lengths(keys, counts, pairs, 3)
        assert abs((10 ** cost[np.isin(keys, every)]).sum() - 1) < 1e-9


def test_query_beats_the_unigram_score(spark):
    got = queries.op1_ppm(spark, "/root/testdata/sf0.1").toPandas()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(got.doc_id) == sorted(k for k, _ in rows) and got.train_tokens.nunique() == 1
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
