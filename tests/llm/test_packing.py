import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from glossa.llm import packing
from tests.conftest import SF_SMALL

TEXTS = ["", None, "a", "Thé idiot <|endoftext|> x", "two words\n\n  and\tmore 12345 \U0001f600", "word " * 5000, "z" * 30_000]


def expand(runs, counts):
    """Bins as lists of (offset, length), from the runs."""
    bins, ends = {}, {}
    for k, (length, rank, first, per, offset) in enumerate(runs):
        following = [r[1] for r in runs if r[0] == length and r[1] > rank]
        for at in range(min(following, default=counts[length]) - rank):
            bins.setdefault(first + at // per, []).append((offset + at % per * length, length))
    return bins


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12), st.integers(1, 64), st.sampled_from(["dot", "norm"]))
def test_plan_meets_every_capacity_without_gaps(counts, max_docs, rule):
    runs = packing.plan_bins(counts, 64, max_docs, 64 * 64, rule=rule)
    bins = expand(runs.tolist(), counts)
    assert sum(map(len, bins.values())) == sum(counts.values())
    for items in bins.values():
        items.sort()
        assert items[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(items, items[1:]))
        assert sum(n for _, n in items) <= 64 and len(items) <= max_docs
    assert sorted(bins) == list(range(len(bins)))


def test_attention_capacity_binds():
    runs = packing.plan_bins({10: 6}, 64, 64, 200)
    assert len(expand(runs.tolist(), {10: 6})) == 3  # two pieces of squared length 100 each


def test_no_more_bins_than_plain_best_fit():
    rng = np.random.default_rng(3)
    lengths = sorted(np.minimum(2048, rng.lognormal(5.5, 1.2, 3000).astype(int) + 1).tolist(), reverse=True)
    counts = {n: lengths.count(n) for n in set(lengths)}
    open_bins = []
    for n in lengths:
        fits = [r for r in open_bins if r >= n]
        if fits:
            open_bins.remove(min(fits))
            open_bins.append(min(fits) - n)
        else:
            open_bins.append(2048 - n)
    assert len(expand(packing.plan_bins(counts).tolist(), counts)) <= len(open_bins)


def test_rows_against_the_json_tokenizer(spark):
    docs = spark.createDataFrame([(k, t, "clash", 0) for k, t in enumerate(TEXTS)] + [(None, "a", "c", 0), (2, "a", "c", 1)], "doc_id long, text string, sequence_id string, offset int")
    got = packing.pack(docs).toPandas()
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc, text in [*enumerate(TEXTS), (None, "a"), (2, "a")]:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        for k, (a, b) in enumerate([(0, first), *((x, x + 2048) for x in range(first, len(ids), 2048))]):
            want.append((-1 if doc is None else doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    got["doc_id"] = got.doc_id.fillna(-1).astype(int)
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 2048


def test_empty_table_and_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert packing.pack(docs.limit(0)).count() == 0
    got = packing.pack(docs, rows_a_bucket=20).toPandas()
    assert got.doc_id.nunique() == docs.count()
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) * 1.05 + 1
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 2048
