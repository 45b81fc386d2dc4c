import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from glossa.llm import alignment, queries
from glossa.llm.common import table
from tests.conftest import SF_SMALL

TEXTS = [
    "", None, "a", " lead", "Thé idiot <|endoftext|> <s> </s> <unk> x", "tabs\tand\n\nlines  twice ", "▁ low line", "word " * 400, "z" * 3000,
    "日本語 \U0001f600 \x00 nul", "A sentence that occurs often.", "A sentence that occurs often.", "é a b ​",
]


class Plain:
    """Both tokenizers with each token's bytes, from their own entries."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        self.byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(hidden)}

    def tokens(self, text):
        if not text:
            return [], []
        raw = (" " + text).encode()
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()) for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])


def spans(tokens):
    at, out = 0, []
    for i, x in tokens:
        out.append((at, at + len(x), i))
        at += len(x)
    return out


def plain(rows):
    both, count, docs = Plain(), Counter(), []
    for doc_id, text in rows:
        a, b = map(spans, both.tokens(text))
        links, k = [], 0
        for s, e, i in a:
            while k < len(b) and b[k][1] <= s:
                k += 1
            j = k
            while j < len(b) and b[j][0] < e:
                links.append((i, b[j][2]))
                j += 1
        count.update(links)
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= end) for side in (a, b)))
            start = end
        docs.append((doc_id, a, b, links, groups))
    top = {}
    for (i, j), n in count.items():
        top[j] = max(top.get(j, 0), n)
    digest = lambda groups: hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
    found = [(d, len(a), len(b), len(g), len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), digest(g)) for d, a, b, x, g in docs]
    return sorted(found, key=repr), count


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [200, 8 << 20])
def test_against_plain_overlaps(spark, block_bytes):
    rows = [(None if k == 3 else k // 2, t) for k, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, block int, pair string").repartition(2)
    want, count = plain(rows)
    assert got(alignment.align(df, block_bytes=block_bytes)) == want
    pairs = alignment.pair_counts(alignment.index(df, block_bytes=block_bytes)).collect()
    assert {(r["a"], r["b"]): r["links"] for r in pairs} == dict(count)
    holds = Counter(p for d in rows for p in plain([d])[1])
    assert {(r["a"], r["b"]): r["docs"] for r in pairs} == dict(holds)


def test_chunks_within_a_block(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 50)
    encode = alignment.byte_level("byte_bpe_50k"), alignment.pieces("piece_bpe_32k")
    block = alignment.Block(3, *encode)
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    for doc_id, text in rows:
        block.add(doc_id, text)
    tables = [t.to_pylist() for t in block.tables()]
    assert [r["doc_id"] for r in tables[0]] == [k for k, _ in rows]
    assert sum(r["n"] << r["plane"] for t in tables[1:] for r in t) == sum(plain(rows)[1].values())


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 299), min_size=1, max_size=200), min_size=1, max_size=8))
def test_containers_round_trip(sets):
    import numpy as np

    place = np.array([x for s in sets for x in sorted(s)], "<u2")
    n = np.array([len(s) for s in sets])
    bits = alignment.containers(place, np.cumsum(n) - n, n, 300).to_pylist()
    assert all(len(b) <= 2 * min(len(s), 19) for b, s in zip(bits, sets))
    row, found = alignment.unpack(n, bits)
    back = [set() for _ in sets]
    for r, x in zip(row.tolist(), found.tolist()):
        back[r].add(x)
    assert back == sets


def test_vocabularies_spell_their_entries():
    both, (_, a), (_, b) = Plain(), alignment.byte_level("byte_bpe_50k"), alignment.pieces("piece_bpe_32k")
    assert all(a.tokens[i] == bytes(both.byte[c] for c in both.a.id_to_token(i)) for i in range(len(a.tokens)))
    assert len(b.tokens) == 32_000 and b.tokens[both.b.piece_to_id("▁the")] == b" the"


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert got(queries.op12_pair_bitmaps(spark, SF_SMALL)) == plain(rows)[0]
