import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from glossa.llm import decontaminate, queries
from tests.conftest import SF_SMALL
from tests.llm.conftest import lower, oracle, same

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, leak_hit string, n long"


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        w = WORD.findall(lower(text))
        hit, ids = set(), set()
        for item, passage in items:
            v = WORD.findall(lower(passage))
            n = min(window, len(v))
            for k in range(max(1, len(v) - window + 1)) if v else []:
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == v[k : k + n]:
                        hit |= set(range(i, i + n))
                        if item is not None:
                            ids.add(str(item))
        out.append((doc, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def run(spark, docs, items, window):
    d = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], DOCS)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.hits(d, i, window)
    assert "n" in got.columns
    return sorted(((r.doc_id, r.leak_words, r.leak_hit, list(r.leak_items)) for r in got.collect()), key=repr)


def test_against_brute_force(spark):
    docs = [(1, None), (2, ""), (3, "A b c d e"), (3, "A b c d e"), (3, "other d e f"), (None, "b, C; d a b c"), (5, "a a a a a a b"), (6, "\U0001f600 Éa é9 x_y c d e f g"), (7, "q " * 30_000 + "c d e f")]
    items = [(1, "a b c d"), (1, "c d e f g"), (2, "e"), (10, "x y"), (11, None), (12, "!!"), (None, "a a a"), (20, "Éa É9"), (21, "c d e f")]
    assert run(spark, docs, items, 4) == brute(docs, items, 4)
    assert run(spark, docs, [], 4) == brute(docs, [], 4)
    assert run(spark, docs, [(1, "never there at all")], 4) == brute(docs, [(1, "never there at all")], 4)
    assert run(spark, [], items, 4) == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abcd ", max_size=40), min_size=1, max_size=5), st.lists(st.text("abcd ", max_size=16), min_size=1, max_size=4))
def test_random_texts(spark, texts, passages):
    assert run(spark, list(enumerate(texts)), list(enumerate(passages)), 5) == brute(list(enumerate(texts)), list(enumerate(passages)), 5)


def test_query_against_sql(spark):
    got = queries.op8_decontamination(spark, SF_SMALL).toPandas()
    same(got, oracle("op8_decontamination", SF_SMALL))
    assert got.contaminated.any() and not got.contaminated.all()
    assert got.items_sha256[~got.contaminated].eq(hashlib.sha256(b"").hexdigest()).all()
