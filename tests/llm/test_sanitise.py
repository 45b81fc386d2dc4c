import collections
import hashlib
import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from glossa.llm import queries, sanitise
from tests.conftest import SF_SMALL


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    """The contract's patterns, plainly."""
    out = [(m.start(), 0, m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), m[0]))
    for k, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if (12 <= len(d) <= 19 and luhn(d)) if k == 2 else 9 <= len(d) <= 15:
                out.append((m.start(), k, m.end(), m[0]))
    return sorted(out)


def letters(text):
    return [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"(?<![^\W_])[^\W\d_]{4,}(?![^\W_])", text)]


def around(text, span, near):
    """Terms within ``near`` code points before and behind a span, without the words cut there."""
    first = max(0, span[0] - near - 1)
    left, right = text[first : span[0]], text[span[2] : span[2] + near + 1]
    if first > 0:
        left = re.sub(r"^[^\W_]+", "", left)
    if len(right) > near:
        right = re.sub(r"[^\W_]+$", "", right)
    return {w for part in (left, right) for _, _, w in letters(part)}


def named_by(span):
    """The entities of a base span."""
    _, k, _, value = span
    whole = value.lower() if k == 0 else value if k == 1 else re.sub("[^0-9]", "", value)
    shared = whole.split("@")[1] if k == 0 else ".".join(value.split(".")[:2]) if k == 1 else whole[:6]
    return {(k, "value", whole), (k, "shared", shared)}


def low(hits, n, z):
    p = min(1.0, hits / n)
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def brute(rows, near, threshold, z=sanitise.Z):
    """The terms that disclose, and the spans of every row, by the definition over distinct texts."""
    texts = {t for _, t in rows if t}
    n_e, n_te, n_t = collections.defaultdict(set), collections.defaultdict(set), collections.defaultdict(set)
    for t in texts:
        for w in {w for _, _, w in letters(t)}:
            n_t[w].add(t)
        for s in base(t):
            for e in named_by(s):
                n_e[e].add(t)
                for w in around(t, s, near):
                    n_te[e, w].add(t)
    known = set()
    for (e, w), held in n_te.items():
        prior = len(n_e[e]) / len(texts)
        if w in n_t and prior < 1:
            bound = low(len(held), len(n_t[w]), z)
            if bound > 0 and math.log(bound / prior) / -math.log(prior) >= threshold:
                known.add(w)
    out = []
    for doc, t in rows:
        b = base(t or "")
        added = [(a, 4, z_, w) for a, z_, w in letters(t or "") if w in known and not any(a < s[2] and s[0] < z_ for s in b)]
        out.append((doc, [s[:3] for s in b], [s[:3] for s in sorted(b + added)]))
    return sorted(out, key=repr)


def run(spark, rows, **given):
    docs = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, base string, key int")
    found = {(r.key.h, r.key.c): r for r in sanitise.found_spans(docs, **given).collect()}
    out = []
    for r in docs.select("doc_id", sanitise.content().alias("k")).collect():
        f = found.get((r.k.h, r.k.c))
        cut = lambda spans: [tuple(s)[:3] for s in spans]
        out.append((r.doc_id, cut(f.base) if f else [], cut(f["all"]) if f else []))
    return sorted(out, key=repr), docs


PARTS = ["a.b+c%d@ex-1.co.uk", "x@y", "_p@q.r_s@t.uv", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0099.1.01.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "5 500000000000004", "12345678901234567890123", "+1 (555) 010-9999", "+49 30 1234567", "+1", "+12 3", "é\U0001f600", "..", "--", " 7 ", "@", "9999999999999999 "]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PARTS) | st.text("0123456789.-+@ a()", max_size=20), max_size=8).map("".join), min_size=20, max_size=60))
def test_base_spans_against_plain_patterns(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: [tuple(s) for s in r.b] for r in docs.select("doc_id", sanitise.base_spans(sanitise.F.col("text")).alias("b")).collect()}
    for k, t in enumerate(texts):
        assert got[k] == base(t), t


def test_terms_against_the_definition(spark):
    rows = [(k, f"Director Zoltan writes as boss@corp.example from the Harbour office, note {k}") for k in range(6)]
    rows += [(10 + k, f"the office of nobody, note {k} with words the Director uses") for k in range(8)]
    rows += [(30, None), (31, ""), (32, "short"), (33, "boss@corp.example"), (33, "boss@corp.example"), (None, "Zoltan and BOSS@corp.example"), (34, "Zoltan alone"), (35, "q" * 50_000 + "1" * 50_000 + " z@" * 9000 + "+1 " * 9000)]
    got, docs = run(spark, rows, threshold=0.5)
    assert got == brute(rows, 60, 0.5) and any(s[1] == 4 for _, _, every in got for s in every)
    assert run(spark, [])[0] == []
    clean = {r.doc_id: r for r in sanitise.redact(docs, threshold=0.5).collect()}
    assert clean[0].asDict().keys() == {"doc_id", "text", "base", "key"} and "<EMAIL>" in clean[0].text and "Zoltan" not in clean[0].text
    # The term goes where the value is not, and what says nothing of it stays.
    assert clean[34].text == " alone" and "office" in clean[10].text and "Director" in clean[10].text
    assert clean[33].text == "<EMAIL>" and clean[30].text is None and clean[31].text == ""


def test_a_value_in_one_text_and_what_it_shares(spark):
    rows = [(k, f"common words number {'abcdefgh'[k % 8] * 5} stand here {k}") for k in range(300)]
    rows += [(900, "common words of Quimby under quimby@one.example and nothing of him further on " + "common words stand here " * 20 + "Remote")]
    rows += [(901 + k, f"here {'kmn'[k] * 4} of Fabrikant under u{k}@fabrikant.example words") for k in range(3)] + [(950, "Quimby and Fabrikant and Remote here")]
    rows += [(1000 + k, rows[k][1]) for k in range(200)]  # copies change nothing
    for near in (20, 60):
        got, docs = run(spark, rows, near=near, threshold=0.65)
        assert got == brute(rows, near, 0.65)
    clean = {r.doc_id: r.text for r in sanitise.redact(docs, threshold=0.65).collect()}
    assert clean[950] == " and  and Remote here" and clean[5] == rows[5][1] and "Quimby" not in clean[900]


def test_copies_are_no_evidence(spark):
    rows = [(k, f"filler {'abcdefghij'[k % 10] * 4} text {k}") for k in range(200)] + [(500 + k, "Zoltan has zed@corp.example") for k in range(100)]
    rows += [(700 + k, f"Zoltan elsewhere {k}") for k in range(6)]
    got, _ = run(spark, rows)
    assert got == brute(rows, 60, 0.9) and not any(s[1] == 4 for d, _, every in got if d and d >= 700 for s in every)


def test_whole_table_against_the_definition(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    kinds = sanitise.KINDS
    join = lambda spans: ",".join(f"{kinds[k]}:{a}:{z}" for a, k, z in spans)
    got = sorted((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in queries.op9_sanitisation(spark, SF_SMALL).collect())
    want = sorted((d, *[sum(s[1] == k for s in b) for k in range(4)], hashlib.sha256(join(b).encode()).hexdigest(), join(e)) for d, b, e in brute(rows, 60, 0.9))
    assert got == want and any(g[1] for g in got)
