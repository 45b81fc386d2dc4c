import collections
import re

from glossa.llm import queries, templates
from tests.conftest import SF_SMALL
from tests.llm.conftest import oracle, same


def template_names(kinds, similarity):
    """The template of every distinct line (a tuple of tokens) of a leaf."""
    names, groups = {}, [(sorted(kinds), ())]
    while groups:
        group, path = groups.pop()
        if len(group) < 2:
            continue
        counts = [collections.Counter(c) for c in zip(*group)]
        modal = [max((n, x) for x, n in c.items()) for c in counts]
        fits = [k for k in group if sum(x == m for x, (_, m) in zip(k, modal)) >= similarity * len(k)]
        names |= {k: (len(k), *path) for k in fits}
        rest = [k for k in group if k not in names]
        if 4 * len(fits) >= len(group):
            groups.append((rest, (*path, "rest")))
            continue
        where = max((n, -p) for p, (n, _) in enumerate(modal) if n < len(group))[1]
        for token in {k[-where] for k in rest}:
            groups.append(([k for k in rest if k[-where] == token], (*path, -where, token)))
    return names


def brute(rows, depth=3, similarity=0.8, evidence=40):
    """Kept lines of every row, as (id, text) pairs."""
    tokens = lambda line: tuple("<*>" if re.search("[0-9]", w) else w for w in re.split("[ \t\n\x0b\f\r]+", line) if w)
    leaves = collections.defaultdict(set)
    for _, t in rows:
        for line in (t or "").split("\n"):
            if w := tokens(line):
                leaves[len(w), w[:depth]].add(w)
    names = {}
    for leaf, kinds in leaves.items():
        names |= {k: (leaf, name) for k, name in template_names(kinds, similarity).items()}
    where = collections.defaultdict(dict)  # template, or pair of templates -> text -> smallest id
    parsed = {}
    for doc, t in rows:
        if t is None:
            continue
        here = [(i, names.get(w, w), len(w)) for i, line in enumerate(t.split("\n")) if (w := tokens(line))]
        parsed[t] = here
        rank = (doc is not None, doc or 0)
        for what in [x[1] for x in here] + [("link", a[1], b[1]) for a, b in zip(here, here[1:])]:
            where[what][t] = min(where[what].get(t, rank), rank)
    owner = {what: min(at, key=lambda t: at[t]) for what, at in where.items()}

    def lost(t):
        here, out = parsed[t], set()
        for i, name, n in here:
            if len(where[name]) > 1 and len(where[name]) * n >= evidence and owner[name] != t:
                out.add(i)
        run = []
        for k in range(1, len(here) + 1):
            link = ("link", here[k - 1][1], here[k][1]) if k < len(here) else None
            if link and len(where[link]) > 1 and owner[link] != t:
                run.append((k, len(where[link])))
                continue
            if run:
                members = here[run[0][0] - 1 : run[-1][0] + 1]
                if min(d for _, d in run) * sum(n for _, _, n in members) >= evidence:
                    out |= {i for i, _, _ in members}
            run = []
        return out

    cut = {t: lost(t) for t in parsed}
    return [(doc, t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut[t])) for doc, t in rows]


def run(spark, rows, **options):
    docs = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, lines_in string, line int")
    got = [(r.doc_id, r.text) for r in templates.clean(docs, counts=True, **options).collect()]
    kept = templates.clean(docs, **options)
    assert kept.columns == docs.columns
    return got, [(r.doc_id, r.text) for r in kept.collect()]


NOTE = "this long notice about user {} was sent on {} to every reader of the mailing list we keep"


def test_against_brute_force(spark):
    clean = "plain words of document number one that nobody repeats anywhere else in here at all ever"
    rows = [(k, f"unique text of {chr(97 + k) * 4}\n{NOTE.format('abcdefgh'[k] * 3, 10 + k)}\n\n  tail {chr(97 + k)}") for k in range(8)]
    rows += [(20, clean), (20, clean), (21, clean), (None, "nothing like " + clean), (22, None), (23, ""), (24, " \n\n"), (25, "Yes."), (26, "Yes.\nNo."), (27, "a" * 50_000 + " " + "b " * 3000)]
    rows += [(30, NOTE.format("zzz", 99)), (31, "short note\n" + clean)]
    got, kept = run(spark, rows)
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert (0, rows[0][1]) in got and all("notice" not in t for k, t in got if k in range(1, 8))
    assert {20, 21, 22, 23, 24, 25, 26, 27} <= {k for k, _ in kept} and 30 not in {k for k, _ in kept}
    assert (26, "Yes.\nNo.") in kept
    assert run(spark, []) == ([], [])


def test_several_templates_in_a_leaf(spark):
    words = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, NOTE.format(words[k] * 3, 10 + k)) for k in range(8)]
    other = "this long notice of the second kind names {} and then tells all its readers quite other things again"
    assert len(other.split()) == len(NOTE.split())
    rows += [(100 + k, other.format(words[k % 26] + words[k // 26] + "q")) for k in range(40)]
    third = "this long notice has " + " ".join(f"{{0}}{w}" for w in words[:15])
    rows += [(200 + k, third.format(words[k])) for k in range(12)]  # prose: no two lines agree
    got, _ = run(spark, rows)
    assert sorted(got) == sorted(brute(rows))
    assert {k for k, t in got if t} == {0, 100, *range(200, 212)}


def test_passage_wrapped_into_short_lines(spark):
    passage = [" ".join(f"w{chr(97 + k)}{chr(97 + j)}" for j in range(12)) for k in range(6)]
    rows = [(1, "first words\n" + "\n".join(passage) + "\nits own end"), (2, "second start\n\n" + "\n\n".join(passage) + "\nanother end")]
    rows += [(0, passage[2] + "\nunlike all"), (4, "Yes.\nNo.\nalone"), (5, "lone\nYes.\nNo."), (5, "lone\nYes.\nNo.")]
    got, _ = run(spark, rows)
    assert sorted(got) == sorted(brute(rows))
    assert dict(got)[1] == rows[0][1] and dict(got)[2].split() == ["second", "start", "another", "end"]
    assert dict(got)[0] == rows[2][1] and dict(got)[5] == rows[4][1]


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = [(r.doc_id, r.text) for r in queries.op3_line_dedup(spark, SF_SMALL).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert sorted(got, key=repr) != sorted(rows, key=repr)


def test_query_against_sql(spark):
    same(queries.op3_line_dedup(spark, "/root/testdata/sf0.01").toPandas(), oracle("op3_line_dedup", "/root/testdata/sf0.01"))
