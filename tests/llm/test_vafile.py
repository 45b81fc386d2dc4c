import hashlib
import math

import numpy as np
import pytest

from glossa.llm import queries, vafile
from glossa.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.conftest import oracle, same

SCHEMA = "vec_id long, embedding array<float>, label string, q int"


def plain(rows, k, rounds, dims, scale=256):
    """Lloyd's rounds in plain integers: (vec_id, cluster, distance) and the centroids."""
    ok = lambda e: e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    kept = [(i, [math.floor(scale * float(x)) for x in e]) for i, e in rows if ok(e)]
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [q for _, q in sorted(kept, key=key)[:k]]

    def assigned():
        return [min((sum((x - y) ** 2 for x, y in zip(q, c)), n) for n, c in enumerate(centroids)) for _, q in kept]

    for _ in range(rounds):
        found = assigned()
        for c in range(len(centroids)):
            members = [q for (_, q), (_, n) in zip(kept, found) if n == c]
            if members:
                centroids[c] = [sum(xs) // len(members) for xs in zip(*members)]
    return [(i, n, d) for (i, _), (d, n) in zip(kept, assigned())], centroids


def run(spark, rows, **parameters):
    df = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], SCHEMA)
    found, centroids = vafile.cluster(df, **parameters)
    order = lambda r: tuple(-1 if x is None else x for x in r)
    return sorted((tuple(r) for r in found.select("vec_id", "cluster", "distance").collect()), key=order), centroids.tolist()


def test_against_plain_rounds(spark):
    rng = np.random.default_rng(5)
    middle = rng.normal(0, 1, (5, 8))
    rows = [(i, [float(np.float32(x)) for x in middle[i % 5] + rng.normal(0, 0.3, 8)]) for i in range(160)]
    rows += [(i, e) for i, e in rows[:20]]  # repeated rows
    rows += [(None, rows[3][1]), (None, rows[4][1]), (900, None), (901, [1.0]), (902, [None] * 8), (903, [float("nan")] * 8), (904, [float("inf")] * 8)]
    for bits in (2, 6):
        got, centroids = run(spark, rows, k=7, rounds=3, dims=8, bits=bits)
        want, plain_centroids = plain(rows, 7, 3, 8)
        assert got == sorted(want, key=lambda r: tuple(-1 if x is None else x for x in r))
        assert centroids == plain_centroids


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(6)] + [(10, [0.5, 0.0])] * 3
    assert run(spark, rows, k=4, rounds=2, dims=2)[0] == sorted(plain(rows, 4, 2, 2)[0])


def test_empty_and_few(spark):
    assert run(spark, [(1, None)], dims=4)[0] == []
    assert run(spark, [(1, [0.5] * 4), (2, [0.25] * 4)], dims=4, k=9)[0] == sorted(plain([(1, [0.5] * 4), (2, [0.25] * 4)], 9, 5, 4)[0])
    empty = spark.createDataFrame([], SCHEMA)
    assert vafile.report(empty).collect() == []


def test_huge_components_are_an_error(spark):
    with pytest.raises(Exception, match="component"):
        run(spark, [(1, [3e38, 0.0])], dims=2)


def test_intervals_hold_every_distance():
    rng = np.random.default_rng(1)
    q, c = rng.integers(-300, 300, (500, 16)), rng.integers(-300, 300, (9, 16))
    for bits in (1, 4, 8):
        cells = vafile.Cells(q.min(axis=0), q.max(axis=0), bits)
        low, high = vafile.intervals(cells.of(q), (q**2).sum(axis=1), cells.tables(c))
        exact = ((q[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (low <= exact).all() and (exact <= high).all()
        if bits == 8:  # tight enough to settle most vectors without their components
            assert ((low <= high.min(axis=1)[:, None]).sum(axis=1) == 1).mean() > 0.9


def test_whole_table_against_sql(spark):
    same(queries.op13_va_file(spark, SF_SMALL).toPandas(), oracle("op13_va_file", SF_SMALL))


def test_full_vectors_only_where_intervals_overlap(spark, monkeypatch):
    left = []

    def counted(df, name):
        out = kept(df, name)
        if name.endswith("-bounded"):
            left.append((out.where("left IS NOT NULL").count(), out.count()))
        return out

    kept = vafile.stored
    monkeypatch.setattr(vafile, "stored", counted)
    vafile.cluster(table(spark, SF_SMALL, "embeddings"))
    assert left and all(n < total for n, total in left[1:])
