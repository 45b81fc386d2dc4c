import numpy as np

from glossa.llm import nn_descent, queries
from tests.llm.conftest import oracle, same


def brute(rows, threshold=0.95):
    """(id, links, smallest id reachable) of every row, by all pairs."""
    sound = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.abs(v).max() if ok else None for (_, v), ok in zip(rows, sound)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    n = len(rows)
    links = [[j for j in range(n) if j != i and sound[i] and sound[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    out = []
    for i, (k, _) in enumerate(rows):
        seen, stack = {i}, [i]
        while stack:
            for j in links[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        named = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((k, len(links[i]), (min(named) if named else None) if sound[i] else k))
    return sorted(out, key=repr)


def run(spark, rows):
    docs = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<float>, label int, node string")
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in nn_descent.components(docs).collect()), key=repr)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for size in (700, 60, 9, 2, 1, 1):  # a crowded group of several blocks, and small ones
        centre = rng.normal(size=24)
        rows += [(centre + rng.normal(size=24) * 0.16).astype(np.float32).tolist() for _ in range(size)]
    rows += [rng.normal(size=24).astype(np.float32).tolist() for _ in range(400)]
    rows = list(enumerate(rows))
    rows += [(5000, rows[0][1]), (5001, rows[0][1]), (5001, rows[0][1]), (None, rows[0][1]), (None, None), (5002, None), (5003, []), (5004, [0.0] * 24), (5005, [float("nan")] + [1.0] * 23)]
    rows += [(5006, [None] + [1.0] * 23), (5007, [float("inf")] * 24), (5008, [1e38] * 24), (5009, [1e-38] * 24), (5010, [1.0, 2.0]), (5011, [1.0, 2.0]), (5012, [-0.0, 1.0]), (5013, [0.0, 1.0])]
    rows = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    got, want = run(spark, rows), brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sum(g == w for g, w in zip(got, want)) >= 0.995 * len(want)
    assert [g for g in got if (g[0] or 0) >= 5000] == [w for w in want if (w[0] or 0) >= 5000]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_recall_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.vec_id: r for r in queries.op5_nn_descent(spark, sf).collect()}
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    v = np.vstack(table.embedding.to_numpy()).astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    asked = np.flatnonzero(table.vec_id.to_numpy() % 50 == 0)
    true = (v[asked] @ v.T >= 0.95).sum(axis=1) - 1
    found = np.array([got[k].n_links for k in table.vec_id.to_numpy()[asked]])
    assert (found <= true).all() and found.sum() >= 0.99 * true.sum()
    assert all(r.kept == (r.vec_id == r.component_id) and r.audit_recall >= 0.99 for r in got.values())


def test_query_against_sql(spark):
    same(queries.op5_nn_descent(spark, "/root/testdata/sf0.01").toPandas(), oracle("op5_nn_descent", "/root/testdata/sf0.01"))


def near(rng, centre, cosine, n=1):
    """Vectors at a cosine from a unit vector."""
    u = rng.normal(size=(n, len(centre)))
    u -= (u @ centre)[:, None] * centre
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return cosine * centre + np.sqrt(1 - cosine**2) * u


def test_crowded_groups_link_across_saturated_lists(spark):
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(12):  # two groups of 24, 0.99 inside and 0.96 across, and a third behind the second
        a = near(rng, np.eye(32)[0], 0.0)[0]
        b = near(rng, a, 0.965)[0]
        c = near(rng, b, 0.965)[0]
        for centre in (a, b, c):
            rows += near(rng, centre, 0.9975, 24).astype(np.float32).tolist()
    rows += rng.normal(size=(300, 32)).astype(np.float32).tolist()
    rows = list(enumerate(rows))
    got, want = run(spark, rows), brute(rows)
    assert max(w[1] for w in want) >= 47 and got == want


def test_links_of_every_group_size_without_proposals(spark, monkeypatch):
    rng, rows = np.random.default_rng(9), []
    for size in (1, 1, 2, 2, 2, 3, 5, 8, 9, 17, 40):
        rows += near(rng, near(rng, np.eye(32)[0], 0.0)[0], 0.99, size).astype(np.float32).tolist()
    rows += rng.normal(size=(1200, 32)).astype(np.float32).tolist()
    rows = list(enumerate(rows))
    want = sorted(brute(rows))
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    result = lambda: sorted(((r.vec_id, r.n_links, r.component_id), r.audit_recall) for r in nn_descent.components(docs, attempts=1).collect())
    got = result()
    assert [g for g, _ in got] == want and all(recall >= 0.99 for _, recall in got)
    # A forest that proposes nothing is noticed, though few nodes hold a link, and the exact way is taken.
    forest = nn_descent.forest
    monkeypatch.setattr(nn_descent, "forest", lambda *a: forest(*a).where("node < nbr AND node > nbr"))
    assert result() == [(w, 1.0) for w in want]
