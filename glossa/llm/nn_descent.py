"""Operator 5: near-duplicate embeddings by NN-descent.

Equal vectors are one node. The neighbour graph starts from a forest of random hyperplanes: nodes in one
leaf (a crowded leaf is dealt into blocks of ``LEAF``) propose each other. Every round joins
neighbours of neighbours: around each node, what lists it and what it lists meet in numpy, and each
keeps its ``K`` nearest. Pairs at the threshold are then confirmed in double precision and
joined to components.

A list whose ``K`` entries all reach the threshold is saturated: its node may have more links. Its entries
are in its component by then, so the list is enlarged by the ``K`` nearest nodes of other components: the
components that hold a saturated list get a forest and rounds in which members of one component do
not meet, and what links is joined, until no further link is found. The members of a component are
compared in blocks of about ``BLOCK``; only
counts leave a block, so no list or pair table of a crowded component exists.

The trees are as many as a pair at the threshold needs to share a leaf with probability ``target``. Recall is
the least of several: of probes, planted at cosines from the threshold up beside ``AUDIT`` nodes and not part of
the result; and, by brute force against all nodes, of ``AUDIT`` nodes and of up to ``PICKS`` nodes of each
size class of components (powers of two), as the mean over nodes that hold links. While it
is below ``target`` another forest and more rounds are added; if that does not reach it, all nodes
are compared block by block, which is quadratic and exact.

Defined cases: a vector that is null, zero or holds a null or non-finite component links with
nothing and is its own component. Vectors of different length never link. Repeated rows,
whatever their ids, are vectors of their own that link with each other. A null id never names a component
while another id can. An empty table gives no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import connected_components, stored

K, TREES, LEAF, BLOCK = 8, 8, 96, 256
#: Pivots that one group of a local join holds, and nodes whose recall is audited, of all and of a size class.
PIVOTS, AUDIT, PICKS = 400, 256, 16
#: Nodes in a block of the exact comparison.
EXACT = 1024


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, node) of every row, and (node, vec, dim, copies, low) of every distinct usable vector."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0)
    rows = rows.withColumn("node", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64(F.size("e"), F.transform("e", lambda x: x + F.lit(0.0)))))
    rows = stored(rows, "vectors")

    def unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for e in batch["vec"]:
                v = np.asarray(e, np.float64)
                v = v / np.abs(v).max()
                out.append(v / np.sqrt(v @ v))
            yield batch.assign(vec=out, low=batch["low"].astype("Int64"))

    kinds = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("e").alias("vec"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    kinds = kinds.select("node", "vec", F.size("vec").alias("dim"), "copies", "low")
    return rows.select("vec_id", "node"), stored(kinds.mapInPandas(unit, kinds.schema), "nodes")


def nearest(ids: np.ndarray, vecs: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, neighbour, similarity): each node's ``k`` nearest of a set that have another label."""
    s = vecs @ vecs.T
    s[labels[:, None] == labels[None, :]] = -2
    k = min(k, len(ids) - 1)
    if k < 1:
        return ids[:0], ids[:0], s[:0, 0]
    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    node, nbr, sim = np.repeat(ids, k), ids[top.reshape(-1)], np.take_along_axis(s, top, axis=1).reshape(-1)
    other = sim > -1.5
    return node[other], nbr[other], sim[other]


EDGE = "node long, nbr long, sim float"


def frame(parts: list[tuple]) -> pd.DataFrame:
    node, nbr, sim = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    return pd.DataFrame({"node": node, "nbr": nbr, "sim": sim.astype(np.float32)})


def depth_of(n: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, n) / (LEAF / 2)))))


def trees_of(n: int, threshold: float, target: float) -> int:
    """Trees by which a pair at the threshold shares a leaf with probability ``target``, and ``TREES`` at least."""
    same = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** depth_of(n)
    return TREES if same >= target else max(TREES, int(np.ceil(np.log1p(-target) / np.log1p(-same))))


def forest(nodes: DataFrame, n: int, seed: int, trees: int) -> DataFrame:
    """Proposals (node, nbr, sim) from the leaves of random-hyperplane trees."""
    depth = depth_of(n)

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                dim = int(dim)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).normal(size=(dim, trees * depth))
                side = (np.vstack(part["vec"].to_numpy()) @ planes[dim] > 0).reshape(len(part), trees, depth)
                code = (side * (1 << np.arange(depth, dtype=np.int64))).sum(axis=2)
                for t in range(trees):
                    yield pd.DataFrame({"tree": t, "dim": dim, "code": code[:, t], "node": part["node"], "label": part["label"], "vec": [np.asarray(v, np.float32) for v in part["vec"]]})

    rows = nodes.mapInPandas(leaves, "tree int, dim int, code long, node long, label long, vec array<float>")
    keys = ["tree", "dim", "code"]
    # A crowded leaf is dealt into blocks by hash, so no group is larger than a few LEAF.
    crowd = stored(rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 2 * LEAF), "crowded-leaves")
    rows = rows.join(crowd, keys, "left").withColumn("part", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("n") / LEAF))))
    group = F.pmod(F.xxhash64(*keys, "part"), F.lit(1 + n * trees // (PIVOTS * 16)))

    def propose(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, leaf in group.groupby([*keys, "part"]):
            parts.append(nearest(leaf["node"].to_numpy(np.int64), np.vstack(leaf["vec"].to_numpy()), leaf["label"].to_numpy(np.int64), K))
        return frame(parts)

    return rows.withColumn("group", group).groupBy("group").applyInPandas(propose, EDGE)


def best(edges: DataFrame) -> DataFrame:
    """Each node's ``K`` nearest of its proposals; those of a hub are reduced in parts first."""
    edges = edges.distinct()
    many = edges.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > 512 * K)
    edges = edges.join(many, "node", "left").withColumn("part", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("nbr"), F.ceil(F.col("n") / (256 * K)))))
    for keys in (["node", "part"], ["node"]):
        lists = edges.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list(F.struct("sim", "nbr")), asc=False), 1, K).alias("l"))
        edges = lists.select("node", F.explode("l").alias("e")).select("node", "e.nbr", "e.sim")
    return edges


def descend(graph: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """One round: proposals among the neighbours, listed and listing, of every node."""
    around = graph.select(F.col("node").alias("pivot"), F.col("nbr").alias("node")).union(graph.select(F.col("nbr").alias("pivot"), "node"))
    around = around.distinct()
    # A node that very many list is joined in parts of bounded size.
    wide = around.groupBy("pivot").agg(F.count("*").alias("n")).where(F.col("n") > 8 * K)
    around = around.join(wide, "pivot", "left").withColumn("part", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / (4 * K)))))
    rows = around.select("pivot", "part", "node").join(nodes.select("node", "label", F.col("vec").cast("array<float>").alias("vec")), "node")
    group = F.pmod(F.xxhash64("pivot", "part"), F.lit(1 + n // PIVOTS))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["pivot", "part"], kind="stable")
        key = group[["pivot", "part"]].to_numpy()
        ids, labels = group["node"].to_numpy(np.int64), group["label"].to_numpy(np.int64)
        vecs = np.vstack(group["vec"].to_numpy()) if group["vec"].map(len).nunique() == 1 else None
        edges = np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1
        parts = []
        for at in np.split(np.arange(len(group)), edges):
            part = vecs[at] if vecs is not None else np.vstack(group["vec"].to_numpy()[at])
            parts.append(nearest(ids[at], part, labels[at], K))
        return frame(parts)

    return rows.withColumn("group", group).groupBy("group").applyInPandas(meet, EDGE)


def confirmed(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, nbr): listed pairs whose cosine in double precision reaches the threshold."""
    near = graph.where(F.col("sim") >= threshold - 1e-4).select("node", "nbr")
    one, two = nodes.select("node", F.col("vec").alias("a")), nodes.select(F.col("node").alias("nbr"), F.col("vec").alias("b"))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return near.join(one, "node").join(two, "nbr").where(dot >= threshold).select("node", "nbr")


def enlarged(graph: DataFrame, nodes: DataFrame, label: DataFrame, threshold: float, rounds: int, target: float, seed: int) -> DataFrame:
    """``label`` (node, label) with the components joined that only saturated lists kept apart."""
    full = graph.where(F.col("sim") >= threshold - 1e-4).groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") >= K).select("node")
    full = stored(full, "saturated")
    for k in range(1 << 30):
        crowds = stored(label.join(full, "node").select("label").distinct(), "saturated-components")
        if len(crowds.take(2)) < 2:
            return label
        members = stored(nodes.drop("label").join(label, "node").join(crowds, "label"), "saturated-members")
        n = members.count()
        inside = graph.join(members.select("node"), "node", "left_semi").join(members.select(F.col("node").alias("nbr")), "nbr", "left_semi").select("node", "nbr", "sim")
        outside = stored(best(forest(members, n, seed + k, trees_of(n, threshold, target))), "outside")
        for _ in range(rounds):
            outside = stored(best(descend(inside.union(outside), members, n).union(outside)), "outside")
        found = confirmed(outside, members, threshold)
        one, two = label.select("node", F.col("label").alias("a")), label.select(F.col("node").alias("nbr"), F.col("label").alias("b"))
        found = stored(found.join(one, "node").join(two, "nbr").select("a", "b").distinct(), "outside-links")
        if not found.take(1):
            return label
        label = merged(label, found)


def merged(label: DataFrame, found: DataFrame) -> DataFrame:
    """``label`` (node, label) with the components joined that the pairs of labels (a, b) link."""
    met = connected_components(found, "enlarged").select(F.col("node").alias("label"), "component")
    return stored(label.join(met, "label", "left").select("node", F.coalesce("component", "label").alias("label")), "enlarged-labels")


def across(nodes: DataFrame, n: int, threshold: float) -> DataFrame:
    """(a, b): the pairs of labels that a link joins, by comparing all nodes block by block."""
    blocks = -(-n // EXACT)
    rows = nodes.select("node", "label", "vec", "dim", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("own"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.select("label", "vec", "dim", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        parts = [np.empty((0, 2), np.int64)]
        for _, g in group.groupby("dim"):
            one, two = g[g["own"] == g["lo"]], g[g["own"] == g["hi"]]
            if len(one) and len(two):
                a, b = one["label"].to_numpy(np.int64), two["label"].to_numpy(np.int64)
                x, y = np.nonzero((np.vstack(one["vec"].to_numpy()) @ np.vstack(two["vec"].to_numpy()).T >= threshold) & (a[:, None] != b[None, :]))
                parts.append(np.unique(np.stack([a[x], b[y]], axis=1), axis=0))
        return pd.DataFrame(np.concatenate(parts), columns=["a", "b"])

    return stored(rows.groupBy("lo", "hi").applyInPandas(compare, "a long, b long").distinct(), "exact-links")


def counts(members: DataFrame, n: int, threshold: float) -> DataFrame:
    """(node, links, pairs): within every component, the copies and the nodes that each node links with, itself included.

    ``members``: (label, node, vec, copies). A component is compared block by block, so a saturated
    list needs no larger list; components of one block share groups.
    """
    sizes = members.groupBy("label").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    rows = members.join(sizes, "label").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("label"), F.lit(1 + n // PIVOTS))).otherwise(F.xxhash64("label", "lo", "hi"))
    small = rows.select("label", "node", "vec", "copies", "own", "lo", "hi", group.alias("group"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for (_, lo, hi), g in group.groupby(["label", "lo", "hi"]):
            ids, n, own = g["node"].to_numpy(np.int64), g["copies"].to_numpy(np.int64), g["own"].to_numpy()
            v = np.vstack(g["vec"].to_numpy())
            linked = v @ v.T >= threshold
            np.fill_diagonal(linked, True)
            if lo != hi:
                linked &= own[:, None] != own[None, :]
            parts.append(pd.DataFrame({"node": ids, "links": linked @ n, "pairs": linked.sum(axis=1)}))
        return pd.concat(parts)

    found = small.groupBy("group").applyInPandas(compare, "node long, links long, pairs long")
    return found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("pairs").alias("pairs"))


def planted(nodes: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Probes, as nodes and with their ``origin``: beside each of the ``AUDIT`` first nodes by hash, a vector that links with it."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(AUDIT).select("node", "vec", F.xxhash64("node", F.lit("probe")).alias("probe")).collect()
    rng, rows = np.random.default_rng([seed, 1]), []
    for k, r in enumerate(sample):
        v = np.array(r["vec"])
        u = rng.normal(size=len(v))
        u -= (u @ v) * v
        size = np.sqrt(u @ u)
        cosine = threshold + (1 - threshold) * (0.001 + 0.9 * k / AUDIT) if size > 1e-6 else 1.0
        v = cosine * v + (np.sqrt(max(0.0, 1 - cosine**2)) * u / size if cosine < 1 else 0.0)
        rows.append((r["probe"], (v / np.sqrt(v @ v)).tolist(), len(v), r["node"]))
    probes = nodes.sparkSession.createDataFrame(rows, "node long, vec array<double>, dim int, origin long")
    return stored(probes.select("node", "vec", "dim", F.lit(0).cast("long").alias("copies"), F.lit(None).cast("long").alias("low"), F.col("node").alias("label"), "origin"), "probes")


def probed(graph: DataFrame, nodes: DataFrame, probes: DataFrame, label: DataFrame, threshold: float) -> float:
    """Share of the probes that the graph links with the component of their origin; ``nodes`` holds both kinds."""
    total = probes.count()
    both = graph.union(graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "sim"))
    both = confirmed(both.join(F.broadcast(probes.select("node")), "node", "left_semi"), nodes, threshold)
    both = both.join(probes.select("node", "origin"), "node")
    one, two = label.select(F.col("node").alias("nbr"), F.col("label").alias("x")), label.select(F.col("node").alias("origin"), F.col("label").alias("y"))
    met = both.join(one, "nbr", "left").join(two, "origin", "left").where(F.coalesce("x", "nbr") == F.coalesce("y", "origin"))
    return met.select("node").distinct().count() / total if total else 1.0


def audited(nodes: DataFrame, label: DataFrame, found: DataFrame, threshold: float) -> float:
    """Least share of the true links found, by nodes that hold any: of the ``AUDIT`` first by hash, and of ``PICKS`` of each size class."""
    first = nodes.orderBy(F.xxhash64("node"), "node").limit(AUDIT).select(F.lit(0).cast("long").alias("kind"), "node")
    sizes = label.groupBy("label").agg(F.floor(F.log2(F.count("*").cast("double"))).alias("kind"))
    picks = label.join(sizes, "label").groupBy("kind", F.pmod(F.xxhash64("node"), F.lit(PICKS)).alias("part")).agg(F.min("node").alias("node"))
    asked = stored(first.union(picks.select("kind", "node")), "audit")
    sample = nodes.join(asked.select("node").distinct(), "node").select("node", "vec").collect()
    ids, by = [r["node"] for r in sample], {}
    for k, r in enumerate(sample):
        by.setdefault(len(r["vec"]), []).append((k, np.array(r["vec"])))
    sent = nodes.sparkSession.sparkContext.broadcast({dim: ([k for k, _ in x], np.vstack([v for _, v in x])) for dim, x in by.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        true = np.zeros(len(ids), np.int64)
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                if dim in sent.value:
                    at, q = sent.value[dim]
                    true[at] += (q @ np.vstack(part["vec"].to_numpy()).T >= threshold).sum(axis=1)
        yield pd.DataFrame({"node": ids, "true": true})

    true = nodes.mapInPandas(run, "node long, true long").groupBy("node").agg(F.sum("true").alias("true")).where(F.col("true") > 1)
    share = (F.least(F.coalesce("pairs", F.lit(1)), "true") - 1) / (F.col("true") - 1)
    least = asked.join(true, "node").join(found, "node", "left").groupBy("kind").agg(F.avg(share).alias("share")).agg(F.min("share")).first()[0]
    # Without a true link only the probes tell.
    return 1.0 if least is None else float(least)


def components(vectors: DataFrame, threshold: float = 0.95, rounds: int = 2, target: float = 0.99, attempts: int = 3, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, audit_recall of every row."""
    rows, nodes = nodes_of(vectors)
    nodes = nodes.withColumn("label", F.col("node"))
    n = nodes.count()
    probes = planted(nodes, threshold, seed)
    every = nodes.union(probes.drop("origin"))
    trees = trees_of(n, threshold, target)
    graph = links = label = None
    recall = 1.0

    def counted(name: str) -> DataFrame:
        return stored(counts(label.join(nodes.drop("label"), "node").select("label", "node", "vec", "copies"), n, threshold), name)

    for attempt in range(attempts):
        proposals = forest(every, n, seed + attempt, trees)
        graph = stored(best(proposals if graph is None else proposals.union(graph)), f"graph-{attempt}")
        for k in range(rounds):
            graph = stored(best(descend(graph, every, n).union(graph)), f"graph-{attempt}-{k}")
        # Probes are no nodes of the result, so that their links end here.
        edges = confirmed(graph, nodes, threshold).select(F.col("node").alias("a"), F.col("nbr").alias("b"))
        label = connected_components(edges, f"embeddings-{attempt}").select("node", F.col("component").alias("label"))
        label = enlarged(graph, nodes, stored(label, f"labels-{attempt}"), threshold, rounds, target, seed + 1000 * (attempt + 1))
        links = counted(f"links-{attempt}")
        recall = min(probed(graph, every, probes, label, threshold), audited(nodes, label, links, threshold))
        if recall >= target:
            break
    if recall < target:
        label = stored(nodes.select("node").join(label, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "all-labels")
        label = merged(label, across(nodes.drop("label").join(label, "node"), n, threshold))
        links, recall = counted("links-exact"), 1.0
    known = nodes.select("node", "copies", "low").join(label, "node", "left").join(links, "node", "left")
    known = known.select("node", F.coalesce("label", "node").alias("label"), (F.coalesce("links", "copies") - 1).alias("n_links"), "low")
    least = known.groupBy("label").agg(F.min("low").alias("component_id"))
    known = known.join(least, "label").select("node", "n_links", "component_id")
    out = rows.join(known, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.lit(recall).alias("audit_recall"))
