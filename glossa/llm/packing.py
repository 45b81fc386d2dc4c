"""Operator 2: best-fit packing of documents into sequences under several capacities.

Texts are tokenised in parallel and cut into pieces; what a piece needs of each
capacity (tokens, one document, squared length as attention cost) follows from its
length alone. So the histogram of lengths, at most ``max_tokens`` rows however large
the corpus, describes the whole packing problem. The driver runs vector best-fit
over the histogram: lengths in falling order, bins of equal residuals as one class,
and each length goes to the class with the smallest weighted dot product of item and
residual (or the smallest residual norm) that meets every capacity. The result is a
list of runs "pieces of length l with ranks from r on go to bins from b on, k a bin".
Pieces get their rank within their length from counts over hash buckets, and look their
place up in the runs. Nothing that grows with the corpus reaches the driver or one task.

Defined cases: a null or empty text is the one end token. Repeated rows and rows with
a null id are packed each for itself. An empty table gives no rows. Only
``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.common import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def encoder(vocabulary: str):
    """``text -> ids`` of the public byte-level vocabulary with that name.

    The rank file holds the vocabulary of the JSON file; both libraries give the same
    ids (tested), this one at a quarter of the time. A special token's string in a
    text is that token, as in the JSON tokenizer. The JSON tokenizer takes over where
    the other refuses a text.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    end = {"<|endoftext|>": 50256}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=end)
    exact: list = []

    def encode(text: str) -> np.ndarray:
        try:
            return np.asarray(fast.encode(text, allowed_special="all"), dtype="<u4")
        except Exception:  # the rank library's pattern engine gives up on some texts
            if not exact:
                exact.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
            return np.asarray(exact[0].encode(text, add_special_tokens=False).ids, dtype="<u4")

    return encode


def cut(ids: np.ndarray, max_tokens: int) -> Iterator[tuple[int, int]]:
    """(start, end) of a document's pieces: full ones, but for the first if it must be shorter."""
    first = len(ids) % max_tokens or min(len(ids), max_tokens)
    edges = [0, *range(first, len(ids) + 1, max_tokens)]
    return zip(edges, edges[1:])


def piece_rows(docs: DataFrame, max_tokens: int = 2048, vocabulary: str = "byte_bpe_50k", end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and the crc32 of its ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encode(text if isinstance(text, str) else ""), np.uint32(end_id)).astype("<u4")
                doc = None if pd.isna(doc) else int(doc)
                rows += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(cut(ids, max_tokens))]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, PIECES)


def plan_bins(
    counts: dict[int, int],
    max_tokens: int = 2048,
    max_docs: int = 2048,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    rule: str = "dot",
) -> np.ndarray:
    """Vector best-fit, lengths falling, over ``{length: number of pieces}``.

    Returns int64 rows (length, first rank, first bin, pieces a bin, first offset): the pieces
    of a run fill its bins in turn. Bins with equal residuals are one class, held as ranges of bin
    numbers. ``rule``: "dot" takes the feasible class with the smallest weighted dot product of
    item and residual, "norm" the one with the smallest weighted norm left after placing.
    """
    caps = np.array([max_tokens, max_docs, max_attention or max_tokens**2], dtype=np.float64)
    w = np.asarray(weights, dtype=np.float64)
    keys = np.empty((0, 3), dtype=np.int64)  # residuals of the classes
    ranges: list[list[tuple[int, int]]] = []  # their bins: (first, number)
    where: dict[tuple, int] = {}
    runs, bins = [], 0

    def add(state: tuple[int, int, int], first: int, n: int) -> None:
        nonlocal keys
        if n and state[0] > 0 and state[1] > 0:
            if state not in where:
                where[state] = len(ranges)
                ranges.append([])
                if len(ranges) > len(keys):
                    keys = np.vstack([keys, np.zeros((max(256, len(keys)), 3), dtype=np.int64)])
                keys[where[state]] = state
            ranges[where[state]].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        item = np.array([length, 1, length * length], dtype=np.int64)
        if (item > caps).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        while left:
            used = keys[: len(ranges)]
            open_ = np.fromiter((bool(r) for r in ranges), bool, len(ranges))
            fits = np.flatnonzero(open_ & (used >= item).all(axis=1))
            if len(fits):
                rest = used[fits] / caps
                score = rest @ (w * item / caps) if rule == "dot" else ((rest - item / caps) ** 2) @ w
                c = int(fits[np.argmin(score)])
                state = tuple(int(x) for x in keys[c])
                first, n = ranges[c].pop()
            else:
                state, first = (int(caps[0]), int(caps[1]), int(caps[2])), bins
                per = int(min(np.array(state) // item))
                n = -(-left // per)
                bins += n
            per = int(min(np.array(state) // item))
            full = min(n, left // per)
            runs.append((length, rank, first, per, max_tokens - state[0]))
            placed = min(left, n * per)
            add(tuple(int(x) for x in np.array(state) - per * item), first, full)
            touched = full
            if placed > full * per:  # one bin takes the rest
                add(tuple(int(x) for x in np.array(state) - (placed - full * per) * item), first + full, 1)
                touched += 1
            add(state, first + touched, n - touched)
            left, rank = left - placed, rank + placed
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame,
    max_tokens: int = 2048,
    max_docs: int = 2048,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    rule: str = "dot",
    vocabulary: str = "byte_bpe_50k",
    rows_a_bucket: int = 20_000,
) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences; one row per piece with its sequence and offset.

    ``max_docs`` is the number of pieces a sequence may hold and ``max_attention`` the sum of
    their squared lengths (by default not binding).
    """
    rows = stored(piece_rows(docs, max_tokens, vocabulary), "pieces")
    # A length that a third of all pieces share is ranked in many buckets, each by itself.
    buckets = 1 + rows.count() // rows_a_bucket
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    sizes = stored(rows.groupBy("length", "bucket").agg(F.count("*").alias("n")), "piece-lengths")
    counts = {int(r["length"]): int(r["n"]) for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan_bins(counts, max_tokens, max_docs, max_attention, weights, rule)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("row", F.row_number().over(inside)).join(base, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("row") - 1).alias("rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(np.int64), batch.pop("rank").to_numpy(np.int64)
            run = runs[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            at = rank - run[:, 1]
            batch["sequence_id"] = run[:, 2] + at // run[:, 3]
            batch["offset"] = run[:, 4] + at % run[:, 3] * length
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch

    return ranked.mapInPandas(place, PACKED)
