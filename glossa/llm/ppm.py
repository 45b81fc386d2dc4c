"""Operator 1: language-model scores by prediction by partial matching (PPM).

A text is coded as its lower-case words, each followed by a space, and a line feed for its end
(neither occurs in a word); before its first byte stand spaces. The model is a trie of byte
contexts: a byte is predicted from up to ``order`` bytes before it. In a context, a byte seen n
times of T, with D distinct bytes seen, has probability (n - 1/2) / T, and the escape to the next
shorter context D / 2T (method D); bytes seen in the longer context are excluded from the
shorter one, and below the empty context all bytes that are left of the 256 are equally likely. The model
is pretrained: its counts come from all training documents, and a text does not change them.

Spark spreads the work so that no task or driver holds the corpus' model:
1. documents meet in hash blocks of about ``block_bytes``; a block gives its distinct words and its
   distinct events (a context of ``order`` bytes and the byte after it), both with training counts;
2. both are added up over bands of 64 blocks, with a bit for each block that holds them, so that a frequent word or event is a row
   a band; and over the bands, to the vocabulary and the trie's longest n-grams;
3. events get their code lengths in groups of the same last two context bytes: the shorter contexts
   that an event falls back to end in the same bytes. Only the counts of bytes and byte
   pairs (at most 65,536 numbers) are common to all groups. Groups of more than ``group_rows`` events are split by the context byte
   before, and are given the counts of their two bytes (at most 256 numbers) from outside;
4. words' counts and events' code lengths go back to the blocks that hold them, where the
   documents are scored.

Defined cases: a null or empty text is its end alone. Repeated rows are scored, and learnt from,
each for itself; a null id counts as the empty text in the fold's crc32 (0: held out). Without
training rows every byte costs log10 256 and the base score is that of an empty count. An empty
table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import crc_bucket, stored

#: Bytes of text whose events are sorted at a time.
CHUNK = 1_000_000
#: The end of a text among the words of a block.
END_WORD = ""
#: Stands for the event in a word's row.
WORD = -1


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def coded(tokens: list[bytes], order: int) -> bytes:
    """A text's bytes behind ``order`` spaces."""
    return b" " * order + b" ".join(tokens) + (b" \n" if tokens else b"\n")


def event_keys(data: np.ndarray, order: int) -> np.ndarray:
    """The event that ends at each place from ``order`` on: its bytes as one number."""
    n = len(data) - order
    key = np.zeros(n, np.int64)
    for k in range(order + 1):
        key = (key << 8) | data[k : k + n]
    return key


def chunks(texts: list[bytes], order: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """(bytes of each text, events of all) for some texts at a time; a long text is several of them."""
    sizes, held, n = [], [], 0
    for k, text in enumerate(texts):
        for i in range(0, len(text) - order, CHUNK):
            part = np.frombuffer(text[i : i + CHUNK + order], np.uint8)
            held.append(event_keys(part, order))
            sizes.append((k, len(held[-1])))
            n += len(held[-1])
            if n >= CHUNK:
                yield sizes, np.concatenate(held)
                sizes, held, n = [], [], 0
    if held:
        yield sizes, np.concatenate(held)


def distinct_events(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' events and how often each occurs."""
    key, count = np.empty(0, np.int64), np.empty(0, np.int64)
    for _, keys in chunks(texts, order):
        new, n = np.unique(keys, return_counts=True)
        del keys
        # Only one chunk's events stand beside those so far.
        at = np.minimum(np.searchsorted(key, new), max(0, len(key) - 1))
        known = key[at] == new if len(key) else np.zeros(len(new), bool)
        count[at[known]] += n[known]
        place = np.searchsorted(key, new[~known])
        key, count = np.insert(key, place, new[~known]), np.insert(count, place, n[~known])
    return key, count


class Places:
    """Where keys stand in a sorted array: a direct table of hashes, and a search for the few keys that share a slot."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.shift = np.uint64(64 - max(8, int(len(keys) * 3).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.table[self.slots(keys)] = np.arange(len(keys), dtype=np.int32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys that all occur."""
        at = self.table[self.slots(keys)]
        missed = np.flatnonzero(self.keys[at] != keys)
        at[missed] = np.searchsorted(self.keys, keys[missed])
        return at


def code_lengths(key: np.ndarray, count: np.ndarray, pairs: np.ndarray, order: int, last: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """log10 probabilities of a group's events.

    ``key``, ``count``: all events whose contexts end in the same two bytes (count 0: only to be
    scored); ``pairs``: training counts of byte pairs (context byte, byte) over all groups. With ``last``, the sorted 3-grams
    of those two bytes and their counts, the events may be those of one third byte.
    """
    sym = key & 255
    one = pairs.sum(axis=0)
    t0, d0 = float(one.sum()), float((one > 0).sum())
    logp = np.zeros(len(key))
    t, d = np.full(len(key), -1.0), np.full(len(key), -1.0)  # -1: no context seen so far
    open_ = np.ones(len(key), bool)

    def settle(at: np.ndarray, n: np.ndarray, next_t: np.ndarray, next_d: np.ndarray) -> None:
        """Code the byte where it was seen, else the escape; then the next shorter context's counts without exclusions."""
        total = t[at]
        hit = n > 0
        logp[at[hit]] += np.log10((n[hit] - 0.5) / total[hit])
        open_[at[hit]] = False
        gone = at[~hit]
        some = d[gone] > 0
        logp[gone[some]] += np.log10(0.5 * d[gone[some]] / total[~hit][some])
        t[gone], d[gone] = next_t[~hit], next_d[~hit]

    # n-grams of each length and their counts, from the longest down; a context is its n-gram without the last byte.
    grams = {order + 1: (key[count > 0], count[count > 0].astype(float))}
    for n in range(order, 2, -1):
        short, inverse = np.unique(grams[n + 1][0] & ((1 << 8 * n) - 1), return_inverse=True)
        grams[n] = (short, np.bincount(inverse, grams[n + 1][1], len(short))) if n > 3 or last is None else last
    by = np.argsort(grams[order + 1][0])
    grams[order + 1] = tuple(x[by] for x in grams[order + 1])
    t1, d1 = pairs.sum(axis=1).astype(float), (pairs > 0).sum(axis=1).astype(float)
    for k in range(order, 1, -1):
        gram, n = grams[k + 1]
        if not len(gram):
            continue
        ctx, first = np.unique(gram >> 8, return_index=True)
        ct, cd = np.add.reduceat(n, first), np.diff(np.append(first, len(gram))).astype(float)
        # The next shorter context: its counts of the bytes seen here, and its totals.
        if k > 2:
            sg, sn = grams[k]
            sctx, sfirst = np.unique(sg >> 8, return_index=True)
            st, sd = np.add.reduceat(sn, sfirst), np.diff(np.append(sfirst, len(sg))).astype(float)
            parent = np.searchsorted(sctx, ctx & ((1 << 8 * (k - 1)) - 1))
            pt, pd_ = st[parent], sd[parent]
            shorter = sn[np.searchsorted(sg, gram & ((1 << 8 * k) - 1))]
        else:
            pt, pd_ = t1[ctx & 255], d1[ctx & 255]
            shorter = pairs[gram >> 8 & 255, gram & 255].astype(float)
        nt, nd = pt - np.add.reduceat(shorter, first), pd_ - cd
        at = np.flatnonzero(open_)
        mine = key[at] >> 8 & ((1 << 8 * k) - 1)
        row = np.minimum(np.searchsorted(ctx, mine), len(ctx) - 1)
        seen = ctx[row] == mine
        at, row, mine = at[seen], row[seen], mine[seen]
        fresh = t[at] < 0
        t[at[fresh]], d[at[fresh]] = ct[row[fresh]], cd[row[fresh]]
        whole = mine << 8 | sym[at]
        place = np.minimum(np.searchsorted(gram, whole), len(gram) - 1)
        settle(at, np.where(gram[place] == whole, n[place], 0.0), nt[row], nd[row])
    at = np.flatnonzero(open_)
    last = key[at] >> 8 & 255
    at, last = at[t1[last] > 0], last[t1[last] > 0]
    fresh = t[at] < 0
    t[at[fresh]], d[at[fresh]] = t1[last[fresh]], d1[last[fresh]]
    less = ((pairs > 0) * one[None, :]).sum(axis=1)
    settle(at, pairs[last, sym[at]].astype(float), t0 - less[last], d0 - d1[last])
    at = np.flatnonzero(open_)
    if t0 > 0:
        fresh = t[at] < 0
        t[at[fresh]], d[at[fresh]] = t0, d0
        settle(at, one[sym[at]].astype(float), np.zeros(len(at)), np.zeros(len(at)))
    logp[open_] -= np.log10(256 - d0)
    return logp


def blocked(docs: DataFrame, block_bytes: int, folds: int) -> DataFrame:
    """doc_id, text, held_out and block; blocks are even by hash, so no source or copy fills one."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + int(total) // block_bytes
    block = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(blocks)).cast("int")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_bucket("doc_id", folds) == 0).alias("held_out"), block.alias("block"))


def block_counts(rows: DataFrame, order: int) -> DataFrame:
    """(block, word, key, n): a block's distinct words (``key`` is ``WORD``), and events, and their training counts."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        learnt, met = Counter(), {END_WORD.encode()}
        texts: dict[bool, list[bytes]] = {False: [], True: []}
        for text, held_out in zip(group["text"], group["held_out"]):
            tokens = words(text if isinstance(text, str) else None)
            texts[bool(held_out)].append(coded(tokens, order))
            if held_out:
                met.update(tokens)
            else:
                learnt.update(tokens)
        learnt[END_WORD.encode()] = len(texts[False])
        for w in met - learnt.keys():
            learnt[w] = 0
        key, n = distinct_events(texts[False], order)
        other = np.setdiff1d(distinct_events(texts[True], order)[0], key)
        del texts
        found = len(learnt), len(key), len(other)
        word = np.full(sum(found), None, object)
        word[: found[0]] = [w.decode("utf-8", "replace") for w in learnt]
        keys = np.concatenate([np.full(found[0], WORD), key, other])
        counts = np.concatenate([np.fromiter(learnt.values(), np.int64, found[0]), n, np.zeros(found[2], np.int64)])
        return pd.DataFrame({"block": np.full(len(keys), group["block"].iloc[0], np.int32), "word": word, "key": keys, "n": counts}, copy=False)

    return rows.groupBy("block").applyInPandas(run, "block int, word string, key long, n long")


def event_costs(events: DataFrame, order: int, group_rows: int = 100_000) -> DataFrame:
    """(key, cost): log10 probability of every event, from (key, n)."""
    pairs = np.zeros((256, 256), np.int64)
    pair = (F.col("key").bitwiseAND(F.lit(65535))).alias("pair")
    for r in events.where("n > 0").groupBy(pair).agg(F.sum("n").alias("n")).collect():  # at most 65,536 rows
        pairs[r["pair"] >> 8, r["pair"] & 255] = r["n"]

    last = F.shiftright("key", 8).bitwiseAND(F.lit(65535))
    large = events.groupBy(last.alias("last")).agg(F.count("*").alias("rows")).where(F.col("rows") > group_rows)
    large = np.sort(np.array([r["last"] for r in large.select("last").collect()], np.int64))  # at most 65,536
    held = events.where(last.isin(large.tolist()) & (F.col("n") > 0)) if len(large) else None
    given = {int(x): {} for x in large}
    if held is not None:
        for r in held.groupBy(F.col("key").bitwiseAND(F.lit((1 << 24) - 1)).alias("gram")).agg(F.sum("n").alias("n")).collect():  # 256 a large pair
            given[r["gram"] >> 8][r["gram"]] = r["n"]
    thirds = {x: (np.array(sorted(n), np.int64), np.array([n[g] for g in sorted(n)], float)) for x, n in given.items()}

    def run(group: pd.DataFrame) -> pd.DataFrame:
        key = group["key"].to_numpy(np.int64)
        outside = thirds.get(int(key[0]) >> 8 & 65535)
        return pd.DataFrame({"key": key, "cost": code_lengths(key, group["n"].to_numpy(np.int64), pairs, order, outside)})

    third = F.when(last.isin(large.tolist()), F.shiftright("key", 24).bitwiseAND(F.lit(255))).otherwise(-1) if len(large) else F.lit(-1)
    grouped = events.select(last.alias("last"), third.alias("third"), "key", "n").groupBy("last", "third")
    return grouped.applyInPandas(run, "key long, cost double")


def score(docs: DataFrame, order: int = 5, folds: int = 10, block_bytes: int = 10 << 20, group_rows: int = 100_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Rows whose crc32 of the id modulo ``folds`` is 0 are held out of training. ``base_score`` is the
    smoothed unigram score of the same words. ``order`` is 2 to 6.
    """
    rows = blocked(docs.select("doc_id", "text"), block_bytes, folds)
    counted = block_counts(rows, order).groupBy("word", "key", F.shiftright("block", 6).alias("band"))
    counted = stored(counted.agg(F.sum("n").alias("n"), F.expr("bit_or(shiftleft(1L, block & 63))").alias("held")), "words-and-events")
    vocabulary = counted.where(F.col("key") == WORD).groupBy("word").agg(F.sum("n").alias("n"))
    sums = vocabulary.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    n, v = int(sums["n"] or 0), int(sums["v"])
    unigram = F.log10((F.col("n") + 0.1) / F.lit(n + 0.1 * (v + 1)))
    events = stored(counted.where(F.col("key") != WORD).groupBy("key").agg(F.sum("n").alias("n")), "events")
    costs = stored(event_costs(events, order, group_rows), "event-costs")
    known = vocabulary.select("word", unigram.alias("cost"), (F.col("n") > 0).alias("seen")).join(counted.where(F.col("key") == WORD).select("word", "band", "held"), "word")
    known = known.select("band", "held", "word", F.lit(WORD).cast("long").alias("key"), "cost", "seen")
    coded_ = counted.where(F.col("key") != WORD).select("key", "band", "held").join(costs, "key")
    known = known.union(coded_.select("band", "held", F.lit(None).cast("string").alias("word"), "key", "cost", F.lit(False).alias("seen")))
    known = known.select("*", F.explode(F.array(*map(F.lit, range(64)))).alias("bit")).where(F.expr("(held >> bit) & 1 = 1"))
    known = known.select((F.col("band") * 64 + F.col("bit")).alias("block"), "word", "key", "cost", "seen")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        key, cost = right["key"].to_numpy(np.int64), right["cost"].to_numpy(np.float64)
        by = np.argsort(key)  # words first
        of_words, of_events = np.split(by, [int((key == WORD).sum())])
        at = {w.encode("utf-8", "replace"): k for k, w in enumerate(right["word"].to_numpy()[of_words])}
        base, seen = cost[of_words], right["seen"].to_numpy(bool)[of_words]
        places, cost = Places(key[of_events]), cost[of_events]
        del right, key, by, of_words, of_events
        texts, found = [], []
        for doc, text, held_out in zip(left["doc_id"], left["text"], left["held_out"]):
            tokens = words(text if isinstance(text, str) else None)
            texts.append(coded(tokens, order))
            k = np.fromiter((at[w] for w in (*tokens, END_WORD.encode())), np.int64, len(tokens) + 1)
            found.append((None if pd.isna(doc) else int(doc), bool(held_out), len(k), int(seen[k].sum()), n, base[k].sum()))
        got = np.zeros(len(texts))
        for sizes, keys in chunks(texts, order):
            owner, length = np.array(sizes).T
            np.add.at(got, owner, np.add.reduceat(cost[places.of(keys)], np.cumsum(length) - length))
        out = pd.DataFrame(found, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"])
        return out.assign(score=got).astype({"doc_id": "Int64", "held_out": bool})

    fields = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(run, fields)
