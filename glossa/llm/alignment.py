"""Operator 12: two tokenizers' ids aligned by inverted pair bitmaps.

The text's byte-level ids (A) and piece ids (B) cover the same bytes. Each stretch between neighbouring
ends of either lies in one A and one B token, so it is a link; ends that both share close a group.

The index is inverted: for a pair (A id, B id), the documents that hold it, as compressed bitmaps. Documents are numbered
within blocks of at most 65,536 documents and about ``block_bytes`` of text. A block's documents of a pair are bit planes: plane j
holds the documents whose number of links has bit j set, as an array of 16-bit numbers or, where that is shorter, as
plain bits. A task reads a block in chunks whose postings are OR-merged into the block's. The union of a
pair's planes is its document bitmap; planes' popcounts, kept beside them, give the pair's documents and links, and
their sums over blocks (combined before they move) the corpus' counts. The pairs' scores go back to the blocks
along the postings, where the planes are unpacked and scores summed per document.

No task holds more than one block, whatever pair, text or source is frequent; a pair has one row a block and plane.

Defined cases: a text that is null or empty, or whose tokens of either kind do not spell a space and the text, has no tokens: zeros, and the digest ''.
Repeated rows count, and are returned, each for itself; a null id is a row like others. An empty table gives no rows. Only
``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import stored

#: Bits of a pair's B id, and of a document's number in its block.
B_BITS, ORD_BITS = 24, 16
#: Bytes of text whose links are found at a time.
CHUNK = 1 << 20
POSTINGS = pa.schema(
    [("block", pa.int64()), ("ord", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
     ("groups_sha256", pa.string()), ("pair", pa.int64()), ("plane", pa.int32()), ("n", pa.int64()), ("n_docs", pa.int64()), ("bits", pa.binary())]
)
ROWS = "block long, ord int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, plane int, n long, n_docs long, bits binary"


class Vocabulary:
    """Ids to bytes: ``tokens[id]``, their lengths, and the digits of each id."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        width = len(str(len(tokens)))
        digits = np.frombuffer(b"".join(str(i).encode().ljust(width, b"\0") for i in range(len(tokens))), np.uint8)
        self.digits = digits.reshape(len(tokens), width)

    def spells(self, ids: list[int], raw: bytes) -> bool:
        return b"".join([self.tokens[i] for i in ids]) == raw


def byte_level(vocabulary: str):
    """(encode, Vocabulary) of the byte-level tokenizer; special tokens' strings are plain text.

    The rank file is the JSON file's vocabulary and gives the same ids (tested) in a third of the time; the JSON tokenizer
    takes over where the rank library refuses a text.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact: list = []

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except Exception:  # the rank library's pattern engine gives up on some texts
            if not exact:
                exact.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
                exact[0].encode_special_tokens = True
            return exact[0].encode(text, add_special_tokens=False).ids

    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return encode, Vocabulary(tokens)


def pieces(vocabulary: str):
    """(encode, Vocabulary) of the piece tokenizer, which puts a space before the text."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{vocabulary}.model"))

    def spelled(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return model.encode, Vocabulary([spelled(i) for i in range(model.get_piece_size())])


def links(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the links, their A and B occurrences, and which ends both kinds share; a and b cover the same bytes."""
    a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    mark = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, np.uint8)
    mark[a_ends] = 1
    mark[b_ends] |= 2
    ends = np.flatnonzero(mark)
    kind = mark[ends]
    of_a, of_b = (kind & 1).astype(np.int64), (kind >> 1).astype(np.int64)
    return ends, np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b, kind == 3


def group_text(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, va: Vocabulary, vb: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;...`` of all documents in a row as bytes, and the bytes up to each group's end."""
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    width = max(va.digits.shape[1], vb.digits.shape[1]) + 1
    out = np.zeros((len(a) + len(b), width), np.uint8)
    a_last, b_last = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
    a_at = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[a_group]
    b_at = np.arange(len(b)) + np.cumsum(n_a)[b_group]
    out[a_at, : va.digits.shape[1]] = va.digits[a]
    out[b_at, : vb.digits.shape[1]] = vb.digits[b]
    out[:, -1] = ord(",")
    out[a_at[a_last], -1] = ord("|")
    out[b_at[b_last], -1] = ord(";")
    flat = out.reshape(-1)
    kept = flat != 0
    ends = np.cumsum(np.count_nonzero(kept.reshape(out.shape), axis=1))[b_at[b_last]] if groups else np.empty(0, np.int64)
    return flat[kept], ends


class Block:
    """A block under construction: its documents' rows and its postings so far."""

    def __init__(self, number: int, a_kind, b_kind) -> None:
        self.number, (self.encode_a, self.va), (self.encode_b, self.vb) = number, a_kind, b_kind
        self.docs: list[tuple] = []
        self.chunk: list[tuple[int | None, list[int], list[int], int]] = []
        self.size = self.pending = 0
        self.keys, self.counts = [], []

    def add(self, doc_id: int | None, text: str | None) -> None:
        a = b = []
        raw = (" " + (text or "")).encode("utf-8", "replace")
        if text:
            a, b = self.encode_a(" " + text), self.encode_b(text)
            if not (self.va.spells(a, raw) and self.vb.spells(b, raw)):
                a = b = []
        self.chunk.append((doc_id, a, b, len(raw) if len(a) else 0))
        self.size, self.pending = self.size + len(raw), self.pending + len(raw)
        if self.pending >= CHUNK:
            self.link()

    def link(self) -> None:
        """Find the links of the chunk's documents, and add their rows and postings."""
        n = len(self.chunk)
        a, b = (np.fromiter((i for doc in self.chunk for i in doc[k]), np.int64, sum(len(doc[k]) for doc in self.chunk)) for k in (1, 2))
        doc_end = np.cumsum([doc[3] for doc in self.chunk])
        ends, a_at, b_at, shared = links(a, b, self.va.sizes, self.vb.sizes)
        doc = np.searchsorted(doc_end, ends)
        n_links, n_groups = np.bincount(doc, minlength=n), np.bincount(doc[shared], minlength=n)
        # An occurrence's last link ends with it; groups before that end are those it follows.
        group = np.cumsum(shared) - shared
        a_group, b_group = (group[np.append(np.flatnonzero(np.diff(at)), len(at) - 1)] if len(at) else at for at in (a_at, b_at))
        text, group_ends = group_text(a, b, a_group, b_group, self.va, self.vb)
        first, at, base = 0, 0, len(self.docs)
        for k, (doc_id, ids_a, ids_b, _) in enumerate(self.chunk):
            digest = ""
            if n_groups[k]:
                at += int(n_groups[k])
                digest = hashlib.sha256(text[first : group_ends[at - 1] - 1]).hexdigest()
                first = int(group_ends[at - 1])
            self.docs.append((doc_id, len(ids_a), len(ids_b), int(n_groups[k]), int(n_links[k]), digest))
        pair = (a[a_at] << B_BITS) | b[b_at]
        key, count = np.unique((pair << ORD_BITS) | (base + doc), return_counts=True)
        self.keys.append(key)
        self.counts.append(count)
        self.chunk, self.pending = [], 0

    def tables(self) -> Iterator[pa.RecordBatch]:
        """The block's documents, then its postings plane by plane."""
        if self.chunk:
            self.link()
        doc_id, *numbers, digest = zip(*self.docs)
        columns = [pa.array(doc_id, pa.int64()), *(pa.array(x, pa.int64()) for x in numbers), pa.array(digest, pa.string())]
        yield batch(self.number, len(doc_id), dict(zip(POSTINGS.names[2:8], columns)) | {"ord": pa.array(np.arange(len(doc_id), dtype=np.int32))})
        # Chunks hold different documents: the OR of their bitmaps is their entries in one order.
        key, count = np.concatenate(self.keys), np.concatenate(self.counts)
        by = np.argsort(key)
        key, count = key[by], count[by]
        pair, place = key >> ORD_BITS, (key & ((1 << ORD_BITS) - 1)).astype("<u2")
        new = np.diff(pair, prepend=-1) != 0
        union = np.diff(np.append(np.flatnonzero(new), len(pair)))  # documents of each pair
        row = np.cumsum(new) - 1
        low = np.zeros(len(union), np.int64)  # a pair's lowest plane carries its number of documents
        for k in range(int(count.max()).bit_length() if len(count) else 0):
            held = np.flatnonzero(count >> k & 1)
            if not len(held):
                continue
            starts = np.flatnonzero(np.diff(row[held], prepend=-1) != 0)
            of = row[held][starts]
            n = np.diff(np.append(starts, len(held)))
            n_docs = np.where(low[of] == 0, union[of], 0)
            low[of] = 1
            bits = containers(place[held], starts, n, len(self.docs))
            yield batch(self.number, len(n), {"pair": pa.array(pair[held][starts]), "plane": pa.array(np.full(len(n), k, np.int32)), "n": pa.array(n), "n_docs": pa.array(n_docs), "bits": bits})


def batch(number: int, rows: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    columns["block"] = pa.array(np.full(rows, number, np.int64))
    return pa.record_batch([columns.get(f.name, pa.nulls(rows, f.type)) for f in POSTINGS], schema=POSTINGS)


def containers(place: np.ndarray, starts: np.ndarray, n: np.ndarray, n_docs: int) -> pa.Array:
    """Rows' sorted places as bytes: 16-bit numbers, or plain bits where those are shorter."""
    words = -(-n_docs // 16)  # of 16 bits
    dense = n > words
    size = np.where(dense, words, n)
    offset = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), "<u2")
    row = np.repeat(np.arange(len(n)), n)
    sparse = ~dense[row]
    data[(offset[row] + np.arange(len(place)) - starts[row])[sparse]] = place[sparse]
    for r in np.flatnonzero(dense):
        bits = np.zeros(words * 16, np.uint8)
        bits[place[starts[r] : starts[r] + n[r]]] = 1
        data[offset[r] : offset[r] + words] = np.packbits(bits, bitorder="little").view("<u2")
    ends = np.append(0, np.cumsum(size * 2)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def unpack(n: np.ndarray, bits: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every entry of the rows' containers."""
    size = np.fromiter(map(len, bits), np.int64, len(bits))
    sparse = size == 2 * n
    rows = [np.repeat(np.flatnonzero(sparse), n[sparse])]
    places = [np.frombuffer(b"".join([bits[r] for r in np.flatnonzero(sparse)]), "<u2").astype(np.int64)]
    for r in np.flatnonzero(~sparse):
        found = np.flatnonzero(np.unpackbits(np.frombuffer(bits[r], np.uint8), bitorder="little"))
        rows.append(np.full(len(found), r))
        places.append(found)
    return np.concatenate(rows), np.concatenate(places)


def index(docs: DataFrame, a: str = "byte_bpe_50k", b: str = "piece_bpe_32k", block_bytes: int = 8 << 20) -> DataFrame:
    """The documents' rows and the postings of every block (rows with a ``pair``), in one stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = byte_level(a), pieces(b)
        number = TaskContext.get().partitionId() << 32
        block = Block(number, *kinds)
        for given in batches:
            for doc_id, text in zip(*(given.column(k).to_pylist() for k in (0, 1))):
                if block.size >= block_bytes or len(block.docs) + len(block.chunk) == 1 << ORD_BITS:
                    yield from block.tables()
                    number += 1
                    block = Block(number, *kinds)
                block.add(doc_id, text)
        if block.docs or block.chunk:
            yield from block.tables()

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS), "pair-index")


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, a, b, docs, links) over the corpus, from the planes' popcounts, and whether it is its B id's most frequent pair."""
    counted = postings.where("pair IS NOT NULL").groupBy("pair").agg(
        F.sum("n_docs").alias("docs"), F.sum(F.expr("shiftleft(n, plane)")).alias("links")
    )
    counted = stored(
        counted.select("pair", F.shiftright("pair", B_BITS).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)).alias("b"), "docs", "links"), "pair-counts"
    )
    top = counted.groupBy("b").agg(F.max("links").alias("top"))  # at most one row an id of the B vocabulary
    return counted.join(top, "b").select("pair", "a", "b", "docs", "links", (F.col("links") == F.col("top")).alias("best"))


def align(docs: DataFrame, a: str = "byte_bpe_50k", b: str = "piece_bpe_32k", block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    rows = index(docs, a, b, block_bytes)
    scores = pair_counts(rows).select("pair", "links", "best")
    # Pairs grow with the corpus, so they are merged with the postings at every size, never broadcast.
    postings = rows.where("pair IS NOT NULL").select("block", "pair", "plane", "n", "bits").join(scores.hint("merge"), "pair").select("block", "plane", "n", "bits", "links", "best")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        row, place = unpack(group["n"].to_numpy(np.int64), group["bits"].tolist())
        times = np.int64(1) << group["plane"].to_numpy(np.int64)
        best, count = times * group["best"].to_numpy(bool), times * group["links"].to_numpy(np.int64)
        size = int(place.max()) + 1 if len(place) else 0
        n_best, count_sum = np.zeros(size, np.int64), np.zeros(size, np.int64)
        np.add.at(n_best, place, best[row])
        np.add.at(count_sum, place, count[row])
        ords = np.unique(place)
        return pd.DataFrame({"block": group["block"].iloc[0], "ord": ords.astype(np.int32), "n_best": n_best[ords], "count_sum": count_sum[ords]})

    scored = postings.groupBy("block").applyInPandas(run, "block long, ord int, n_best long, count_sum long")
    documents = rows.where("pair IS NULL").select("block", "ord", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return documents.join(scored, ["block", "ord"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
