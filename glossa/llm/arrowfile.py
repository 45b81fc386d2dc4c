"""Operator 11: token ids as Arrow files of equal-length sequences.

A shard is an Arrow IPC file (a stream of record batches with a footer of their places). Its batches hold
``batch_rows`` rows each, the last fewer, of fixed-size lists: ``ids`` (the smallest unsigned type that holds
the vocabulary), ``real`` (false where the shard's last sequence is padded) and ``ends`` (true at a
document's last id). So sequence k is row k % batch_rows of batch k // batch_rows, and a memory-mapped file gives it as
a view, without a copy (``Sequences``). A second file beside it lists the shard's documents in order
(``doc_id``, ``length``).

Documents are dealt by ranges of (doc_id, hash of the text, a seeded number), so a shard follows the shard before it, and
no id, source or copied text fills one alone. Each task encodes its range in order and writes its shard batch by batch; it
holds one batch of ids, never a shard. Files get a fresh name for every attempt, and the manifest (one row a shard), committed by
Spark, names those of the attempts that counted. Reading goes shard by shard, batch by batch, in tasks as well.

Defined cases: a null or empty text is the one end id. Rows with a null id come first; repeated rows are
documents of their own, those with the same id in order of their texts' hashes. An empty table gives no shard and no
rows. Only ``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.common import stored
from glossa.llm.packing import encoder
from glossa.session import ensure_checkpoint_dir

MANIFEST = "shard int, path string, docs_path string, n_docs long, n_tokens long, n_sequences long"
DOCUMENTS = "doc_id long, shard int, at long, n_tokens long, ids_crc32 long"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI or plain path, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def id_type(n_ids: int) -> np.dtype:
    """The smallest little-endian unsigned type for ids below ``n_ids``."""
    return np.dtype("<u2") if n_ids <= 1 << 16 else np.dtype("<u4")


def sequence_schema(length: int, batch_rows: int, dtype: np.dtype) -> pa.Schema:
    of = lambda t: pa.list_(pa.field("item", t, nullable=False), length)
    columns = [pa.field("ids", of(pa.from_numpy_dtype(dtype)), nullable=False)]
    columns += [pa.field(name, of(pa.bool_()), nullable=False) for name in ("real", "ends")]
    return pa.schema(columns, metadata={"length": str(length), "batch_rows": str(batch_rows)})


DOCS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("length", pa.int64())])


class ShardWriter:
    """Writes documents' ids to one shard; holds one batch of sequences and of documents."""

    def __init__(self, folder: str, name: str, length: int, batch_rows: int, dtype: np.dtype) -> None:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        self.path, self.docs_path = f"{folder}/{name}.arrow", f"{folder}/{name}.docs.arrow"
        self.schema = sequence_schema(length, batch_rows, dtype)
        self.sinks = [system.open_output_stream(f"{base}/{name}{kind}.arrow") for kind in ("", ".docs")]
        self.sequences, self.docs = (pa.ipc.new_file(sink, schema) for sink, schema in zip(self.sinks, (self.schema, DOCS_SCHEMA)))
        self.length, self.dtype = length, dtype
        self.ids = np.zeros(batch_rows * length, dtype)
        self.ends = np.zeros(batch_rows * length, bool)
        self.at = self.n_docs = self.n_tokens = self.n_sequences = 0
        self.listed: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        done = 0
        while done < len(ids):
            n = min(len(ids) - done, len(self.ids) - self.at)
            self.ids[self.at : self.at + n] = ids[done : done + n]
            self.at, done = self.at + n, done + n
            if done == len(ids):
                self.ends[self.at - 1] = True
            if self.at == len(self.ids):
                self.flush()
        self.n_docs, self.n_tokens = self.n_docs + 1, self.n_tokens + len(ids)
        self.listed.append((doc_id, len(ids)))
        if len(self.listed) == 10_000:
            self.list_docs()

    def flush(self) -> None:
        rows = -(-self.at // self.length)
        used = rows * self.length
        self.ids[self.at : used] = 0
        real = np.arange(used) < self.at
        values = (pa.array(self.ids[:used]), pa.array(real), pa.array(self.ends[:used]))
        lists = [pa.FixedSizeListArray.from_arrays(v, type=t) for v, t in zip(values, self.schema.types)]
        self.sequences.write_batch(pa.record_batch(lists, schema=self.schema))
        self.n_sequences += rows
        self.ends[:] = False
        self.at = 0

    def list_docs(self) -> None:
        ids, lengths = zip(*self.listed)
        self.docs.write_batch(pa.record_batch([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64())], schema=DOCS_SCHEMA))
        self.listed = []

    def close(self) -> None:
        if self.at:
            self.flush()
        if self.listed:
            self.list_docs()
        for part in (self.sequences, self.docs, *self.sinks):
            part.close()


class Sequences:
    """Random access to a shard's sequences; on a local file system they are views of the mapped file."""

    def __init__(self, path: str) -> None:
        system, base = file_system(path)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(base) if local else system.open_input_file(base)
        self.file = pa.ipc.open_file(self.source)
        meta = self.file.schema.metadata
        self.length, self.batch_rows = int(meta[b"length"]), int(meta[b"batch_rows"])

    def __len__(self) -> int:
        n = self.file.num_record_batches
        return (n - 1) * self.batch_rows + self.file.get_batch(n - 1).num_rows if n else 0

    def batch(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Batch ``k``: ids (rows x length) and the bits of ``real`` and ``ends`` (rows x bytes), low bit first."""
        got = self.file.get_batch(k)
        ids = got.column(0).values.to_numpy(zero_copy_only=True).reshape(got.num_rows, self.length)
        if self.length % 8:
            masks = [np.packbits(c.values.to_numpy(zero_copy_only=False).reshape(got.num_rows, -1), axis=1, bitorder="little") for c in got.columns[1:]]
        else:
            width = self.length // 8
            masks = [np.frombuffer(c.values.buffers()[1], np.uint8, got.num_rows * width).reshape(got.num_rows, width) for c in got.columns[1:]]
        return ids, *masks

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not 0 <= k < len(self):
            raise IndexError(k)
        return tuple(part[k % self.batch_rows] for part in self.batch(k // self.batch_rows))

    def close(self) -> None:
        self.source.close()


def write(
    docs: DataFrame,
    folder: str | None = None,
    length: int = 2048,
    vocabulary: str = "byte_bpe_50k",
    n_ids: int = 50_257,
    end_id: int = 0,
    shard_bytes: int = 32 << 20,
    batch_rows: int = 64,
) -> DataFrame:
    """Write ``docs`` (doc_id, text) as shards of about ``shard_bytes`` of text in ascending doc_id order; returns the manifest.

    ``folder`` is one that all executors share, by default a new one under ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/glossa-llm/sequences-{uuid.uuid4().hex[:12]}"
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + int(total) // shard_bytes
    dtype = id_type(n_ids)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"), F.rand(11).alias("salt"))
    order = ["doc_id", "hash", "salt"]
    dealt = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("shard"), "doc_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, writer, shard = encoder(vocabulary), None, None
        for batch in batches:
            if writer is None and len(batch):
                shard = int(batch["shard"].iloc[0])
                writer = ShardWriter(folder, f"shard-{shard:07d}-{uuid.uuid4().hex[:12]}", length, batch_rows, dtype)
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encode(text if isinstance(text, str) else ""), end_id)
                writer.add(None if pd.isna(doc) else int(doc), ids.astype(dtype, casting="unsafe"))
        if writer is not None:
            writer.close()
            yield pd.DataFrame([(shard, writer.path, writer.docs_path, writer.n_docs, writer.n_tokens, writer.n_sequences)], columns=[c.split()[0] for c in MANIFEST.split(", ")])

    return stored(dealt.mapInPandas(run, MANIFEST), "sequence-manifest")


def shard_documents(path: str, docs_path: str) -> Iterator[tuple[int | None, int, int, int]]:
    """(doc_id, place in the shard, number of ids, crc32 of the ids as 32-bit integers) of a shard's documents, from its files."""
    system, base = file_system(docs_path)
    with system.open_input_file(base) as source:
        file = pa.ipc.open_file(source)
        listed = (row for k in range(file.num_record_batches) for row in zip(*(c.to_pylist() for c in file.get_batch(k).columns)))
        sequences = Sequences(path)
        crc = n = at = 0
        for k in range(sequences.file.num_record_batches):
            ids, real, ends = sequences.batch(k)
            wide = ids.reshape(-1).astype("<u4")
            bits = [np.unpackbits(m, axis=1, count=sequences.length, bitorder="little").reshape(-1) for m in (real, ends)]
            done = 0
            for end in np.flatnonzero(bits[1]) + 1:
                doc_id, length = next(listed)
                crc, n = zlib.crc32(wide[done:end], crc), n + int(end) - done
                if n != length:
                    raise ValueError(f"{path}: document {doc_id} has {n} ids, its list says {length}")
                yield doc_id, at, n, crc
                at, done, crc, n = at + n, int(end), 0, 0
            last = int(bits[0].sum())
            crc, n = zlib.crc32(wide[done:last], crc), n + last - done
        sequences.close()


def read(manifest: DataFrame) -> DataFrame:
    """Per document, from the files of ``manifest``: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, path, docs_path in zip(batch["shard"], batch["path"], batch["docs_path"]):
                rows = []
                for row in shard_documents(path, docs_path):
                    rows.append((row[0], int(shard), *row[1:]))
                    if len(rows) == 10_000:
                        yield frame(rows)
                        rows = []
                if rows:
                    yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["doc_id", "shard", "at", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    shards = max(1, manifest.count())
    found = manifest.select("shard", "path", "docs_path").repartitionByRange(shards, "shard").mapInPandas(run, DOCUMENTS)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    base = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return found.join(base, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
