import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from glossa.llm import arrowfile, queries
from glossa.llm.common import table
from tests.conftest import SF_SMALL

TEXTS = ["", None, "a", "Thé idiot <|endoftext|> x", "! ! !", "two words\n\n  and\tmore 12345 \U0001f600", "word " * 5000, "z" * 9000]
SCHEMA = "doc_id long, text string, start string, shard int, hash string"


def plain(rows):
    """(doc_id, start, n_tokens, ids_crc32) by the JSON tokenizer, in doc_id order."""
    json = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*json.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_against_the_json_tokenizer(spark):
    rows = [(k * 7 % 101, TEXTS[k % len(TEXTS)]) for k in range(40)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    for length, shard_bytes in ((16, 20_000), (2048, 32 << 20), (7, 5_000)):
        manifest = arrowfile.write(df, length=length, shard_bytes=shard_bytes, batch_rows=4)
        got = sorted(tuple(r) for r in arrowfile.read(manifest).collect())
        assert got == plain(rows)
        files = manifest.orderBy("shard").collect()
        assert len(files) > 1 or shard_bytes > 1 << 20
        assert [f["n_sequences"] for f in files] == [len(arrowfile.Sequences(f["path"])) for f in files]


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "one"), (None, "one"), (5, "two words"), (5, "two words"), (5, None)]
    got = [tuple(r) for r in arrowfile.read(arrowfile.write(spark.createDataFrame(rows, "doc_id long, text string"))).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, None, 5, 5, 5]
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]


def test_empty_table(spark):
    assert arrowfile.read(arrowfile.write(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_sequences_are_views_of_the_mapped_file(spark):
    docs = table(spark, SF_SMALL, "documents")
    file = arrowfile.write(docs, length=64).collect()[0]
    sequences = arrowfile.Sequences(file["path"])
    before = pa.total_allocated_bytes()
    ids, real, ends = sequences[len(sequences) // 2]
    assert ids.shape == (64,) and ids.dtype == np.uint16 and not ids.flags.writeable and not ids.flags.owndata
    assert pa.total_allocated_bytes() == before  # nothing was copied into memory
    assert np.unpackbits(real, bitorder="little").all()
    last = sequences[len(sequences) - 1][1]
    assert np.unpackbits(last, bitorder="little").sum() == (file["n_tokens"] - 1) % 64 + 1
    assert sum(int(np.unpackbits(sequences[k][2]).sum()) for k in range(len(sequences))) == file["n_docs"]
    with pytest.raises(IndexError):
        sequences[len(sequences)]


def test_a_list_that_differs_is_an_error(spark):
    rows = [(1, "some words here"), (2, "more words")]
    a, b = (arrowfile.write(spark.createDataFrame(rows[k:], "doc_id long, text string")).first() for k in (0, 1))
    with pytest.raises(ValueError, match="its list says"):
        list(arrowfile.shard_documents(a["path"], b["docs_path"]))


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in queries.op11_arrow_sequences(spark, SF_SMALL).collect()) == plain(rows)
