"""Token files, token counts and the range coder: exact round trips."""

import random
import sys
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stockroom.llm import encode, range_coder, token_count, token_file
from stockroom.llm.common import vocabulary

BYTE = vocabulary("byte_bpe_50k.json")
ODD = [(3, None), (1, ""), (2, "a b"), (2, "a c"), (2, "a b"), (None, "<|endoftext|>!!"), (7, "w " * 30_000), (5, " \n")]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65535) | st.integers(0, 3), max_size=120), max_size=12))
def test_round_trip(blocks):
    blocks = [np.array(b, np.uint16) for b in blocks]
    tables = range_coder.Tables.of(blocks)
    payloads = range_coder.encode(blocks, tables)
    stored = range_coder.Tables.unpack(tables.pack())
    again = range_coder.decode(payloads, [len(b) for b in blocks], stored)
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(blocks, again, strict=True))


def test_blocks_are_independent():
    rng = np.random.default_rng(0)
    blocks = [rng.zipf(1.3, n).clip(0, 50_000).astype(np.uint16) for n in (900, 17, 4000, 0)]
    tables = range_coder.Tables.of(blocks)
    together = range_coder.encode(blocks, tables)
    assert together == [range_coder.encode([b], tables)[0] for b in blocks]
    assert (range_coder.decode([together[2]], [4000], tables)[0] == blocks[2]).all()


def test_context_pays():
    rng = np.random.default_rng(1)
    chain = np.array([5, 900, 31, 7, 20_000], np.uint16)
    steady = np.tile(chain, 800)
    noise = rng.integers(0, 50_000, 4000).astype(np.uint16)
    few = rng.choice(np.array([3, 40, 500, 6000], np.uint16), 4000)
    sizes = []
    for block in (steady, noise, few):
        tables = range_coder.Tables.of([block])
        sizes.append(8 * len(range_coder.encode([block], tables)[0]) / 4000)
    assert sizes[0] < 0.3 and sizes[1] < 17.5 and sizes[2] < 4


def order_0_bits(ids):
    counts = np.unique(ids, return_counts=True)[1]
    return -(counts * np.log2(counts / len(ids))).sum()


def test_smaller_than_order_0():
    """Blocks of real text, with the tables, take fewer bits than each block's own order-0 entropy."""
    docs = pq.read_table("/root/testdata/sf0.1/documents.parquet").sort_by("doc_id").column("text")
    library = encode.Encoder(BYTE)
    flat = np.frombuffer(b"".join(t + b"\0\0" for t in library.encode(docs.to_pylist())), np.uint16)
    for size, n in ((2048, 5_000_000), (8192, 1_000_000)):
        blocks = [flat[k : k + size] for k in range(0, n, size)]
        tables = range_coder.Tables.of(blocks)
        bits = 8 * (len(tables.pack()) + sum(map(len, range_coder.encode(blocks, tables))))
        assert bits < sum(map(order_0_bits, blocks))


def test_carry():
    """A carry runs back over full digits of its lane, and no farther."""
    writer = range_coder.Writer(2, 4)
    writer.out[:3], writer.out[writer.row : writer.row + 3] = (5, 0xFFFF, 0xFFFF), (7, 8, 9)
    writer.at += 3
    writer._carry(np.array([0, 1]))
    assert writer.out[:3].tolist() == [6, 0, 0]
    assert writer.out[writer.row : writer.row + 3].tolist() == [7, 8, 10]


def test_hard_ids():
    """Ids that fare worst in each decision, in as many blocks as a group has, and few searches and fetches for a step."""
    rng = np.random.default_rng(2)
    rare = rng.permutation(1 << 16).astype(np.uint16)
    tiled = [np.tile(rng.integers(0, 9, 7), 9).astype(np.uint16) for _ in range(2600)]
    blocks = [np.concatenate([t, rare[25 * k : 25 * k + 25]]) for k, t in enumerate(tiled)]
    tables = range_coder.Tables.of(blocks)
    calls = 0

    def count(_, event, what):
        nonlocal calls
        calls += event == "c_call" and getattr(what, "__name__", "") in ("searchsorted", "take", "concatenate", "nonzero")

    sys.setprofile(count)
    try:
        payloads = range_coder.encode(blocks, tables)
        encoding, calls = calls, 0
        again = range_coder.decode(payloads, [len(b) for b in blocks], tables)
    finally:
        sys.setprofile(None)
    assert all((x == y).all() for x, y in zip(blocks, again, strict=True))
    assert encoding < 20 * 88 and calls < 20 * 88


def expected(rows, end):
    library = Tokenizer.from_file(BYTE)
    out, at = [], 0
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("small", [True, False])
def test_token_file(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    how = token_file.Settings(BYTE, block=700, lanes=9, file_bytes=60_000) if small else token_file.Settings(BYTE)
    files = token_file.write(docs.orderBy(F.rand(3)), how)
    assert files.count() > 3 or not small
    got = sorted(map(tuple, token_file.read(files, how).collect()))
    assert got == expected(sorted(map(tuple, docs.collect())), 0)


def test_token_file_odd_rows(spark):
    how = token_file.Settings(BYTE, block=100)
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("h", F.lit(1))
    got = token_file.read(token_file.write(docs, how), how).collect()
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    names = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert names == [None, 1, 2, 2, 2, 3, 5, 7]
    want = [(d, n, c) for d, _, n, c in expected(ODD, 0)]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert token_file.read(token_file.write(docs.limit(0), how), how).isEmpty()


def test_damage_is_found(spark, tmp_path):
    how = token_file.Settings(BYTE, block=50)
    path = tmp_path / "x.toks"
    with open(path, "wb") as sink:
        writer = token_file.FileWriter(sink, how)
        for k in range(9):
            writer.add(k, np.arange(k * 10, k * 10 + 30, dtype=np.uint16))
        writer.close()
    files = lambda: spark.createDataFrame([(0, f"file://{path}", 9, 270, 1)], "file long, path string, n_docs long, n_ids long, n_bytes long")
    assert token_file.read(files(), how).count() == 9
    whole = path.read_bytes()
    tables = 4 + token_file.GROUP.unpack_from(whole, 4)[1] + token_file.GROUP.size
    for place in (30, tables + 4, tables + 30):  # in the tables, in a block's head, in its payload
        data = bytearray(whole)
        data[place] ^= 1
        path.write_bytes(data)
        with pytest.raises(Exception, match="Damaged"):
            token_file.read(files(), how).collect()


@pytest.mark.parametrize("block", [1 << 22, 64, 1])
def test_flat_counts(spark, block, tmp_path):
    rng = random.Random(4)
    want, rows = [], []
    sizes = ([0, 0, 5, 0, 130, 1, 64, 63], [200], [], [1] * 20, [0])
    for file, docs in enumerate(sizes):
        ended = file != 1
        flat, at = [], 0
        for doc, n in enumerate(docs):
            last = doc == len(docs) - 1
            want.append((file, doc, at, n, ended or not last))
            flat += [rng.randrange(50_000) for _ in range(n)] + [50256] * (ended or not last)
            at = len(flat)
        path = tmp_path / f"{file}.ids"
        path.write_bytes(np.array(flat, "<u2").tobytes())
        rows.append((file, f"file://{path}", 2 * len(flat)))
    files = spark.createDataFrame(rows, "file long, path string, n_bytes long")
    got = token_count.counts(files, token_count.Settings(block=block)).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_half_an_id(spark):
    files = spark.createDataFrame([(0, "file:///x", 3)], "file long, path string, n_bytes long")
    with pytest.raises(Exception, match="within an id"):
        token_count.counts(files).collect()


def test_documents_to_counts(spark):
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    docs = docs.union(spark.createDataFrame([(t,) for _, t in ODD], "text string"))
    texts = [r.text or "" for r in docs.collect()]
    got = token_count.counts(token_count.write_flat(docs, BYTE)).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(library.encode(t, add_special_tokens=False).ids) for t in texts)
    assert all(r.ended for r in got)
    assert token_count.counts(token_count.write_flat(docs.limit(0), BYTE)).isEmpty()
