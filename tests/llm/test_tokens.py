"""Packed token files and sequence packing: exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from indicatrix.llm import packing, token_ids
from indicatrix.llm.common import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(5, "Hello world, it's 12.5!"), (3, None), (4, ""), (-7, " lead\tand  double\n\nspace \n"), (9, "word " * 30_000), (5, "Hello world, it's 12.5!"),
        (None, "no id"), (11, "<|endoftext|> é日本 x"), (12, "a\n"), (13, "\x1c!! \xa0b")]


@pytest.fixture(scope="module")
def encoder():
    return token_ids.TextEncoder(PATH, capacity=50)


def ids_of(encoder, text):
    return np.frombuffer(encoder.plain(text or "") + (2).to_bytes(4, "little"), "<u4")


def test_encoder_equals_whole_texts(encoder):
    rng = random.Random(5)
    parts = ["a", "bc", " ", " ", ",", ".", "\n", "'s", "é", "1", "д", "\t", "  ", "||", "!", "\xa0", "日", "-", "AB", "\r"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert encoder(text) == encoder.plain(text), repr(text)


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 24, 31, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1001])
def test_packing_bits(bits, n):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, n, dtype=np.uint64)
    data = token_ids.pack(ids, bits)
    assert len(data) == -(-n // 8) * bits and (token_ids.unpack(data, bits, n) == ids).all()


def test_bits_for_a_vocabulary():
    assert [token_ids.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_files_round_trip(spark, encoder):
    df = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, text string, start int, n_tokens string")
    files = token_ids.write_packed(df, shared_folder(spark, "ids"), PATH, block=1024).collect()
    got = token_ids.packed_documents(df, PATH, block=1024).collect()
    at = 0
    assert len(got) == len(ROWS)
    rows = sorted(got, key=lambda r: r.start)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    for r, (doc_id, text) in zip(rows, order, strict=True):
        ids = ids_of(encoder, text)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    for f in files:  # any range of a file, across blocks
        reader, whole = token_ids.PackedReader(f.uri), []
        for k in range(len(reader.offsets)):
            whole.extend(reader.read_block(k).tolist())
        for a, b in [(0, 0), (0, 1), (0, f.n_ids), (min(1000, f.n_ids), min(3000, f.n_ids))]:
            assert reader.ids(a, b).tolist() == whole[a:b]


def test_no_documents_no_files(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_ids.packed_documents(empty, PATH).collect() == []
    assert packing.pack_documents(empty, PATH).collect() == []


def test_piece_lengths():
    assert packing.piece_lengths(1, 4) == [1] and packing.piece_lengths(4, 4) == [4] and packing.piece_lengths(9, 4) == [1, 4, 4]
    assert packing.piece_lengths(8, 4) == [4, 4]


def check_sequences(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pack_documents(spark, encoder):
    df = spark.createDataFrame([(*r, "s") for r in ROWS], "doc_id long, text string, size string")
    got = packing.pack_documents(df, PATH, capacity=64).collect()
    check_sequences(got, 64)
    want = []
    for doc_id, text in ROWS:
        ids, at = ids_of(encoder, text), 0
        for k, n in enumerate(packing.piece_lengths(len(ids), 64)):
            want.append((doc_id, k, at, n, zlib.crc32(ids[at:at + n].tobytes())))
            at += n
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)


def test_packing_is_near_the_bound(spark):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(1, 1025, 3000)]
    df = spark.createDataFrame([(k, n, "z") for k, n in enumerate(lengths)], "name long, length int, region string")
    got = packing.pack_pieces(df, region=1000)
    assert got.columns == ["name", "length", "region", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted((r.name, r.length) for r in rows) == list(enumerate(lengths))
    assert check_sequences(rows, 1024) <= 1.015 * sum(lengths) / 1024 + 3


def test_crossover_keeps_every_piece_once():
    packer = packing.Packer(np.random.default_rng(0).integers(1, 60, 200), 100, 7)
    one, two = packer.fresh(0), packer.fresh(30)
    for _ in range(20):
        child = packer.cross(one, two)
        assert (child >= 0).all() and np.bincount(child, packer.sizes).max() <= 100
        one, two = two, child
    assert packer.evolve([one, two], 4, 10)[0].shape == one.shape


def test_best_fit_takes_the_fullest_bin_with_room():
    packer = packing.Packer(np.array([60, 70, 30, 30, 40]), 100, 0)
    bins = packer.best_fit(np.full(5, -1), np.arange(5))
    assert bins.tolist() == [0, 1, 1, 0, 2]
