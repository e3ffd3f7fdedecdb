"""Token ids in fixed-width bit-packed files, with block offsets for vectorised unpacking and random access.

A file holds blocks of ``BLOCK`` ids, each id in as many bits as the vocabulary needs, eight ids in that many bytes. After
the blocks come their offsets, the documents' identifiers (with a null mask) and lengths, and a trailer of fixed size.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import of_worker, shared_folder

BLOCK = 1 << 16
MAGIC = b"bitpack1"
TRAILER = struct.Struct("<QQQQQQ8s")  # ids, documents, blocks, bits, ids per block, offset of the footer, magic
#: The visible characters that byte-level vocabularies use for the 256 byte values.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _SHOWN)}
#: White space (and characters that libraries class differently) inside a word: such texts are encoded whole.
_ODD = re.compile("[\t-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class _OddSpace(Exception):
    pass


class _Words(dict):
    """Ids of the words after a space (or at a line's start), as little-endian unsigned 32-bit bytes, found when first asked for.

    Two generations of at most ``capacity`` words each: a word asked for again moves to the young one.
    """

    def __init__(self, encoder: TextEncoder, lead: str, capacity: int):
        self.encoder, self.lead, self.capacity, self.old = encoder, lead, capacity, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.found(word)
        self[word] = ids
        return ids

    def found(self, word: str) -> bytes:
        if word.isalpha():  # one unit of the pattern, so the model alone decides
            shown = self.lead + (word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES))
            return b"".join([self.encoder.as_bytes[t.id] for t in self.encoder.model.tokenize(shown)])
        core = word.rstrip(_MARKS)
        if core != word and core.isalpha():  # the pattern splits between letters and such marks, and keeps the marks together
            return self[core] + self.encoder.marks[word[len(core):]]
        if not word or _ODD.search(word):
            raise _OddSpace
        return self.encoder.plain((" " if self.lead else "") + word)

    def age(self) -> None:
        if len(self) > self.capacity:
            self.old = dict(self)
            self.clear()


class TextEncoder:
    """A text's ids as bytes of little-endian unsigned 32-bit integers, equal to encoding the whole text.

    The pattern of byte-level vocabularies always splits before a space that follows a word and around a single newline,
    so words are encoded once each and remembered (a bounded number of them); texts with any other white space are
    encoded whole. Special tokens' strings are ordinary text.
    """

    def __init__(self, path: str, capacity: int = 300_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.n_ids = self.whole.get_vocab_size()
        self.as_bytes = [k.to_bytes(4, "little") for k in range(self.n_ids)]
        self.spaced = _Words(self, _BYTES[32], capacity)
        self.bare, self.marks = _Words(self, "", capacity // 4), _Words(self, "", capacity // 4)
        self.newline = self.plain("\n")

    def plain(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        spaced, bare, out = self.spaced.__getitem__, self.bare, []
        lines = text.split("\n")
        try:
            for k, line in enumerate(lines):
                first, *rest = line.split(" ")
                if k:
                    out.append(self.newline)
                    if not line and k == len(lines) - 1 and lines[k - 1]:
                        break
                out.append(bare[first])
                out.extend(map(spaced, rest))
        except _OddSpace:
            return self.plain(text)
        for words in (self.spaced, self.bare, self.marks):
            words.age()
        return b"".join(out)


def text_encoder(path: str) -> TextEncoder:
    """The process's encoder: a worker keeps its words from task to task."""
    return of_worker("token ids", path, lambda: TextEncoder(path))


def bits_for(n_ids: int) -> int:
    return max(1, int(n_ids - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids to ``bits`` bytes, least significant bit first; the last group is filled up with zeros."""
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    groups.reshape(-1)[:len(ids)] = ids
    out = np.zeros((len(groups), bits), np.uint8)
    for k in range(8):
        at, shift = divmod(k * bits, 8)
        value = groups[:, k] << np.uint64(shift)
        for j in range(-(-(shift + bits) // 8)):
            out[:, at + j] |= (value >> np.uint64(8 * j)).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    packed = np.frombuffer(data, np.uint8, -(-count // 8) * bits).reshape(-1, bits)
    out, mask = np.empty((len(packed), 8), np.uint32), np.uint64((1 << bits) - 1)
    for k in range(8):
        at, shift = divmod(k * bits, 8)
        value = np.zeros(len(packed), np.uint64)
        for j in range(-(-(shift + bits) // 8)):
            value |= packed[:, at + j].astype(np.uint64) << np.uint64(8 * j)
        out[:, k] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:count]


class PackedWriter:
    def __init__(self, stream, bits: int, block: int = BLOCK):
        self.stream, self.bits, self.block = stream, bits, block
        self.held, self.n_held, self.n_ids, self.at = [], 0, 0, 0
        self.offsets, self.docs, self.lengths = [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block:
            self._flush(self.n_held - self.n_held % self.block)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        for at in range(0, n, self.block):
            data = pack(ids[at:min(at + self.block, n)], self.bits)
            self.offsets.append(self.at)
            self.stream.write(data)
            self.at += len(data)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.n_held)
        nulls = np.array([d is None for d in self.docs], np.uint8)
        docs = np.array([d or 0 for d in self.docs], "<i8")
        for x in (np.array(self.offsets, "<u8"), docs, nulls, np.array(self.lengths, "<u8")):
            self.stream.write(x.tobytes())
        self.stream.write(TRAILER.pack(self.n_ids, len(docs), len(self.offsets), self.bits, self.block, self.at, MAGIC))
        self.stream.close()


class PackedReader:
    """Random access to a file's ids: only the blocks asked for are read."""

    def __init__(self, uri: str):
        files, path = fs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        self.n_ids, self.n_docs, n_blocks, self.bits, self.block, footer, magic = TRAILER.unpack(
            self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no packed id file")
        rest = self.file.read_at(size - TRAILER.size - footer, footer)
        self.offsets = np.frombuffer(rest, "<u8", n_blocks)
        self.docs = np.frombuffer(rest, "<i8", self.n_docs, 8 * n_blocks)
        self.nulls = np.frombuffer(rest, np.uint8, self.n_docs, 8 * (n_blocks + self.n_docs)).astype(bool)
        self.lengths = np.frombuffer(rest, "<u8", self.n_docs, 8 * n_blocks + 9 * self.n_docs).astype(np.int64)

    def read_block(self, k: int) -> np.ndarray:
        count = min(self.block, self.n_ids - k * self.block)
        return unpack(self.file.read_at(-(-count // 8) * self.bits, int(self.offsets[k])), self.bits, count)

    def ids(self, start: int, end: int) -> np.ndarray:
        parts = [self.read_block(k) for k in range(start // self.block, -(-end // self.block))] if end > start else []
        base = start // self.block * self.block
        return np.concatenate(parts)[start - base:end - base] if parts else np.empty(0, np.uint32)


def write_packed(docs: DataFrame, folder: str, tokenizer: str, *, text: str = "text", doc_id: str = "doc_id",
                 end_id: int = 2, block: int = BLOCK) -> DataFrame:
    """Write packed files in ascending doc_id order; one row per file: uri, n_docs, n_ids, start (ids of all files before).

    Documents are range-partitioned by identifier, so file k holds identifiers below those of file k + 1; a null
    identifier comes first, rows that repeat an identifier are ordered by text. A null text is empty; each document ends
    with ``end_id``, so it has at least one id. Files are written under a name of the attempt and renamed, so that a task
    that runs twice leaves one file. The rows collected to the driver are one per file. An empty table has no files.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, end = None, None, np.array([end_id], np.uint32)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        files, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            if writer is None and batch.num_rows:
                encode = text_encoder(tokenizer)
                files.create_dir(base, recursive=True)
                temporary = f"{base}/_writing-{part:06d}-{attempt}"
                writer = PackedWriter(files.open_output_stream(temporary), bits_for(max(encode.n_ids, end_id + 1)), block)
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                writer.add(d, np.append(np.frombuffer(encode(t.as_py()), "<u4"), end))
        if writer is not None:
            writer.close()
            files.move(temporary, f"{base}/part-{part:06d}.bits")
            yield pa.RecordBatch.from_pydict({"part": [part], "uri": [f"{folder}/part-{part:06d}.bits"],
                                              "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    value = F.coalesce(F.col(text), F.lit(""))
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), value.alias("text"))
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text"))
    rows = sorted(ordered.mapInArrow(write, "part long, uri string, n_docs long, n_ids long").collect())
    starts = np.cumsum([0, *[r.n_ids for r in rows]]).tolist()
    spark = docs.sparkSession
    listed = [(r.uri, r.n_docs, r.n_ids, s) for r, s in zip(rows, starts, strict=False)]
    return spark.createDataFrame(spark.sparkContext.parallelize(listed, max(1, len(listed))),
                                 "uri string, n_docs long, n_ids long, start long")


def read_packed(files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32; one block is in memory at a time."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist(), strict=True):
                file = PackedReader(uri)
                ends = np.cumsum(file.lengths)
                crcs, doc, crc, at = [], 0, 0, 0
                for k in range(len(file.offsets)):
                    ids = memoryview(file.read_block(k).astype("<u4").tobytes())
                    base, until = k * file.block, k * file.block + len(ids) // 4
                    while at < until:
                        stop = min(int(ends[doc]), until)
                        crc = zlib.crc32(ids[4 * (at - base):4 * (stop - base)], crc)
                        at = stop
                        if at == ends[doc]:
                            crcs.append(crc)
                            doc, crc = doc + 1, 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.docs, mask=file.nulls), pa.array(start + ends - file.lengths), pa.array(file.lengths),
                     pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def packed_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write to a new shared folder and read back."""
    return read_packed(write_packed(docs, shared_folder(docs.sparkSession, "token-ids"), tokenizer, **options))
