"""Lines that many documents share, found by range-partitioned hashes and returned as keep bitmaps.

Line hashes are range-partitioned by hash and document and sorted by hash, document and position; each partition streams
its runs once. Documents are counted where a line first occurs in them, so a run gives the number of documents of its
hash in that partition, and a hash that spans partitions (one line may stand in a third of all documents) is added up
afterwards from one row per partition. The result per document is a compressed bitmap of the lines to keep, not its text;
``apply_bitmaps`` puts it to use.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import LOWER, SPACES, UPPER, stored

MIN_DOCS, MIN_LENGTH = 10, 1


def line_key(line: Column) -> Column:
    """A line without ASCII white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct documents per hash from rows sorted by hash and document: one row per hash and batch."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, d = (batch.column(k).fill_null(0).to_numpy(zero_copy_only=False) for k in ("a", "b", "d"))
        nulls = batch.column("d").is_null().to_numpy(zero_copy_only=False)
        hashed = np.ones(len(a), bool)
        hashed[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = hashed.copy()
        first[1:] |= (d[1:] != d[:-1]) | (nulls[1:] != nulls[:-1])
        if last == (a[0], b[0], d[0], nulls[0]):
            first[0] = False
        last = (a[-1], b[-1], d[-1], nulls[-1])
        starts = np.flatnonzero(hashed)
        yield pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.array(b[starts]),
                                          pa.array(np.add.reduceat(first.astype(np.int64), starts))], ["a", "b", "n"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One compressed bitmap per row key from (k, n_lines, position) rows that are sorted by key and position."""
    def packed(key, n_lines, positions):
        keep = np.ones(n_lines, bool)
        keep[positions] = False
        return key, n_lines, int(n_lines - keep.sum()), zlib.compress(np.packbits(keep).tobytes(), 1)

    open_key, open_n, held = None, 0, []
    for batch in batches:
        k, n, p = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "n_lines", "position"))
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, int)
        out = []
        for at, end in zip(starts, np.r_[starts[1:], len(k)], strict=True):
            if k[at] != open_key:
                if held:
                    out.append(packed(open_key, open_n, np.concatenate(held)))
                open_key, open_n, held = int(k[at]), int(n[at]), []
            held.append(p[at:end])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["k", "n_lines", "n_dropped", "bitmap"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in packed(open_key, open_n, np.concatenate(held))],
                                         ["k", "n_lines", "n_dropped", "bitmap"])


def line_bitmaps(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, min_docs: int = MIN_DOCS,
                 min_length: int = MIN_LENGTH) -> DataFrame:
    """Bitmaps of the documents that lose lines: k (row key), n_lines long, n_dropped long, bitmap binary.

    A line whose key has at least ``min_length`` code points and stands in at least ``min_docs`` documents loses all its
    occurrences. A document is an identifier: rows that repeat one count once (null identifiers together count as one),
    and repeated rows share a bitmap. A null or empty text is one empty line, which has no key. Documents not listed keep
    every line. An empty table gives an empty result; other columns are not read.
    """
    lines = docs.select(F.col(doc_id).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("v")).select(
        "d", _row_key(F.col("d"), F.col("v")).alias("k"), F.split("v", "\n").alias("all")).select(
        "d", "k", F.size("all").alias("n_lines"), F.posexplode("all").alias("position", "line"))
    lines = lines.withColumn("line", line_key(F.col("line"))).where(F.length("line") >= min_length)
    lines = stored(lines.select("d", "k", "n_lines", "position", F.xxhash64("line").alias("a"),
                                F.xxhash64(F.lit(1), F.col("line")).alias("b")), "lines")
    runs = (lines.select("a", "b", "d", "position").repartitionByRange("a", "b", "d")
            .sortWithinPartitions("a", "b", "d", "position").mapInArrow(_count_runs, "a long, b long, n long"))
    common = runs.groupBy("a", "b").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs).select("a", "b")
    dropped = lines.join(common, ["a", "b"]).select("k", F.col("n_lines").cast("long").alias("n_lines"),
                                                    F.col("position").cast("long").alias("position"))
    return (dropped.repartition("k").sortWithinPartitions("k", "position")
            .mapInArrow(_bitmaps, "k long, n_lines long, n_dropped long, bitmap binary"))


def _kept(bitmap: bytes | None, text: str | None) -> str | None:
    if bitmap is None:
        return text
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return "\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k])


@F.arrow_udf(StringType())
def _cut(bitmap: pa.Array, text: pa.Array) -> pa.Array:
    return pa.array([_kept(b, t) for b, t in zip(bitmap.to_pylist(), text.to_pylist(), strict=True)], pa.string())


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` as a struct ``row``, with ``kept`` (the lines to keep, joined by newlines), ``n_lines`` and ``n_dropped``."""
    value = F.coalesce(F.col(text), F.lit(""))
    whole = docs.select(F.struct("*").alias("row"), value.alias("v"), _row_key(F.col(doc_id), value).alias("k"))
    joined = whole.join(bitmaps.select("k", "bitmap", F.col("n_dropped").alias("lost")), "k", "left")
    # only texts that lose lines go to Python
    kept = F.coalesce(_cut("bitmap", F.when(F.col("bitmap").isNotNull(), F.col("v"))), F.col("v"))
    return joined.select("row", kept.alias("kept"), F.size(F.split("v", "\n")).cast("long").alias("n_lines"),
                         F.coalesce("lost", F.lit(0)).cast("long").alias("n_dropped"))


def without_common_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with all columns; texts lose their common lines. A null text stays null."""
    kept = apply_bitmaps(docs, line_bitmaps(docs, text, doc_id, **options), text, doc_id)
    new = F.when(F.col("row")[text].isNotNull(), F.col("kept"))
    return kept.select(*[(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
