"""Phrases of words that belong together, from exact counts kept in counting quotient filters.

A text is lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and pieces into words at blanks and tabs. Every
(language, word) that is frequent enough to be in a phrase has a number; other words end a piece, as no candidate holds them.

An n-gram is the number that its words' numbers make side by side. A Feistel network permutes these numbers, so they spread
evenly and can be turned back. A filter stores the permuted number's upper bits by place (the quotient: one bit for each
quotient that occurs, one for each end of a run of equal quotients) and the rest in full (the remainder), with a counter of one
byte or, where that is not enough, eight. Nothing is lost: counts are exact. Every task counts into its own filter, cuts it by
quotient ranges and sends each range once; a range's filters, sorted by nature, are merged where they meet.

N-grams of three and four words are only counted where both n-grams within them, one word shorter, may be frequent. That is
told by a bitmap of ``BITMAP`` bits at most, whatever the input: bits that different n-grams share only mean more counting.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, numbered, stored

LEAST, TOP, LONGEST, CONTAINED = 30, 2000, 4, 80
#: Words of a block; bytes that are split into words at once; entries of a task's filter, and of a merged range, about.
BLOCK, SLICE, ENTRIES = 1_000_000, 4_000_000, 3_000_000
#: Words whose n-grams are made at once.
MADE = 100_000
#: The bitmap has 2 to this power bits at most.
BITMAP = 27
#: Shares over which candidates that hold one word are spread when its count is looked up.
SALTS = 16

_ENDS = b".,;:!?\x0b\x0c\r"
_TABLE = bytes.maketrans(_ENDS + b"\t" + UPPER.encode(), b"\n" * len(_ENDS) + b" " + LOWER.encode())
_ONE = np.uint64(1)


class _Places(dict):
    """Words of a block by place; the empty word is 0 and the end of a piece 1."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > size:
            found = [x for x in (text.find(b" ", at + size), text.find(b"\n", at + size)) if x >= 0]
            end = min(found, default=end)
        yield text[at:end]
        at = end


def _blocks(limit: int, slice_size: int):
    """Per block and language the places of its words in order, and a row for each of its words with its number there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, words = TaskContext.get().partitionId(), 0, {}, 0
        kinds = [("block", pa.int64()), ("lang", pa.string()), ("places", pa.binary()), ("word", pa.binary()), ("place", pa.int32()),
                 ("n", pa.int64())]

        def rows(lang, places, word, place, n):
            size = len(word)
            columns = [[(part << 32) | block] * size, [lang] * size, places, word, place, n]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], [k for k, _ in kinds])

        def done():
            for lang, (known, runs) in held.items():
                codes = np.concatenate(runs)
                counts = np.bincount(codes, minlength=len(known))[2:]
                narrow = codes.astype("<u2") if len(known) <= 1 << 16 else codes
                yield rows(lang, [bytes([narrow.itemsize]) + narrow.tobytes()], [None], [None], [None])
                all_words = list(known)[2:]
                for at in range(0, len(all_words), 100_000):
                    some = all_words[at:at + 100_000]
                    yield rows(lang, [None] * len(some), some, range(at + 2, at + 2 + len(some)), counts[at:at + 100_000])

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                known, runs = held.setdefault(lang.as_py(), (_Places(), []))
                for piece in _slices((text.as_py() or b"").translate(_TABLE), slice_size):
                    tokens = piece.replace(b"\n", b" \n ").split(b" ")
                    codes = np.fromiter(map(known.__getitem__, tokens), "<u4", len(tokens))
                    runs.append(codes[codes != 0])
                    words += len(codes)
                runs.append(np.ones(1, "<u4"))
                if words >= limit or len(runs) > limit:
                    yield from done()
                    block, held, words = block + 1, {}, 0
        yield from done()
    return run


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places to the words' numbers; a run of zeros ends a piece."""
    for batch in batches:
        for places, at, numbers in zip(batch.column("places"), batch.column("at"), batch.column("numbers"), strict=True):
            data = places.as_buffer()
            codes = np.frombuffer(data, "<u2" if data[0:1].to_pybytes() == b"\x02" else "<u4", offset=1)
            if at.is_valid:
                table = np.zeros(max(int(codes.max(initial=0)), 1) + 1, "<u4")
                table[at.values.to_numpy(zero_copy_only=False)] = numbers.values.to_numpy(zero_copy_only=False)
                out = table[codes]
                out = out[(out != 0) | np.r_[out[1:] != 0, False]]
                if len(out):
                    yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["words"])


# --- numbers of up to 128 bits as one or two columns of 64, the upper first

def _down(keys: np.ndarray, by: int) -> np.ndarray:
    """The bits above ``by``, which fit 64."""
    if keys.shape[1] == 1:
        return keys[:, 0] >> np.uint64(by) if by < 64 else np.zeros(len(keys), np.uint64)
    if by >= 64:
        return keys[:, 0] >> np.uint64(by - 64) if by < 128 else np.zeros(len(keys), np.uint64)
    return keys[:, 1] if by == 0 else (keys[:, 0] << np.uint64(64 - by)) | (keys[:, 1] >> np.uint64(by))


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << min(bits, 64)) - 1)


def _side_by_side(upper: np.ndarray, lower: np.ndarray, bits: int, columns: int) -> np.ndarray:
    """``upper`` above ``bits`` bits of ``lower`` (one or two columns)."""
    if columns == 1:
        return ((upper << np.uint64(bits)) | lower[:, -1])[:, None] if bits < 64 else lower.copy()
    out = np.zeros((len(upper), 2), np.uint64)
    out[:, 2 - lower.shape[1]:] = lower
    if bits >= 64:
        out[:, 0] |= upper << np.uint64(bits - 64) if bits < 128 else np.uint64(0)
    else:
        out[:, 0] |= upper >> np.uint64(64 - bits) if bits else np.uint64(0)
        out[:, 1] |= upper << np.uint64(bits)
    return out


class Layout:
    """How n-grams of ``n`` words numbered below 2 to the power ``bits`` become permuted numbers."""

    def __init__(self, n: int, bits: int):
        self.n, self.word_bits = n, bits
        self.half = (n * bits + 1) // 2
        self.bits = 2 * self.half
        self.columns = 1 if self.bits <= 64 else 2
        self.seeds = [np.uint64((0x9E3779B97F4A7C15 * (k + 1)) % (1 << 64)) for k in range(4)]

    def _turn(self, x: np.ndarray, seed: np.uint64) -> np.ndarray:
        x = (x + seed) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(32))) & _mask(self.half)

    def permute(self, words: list[np.ndarray]) -> np.ndarray:
        """Columns of word numbers, one n-gram a row, to permuted numbers."""
        first, width = words[0].astype(np.uint64), np.uint64(self.word_bits)
        if self.columns == 1:
            for w in words[1:]:
                first = (first << width) | w
            packed = first[:, None]
        else:
            packed = np.stack([np.zeros(len(first), np.uint64), first], axis=1)
            for w in words[1:]:
                packed[:, 0] = (packed[:, 0] << width) | (packed[:, 1] >> np.uint64(64 - self.word_bits))
                packed[:, 1] = (packed[:, 1] << width) | w
        a, b = _down(packed, self.half), packed[:, -1] & _mask(self.half)
        for seed in self.seeds:
            a, b = b, a ^ self._turn(b, seed)
        return _side_by_side(a, b[:, None], self.half, self.columns)

    def words(self, keys: np.ndarray) -> list[np.ndarray]:
        """The word numbers of permuted numbers."""
        a, b = _down(keys, self.half), keys[:, -1] & _mask(self.half)
        for seed in reversed(self.seeds):
            a, b = b ^ self._turn(a, seed), a
        packed = _side_by_side(a, b[:, None], self.half, self.columns)
        return [_down(packed, self.word_bits * k) & _mask(self.word_bits) for k in reversed(range(self.n))]

    def top(self, keys: np.ndarray, bits: int) -> np.ndarray:
        return _down(keys, self.bits - bits)


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers with their counts added up (each 1 if not given)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if keys.shape[1] == 1 and counts is None:
        keys = np.sort(keys[:, 0])[:, None]
        first = np.flatnonzero(np.r_[True, keys[1:, 0] != keys[:-1, 0]])
        return keys[first], np.diff(np.r_[first, len(keys)])
    order = np.argsort(keys[:, 0], kind="stable") if keys.shape[1] == 1 else np.lexsort((keys[:, 1], keys[:, 0]))
    keys = keys[order]
    counts = None if counts is None else counts[order]
    del order
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
    totals = np.diff(np.r_[first, len(keys)]) if counts is None else np.add.reduceat(counts, first)
    del counts
    return keys[first], totals


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``counted`` of all in ``held``, which is emptied: its numbers are not kept beside their copy."""
    both = [np.concatenate([c for _, c in held]), np.concatenate([k for k, _ in held])]
    held.clear()
    return counted(both.pop(), both.pop())


def encode(keys: np.ndarray, counts: np.ndarray, layout: Layout, part: int, part_bits: int) -> bytes:
    """The counting quotient filter of sorted distinct numbers whose upper ``part_bits`` are ``part``.

    Its head (entries, quotient bits), a bit for each quotient that occurs, a bit for each entry that ends its run, remainders
    in whole bytes, counters of one byte, and the counts of 255 and more in order.
    """
    q = min(len(keys).bit_length() - 1, layout.bits - part_bits)
    quotients = (layout.top(keys, part_bits + q) - (np.uint64(part) << np.uint64(q))).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotients] = True
    ends = np.r_[quotients[1:] != quotients[:-1], True]
    width = -(-(layout.bits - part_bits - q) // 8)
    remainders = np.ascontiguousarray(keys.astype(">u8")).view(np.uint8).reshape(len(keys), -1)
    remainders = remainders[:, remainders.shape[1] - width:]
    return b"".join([np.array([len(keys), q], "<i8").tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                     remainders.tobytes(), np.minimum(counts, 255).astype(np.uint8).tobytes(),
                     counts[counts >= 255].astype("<i8").tobytes()])


def decode(data, layout: Layout, part: int, part_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of a filter."""
    raw = np.frombuffer(data, np.uint8)
    size, q = (int(x) for x in raw[:16].view("<i8"))
    rest = layout.bits - part_bits - q
    width, at = -(-rest // 8), 16
    parts = []
    for length in (-(-(1 << q) // 8), -(-size // 8), width * size, size):
        parts.append(raw[at:at + length])
        at += length
    ends = np.unpackbits(parts[1], count=size)
    run = np.cumsum(ends) - ends
    quotients = np.flatnonzero(np.unpackbits(parts[0], count=1 << q))[run].astype(np.uint64)
    wide = np.zeros((size, 8 * layout.columns), np.uint8)
    wide[:, wide.shape[1] - width:] = parts[2].reshape(size, width)
    lower = wide.view(">u8").astype(np.uint64)
    lower[:, -1] &= _mask(rest)
    if layout.columns == 2:
        lower[:, 0] &= _mask(max(rest - 64, 0))
    keys = _side_by_side(quotients | (np.uint64(part) << np.uint64(q)), lower, rest, layout.columns)
    counts = parts[3].astype(np.int64)
    counts[counts == 255] = raw[at:].view("<i8") if at % 8 == 0 else np.frombuffer(raw[at:].tobytes(), "<i8")
    return keys, counts


def _count(layout: Layout, part_bits: int, shorter: Layout | None, bitmap, bitmap_bits: int, entries: int):
    """Filters of a task's n-grams, a row for each range of quotients: (part, filter)."""
    def grams(ids: np.ndarray) -> np.ndarray:
        n = layout.n
        size = max(len(ids) - n + 1, 0)
        inside = np.ones(size, bool)
        for k in range(n):
            inside &= ids[k:size + k] != 0
        if shorter is not None and size:
            size_before = len(ids) - n + 2
            may = np.ones(size_before, bool)
            for k in range(n - 1):
                may &= ids[k:size_before + k] != 0
            at = np.flatnonzero(may)
            bit = shorter.top(shorter.permute([ids[at + k] for k in range(n - 1)]), bitmap_bits)
            may[at] = (bitmap.value[(bit >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (bit & np.uint64(7)).astype(np.uint8))) & 1
            inside &= may[:size] & may[1:]
        at = np.flatnonzero(inside)
        return layout.permute([ids[at + k] for k in range(n)])

    def sent(keys, counts):
        parts = layout.top(keys, part_bits).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else []
        for a, b in zip(starts, [*starts[1:], len(parts)], strict=True):
            yield int(parts[a]), encode(keys[a:b], counts[a:b], layout, int(parts[a]), part_bits)

    def rows(found):
        while batch := list(itertools.islice(found, 64)):
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in batch], pa.int32()),
                                              pa.array([d for _, d in batch], pa.binary())], ["part", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for words in batch.column("words"):
                ids = np.frombuffer(words.as_buffer(), "<u4")
                held.append(counted(np.concatenate([grams(ids[at:at + MADE + layout.n - 1]) for at in range(0, len(ids), MADE)])))
                if sum(len(k) for k, _ in held) > entries:
                    held.append(_joined(held))
                    if len(held[0][0]) > entries // 2:
                        yield from rows(sent(*held.pop()))
        if held:
            yield from rows(sent(*_joined(held)))
    return run


def _merge(layout: Layout, part_bits: int, least: int, bitmap_bits: int, longest: int, entries: int):
    """Filters, those of a part side by side, to rows of frequent n-grams and, per part, its slice of the bitmap."""
    names = ["part", "bits", *[f"w{k + 1}" for k in range(longest)], "a"]

    def finish(part, held):
        keys, counts = _joined(held)
        keys, counts = keys[counts >= least], counts[counts >= least]
        bits = np.zeros(1 << (bitmap_bits - part_bits), np.uint8)
        bits[(layout.top(keys, bitmap_bits) & _mask(bitmap_bits - part_bits)).astype(np.int64)] = 1
        head = [pa.array([part], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(head + [pa.nulls(1, pa.int64()) for _ in names[2:]], names)
        words = [w.astype(np.int64) for w in layout.words(keys)] + [np.zeros(len(keys), np.int64)] * (longest - layout.n)
        for at in range(0, len(keys), 100_000):
            some = slice(at, at + 100_000)
            size = len(keys[some])
            yield pa.RecordBatch.from_arrays([pa.array([part] * size, pa.int32()), pa.nulls(size, pa.binary()),
                                              *[pa.array(w[some]) for w in words], pa.array(counts[some])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, pending = None, [], 0
        for batch in batches:
            for at, data in zip(batch.column("part").to_pylist(), batch.column("filter"), strict=True):
                if at != part:
                    if held:
                        yield from finish(part, held)
                    part, held, pending = at, [], 0
                held.append(decode(data.as_buffer(), layout, part, part_bits))
                pending += len(held[-1][0])
                if pending > max(entries // 2, len(held[0][0])):
                    held, pending = [_joined(held)], 0
        if held:
            yield from finish(part, held)
    return run, f"part int, bits binary, {', '.join(f'w{k + 1} long' for k in range(longest))}, a long"


def frequent_grams(words: DataFrame, n_words: int, tokens: int, least: int, longest: int) -> list[DataFrame]:
    """Tables (w1, ..., a) of the n-grams of 2 to ``longest`` words that occur ``least`` times or more; absent words are 0."""
    spark, bits = words.sparkSession, max(n_words.bit_length(), 1)
    found, shorter, bitmap, bitmap_bits = [], None, None, 0
    wish = max(tokens // (ENTRIES // 4), 8).bit_length()
    for n in range(2, longest + 1):
        layout = Layout(n, bits)
        own_bits = min(BITMAP, layout.bits, max(tokens, 1 << 13).bit_length() + 4)
        part_bits = max(min(wish, own_bits - 3), 0)
        filters = words.mapInArrow(_count(layout, part_bits, shorter, bitmap, bitmap_bits, ENTRIES), "part int, filter binary")
        merge, schema = _merge(layout, part_bits, least, own_bits, longest, ENTRIES)
        dealt = filters.repartition(max((1 << part_bits) // 2, 1), "part").sortWithinPartitions("part")
        grams = stored(dealt.mapInArrow(merge, schema), f"grams-{n}")
        found.append(grams.where("a is not null").drop("part", "bits"))
        if n < longest:
            whole = np.zeros((1 << own_bits) // 8 + 1, np.uint8)
            width = (1 << (own_bits - part_bits)) // 8
            for row in grams.where("bits is not null").select("part", "bits").toLocalIterator():
                whole[row["part"] * width:(row["part"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)[:width]
            shorter, bitmap, bitmap_bits = layout, spark.sparkContext.broadcast(whole), own_bits
    return found


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 longest: int = LONGEST, contained: int = CONTAINED) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A candidate is a phrase of 2 to ``longest`` words that occurs ``least`` times or more (``a``) within pieces, overlaps
    counted. Cut after its first words, its parts occur ``l`` and ``r`` times; of all cuts the one with the lowest
    ``floor(2000000 * a / (l + r))`` counts, of equal ones the earliest. Candidates that lie in a longer candidate with at least
    ``contained`` percent of their occurrences are left out. ``n`` counts the language's words. Ordered by score, occurrences
    and phrase (by UTF-8 bytes). A null language is ``und``; null and empty texts have no words; rows that repeat count each;
    other columns are not read. An empty table gives an empty result.
    """
    names = [f"w{k + 1}" for k in range(longest)]
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    blocks = stored(rows.mapInArrow(_blocks(BLOCK, SLICE), "block long, lang string, places binary, word binary, place int, n long"), "blocks")
    said = blocks.where("word is not null")
    counts = stored(said.groupBy("lang", "word").agg(F.sum("n").alias("f")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    known = stored(numbered(counts.where(F.col("f") >= least), "words", "id").withColumn("id", F.col("id") + 1), "numbers")
    size = known.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("f"), F.lit(0)).alias("tokens")).first()

    answers = (said.select("block", "lang", "word", "place").join(known.select("lang", "word", "id"), ["lang", "word"])
               .groupBy("block", "lang").agg(F.collect_list("place").alias("at"), F.collect_list("id").alias("numbers")))
    words = (blocks.where("places is not null").select("block", "lang", "places").join(answers, ["block", "lang"])
             .select("places", "at", "numbers"))
    words = stored(words.mapInArrow(_numbers, "words binary"), "numbered-words")
    longer = frequent_grams(words, size["words"], size["tokens"], least, longest)

    candidates = longer[0]
    for more in longer[1:]:
        candidates = candidates.unionByName(more)
    candidates = stored(candidates, "candidates")
    singles = known.select(F.col("id").alias("w1"), *[F.lit(0).cast("long").alias(w) for w in names[1:]], F.col("f").alias("a"),
                           "lang", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    parts = singles.unionByName(candidates.where(F.col(names[-1]) == 0)
                                .withColumns({"lang": F.lit(None).cast("string"), "salt": F.lit(0)}))
    parts = parts.select(*[F.col(w).alias(f"p{k}") for k, w in enumerate(names)], F.col("a").alias("f"), F.col("lang").alias("of"), "salt")
    length = sum((F.col(w) > 0).cast("int") for w in names)
    grams = candidates.withColumns({"g": F.filter(F.array(*names), lambda w: w > 0), "m": length})

    def padded(items):
        return F.slice(F.concat(items, F.array_repeat(F.lit(0).cast("long"), longest)), F.lit(1), F.lit(longest))

    cut = F.transform(F.sequence(F.lit(1), F.col("m") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(True).alias("left"), padded(F.slice("g", F.lit(1), k)).alias("p")),
        F.struct(k.alias("k"), F.lit(False).alias("left"), padded(F.slice("g", k + 1, F.col("m"))).alias("p"))))
    halves = grams.select(*names, "a", F.explode(F.flatten(cut)).alias("cut")).select(*names, "a", "cut.*")
    halves = halves.select(*names, "a", "k", "left", *[F.get("p", F.lit(k)).alias(f"p{k}") for k in range(longest)])
    halves = halves.withColumn("salt", F.when(F.col("p1") == 0, F.pmod(F.xxhash64(*names), F.lit(SALTS))).otherwise(0).cast("int"))
    met = halves.join(parts, ["salt", *[f"p{k}" for k in range(longest)]])
    cuts = met.groupBy(*names, "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"),
                                             F.max(F.when(~F.col("left"), F.col("f"))).alias("r"), F.max("of").alias("lang"))
    score = F.expr("cast(a as decimal(20, 0)) * 2000000 div (cast(l as decimal(20, 0)) + r)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy(*names, "a").agg(best, F.max("lang").alias("lang")).select(*names, "a", "lang", "best.*")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("m") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("m") - size + 1), lambda at: padded(F.slice("g", at, size)))))
    within = grams.where("m > 2").select("a", F.explode(inner).alias("p")).groupBy("p").agg(F.max("a").alias("most"))
    within = within.select(*[F.get("p", F.lit(k)).alias(w) for k, w in enumerate(names)], "most")
    held = F.coalesce(F.col("most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * contained, F.lit(False))
    kept = scored.join(within, names, "left").where(~held).drop("most")

    order = [F.col("score").desc(), F.col("a").desc()]
    near = kept.withColumn("near", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("near") <= top).drop("near")
    near = stored(near, "near-top")
    letters = near.select(*names, F.posexplode(F.filter(F.array(*names), lambda w: w > 0)).alias("pos", "id"))
    written = (letters.join(known.select("id", "word"), "id").groupBy(*names)
               .agg(F.sort_array(F.collect_list(F.struct("pos", F.col("word").cast("string").alias("word")))).alias("s")))
    phrase = written.select(*names, F.array_join(F.transform("s", lambda x: x["word"]), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.col("phrase").asc()))
    ranked = near.join(phrase, names).withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              F.col("n").cast("long").alias("n"), F.col("score").cast("long").alias("score"))
