"""Katz backoff language model: n-grams counted over all training texts, evaluated recursively on every text.

Texts become blocks of about a million tokens, each with its distinct words. Blocks are stored in buckets, so that answers go
to them and they are not sent themselves. Every block sends its words (hash and count in training texts) to the partition of
the word table that the hash names; the table adds them up and answers with each word's number and count, in the order it was
asked, and whether no other block has the word.

Each order from two on is then one exchange of packed arrays. A block sends its distinct n-grams, each once with its count in
the block's training texts, to the partition of that order's count table that the context (all words but the last) names. An
n-gram thus arrives at most once per block, however often it occurs. A context with more than a partition's share of all
tokens is spread over several partitions by the last word; what belongs together of it is a few sums per partition. The
partition adds the counts up and answers, in the order asked, with each n-gram's count, whether no other block has it and, per
context, what its backoff weight needs; answers are stored, and the counts of counts, which give the Good-Turing discounts,
are added up. What follows a context that no other block has is counted in its block; only its counts of counts are sent.

An n-gram that was seen has its discounted relative frequency; any other has the context's backoff weight times the
probability that the next lower order gives, down to single words, where unknown words are one more word that holds the mass
discounted from single words. Backoff weights are what normalises each distribution: (1 - seen mass) / (1 - lower-order mass
of the seen words). After a context that training never had, the lower order counts alone.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, stored, stored_in_buckets

BLOCK, PART = 1_000_000, 1_500_000
WORD_BYTES = 6  # of text to a word and its space, about
BUCKETS = 10_000  # of blocks, at most
CUTOFF = 5  # counts above it are not discounted
#: The first word of a text follows this; it is no word and is never predicted. Unknown words, 0 too, are in no context asked for.
BEGIN = 0
END = b" "  # no word holds a space

_SCHEMA = ("block long, kind int, part int, n long, docs array<long>, a binary, b binary, c binary, d binary")
_NAMES = ["block", "kind", "part", "n", "docs", "a", "b", "c", "d"]
_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]


def _squeeze(values: np.ndarray) -> bytes:
    """A compressed array: its bytes by place, so that like ones stand together, without upper ones that are 0 in all values."""
    values = np.ascontiguousarray(values)
    width = values.itemsize
    if values.dtype.kind in "iu" and len(values) and values.min() >= 0:
        width = max(1, -(-int(values.max()).bit_length() // 8))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize)[:, :width].T)
    return len(values).to_bytes(7, "little") + bytes([width]) + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _expand(data: bytes, dtype) -> np.ndarray:
    n, width = int.from_bytes(data[:7], "little"), data[7]
    out = np.zeros(n, dtype)
    if n:
        planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], n * width), np.uint8).reshape(width, n)
        out.view(np.uint8).reshape(n, -1)[:, :width] = planes.T
    return out


def _order(*keys: np.ndarray) -> np.ndarray:
    """Places by the first of ``keys`` (not negative), then the next; stable."""
    bits = [int(k.max(initial=0)).bit_length() for k in keys]
    if sum(bits) > 63:
        return np.lexsort(keys[::-1])
    one = keys[0].astype(np.int64)
    for k, width in zip(keys[1:], bits[1:], strict=True):
        one = (one << width) | k
    return np.argsort(one, kind="stable")


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What np.unique gives with the first places and the inverse; keys and places are sorted as one number where that fits."""
    bits = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits > 63:
        return np.unique(keys, return_index=True, return_inverse=True)
    both = np.sort((keys << bits) | np.arange(len(keys)))
    place, both = both & ((1 << bits) - 1), both >> bits
    new = np.ones(len(keys), bool)
    new[1:] = both[1:] != both[:-1]
    inverse = np.empty(len(keys), np.int64)
    inverse[place] = np.cumsum(new) - 1
    return both[new], place[new], inverse


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _mix(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def discounts(n_r: np.ndarray, cutoff: int = CUTOFF) -> np.ndarray:
    """Katz's Good-Turing ratios for counts 0 to ``cutoff`` + 1 (the last for all above: 1) from counts of counts 1 to cutoff + 1.

    A ratio that comes out above 1 or not above 0, as small counts of counts give, is replaced by (r - 1/2) / r.
    """
    out = np.ones(cutoff + 2)
    for r in range(1, cutoff + 1):
        ratio = -1.0
        if n_r[0] > 0 and n_r[r - 1] > 0:
            rest = (cutoff + 1) * n_r[cutoff] / n_r[0]
            if rest < 1:
                ratio = ((r + 1) * n_r[r] / (r * n_r[r - 1]) - rest) / (1 - rest)
        out[r] = ratio if 0 < ratio <= 1 else (r - 0.5) / r
    return out


def _discounted(counts: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    return counts * ratios[np.minimum(counts, len(ratios) - 1)]


def _blocks(n_parts: int, size: int):
    """Blocks of texts: a row with the tokens (words by rank in the block, and each rank's place among the words asked for),
    and a row per part with the words' hashes and counts."""
    def rows(block: int, docs: list, held: list, lengths: list, tokens: list, words: dict) -> list[tuple]:
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        part = (hashes % np.uint64(n_parts)).astype(np.int64)
        order = np.lexsort((hashes, part))  # as the words are asked for
        flat = np.concatenate(tokens)
        trained = np.repeat(~np.array(held, bool), lengths)
        counts = np.bincount(flat[trained], minlength=len(order)).astype(np.uint32)
        often = np.argsort(-np.bincount(flat, minlength=len(order)), kind="stable")  # small numbers for frequent words
        rank, place = np.empty(len(order), np.uint32), np.empty(len(order), np.uint32)
        rank[often] = place[order] = np.arange(len(order), dtype=np.uint32)
        ends = np.searchsorted(part[order], np.arange(n_parts + 1))
        out = [(block, 0, -1, len(flat), docs, _squeeze(rank[flat]), _squeeze(np.array(lengths, np.uint32)),
                _squeeze(np.array(held, np.uint8)), _squeeze(place[often]))]
        hashes, counts = hashes[order], counts[order]
        out += [(block, 0, p, int(e - s), None, _squeeze(np.diff(hashes[s:e], prepend=np.uint64(0))), _squeeze(counts[s:e]), None, None)
                for p, (s, e) in enumerate(itertools.pairwise(ends.tolist())) if e > s]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first = itertools.count(), TaskContext.get().partitionId() << 32
        state: tuple = ([], [], [], [], defaultdict(itertools.count().__next__))
        n = 0
        for batch in batches:
            for doc, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(),
                                      batch.column("text"), strict=True):
                docs, held, lengths, tokens, words = state
                own = (text.as_py() or "").encode("utf-8", "replace").lower().split()
                own.append(END)
                docs.append(doc)
                held.append(out)
                lengths.append(len(own))
                tokens.append(np.fromiter(map(words.__getitem__, own), np.uint32, len(own)))
                n += len(own)
                if n >= size:
                    yield _batch(rows(first + next(number), *state))
                    state, n = ([], [], [], [], defaultdict(itertools.count().__next__)), 0
        if n:
            yield _batch(rows(first + next(number), *state))
    return run


def _word_table(n_parts: int, cutoff: int):
    """One part of the word table: answers to its blocks in the order asked, and a row of totals (block -1)."""
    def run(asked: pa.Table) -> pa.Table:
        rows = asked.select(["block", "part", "a", "b"]).to_pylist()
        part = rows[0]["part"]
        hashes = [np.cumsum(_expand(r["a"], np.uint64)) for r in rows]
        words, place = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(place, np.concatenate([_expand(r["b"], np.uint32) for r in rows]), len(words)).astype(np.int64)
        known, alone = counts > 0, np.bincount(place, minlength=len(words)) == 1
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(words))  # small numbers for frequent words: they pack better
        numbers = np.where(known, rank * n_parts + part + 1, 0)
        out, at = [], 0
        for r, h in zip(rows, hashes, strict=True):
            own = place[at:at + len(h)]
            at += len(h)
            out.append((r["block"], 1, part, len(h), None, _squeeze(numbers[own]), _squeeze(2 * counts[own] + alone[own]), None, None))
        totals = np.r_[known.sum(), counts.sum(), np.bincount(np.minimum(counts[known], cutoff + 2), minlength=cutoff + 3)[1:cutoff + 2]]
        out.append((-1, 1, part, 0, totals.tolist(), None, None, None, None))
        return pa.Table.from_batches([_batch(out)])
    return run


class Words:
    """Probabilities of single words from the totals of the word table."""

    def __init__(self, n_words: int, n_tokens: int, n_r: np.ndarray):
        self.n_words, self.n_tokens, self.ratios = n_words, n_tokens, discounts(n_r)
        #: of the discounted counts: set by ``mass``
        self.total = self.unknown = 0.0

    def mass(self, n_r: np.ndarray) -> Words:
        """The mass of unknown words is what discounting takes away (one count if it takes nothing), so all add up to 1."""
        lost = sum(n * r * (1 - self.ratios[r]) for r, n in enumerate(n_r[:CUTOFF].tolist(), 1))
        self.total = float(self.n_tokens if lost > 0 else self.n_tokens + 1)
        self.unknown = (lost if lost > 0 else 1.0) / self.total
        return self

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.ratios) / self.total, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.n_tokens + 0.1 * (self.n_words + 1)))


def _spread(count: np.ndarray, n_parts: int, n_tokens: int) -> np.ndarray:
    """Over how many parts a context of this count is spread."""
    return np.maximum(1, -(-count * n_parts // max(1, n_tokens)))


class Order:
    """What all blocks need of an order's count table: discounts, and the sums of contexts that several parts share."""

    def __init__(self, rows: list):
        n_r = np.sum([r.docs for r in rows], axis=0) if rows else np.zeros(CUTOFF + 1)
        self.ratios, self.spread = discounts(n_r), {}
        for r in rows:
            own = _expand(r.c, np.float64)
            if not len(own):
                continue
            contexts, low = (_expand(x, np.int64).reshape(len(own), -1) for x in (r.a, r.b))
            for key, values in zip(map(tuple, contexts.tolist()), np.c_[low, own], strict=True):
                self.spread[key] = self.spread.get(key, 0) + values
        #: taken from a context's total per n-gram counted 1, 2, ..., and the same as bits
        self.lost = np.arange(1, CUTOFF + 1) * (1 - self.ratios[1:CUTOFF + 1])
        self.bits = _bits(self.lost)


def _bits(low: np.ndarray) -> np.ndarray:
    """Which of the counts 1 to CUTOFF there are, one bit each."""
    return ((low > 0) @ (1 << np.arange(CUTOFF))).astype(np.uint8)


class _Block:
    """A block's tokens. Of each: the n-gram of the order reached that ends there, its count in training, its log10 probability."""

    def __init__(self, texts: pa.Table, answers: pa.Table, words: Words, n_parts: int, n_trained: int):
        self.answers = defaultdict(list)
        for r in sorted(answers.to_pylist(), key=lambda r: r["part"]):
            self.answers[r["kind"]].append(r)
        (own,) = texts.to_pylist()
        numbers = np.concatenate([_expand(r["a"], np.int64) for r in self.answers[1]])
        counts = np.concatenate([_expand(r["b"], np.int64) for r in self.answers[1]])
        tokens, place = _expand(own["a"], np.uint32).astype(np.int64), _expand(own["d"], np.uint32)
        by = np.argsort(numbers, kind="stable")  # so numbers are sent in order, which packs better
        to = np.empty(len(by), np.int64)
        to[by] = np.arange(len(by))
        numbers, counts, tokens = numbers[by], counts[by], to[place][tokens]
        counts, alone = counts >> 1, (counts & 1).astype(bool)
        self.block, self.docs, self.lengths = own["block"], own["docs"], _expand(own["b"], np.uint32).astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.at = np.arange(len(tokens)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)  # in the text
        self.trained = ~_expand(own["c"], np.uint8).astype(bool)[self.doc]
        self.number, self.count, self.alone = numbers[tokens], counts[tokens], alone[tokens]
        self.known = self.sums(self.count > 0).astype(np.int64)
        self.base = self.sums(words.base(counts)[tokens])
        self.log = np.log10(words.probability(self.count))
        self.total = np.full(len(tokens), words.total)  # what the discounted count was divided by
        self.word = self.gram = np.where(self.count > 0, tokens, 0)  # unknown words, whose number is 0, come first
        self.size = len(numbers) + 2
        self.n_parts, self.n_tokens, self.n_trained = n_parts, words.n_tokens, n_trained

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, values, len(self.lengths))

    def distinct(self, order: int) -> None:
        """Finds the distinct n-grams after contexts that training had, by part and, within one, by context (a run).

        Those whose context no other block has come last, in a part that is not sent: from ``self.own`` on.
        """
        before, count, alone = (np.r_[x[:1], x[:-1]] for x in (self.gram, self.count, self.alone))
        start = self.at == 0
        before, count[start], alone[start] = before + 1, self.n_trained if order == 2 else 0, False
        before[start] = 0
        self.asked = np.flatnonzero(count > 0)
        grams, one, self.inverse = _distinct(before[self.asked] * self.size + self.word[self.asked])
        one = self.asked[one]
        shared = np.flatnonzero(~alone[one])
        sent = one[shared]
        spread = _spread(count[sent], self.n_parts, self.n_tokens)
        hashes = _mix(self.number[sent]) % spread.astype(np.uint64)  # the last word's share of a context that is spread
        words = [np.where(self.at[sent] >= k, self.number[sent - k], BEGIN) for k in range(order - 1, 0, -1)]
        for c in words:
            hashes = _mix(hashes * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
        over, contexts = np.ones(len(one), np.int64), np.zeros((order - 1, len(one)), np.int64)
        over[shared], contexts[:, shared] = spread, words
        part = np.full(len(one), self.n_parts, np.uint16 if self.n_parts < (1 << 16) - 1 else np.int64)
        part[shared] = hashes % np.uint64(self.n_parts)
        self.sort = np.argsort(part, kind="stable")
        self.part, self.one, context = part[self.sort], one[self.sort], (grams // self.size)[self.sort]
        new = np.ones(len(one), bool)
        new[1:] = (context[1:] != context[:-1]) | (self.part[1:] != self.part[:-1])
        self.runs, self.run = np.flatnonzero(new), np.cumsum(new) - 1
        self.over, self.contexts = over[self.sort][self.runs], contexts[:, self.sort[self.runs]]
        self.context_count = count[self.one[self.runs]]
        self.own = int(np.searchsorted(self.part, self.n_parts))
        self.own_runs = int(np.searchsorted(self.runs, self.own))
        self.trained_count = np.bincount(self.inverse, self.trained[self.asked], len(self.one)).astype(np.int64)[self.sort]

    def seen(self, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each context that no other block has: how many of its n-grams count 1, 2, ...; its seen words' lower-order mass.

        ``ratios`` are the discounts of the order below.
        """
        counts, run = self.trained_count[self.own:], self.run[self.own:] - self.own_runs
        n, lower = len(self.runs) - self.own_runs, self.count[self.one[self.own:]]
        total = self.total[self.one[self.runs[self.own_runs:]]]
        own = np.bincount(run, np.where(counts > 0, _discounted(lower, ratios), 0) / total[run], n)
        return np.stack([np.bincount(run, counts == r, n) for r in range(1, CUTOFF + 1)], 1).astype(np.int64), own

    def asks(self, order: int) -> list[tuple]:
        """A row per part: its contexts, the n-grams of each, their last words; counts in the block, of the lower order, its totals.

        One more row (n: 0) has the counts of counts of what is not sent.
        """
        self.distinct(order)
        counts = self.trained_count
        lower, words = np.where(counts > 0, self.count[self.one], 0), self.number[self.one]
        totals, sizes = self.total[self.one[self.runs]].astype(np.int64), np.diff(np.r_[self.runs, len(self.one)])
        words = _differences(words, self.runs)
        parts = np.flatnonzero(np.r_[True, self.part[1:self.own] != self.part[:self.own - 1]]) if self.own else []
        ends, out = np.r_[parts, self.own].astype(np.int64), []
        if self.own < len(self.one):
            out.append((self.block, order, self.block % self.n_parts, 0, _counts_of_counts(counts[self.own:]).tolist(),
                        None, None, None, None))
        for s, e in itertools.pairwise(ends.tolist()):
            u, v = np.searchsorted(self.runs, (s, e)).tolist()
            contexts = self.contexts[:, u:v].copy()
            contexts[0] = np.diff(contexts[0], prepend=0)
            out.append((self.block, order, int(self.part[s]), e - s, np.flatnonzero(self.over[u:v] > 1).tolist(),
                        _squeeze(contexts.ravel()), _squeeze(sizes[u:v]), _squeeze(words[s:e]),
                        _squeeze(np.r_[counts[s:e], lower[s:e], totals[u:v]])))
        return out

    def climb(self, order: int, table: Order, ratios: np.ndarray) -> None:
        """One order further, with the answers of its count table; ``ratios`` are the discounts of the order below."""
        self.distinct(order)
        size, rows = len(self.log), self.answers[order]
        gram, of_gram, total = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        alone = np.zeros(size, bool)
        if len(self.one):
            answered = [np.concatenate([np.empty(0, t), *(_expand(r[k], t) for r in rows)])
                        for k, t in (("a", np.int64), ("b", np.uint8), ("c", np.int64), ("d", np.float64))]
            own_low, own_mass = self.seen(ratios)
            counts = np.r_[answered[0] >> 1, self.trained_count[self.own:]]
            only = np.r_[(answered[0] & 1).astype(bool), np.ones(len(self.one) - self.own, bool)]
            bits = np.r_[answered[1], _bits(own_low)]
            needed = np.logical_or.reduceat(counts == 0, self.runs)
            asked = needed.copy()
            asked[self.own_runs:] = False
            low, own = np.zeros((len(needed), CUTOFF)), np.zeros(len(needed))
            low[asked], own[asked] = answered[2].reshape(-1, CUTOFF), answered[3]
            low[self.own_runs:], own[self.own_runs:] = own_low, np.where(needed[self.own_runs:], own_mass, 0)
            for k in np.flatnonzero(self.over > 1).tolist():
                sums = table.spread[tuple(self.contexts[:, k].tolist())]
                low[k], own[k], bits[k] = sums[:-1], sums[-1], _bits(sums[:-1])
            nothing = (bits & table.bits) == 0  # nothing was discounted: one count more is left for the unseen
            totals = (self.context_count + nothing).astype(float)
            weight = np.where(needed, np.where(nothing, 1.0, low @ table.lost) / totals / (1 - own), 1.0)
            kept = np.where(counts > 0, _discounted(counts, table.ratios) / totals[self.run], weight[self.run])
            back = np.empty(len(counts), np.int64)
            back[self.sort] = np.arange(len(counts))
            back = back[self.inverse]
            gram[self.asked], of_gram[self.asked], total[self.asked] = self.inverse, counts[back], totals[self.run][back]
            alone[self.asked] = only[back]
            self.log[self.asked] = np.log10(kept)[back] + np.where(counts[back] > 0, 0, self.log[self.asked])
        self.gram, self.count, self.total, self.alone = gram, of_gram, total, alone


def _differences(values: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Values by what they differ from the one before, the first of each run as it is."""
    out = np.diff(values, prepend=0)
    out[runs] = values[runs]
    return out


def _from_differences(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums, runs = np.cumsum(values), np.cumsum(sizes) - sizes
    return sums - np.repeat(sums[runs] - values[runs], sizes)


def _counts_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, CUTOFF + 2), minlength=CUTOFF + 3)[1:CUTOFF + 2]


def _count_table(order: int, ratios: np.ndarray, last: bool):
    """One part of an order's count table: answers to its blocks in the order asked, and a row of totals (block -1).

    ``ratios`` are the discounts of the order below, which the mass of a context's seen words there needs. After the ``last``
    order it does not matter which n-grams one block alone has.
    """
    def run(asked: pa.Table) -> pa.Table:
        n_r, rows = np.zeros(CUTOFF + 1, np.int64), []
        for r in asked.to_pylist():
            if r["n"]:
                rows.append(r)
            else:
                n_r += r["docs"]
        if not rows:
            nothing = _squeeze(np.empty(0))
            return pa.Table.from_batches([_batch([(-1, order, -1, 0, n_r.tolist(), nothing, nothing, nothing, None)])])
        contexts = [_expand(r["a"], np.int64).reshape(order - 1, -1) for r in rows]
        for c in contexts:
            c[0] = np.cumsum(c[0])
        n_runs = [c.shape[1] for c in contexts]
        contexts = np.concatenate(contexts, 1)
        sort = _order(*contexts)
        new = np.r_[True, (contexts[:, sort[1:]] != contexts[:, sort[:-1]]).any(0)]
        context = np.empty(len(sort), np.int64)  # each run's, numbered
        context[sort] = np.cumsum(new) - 1
        n, contexts = int(new.sum()), contexts[:, sort[new]]
        sizes = [_expand(r["b"], np.int64) for r in rows]
        words = np.concatenate([_from_differences(_expand(r["c"], np.int64), own) for r, own in zip(rows, sizes, strict=True)])
        sizes = np.concatenate(sizes)
        trained, lower, totals = (np.concatenate(x) for x in zip(*(
            np.split(_expand(r["d"], np.int64), [r["n"], 2 * r["n"]]) for r in rows), strict=True))
        sort = _order(of := np.repeat(context, sizes), words)
        new = np.r_[True, (of[sort[1:]] != of[sort[:-1]]) | (words[sort[1:]] != words[sort[:-1]])]
        place = np.empty(len(sort), np.int64)
        place[sort] = np.cumsum(new) - 1
        group = of[sort[new]]
        count = np.bincount(place, trained, len(group)).astype(np.int64)
        alone = np.zeros(len(group), bool) if last else np.bincount(place, minlength=len(group)) == 1
        below, total = np.zeros(len(group), np.int64), np.ones(n)
        below[place[trained > 0]] = lower[trained > 0]
        total[context] = totals
        own = np.bincount(group, np.where(count > 0, _discounted(below, ratios), 0) / total[group], n)
        low = np.stack([np.bincount(group, count == r, n) for r in range(1, CUTOFF + 1)], 1).astype(np.int64)
        bits, out, shared, at, run = _bits(low), [], [], 0, 0
        for r, runs in zip(rows, n_runs, strict=True):
            grams, here = place[at:at + r["n"]], context[run:run + runs]
            counts = count[grams]
            first = np.cumsum(sizes[run:run + runs]) - sizes[run:run + runs]
            needed = here[np.logical_or.reduceat(counts == 0, first)]
            shared.append(here[np.array(r["docs"], np.int64)])
            out.append((r["block"], order, r["part"], r["n"], None, _squeeze(2 * counts + alone[grams]), _squeeze(bits[here]),
                        _squeeze(low[needed].ravel()), _squeeze(own[needed])))
            at, run = at + r["n"], run + runs
        shared = np.unique(np.concatenate(shared))
        n_r += _counts_of_counts(count)
        out.append((-1, order, rows[0]["part"], 0, n_r.tolist(), _squeeze(contexts[:, shared].T.ravel()),
                    _squeeze(low[shared].ravel()), _squeeze(own[shared]), None))
        return pa.Table.from_batches([_batch(out)])
    return run


def _climbed(texts: pa.Table, answers: pa.Table, words: Words, orders: list[Order], n_parts: int, n_trained: int) -> _Block:
    block = _Block(texts, answers, words, n_parts, n_trained)
    for k, (below, table) in enumerate(itertools.pairwise([words, *orders]), 2):
        block.climb(k, table, below.ratios)
    return block


def _asks(order: int, *about):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(_climbed(texts, answers, *about).asks(order))])
    return run


def _documents(words: Words, *about):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        block = _climbed(texts, answers, words, *about)
        return pa.table({"n_tokens": block.lengths, "n_known": block.known,
                         "train_tokens": np.full(len(block.lengths), words.n_tokens), "base_score": block.base,
                         "score": block.sums(block.log), "doc_id": pa.array(block.docs, pa.int64())})
    return run


def katz_scores(docs: DataFrame, held_out: Column, *, order: int = 2, text: str = "text", doc_id: str = "doc_id",
                block: int = BLOCK, part: int = PART) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability).

    The model has n-grams of up to ``order`` words, at least 1. At a text's start the context is what there is of it.
    Learns from the rows where ``held_out`` is false and scores all. Tokens are words (runs of anything but ASCII white
    space, A-Z in lower case) and one end; a null text is empty and has only its end. ``base_score`` is the sum of
    log10((c + 0.1) / (N + 0.1 (V + 1))). Rows may repeat: each is a text. Without training rows every token is the unknown
    word, whose probability is then 1. An empty table gives an empty result. The driver holds totals and, for the
    contexts that are spread over parts, at most two rows of sums per part.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(text).alias("text"))
    n_bytes, n_trained = rows.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    n_parts = parts_for((n_bytes or 0) / WORD_BYTES, part)
    blocks = rows.mapInArrow(_blocks(n_parts, block), _SCHEMA).withColumn("text", F.col("part") < 0)
    blocks = stored_in_buckets(blocks, "blocks", "block", min(n_parts, BUCKETS), "text")
    answers = stored(blocks.where("not text").drop("text").groupBy("part").applyInArrow(_word_table(n_parts, CUTOFF), _SCHEMA), "words")
    totals = np.array([r.docs for r in answers.where("block = -1").select("docs").collect()] or [[0] * (CUTOFF + 3)], float).sum(0)
    words = Words(int(totals[0]), int(totals[1]), totals[2:]).mass(totals[2:])
    texts = blocks.where("text").drop("text")
    n_all = texts.agg(F.sum("n")).first()[0] or 0

    n_parts = parts_for(n_all, part)
    known, orders = answers.where("block >= 0"), []

    def in_blocks(what, schema: str) -> DataFrame:
        return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(what, schema)

    for k in range(2, order + 1):
        asked = in_blocks(_asks(k, words, orders, n_parts, n_trained), _SCHEMA)
        below = orders[-1].ratios if orders else words.ratios
        answers = stored(asked.groupBy("part").applyInArrow(_count_table(k, below, k == order), _SCHEMA), f"counts{k}")
        orders = [*orders, Order(answers.where("block = -1").select("docs", "a", "b", "c").collect())]
        known = known.unionAll(answers.where("block >= 0"))
    return in_blocks(_documents(words, orders, n_parts, n_trained), "n_tokens long, n_known long, train_tokens long, "
                     "base_score double, score double, doc_id long")
