"""Language identification by unigram models over a fixed public vocabulary, summed over all segmentations.

Each language has a probability for every piece of the vocabulary. A word's probability is the sum over all ways to cut it
into pieces, found by the forward algorithm; a text's is the product over its words (runs of letters, in lower case, marked
at their start). Piece probabilities come from the expectation step over the labelled texts: distinct words are counted per
language by Spark, and each word's expected pieces are found by the forward-backward algorithm and added up. A worker keeps
the words it has scored, so a text costs one lookup per word.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import of_worker, stored

LONGEST_PIECE, LONGEST_WORD = 16, 24
SMOOTHING, UNKNOWN = 0.1, 1e-7
START = "▁"
#: Letters, and numerals that regular expressions take for parts of words, such as superscripts, fractions and Roman numerals.
LETTERS = re.compile(r"[^\W\d_]+")
NONE = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    """All segmentations of words into the pieces of a vocabulary; a character that is no piece is the unknown piece."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())
                  if not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k) or model.is_byte(k))]
        self.index = {p: k for k, p in enumerate(pieces) if len(p) <= LONGEST_PIECE}
        self.n, self.powers = len(pieces), np.ones(LONGEST_WORD + 2, np.uint64)
        self.unknown, self.no_piece = self.n, self.n + 1
        self.powers[1:] = np.multiply.accumulate(np.full(LONGEST_WORD + 1, _BASE))
        self.keys: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0))]
        for size in range(1, LONGEST_PIECE + 1):
            own = [p for p in self.index if len(p) == size]
            keys = self._prefixes(own, size)[:, -1] if own else np.empty(0, np.uint64)
            order = np.argsort(keys)
            self.keys.append((keys[order], np.array([self.index[p] for p in own], np.int64)[order]))

    def _prefixes(self, words: list[str], width: int) -> np.ndarray:
        """Polynomial hashes of all prefixes, 0 to ``width`` characters long."""
        codes = np.frombuffer("".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le"), np.uint32)
        codes = codes.reshape(len(words), width).astype(np.uint64)
        out = np.zeros((len(words), width + 1), np.uint64)
        for k in range(width):
            out[:, k + 1] = out[:, k] * _BASE + codes[:, k]
        return out

    def arcs(self, words: list[str], width: int) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """By end position: (start, rows, piece numbers) of the pieces that lie there."""
        hashes, lengths = self._prefixes(words, width), np.array([len(w) for w in words])
        out: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(width + 1)]
        for size in range(1, min(width, LONGEST_PIECE) + 1):
            keys, numbers = self.keys[size]
            parts = hashes[:, size:] - hashes[:, :-size] * self.powers[size]
            if len(keys):
                at = np.minimum(np.searchsorted(keys, parts), len(keys) - 1)
                found = np.where(keys[at] == parts, numbers[at], self.no_piece)
            else:
                found = np.full(parts.shape, self.no_piece)
            if size == 1:
                found[(found == self.no_piece) & (np.arange(width) < lengths[:, None])] = self.unknown
            for start in range(width - size + 1):
                rows = np.flatnonzero(found[:, start] != self.no_piece)
                if len(rows):
                    out[start + size].append((start, rows, found[rows, start]))
        return out

    @staticmethod
    def groups(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """Words of like length together: (width, places)."""
        lengths = np.array([len(w) for w in words])
        at = 0
        for width in (5, 8, 11, 15, LONGEST_WORD):
            for places in np.array_split(p := np.flatnonzero((lengths > at) & (lengths <= width)), -(-len(p) // 20_000) or 1):
                if len(places):
                    yield width, places
            at = width

    def scores(self, words: list[str], model: np.ndarray) -> np.ndarray:
        """Natural log probabilities: words x languages. ``model`` is pieces (and the unknown one) x languages."""
        out = np.zeros((len(words), model.shape[1]))
        for width, places in self.groups(words):
            own = [words[k] for k in places.tolist()]
            alpha = self._forward(self.arcs(own, width), len(own), width, model)
            out[places] = np.log(alpha[[len(w) for w in own], np.arange(len(own))])
        for k, w in enumerate(words):
            if len(w) > LONGEST_WORD:
                out[k] = self._long(w, model)
        return out

    @staticmethod
    def _forward(arcs, n: int, width: int, model: np.ndarray) -> np.ndarray:
        alpha = np.zeros((width + 1, n, model.shape[1]))
        alpha[0] = 1
        for end in range(1, width + 1):
            for start, rows, pieces in arcs[end]:
                alpha[end, rows] += alpha[start, rows] * model[pieces]
        return alpha

    def _steps(self, word: str, model: np.ndarray) -> Iterator[np.ndarray]:
        """One word of any length: by end position, the sum over segmentations divided by that of the position before."""
        recent = [np.ones(model.shape[1])]
        for end in range(1, len(word) + 1):
            here = np.zeros(model.shape[1])
            for size in range(1, min(end, LONGEST_PIECE) + 1):
                piece = self.index.get(word[end - size:end], self.unknown if size == 1 else None)
                if piece is not None:
                    here += recent[-size] * model[piece]
            recent = [x / here for x in recent[-LONGEST_PIECE:]] + [np.ones(model.shape[1])]
            yield here

    def _long(self, word: str, model: np.ndarray) -> np.ndarray:
        """One word of any length, scaled at every step."""
        total = np.zeros(model.shape[1])
        for here in self._steps(word, model):
            total += np.log(here)
        return total

    def _long_expected(self, word: str, weight: np.ndarray, model: np.ndarray, out: np.ndarray) -> None:
        """Adds to ``out`` the expected pieces of one word of any length; each position has the weight of segmentations through it."""
        steps, through = np.empty((len(word), model.shape[1])), np.zeros((len(word) + 1, model.shape[1]))
        for k, here in enumerate(self._steps(word, model)):
            steps[k] = here
        through[-1] = weight
        for end in range(len(word), 0, -1):
            share = through[end]
            for size in range(1, min(end, LONGEST_PIECE) + 1):
                share = share / steps[end - size]
                piece = self.index.get(word[end - size:end], self.unknown if size == 1 else None)
                if piece is not None:
                    out[piece] += share * model[piece]
                    through[end - size] += share * model[piece]

    def expected(self, words: list[str], weights: np.ndarray, model: np.ndarray) -> np.ndarray:
        """Expected pieces x languages of the words, each counted ``weights`` (words x languages) times."""
        out = np.zeros((self.n + 1, model.shape[1]))
        for width, places in self.groups(words):
            own, weight = [words[k] for k in places.tolist()], weights[places]
            arcs = self.arcs(own, width)
            alpha = self._forward(arcs, len(own), width, model)
            ends, rows = np.array([len(w) for w in own]), np.arange(len(own))
            beta = np.zeros_like(alpha)
            beta[ends, rows] = weight / alpha[ends, rows]
            for end in range(width, 0, -1):
                for start, at, pieces in arcs[end]:
                    later = beta[end, at] * model[pieces]
                    beta[start, at] += later
                    share = alpha[start, at] * later
                    for k in range(out.shape[1]):
                        out[:, k] += np.bincount(pieces, share[:, k], len(out))
        for k, w in enumerate(words):
            if len(w) > LONGEST_WORD:
                self._long_expected(w, weights[k], model, out)
        return out


def _lattice(vocabulary: str) -> Lattice:
    return of_worker("language", vocabulary, lambda: Lattice(vocabulary))


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    found = LETTERS.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def has_letter(text: str | None) -> bool:
    found = LETTERS.search(text) if text else None
    return found is not None and (found[0].isalpha() or any(map(str.isalpha, text)))


def count_words(labelled: DataFrame, flush: int = 200_000) -> DataFrame:
    """Rows (lang, word, n) of a table of lang and text; a task holds at most about ``flush`` words and one batch's new ones."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def rows():
            for lang, words in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.string()),
                                                  pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"])
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                held.setdefault(lang, Counter()).update(words_of(text.as_py()))
                if len(held[lang]) > flush:
                    yield from rows()
                    held.clear()
        yield from rows()

    return labelled.mapInArrow(count, "lang string, word string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, vocabulary: str, *, rounds: int = 1) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (pieces x languages) from all rows of a table of lang and text, null lang left out.

    What comes to the driver is one number per piece and language. The first round starts from equal piece probabilities.
    """
    spark = labelled.sparkSession
    labelled = labelled.where(F.col("lang").isNotNull())
    words = stored(count_words(labelled.where(F.col("text").isNotNull())), "words")
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    n = _lattice(vocabulary).n
    model = np.full((n + 1, len(langs)), 1.0 / n)
    number = {x: k for k, x in enumerate(langs)}
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast(model)

        def step(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            lattice, total = _lattice(vocabulary), np.zeros(shared.value.shape)
            for frame in frames:
                own, place = np.unique(frame["word"].to_numpy(object), return_inverse=True)
                weights = np.zeros((len(own), len(number)))
                np.add.at(weights, (place, frame["lang"].map(number).to_numpy()), frame["n"].to_numpy())
                total += lattice.expected([START + w for w in own.tolist()], weights, shared.value)
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "n": total[piece, lang]})

        found = (words.mapInPandas(step, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
                 .toPandas())
        counts = np.full((n + 1, len(langs)), SMOOTHING)
        counts[found["piece"].to_numpy(int), found["lang"].to_numpy(int)] += np.round(found["n"].to_numpy(float), 6)
        model = counts / counts.sum(0)
        model[n] = UNKNOWN
        shared.destroy()
    return langs, model


class Scorer:
    """Texts' log probabilities; the words seen are kept, at most ``capacity`` of them, and then started anew."""

    def __init__(self, vocabulary: str, model: np.ndarray, capacity: int = 400_000):
        self.lattice, self.model, self.capacity = _lattice(vocabulary), model, capacity
        self.place: dict[str, int] = {}
        self.known = np.empty((0, model.shape[1]))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out, at = np.zeros((len(texts), self.model.shape[1])), 0
        while at < len(texts):  # some megabytes of text at a time, however large the batch
            some, size = [], 0
            while at + len(some) < len(texts) and (not some or size < 4_000_000):
                some.append(words_of(texts[at + len(some)]))
                size += len(texts[at + len(some) - 1] or "")
            self.learn({w for words in some for w in words})
            for k, words in enumerate(some):
                if words:
                    out[at + k] = self.known[list(map(self.place.__getitem__, words))].sum(0)
            at += len(some)
        return out

    def learn(self, words: set[str]) -> None:
        if len(self.place) > self.capacity:
            self.place, self.known = {}, self.known[:0]
        new = [w for w in words if w not in self.place]
        if new:
            base = len(self.place)
            self.place.update({w: base + k for k, w in enumerate(new)})
            if base + len(new) > len(self.known):
                self.known = np.concatenate([self.known[:base], np.empty((base // 2 + len(new), self.known.shape[1]))])
            self.known[base:base + len(new)] = self.lattice.scores([START + w for w in new], self.model)


def _predict(langs: list[str], key: str, vocabulary: str, shared, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    scorer = of_worker(f"language {key}", "scorer", lambda: Scorer(vocabulary, shared.value))
    found = scorer(texts) if langs else np.zeros((len(texts), 1))
    best = found.argmax(1)
    sure = 1 / np.exp(found - found.max(1, keepdims=True)).sum(1)
    lettered = np.array([bool(langs) and has_letter(t) for t in texts], bool)
    names = [langs[b] if ok else NONE for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
    return names, np.where(lettered, sure, 0.0)


def identify(docs: DataFrame, langs: list[str], model: np.ndarray, vocabulary: str, *, text: str = "text",
             keep: dict[str, Column] | None = None) -> DataFrame:
    """The columns ``keep`` (by name) with lang_pred and score, the language's probability given equal chances beforehand.

    A text that is null or has no letter, or any text if no language was learned, is ``und`` with score 0. Ties go to the
    language first in code point order. Only the text is looked at. An empty table gives an empty result.
    """
    keep = keep or {}
    kept = list(keep)
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).alias("__text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sure = _predict(langs, key, vocabulary, shared, batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(names, pa.string()),
                                              pa.array(sure, pa.float64())], [*kept, "lang_pred", "score"])

    types = [f"`{n}` {t}" for n, t in rows.dtypes if n != "__text"]
    return rows.mapInArrow(score, ", ".join([*types, "lang_pred string", "score double"]))


def accepted(docs: DataFrame, langs: list[str], model: np.ndarray, vocabulary: str, *, text: str = "text",
             least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is found with a probability of at least ``least``."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sure = _predict(langs, key, vocabulary, shared, batch.column(text).to_pylist())
            yield batch.filter(pa.array((sure >= least) & (np.array(names, object) != NONE), pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
