"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's features describe it and its two neighbours; transitions tie neighbouring labels. A
document's quality is the mean of its lines' marginal probabilities of being good (forward-backward), weighted by length
and put on the scale of the labels by a logistic curve. Lines take their document's label for training, which is done on a
bounded sample of labelled documents; every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the training sample: documents, and bytes of text of each (longer ones are scored, but not trained on).
TRAIN_DOCS, TRAIN_BYTES = 4000, 100_000
ITERATIONS, RATE, PENALTY = 200, 0.1, 1e-3
CHUNK = 2_000_000

_BYTE = np.arange(256)
_CLASSES = {
    "lower": (_BYTE >= 97) & (_BYTE <= 122), "upper": (_BYTE >= 65) & (_BYTE <= 90), "digit": (_BYTE >= 48) & (_BYTE <= 57),
    "wide": _BYTE >= 128, "comma": np.isin(_BYTE, list(b",;:")), "stop": np.isin(_BYTE, list(b".?")),
    "shout": _BYTE == 33, "sign": np.isin(_BYTE, list(b"#$%&*+<=>@^~\\_")), "bar": _BYTE == 124,
    "bracket": np.isin(_BYTE, list(b"()[]{}/\"'-")),
}
N_OWN = len(_CLASSES) + 5
_MIX = np.random.default_rng(11).integers(1, 1 << 62, 256).astype(np.uint64) | np.uint64(1)
_SPACE = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])


def _line_features(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Own features of the lines that begin at ``starts`` (each ends with a newline): lines x N_OWN."""
    codes = np.frombuffer(data, np.uint8)
    ends = np.r_[starts[1:], len(codes)]
    length = (ends - starts - 1).astype(np.float64)
    out = np.zeros((len(starts), N_OWN))
    for k, member in enumerate(_CLASSES.values()):
        out[:, k] = np.add.reduceat(member[codes].astype(np.int32), starts) / np.maximum(length, 1)
    space = _SPACE[codes]
    first = np.flatnonzero(~space & np.r_[True, space[:-1]])  # where words begin
    words, repeated, line = np.zeros(len(starts)), np.zeros(len(starts)), np.zeros(len(starts), np.uint64)
    if len(first):
        mixed = _MIX[codes] * (np.arange(len(codes), dtype=np.uint64) - np.repeat(
            np.r_[0, first].astype(np.uint64), np.diff(np.r_[0, first, len(codes)])) + np.uint64(1))
        mixed[space] = 0
        hashes = np.add.reduceat(mixed, first)
        place = np.searchsorted(starts, first, "right") - 1
        words = np.bincount(place, minlength=len(starts)).astype(float)
        same = np.r_[False, (hashes[1:] == hashes[:-1]) & (place[1:] == place[:-1])]
        repeated = np.bincount(place, same, len(starts))
        np.add.at(line, place, hashes * (np.arange(len(first)).astype(np.uint64) - np.searchsorted(place, place).astype(np.uint64) + np.uint64(1)))
    n = len(_CLASSES)
    out[:, n] = repeated / np.maximum(words, 1)
    out[:, n + 1] = np.log1p(words)
    out[:, n + 2] = np.minimum(length / np.maximum(words, 1), 40) / 10
    out[1:, n + 3] = (line[1:] == line[:-1]) & (words[1:] > 0)
    out[:, n + 4] = length == 0
    return out


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines with those of the line before and after (zeros at the ends), line lengths, lines per text."""
    raw = [(t or "").encode("utf-8", "replace") + b"\n" for t in texts]
    data = b"".join(raw)
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    starts = np.r_[0, breaks[:-1] + 1].astype(np.int64) if len(breaks) else np.empty(0, np.int64)
    counts = np.array([r.count(b"\n") for r in raw], np.int64)
    own = _line_features(data, starts) if len(starts) else np.zeros((0, N_OWN))
    begins = np.cumsum(counts) - counts
    own[begins, len(_CLASSES) + 3] = 0  # the line before is another text's
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[begins], after[begins + counts - 1] = 0, 0
    return np.c_[own, before, after, np.ones(len(own))], (breaks - starts).astype(float), counts


def _scaled(features: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """In standard deviations of the training lines, at most four: a line unlike any of them is no more than unusual."""
    return np.clip((features - centre) / scale, -4, 4)


@dataclass
class Crf:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # features x 2
    moves: np.ndarray  # 2 x 2
    curve: tuple[float, float]

    def marginals(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability of good for every line."""
        scores, out = _scaled(features, self.centre, self.scale) @ self.weights, np.empty(len(features))
        for places in _blocks(counts):
            lines, mask = _padded(counts, places)
            nodes, _, _ = _forward_backward(scores[lines], mask, self.moves)
            out[lines[mask]] = nodes[mask][:, 1]
        return out

    def raw(self, features: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' marginals, as log odds."""
        weight, begins = np.maximum(lengths, 1), np.cumsum(counts) - counts
        good = np.add.reduceat(self.marginals(features, counts) * weight, begins) / np.add.reduceat(weight, begins)
        good = np.clip(good, 1e-6, 1 - 1e-6)
        return np.log(good / (1 - good))

    def quality(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        slope, base = self.curve
        return 1 / (1 + np.exp(-(slope * self.raw(*line_features(texts)) + base)))


def _blocks(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Texts of like numbers of lines together, some hundred thousand padded lines at a time."""
    order, at = np.argsort(-counts, kind="stable"), 0
    while at < len(order):
        some = max(1, 200_000 // int(counts[order[at]]))
        yield order[at:at + some]
        at += some


def _padded(counts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins, steps = (np.cumsum(counts) - counts)[places], np.arange(int(counts[places].max()))
    mask = steps < counts[places][:, None]
    return np.where(mask, begins[:, None] + steps, 0), mask


def _forward_backward(scores: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of labels, expected transitions, and the log partition sums' total, of padded chains."""
    n, steps, _ = scores.shape
    top = scores.max(2, keepdims=True)
    emit, move = np.exp(scores - top), np.exp(moves)
    alpha, beta, norm = np.empty_like(emit), np.ones_like(emit), np.ones((n, steps))
    alpha[:, 0] = emit[:, 0]
    for t in range(steps):
        if t:
            step = (alpha[:, t - 1] @ move) * emit[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        norm[:, t] = np.where(mask[:, t], alpha[:, t].sum(1), 1)
        alpha[:, t] /= norm[:, t, None]
    edges = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        inner = emit[:, t] * beta[:, t] / norm[:, t, None]
        edges += np.einsum("ni,nj->ij", alpha[:, t - 1] * mask[:, t, None], inner) * move
        beta[:, t - 1] = np.where(mask[:, t, None], inner @ move.T, 1)
    nodes = alpha * beta
    nodes /= nodes.sum(2, keepdims=True)
    return nodes, edges, float((np.log(norm) + top[:, :, 0] * mask).sum())


def fit(features: np.ndarray, lengths: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Crf:
    """Maximum likelihood with a penalty, by gradient steps (Adam); each line carries its document's label."""
    centre, scale = features.mean(0), features.std(0)
    centre[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    x, target = _scaled(features, centre, scale), np.repeat(labels, counts)
    truth = np.eye(2)[target]
    inside = np.ones(len(target), bool)
    inside[np.cumsum(counts) - counts] = False
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (target[inside.nonzero()[0] - 1], target[inside]), 1)
    parts = [(*_padded(counts, p),) for p in _blocks(counts)]
    weights, moves = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
    state = [np.zeros(weights.size + 4), np.zeros(weights.size + 4)]
    for step in range(1, ITERATIONS + 1):
        scores, nodes, edges = x @ weights, np.empty((len(x), 2)), np.zeros((2, 2))
        for lines, mask in parts:
            some, own, _ = _forward_backward(scores[lines], mask, moves)
            nodes[lines[mask]] = some[mask]
            edges += own
        slope = np.r_[(x.T @ (truth - nodes)).ravel(), (pairs - edges).ravel()] / len(x)
        slope -= PENALTY * np.r_[weights.ravel(), moves.ravel()]
        state = [0.9 * state[0] + 0.1 * slope, 0.99 * state[1] + 0.01 * slope ** 2]
        move = RATE * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
        weights = weights + move[:-4].reshape(weights.shape)
        moves = moves + move[-4:].reshape(2, 2)
    crf = Crf(centre, scale, weights, moves, (1.0, 0.0))
    raw, curve = crf.raw(features, lengths, counts), np.array([1.0, 0.0])
    for _ in range(50):  # the logistic curve by Newton steps, with a weak prior at slope 1
        p = 1 / (1 + np.exp(-(curve[0] * raw + curve[1])))
        z = np.c_[raw, np.ones(len(raw))]
        slope = z.T @ (labels - p) - 0.1 * (curve - [1, 0])
        curve = curve + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(2), slope)
    crf.curve = (float(curve[0]), float(curve[1]))
    return crf


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "label",
          max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES) -> Crf | float:
    """A model from the documents of at most ``max_docs`` labels, in the order of their identifiers' hash.

    ``labels`` has rows (doc_id, label 0 or 1; others are left out); a document with both labels teaches both. Documents
    of more than ``max_bytes`` bytes are not trained on. The chosen labels are few by that bound and go to every task, so
    the documents' texts are not moved. With labels of one kind only, or none, there is nothing to tell apart: the smoothed
    share of good labels is returned.
    """
    chosen = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
              .select(F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("label")).distinct()
              .orderBy(F.xxhash64("label_id"), "label_id", "label").limit(max_docs))
    sample = (docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
              .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
              .where(F.octet_length("text") <= max_bytes)
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label", "text").limit(max_docs).select("text", "label"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                x, lengths, _ = line_features([t])
                yield pa.RecordBatch.from_pydict({"label": pa.array([y], pa.int32()), "n": [len(x)],
                                                  "x": [x.astype(np.float32).tobytes()], "lengths": [lengths.tobytes()]})

    rows = sample.mapInArrow(features, "label int, n long, x binary, lengths binary").collect()
    labels = np.array([r.label for r in rows], int)
    if len(set(labels.tolist())) < 2:
        return float((labels.sum() + 1) / (len(labels) + 2))
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(r.n, -1) for r in rows]).astype(float)
    return fit(x, np.concatenate([np.frombuffer(r.lengths) for r in rows]), np.array([r.n for r in rows]), labels)


def score(docs: DataFrame, model: Crf | float, *, text: str = "text", threshold: float = 0.3,
          keep: dict[str, Column] | None = None) -> DataFrame:
    """The columns ``keep`` (by name) with score (0 to 1) and predicted (1 from ``threshold`` on).

    A null or empty text is one empty line and is scored like any other. Only the text is looked at.
    """
    keep = keep or {}
    kept = list(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found, at = batch.column("__text").to_pylist(), [], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < CHUNK:
                    size, end = size + len(texts[end] or ""), end + 1
                found.append(shared.value.quality(texts[at:end]) if isinstance(shared.value, Crf)
                             else np.full(end - at, shared.value))
                at = end
            scores = np.concatenate([np.empty(0), *found])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(scores, pa.float64()),
                                              pa.array((scores >= threshold).astype(np.int32))], [*kept, "score", "predicted"])

    types = [f"`{n}` {t}" for n, t in rows.dtypes if n != "__text"]
    return rows.mapInArrow(run, ", ".join([*types, "score double", "predicted int"]))
