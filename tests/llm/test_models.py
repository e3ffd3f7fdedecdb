"""Language identification, line quality, Katz backoff and neighbour search against plain computations."""

import glob
import math
import os
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from indicatrix.llm import ann, katz, language_id, quality
from indicatrix.llm.queries import op4_katz_scores

PIECES = public_tokenizers.path("piece_bpe_32k.model")
EN = "the quick brown fox jumps over the lazy dog and runs away with all of the other animals"
DE = "der schnelle braune Fuchs springt über den faulen Hund und läuft mit allen anderen Tieren davon"


def all_ways(lattice, model, word):
    """Log of the sum over all segmentations, by recursion on the text."""
    def rest(at):
        if at == len(word):
            return np.ones(model.shape[1])
        total = np.zeros(model.shape[1])
        for size in range(1, min(language_id.LONGEST_PIECE, len(word) - at) + 1):
            piece = lattice.index.get(word[at:at + size], lattice.unknown if size == 1 else None)
            if piece is not None:
                total = total + model[piece] * rest(at + size)
        return total
    return np.log(rest(0))


def test_forward_sums_all_segmentations():
    lattice = language_id._lattice(PIECES)
    model = np.random.default_rng(0).random((lattice.n + 1, 2))
    model /= model.sum(0)
    words = ["▁hello", "▁é☃x", "▁a", "▁nationality", "▁über"]
    want = [all_ways(lattice, model, w) for w in words]
    assert np.allclose(lattice.scores(words, model), want)
    assert np.allclose([lattice._long(w, model) for w in words], want)
    long = "▁" + "abcdefghij" * 300
    assert np.isfinite(lattice.scores([long], model)).all()


def test_expected_pieces_cover_every_character_once():
    lattice = language_id._lattice(PIECES)
    model = np.full((lattice.n + 1, 1), 1 / lattice.n)
    words = ["▁hello", "▁the", "▁☃"]
    counts = lattice.expected(words, np.array([[2.0], [1.0], [3.0]]), model)[:, 0]
    sizes = np.zeros(lattice.n + 1)
    for piece, k in lattice.index.items():
        sizes[k] = len(piece)
    sizes[lattice.unknown] = 1
    assert counts @ sizes == pytest.approx(2 * 6 + 4 + 3 * 2)


def test_long_words_are_counted():
    lattice = language_id._lattice(PIECES)
    model = np.random.default_rng(1).random((lattice.n + 1, 2))
    model /= model.sum(0)
    for word in ("▁hello", "▁é☃x", "▁nationality"):
        alone = np.zeros_like(model)
        lattice._long_expected(word, np.array([2.0, 0.5]), model, alone)
        assert np.allclose(alone, lattice.expected([word], np.array([[2.0, 0.5]]), model))
    long = "▁" + "donaudampfschifffahrtsgesellschaft" * 40
    counts = lattice.expected(["▁the", long], np.array([[1.0, 0.0], [0.0, 3.0]]), model)
    sizes = np.zeros(lattice.n + 1)
    for piece, k in lattice.index.items():
        sizes[k] = len(piece)
    sizes[lattice.unknown] = 1
    assert sizes @ counts == pytest.approx([4, 3 * len(long)])


def language_rows():
    rows = [(k, EN if k % 2 else DE, "en" if k % 2 else "de", "x") for k in range(20)]
    return rows + [(50, None, "en", "x"), (51, "", None, "x"), (52, "12 34 !!", "de", "x"), (53, "Die anderen Hunde", None, None),
                   (54, "x" * 100_000, None, "x"), (53, "all of the animals", None, None), (None, EN, None, "x")]


def test_language_of_texts(spark):
    df = spark.createDataFrame(language_rows(), "doc_id long, text string, lang string, score string")
    langs, model = language_id.train(df.select("lang", "text"), PIECES)
    assert langs == ["de", "en"] and model[:-1].sum(0) == pytest.approx(1, abs=1e-3)
    got = language_id.identify(df, langs, model, PIECES, keep={"doc_id": F.col("doc_id"), "text": F.col("text")}).collect()
    by = {(r.doc_id, r.text): r for r in got}
    assert len(got) == 27 and all(0 <= r.score <= 1 for r in got)
    assert {by[(d, t)].lang_pred for d, t in [(50, None), (51, ""), (52, "12 34 !!")]} == {"und"}
    assert by[(53, "Die anderen Hunde")].lang_pred == "de" and by[(53, "all of the animals")].lang_pred == "en"
    assert by[(None, EN)].lang_pred == "en" and all(by[(k, EN)].lang_pred == "en" for k in range(1, 20, 2))
    stay = language_id.accepted(df, langs, model, PIECES)
    assert stay.columns == df.columns
    assert {r.doc_id for r in stay.collect()} >= {*range(20), 53, None} and not {50, 51, 52} & {r.doc_id for r in stay.collect()}


def test_no_language_learned(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    langs, model = language_id.train(df, PIECES)
    (row,) = language_id.identify(df, langs, model, PIECES).collect()
    assert (langs, row.lang_pred, row.score) == ([], "und", 0.0)
    assert language_id.identify(df.limit(0), langs, model, PIECES).collect() == []


def test_held_out_accuracy_of_languages_and_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    split = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    langs, model = language_id.train(docs.where(~split), PIECES)
    got = language_id.identify(docs.where(split), langs, model, PIECES, keep={"lang": F.col("lang")}).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    split = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    crf = quality.train(docs.where(~split), labels)
    got = quality.score(docs.where(split).join(labels, "doc_id"), crf, keep={"label": F.col("label")}).collect()
    good, bad = ([r.score for r in got if r.label == y] for y in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95


def test_crf_marginals_equal_all_labelings():
    rng = np.random.default_rng(2)
    scores, moves = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2))
    weights = defaultdict(float)
    for code in range(16):
        y = [code >> t & 1 for t in range(4)]
        weights[tuple(y)] = math.exp(sum(scores[0, t, y[t]] for t in range(4)) + sum(moves[y[t - 1], y[t]] for t in range(1, 4)))
    z = sum(weights.values())
    nodes, edges, log = quality._forward_backward(scores, np.ones((1, 4), bool), moves)
    want = [[sum(w for y, w in weights.items() if y[t] == k) / z for k in (0, 1)] for t in range(4)]
    assert np.allclose(nodes[0], want) and log == pytest.approx(math.log(z))
    pairs = np.zeros((2, 2))
    for y, w in weights.items():
        for t in range(1, 4):
            pairs[y[t - 1], y[t]] += w / z
    assert np.allclose(edges, pairs)
    padded, mask = np.concatenate([scores, np.zeros((1, 3, 2))], 1), np.array([[True] * 4 + [False] * 3])
    assert np.allclose(quality._forward_backward(padded, mask, moves)[0][0, :4], want)
    assert np.allclose(quality._forward_backward(padded, mask, moves)[1], pairs)


def test_line_features_of_many_texts_equal_those_of_one():
    texts = ["a b\nB! B!\n\nB! B!", None, "", "x | y | z\n" + "word " * 5000, "é 12\n\n", "a a a a"]
    together, lengths, counts = quality.line_features(texts)
    apart = [quality.line_features([t]) for t in texts]
    assert np.allclose(together, np.concatenate([x for x, _, _ in apart])) and counts.tolist() == [4, 1, 1, 2, 3, 1]
    assert np.allclose(lengths, np.concatenate([x for _, x, _ in apart]))
    names = list(quality._CLASSES)
    assert together[-1, len(names)] == 0.75  # repeated words
    assert together[6, names.index("bar")] == pytest.approx(2 / 9)


def test_quality_of_texts(spark):
    rows = [(k, "Some plain words of a text.\nAnd one more line." if k % 2 else "BUY!! NOW!!\nBUY!! NOW!!", "c") for k in range(40)]
    rows += [(100, None, "c"), (101, "", "c"), (102, "BUY!! NOW!!\n" * 30_000, None), (1, "BUY!!", None), (None, "Plain words of text.", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(30)] + [(5, None, 1), (None, 1, 0), (900, 1, 0)],
                                   "doc_id long, label int, toxic int")
    model = quality.train(docs, labels)
    got = quality.score(docs, model, keep={"doc_id": F.col("doc_id"), "text": F.col("text")}).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id in range(2, 40))
    assert {r.doc_id: r.predicted for r in got}[102] == 0
    assert quality.score(docs.limit(0), model).collect() == []
    alone = quality.train(docs, labels.where("label = 1"))
    assert isinstance(alone, float) and 0.5 < alone < 1
    assert quality.train(docs, labels.limit(0)) == 0.5 and quality.score(docs, 0.5).first().predicted == 1


def plain_katz(rows):
    def tokens(text):
        return (text or "").encode().lower().split() + [b" "]
    words, follow = Counter(), defaultdict(Counter)
    for _, text, held in rows:
        if not held:
            own = tokens(text)
            words.update(own)
            for a, b in zip([None, *own], own, strict=False):
                follow[a][b] += 1
    n_r = lambda counts: np.array([sum(c == r for c in counts) for r in range(1, 7)], float)
    one, two = katz.discounts(n_r(words.values())), katz.discounts(n_r([c for m in follow.values() for c in m.values()]))
    kept = lambda c, d: c * d[min(c, 6)]
    n, mass = sum(words.values()), sum(kept(c, one) for c in words.values())
    total = n if n - mass > 1e-12 else n + 1

    def single(w):
        return kept(words[w], one) / total if w in words else (total - mass) / total

    def after(a, b):
        if a not in follow:
            return single(b)
        t, m = sum(follow[a].values()), sum(kept(c, two) for c in follow[a].values())
        t = t if t - m > 1e-9 * t else t + 1
        if b in follow[a]:
            return kept(follow[a][b], two) / t
        return (t - m) / t / (1 - sum(single(x) for x in follow[a])) * single(b)

    for a in [None, *words, b"never"]:
        assert sum(after(a, b) for b in words) + after(a, b"never seen") == pytest.approx(1)
    out = []
    for d, text, _ in rows:
        own = tokens(text)
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (len(words) + 1))) for w in own)
        score = sum(math.log10(after(a, b)) for a, b in zip([None, *own], own, strict=False))
        out.append((d, len(own), sum(w in words for w in own), n, base, score))
    return out


def plain_katz_of(rows, order):
    """Scores by recursion over the orders, from counts of whole contexts; a text starts with None."""
    texts = [(r, (r[1] or "").encode().lower().split() + [b" "]) for r in rows]
    counts = [defaultdict(Counter) for _ in range(order)]
    for (_, _, held), own in texts:
        for at, word in enumerate(own if not held else []):
            for n in range(min(order, at + 2)):
                counts[n][tuple([None, *own][at + 1 - n:at + 1])][word] += 1
    ratios = [katz.discounts(np.array([sum(c == r for m in of.values() for c in m.values()) for r in range(1, 7)], float))
              for of in counts]

    def after(context, word):
        n = len(context)
        if context not in counts[n]:
            return after(context[1:], word)
        follow = counts[n][context]
        kept = {w: c * ratios[n][min(c, 6)] for w, c in follow.items()}
        total = sum(follow.values())
        total += total - sum(kept.values()) <= 1e-9 * total
        if word in kept:
            return kept[word] / total
        left = (total - sum(kept.values())) / total
        return left / (1 - sum(after(context[1:], w) for w in follow)) * after(context[1:], word) if n else left

    words = counts[0][()]
    for context in [c for of in counts for c in list(of)[:40]]:
        assert sum(after(context, w) for w in words) + after(context, b"never seen") == pytest.approx(1)
    return [(r[0], len(own), sum(math.log10(after(tuple([None, *own][max(0, at + 2 - order):at + 1]), w))
                                 for at, w in enumerate(own))) for r, own in texts]


def katz_rows(seed):
    rng = np.random.default_rng(seed)
    names = [f"W{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choice(names, int(rng.integers(0, 25)), p=(p := 1 / np.arange(1, 61)) / p.sum())), k % 5 == 0)
            for k in range(120)]
    return rows + [(200, None, False), (201, "", True), (202, "new words here w1", True), (3, "W1 w1", False), (3, "W1 w1", False),
                   (None, "w2\tw3\n w4", False), (203, "w1 " * 20_000, True)]


@pytest.mark.parametrize("block, part", [(1_000_000, 3_000_000), (300, 200), (50, 2000)])
def test_katz(spark, block, part):
    rows = katz_rows(block)
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, out boolean, score string, n double")
    got = katz.katz_scores(df, F.col("out"), block=block, part=part).collect()
    key = lambda r: (str(r[0]), r[1], r[4])
    got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
    for mine, want in zip(got, sorted(plain_katz(rows), key=key), strict=True):
        assert mine[:4] == want[:4] and mine[4:] == pytest.approx(want[4:], rel=1e-9)


@pytest.mark.parametrize("order, block, part", [(1, 300, 200), (3, 1_000_000, 3_000_000), (3, 300, 200), (4, 50, 2000)])
def test_katz_orders(spark, order, block, part):
    rows = [r for r in katz_rows(7)[:-1] if r[0] is not None] + [(300, "w1 w2 w1 w2 " * 9, False), (301, "w1 w2 w3 w1 " * 9, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, out boolean")
    got = sorted((r.doc_id, r.n_tokens, r.score) for r in katz.katz_scores(df, F.col("out"), order=order, block=block, part=part).collect())
    for mine, want in zip(got, sorted(plain_katz_of(rows, order)), strict=True):
        assert mine[:2] == want[:2] and mine[2] == pytest.approx(want[2], rel=1e-9)


def test_katz_query_is_of_order_three(spark):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    want = katz.katz_scores(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), held_out, order=3)
    want = sorted((r.doc_id, round(r.score, 6)) for r in want.collect())
    assert sorted((r.doc_id, round(r.score, 6)) for r in op4_katz_scores(spark, "/root/testdata/sf0.001").collect()) == want


def sent(spark, order, name="counts"):
    """Rows and n-grams that each part of the latest count table of an order received."""
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    path = max(glob.glob(f"{root}/{name}{order}-*"), key=os.path.getmtime)
    return spark.read.parquet(f"file://{path}").where("block >= 0").groupBy("part").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()


def test_katz_word_in_most_places(spark):
    rows = [(k, "w " * 3000 + f"w{k % 7} x w{k % 3} " * 20, k % 5 == 0) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, out boolean").repartition(4)
    got = katz.katz_scores(df, F.col("out"), block=9000, part=2000).collect()
    for mine, want in zip(sorted(got, key=lambda r: r.doc_id), plain_katz(rows), strict=True):
        assert (mine.doc_id, mine.n_tokens, mine.n_known) == want[:3] and mine.score == pytest.approx(want[5], rel=1e-9)
    parts = sent(spark, 2)
    assert max(p.n for p in parts) <= 200 and sum(p.n for p in parts) <= 16 * 40  # of 122,440 tokens


def test_katz_word_table_grows_with_the_input(spark):
    rows = [(k, " ".join(f"w{k * 500 + i}" for i in range(500)), False) for k in range(40)]
    katz.katz_scores(spark.createDataFrame(rows, "doc_id long, text string, out boolean"), F.col("out"), block=500, part=1000)
    parts = sent(spark, "", "words")
    assert sum(p.n for p in parts) == 40 * 501 and max(p.n for p in parts) <= 1500  # of 4 shuffle partitions, over 5,000 each


def test_katz_sends_nothing_after_contexts_of_one_block(spark):
    rows = [(k, " ".join(f"w{k * 20 + i} w{k * 20 + i // 2}" for i in range(20)) + " all of them", k % 4 == 3) for k in range(6)]
    df = spark.createDataFrame([*rows, (50, "w1 w2 w3 all of", True)], "doc_id long, text string, out boolean").coalesce(1)
    got = katz.katz_scores(df, F.col("out"), order=3, block=40, part=1000).collect()
    want = sorted(plain_katz_of([*rows, (50, "w1 w2 w3 all of", True)], 3))
    for mine, row in zip(sorted((r.doc_id, r.n_tokens, r.score) for r in got), want, strict=True):
        assert mine[:2] == row[:2] and mine[2] == pytest.approx(row[2], rel=1e-9)
    assert max(sum(p.n for p in sent(spark, order)) for order in (2, 3)) < 80  # of 264 tokens in blocks of 40


def test_katz_without_training_or_rows(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (row,) = katz.katz_scores(df, F.lit(True)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)
    assert katz.katz_scores(df.limit(0), F.lit(True)).collect() == []


def test_discounts_of_good_counts():
    n_r = np.array([1000.0, 400, 220, 140, 100, 75])
    got = katz.discounts(n_r)
    rest = 6 * 75 / 1000
    assert got[1] == pytest.approx((2 * 400 / 1000 - rest) / (1 - rest)) and got[6] == 1
    assert katz.discounts(np.zeros(6))[1:6] == pytest.approx([0.5, 0.75, 5 / 6, 0.875, 0.9])


def neighbours(rows, k):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and fine(v)})
    out = {}
    for i, v in rows:
        scored = [(-float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float))), j) for j, w in rows if j != i and len(w) == len(v)]
        out[i] = sorted(scored)[:k]
    return out


def test_search_of_small_tables_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.integers(-2, 3, 6).astype(float).tolist()) for k in range(150)] + [(500 + k, [1.0] * 6) for k in range(60)]
    rows += [(900, None), (901, [0.0] * 6), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [math.nan] + [1.0] * 5), (904, [math.inf] + [1.0] * 5),
             (None, [1.0] * 6), (905, [2.0, 1.0]), (906, [1.0, 1.0]), (907, []), (500, [1.0] * 6), (908, [9.0] * 6)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, shard string, rank int")
    index = ann.build_index(df, k=20, shard=80)
    got = ann.search_index(index, df, k=20, ef=200, block=50).collect()
    mine = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        mine[r.query_id].append((-r.score, r.vec_id))
        assert r.rank == len(mine[r.query_id])
    want = {i: x for i, x in neighbours(rows, 20).items() if x}
    assert dict(mine) == want
    assert ann.search_index(index, df.limit(0)).collect() == [] and ann.search_index(ann.build_index(df.limit(0)), df).collect() == []


def test_search_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = df.collect()
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32).astype(float)
    found = defaultdict(set)
    for r in ann.search_index(ann.build_index(df, shard=700), df.where("vec_id % 20 = 0")).collect():
        found[r.query_id].add(r.vec_id)
    hits = []
    for q in ids[ids % 20 == 0].tolist():
        scores = points @ points[ids == q][0]
        scores[ids == q] = -np.inf
        hits.append(len(found[q] & set(ids[np.lexsort((ids, -scores))[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9


@pytest.mark.parametrize(("text", "found"), [("²", []), ("Ⅷ ½", []), ("x² 一二 ３ é_ж", ["x", "一二", "é", "ж"]), ("", [])])
def test_numerals_are_no_letters(text, found):
    assert language_id.words_of(text) == found and language_id.has_letter(text) == bool(found)
