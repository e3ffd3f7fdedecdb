"""Counting quotient filters give back what they hold, and phrases equal a count by hand."""

import re
from collections import Counter

import numpy as np
import pytest

from indicatrix.llm.phrases import Layout, collocations, counted, decode, encode


@pytest.mark.parametrize(("n", "bits"), [(2, 1), (2, 5), (3, 9), (4, 16), (3, 21), (4, 17), (4, 25), (4, 32)])
@pytest.mark.parametrize("part_bits", [0, 1])
def test_filters_are_lossless(n, bits, part_bits):
    random = np.random.default_rng(n * bits)
    layout = Layout(n, bits)
    words = [random.integers(0, 1 << bits, 5_000).astype(np.uint64) for _ in range(n)]
    permuted = layout.permute(words)
    assert all((a == b).all() for a, b in zip(layout.words(permuted), words, strict=True))
    keys, counts = counted(permuted)
    counts = counts * random.integers(1, 1000, len(counts))
    assert len(keys) == len(set(zip(*[w.tolist() for w in words], strict=True)))
    parts = layout.top(keys, part_bits).astype(int)
    for part in set(parts.tolist()):
        some = parts == part
        got_keys, got_counts = decode(encode(keys[some], counts[some], layout, part, part_bits), layout, part, part_bits)
        assert (got_keys == keys[some]).all() and (got_counts == counts[some]).all()


def test_merged_filters_add_up():
    layout = Layout(3, 30)
    random = np.random.default_rng(1)
    words = [random.integers(0, 40, 20_000).astype(np.uint64) for _ in range(3)]
    keys = layout.permute(words)
    halves = [counted(keys[::2]), counted(keys[1::2])]
    back = [decode(encode(k, c, layout, 0, 0), layout, 0, 0) for k, c in halves]
    both = counted(np.concatenate([k for k, _ in back]), np.concatenate([c for _, c in back]))
    want = Counter(zip(*[w.tolist() for w in words], strict=True))
    got = dict(zip(zip(*[w.tolist() for w in layout.words(both[0])], strict=True), both[1].tolist(), strict=True))
    assert got == want


def by_hand(rows, least, top, contained=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    out = []
    for (lang, g), a in candidates.items():
        score, k = min((2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g)))
        inside = [b for (other, h), b in candidates.items() if other == lang and len(h) > len(g)
                  and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))]
        if not any(100 * b >= contained * a for b in inside):
            out.append((lang, score, a, " ".join(g), f[lang, g[:k]], f[lang, g[k:]]))
    result = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[1], -o[2], o[3].encode()))[:top]
        result += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (_, s, a, p, l, r) in enumerate(own)]
    return sorted(result)


def corpus():
    random = np.random.default_rng(5)
    words = ["Alpha", "beta", "gamma", "É", "delta", "the", "of", "x\x01y", "новый", "word"]
    rows = []
    for i in range(120):
        some = random.choice(words, 60, p=[.1, .1, .1, .05, .05, .3, .2, .03, .03, .04])
        ends = random.choice([" ", "  ", "\t", ", ", ".", "\n", "!"], 60, p=[.7, .1, .05, .05, .04, .04, .02])
        rows.append((["en", "de", None, ""][i % 4], "".join(w + e for w, e in zip(some, ends, strict=True))))
    return rows + [("en", None), ("en", ""), ("en", "beta " * 30_000), ("en", "one two three four five. " * 40), ("de", " \t\n")] * 2


@pytest.mark.parametrize(("least", "top"), [(2, 7), (5, 2000), (30, 2000)])
def test_phrases_equal_a_count_by_hand(spark, least, top):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, lang, "clash", 1) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, word string, rank int").repartition(5)
    out = collocations(docs, least=least, top=top)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == by_hand(rows, least, top)


def test_many_blocks_and_ranges(spark, monkeypatch):
    from indicatrix.llm import phrases

    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for name, value in (("BLOCK", 500), ("SLICE", 100), ("ENTRIES", 4_000)):
        monkeypatch.setattr(phrases, name, value)
    out = phrases.collocations(docs, least=5)
    assert sorted(map(tuple, out.collect())) == by_hand(rows, 5, 2000)


def test_empty_table_has_no_phrases(spark):
    assert collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []
    assert collocations(spark.createDataFrame([("en", None), (None, "a")], "lang string, text string")).collect() == []


@pytest.mark.parametrize("n, bits, most", [(2, 20, 110), (3, 24, 160)])
def test_memory_of_a_task_that_counts(n, bits, most):
    """A task holds its numbers and one sorted copy, and makes n-grams of a part of its words at once (memory in MB)."""
    import tracemalloc

    import pyarrow as pa

    from indicatrix.llm import phrases

    rng = np.random.default_rng(n)
    ids = [rng.integers(0, 1 << bits, 500_000, dtype=np.uint32) for _ in range(6)]
    batches = [pa.record_batch({"words": pa.array([x.tobytes()], pa.binary())}) for x in ids]
    layout = Layout(n, bits)
    tracemalloc.start()
    found = {}
    for batch in phrases._count(layout, 4, None, None, 0, 2_000_000)(iter(batches)):
        for part, data in zip(batch["part"].to_pylist(), batch["filter"].to_pylist(), strict=True):
            found[part] = found.get(part, 0) + int(decode(data, layout, part, 4)[1].sum())
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    inside = [np.all([x[k:len(x) - n + 1 + k] for k in range(n)], axis=0) for x in ids]
    assert sum(found.values()) == sum(int(x.sum()) for x in inside)
    assert peak < most, peak
