"""Exact dedup, line dedup and mixing against plain Python, with nulls, ties, repeated rows and clashing columns."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicatrix.llm import exact_dedup, line_dedup, mixing
from indicatrix.llm.common import unit_hash

DOCS = "doc_id long, text string, source string"
ODD = "doc_id long, text string, source string, kept string, size string, row string, key string, run int, place string"


def odd(rows):
    return [(*r, "a", "b", "c", "d", 7, "e") for r in rows]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ROWS = [(1, "same", "a"), (2, "same", "a"), (5, "same", None), (3, "Same", "b"), (4, None, "b"), (6, "", "a"), (None, "same", "a"),
        (7, "x" * 300_000, "a"), (8, "x" * 300_000, "a"), (5, "same", "c"), (9, "é\n☃", "b")]


def test_exact_groups(spark):
    got = exact_dedup.exact_groups(spark.createDataFrame(odd(ROWS), ODD)).collect()
    by_text = {}
    for d, t, _ in ROWS:
        by_text.setdefault(t or "", []).append(d)
    want = sorted((d or -1, max(x for x in by_text[t or ""] if x is not None), len(by_text[t or ""]), sha(t or "")) for d, t, _ in ROWS)
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert len(kept) == len(by_text) == len({h for _, h in kept})  # one row of each group, also where 5 is there twice
    assert all(d == k for d, k in [(r.doc_id, r.keep_id) for r in got if r.kept])


@pytest.mark.parametrize("runs, fan_in", [(1, 8), (64, 8), (10, 3), (64, 2)])
def test_exact_groups_do_not_depend_on_the_tree(spark, runs, fan_in):
    df = spark.createDataFrame([(k, f"t{k % 3}", "s") for k in range(60)], DOCS)
    got = exact_dedup.exact_groups(df, keep="min", runs=runs, fan_in=fan_in).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(0, 20), (1, 20), (2, 20)}
    assert sorted(r.doc_id for r in got if r.kept) == [0, 1, 2]


def test_exact_groups_normalised_and_empty(spark):
    df = spark.createDataFrame([(1, "A", "s"), (2, "a", "s")], DOCS)
    assert [r.group_size for r in exact_dedup.exact_groups(df, normalise=F.lower).collect()] == [2, 2]
    assert exact_dedup.exact_groups(df.limit(0)).collect() == []


def plain_lines(rows, min_docs):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    docs = {}
    for d, t, _ in rows:
        for line in (t or "").split("\n"):
            if key(line):
                docs.setdefault(key(line), set()).add(d)
    common = {k for k, v in docs.items() if len(v) >= min_docs}
    return [(d, len(x := (t or "").split("\n")), sum(key(y) in common for y in x), sha("\n".join(y for y in x if key(y) not in common)))
            for d, t, _ in rows]


LINES = [(k, f"Only {k}\n  Shared LINE\t\n\nother\nshared line\nÉ", "s") for k in range(4)] + [
    (10, None, "s"), (11, "", "s"), (12, "\n\n", "s"), (0, "Only 0\nshared line", "s"), (13, "shared line", None),
    (14, "é\nother\n" + "tail " * 50_000, "s"), (None, "É\n\tother", "s"), (None, "É\n\tother", "s"), (15, "É " + " \n", "s")]


@pytest.mark.parametrize("min_docs", [1, 2, 5, 6, 100])
def test_lines(spark, min_docs):
    df = spark.createDataFrame(odd(LINES), ODD)
    got = line_dedup.apply_bitmaps(df, line_dedup.line_bitmaps(df, min_docs=min_docs))
    got = got.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("h")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_lines(LINES, min_docs), key=repr)


def test_lines_hot_line_spans_partitions(spark):
    rows = [(k, f"everywhere\nown {k}", "s") for k in range(300)]
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    got = line_dedup.apply_bitmaps(df, line_dedup.line_bitmaps(df, min_docs=300)).collect()
    assert {r.kept for r in got} == {f"own {k}" for k in range(300)}
    assert {r.n_dropped for r in line_dedup.apply_bitmaps(df, line_dedup.line_bitmaps(df, min_docs=301)).collect()} == {0}


def test_whole_documents_without_common_lines(spark):
    df = spark.createDataFrame(odd(LINES), ODD)
    got = line_dedup.without_common_lines(df, min_docs=5)
    assert got.columns == df.columns
    texts = {(r.doc_id, r.text) for r in got.collect()}
    assert (10, None) in texts and (13, "") in texts and (1, "Only 1\n") in texts
    assert line_dedup.without_common_lines(df.limit(0)).collect() == []


def waterfill(sizes, weights, total, most):
    targets, open_ = {}, dict(sizes)
    budget = total
    while open_:
        level = budget / sum(weights[s] for s in open_)
        full = [s for s in open_ if level * weights[s] >= most * sizes[s]]
        if not full:
            return targets | {s: level * weights[s] for s in open_}
        for s in full:
            targets[s] = most * sizes[s]
            budget -= targets[s]
            del open_[s]
    return targets


def test_mix(spark):
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(["w"] * int(rng.integers(1, 60))), f"s{int(rng.integers(0, 9)) % 5}" if k % 11 else None) for k in range(900)]
    rows += [(5000 + k, "é " * 40, "big") for k in range(600)] + [(1, None, "s1"), (2, "", "s2"), (None, "a b", "s2"), (7, "x", "empty"[:0])]
    rows += [(9, None, "nothing"), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(odd(rows), ODD)
    weight = spark.createDataFrame([(k, float(k % 3), "x") for k in range(0, 900, 2)] + [(4, None, "y")], "doc_id long, weight double, size string")
    got = mixing.mix(df, weight).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = waterfill({s: n for s, n in sizes.items() if n}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.taken <= 2 * r.size and r.taken == r.copies * r.size
        assert r.target == pytest.approx(want.get(r.source, 0.0))
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want.get(s, 0)) <= 30  # half the longest document
    again = {(r.doc_id, r.size, r.taken) for r in mixing.mix(df.repartition(5), weight).collect()}
    assert again == {(r.doc_id, r.size, r.taken) for r in got}


def test_mix_takes_good_documents_first_and_handles_nothing(spark):
    df = spark.createDataFrame([(k, "a b c", "s" if k < 500 else "t") for k in range(1000)], DOCS)
    weight = spark.createDataFrame([(k, 20.0) for k in range(0, 1000, 2)], "doc_id long, weight double")
    got = mixing.mix(df, weight, weights=(1, 4), share=0.5).collect()
    taken = [r.doc_id for r in got if r.source == "s" and r.copies]
    assert 60 < len(taken) < 110 and sum(k % 2 == 0 for k in taken) > 0.85 * len(taken)
    assert mixing.mix(df.limit(0)).collect() == []


def test_mixed_documents(spark):
    df = spark.createDataFrame(odd([(k, "a b", f"s{k % 4}") for k in range(40)]), ODD)
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    got = mixing.mixed(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(k for k, n in copies.items() for _ in range(n))


def test_unit_hash_can_be_repeated(spark):
    (row,) = spark.range(1).select(unit_hash(F.lit(0), F.lit(12)).alias("u")).collect()
    assert row.u == (int(hashlib.md5(b"0|12").hexdigest()[:12], 16) + 0.5) / 2**48 and math.log(row.u) < 0
