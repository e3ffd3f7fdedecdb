"""The similarity join against all pairs, and the pipeline against a plain version of every stage."""

from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pytest

import corpus_pipeline
from indicatrix.llm import near_join
from indicatrix.llm.common import shared_folder, stored

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text, size=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def alike(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


def plain_classes(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x in range(len(rows)):
        for y in range(x):
            if alike(sets[x], sets[y]) >= 0.8:
                links[x] += 1
                links[y] += 1
                parent[root(x)] = root(y)
    least = defaultdict(list)
    for x, (d, _) in enumerate(rows):
        least[root(x)].append(d)
    return [(d, min((i for i in least[root(x)] if i is not None), default=None), links[x]) for x, (d, _) in enumerate(rows)]


def edited(rng, words, n):
    words = list(words)
    for k in rng.choice(len(words), n, replace=False):
        words[k] = f"new{int(rng.integers(1e9))}"
    return " ".join(words)


def near_rows(seed):
    rng = np.random.default_rng(seed)
    def fresh(n):
        return [f"w{int(x)}" for x in rng.integers(0, 5000, n)]
    rows, passage = [], fresh(60)
    for group in range(12):
        base = fresh(int(rng.integers(30, 250)))
        rows += [edited(rng, base, int(rng.integers(0, 5))) for _ in range(int(rng.integers(1, 9)))]
    crowd = fresh(150)  # more near copies than a small bucket holds
    rows += [edited(rng, crowd, int(rng.integers(0, 6))) for _ in range(90)]
    rows += [" ".join(fresh(int(rng.integers(20, 200))) + passage) for _ in range(60)]  # a passage that many share
    rows += ["One two three", "one TWO three", "one two", "", None, " \n", "one two three four five", "é ☃", "x " * 40_000, "x " * 30_000]
    rows += [rows[0]] * 30
    ids = rng.permutation(len(rows)).tolist()
    out = [(int(i), t) for i, t in zip(ids, rows, strict=True)]
    return [*out, (None, rows[1]), (None, "nowhere else is this text found"), out[5]]


@pytest.mark.parametrize("block", [near_join.BLOCK, 20])
def test_classes_and_links_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_join, "BLOCK", block)
    rows = near_rows(block)
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], "doc_id long, text string, rep string, n int, key string")
    got = near_join.near_classes(df.repartition(5)).collect()
    want = sorted(plain_classes(rows), key=repr)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == want
    firsts = [r for r in got if r.first]
    alone = sum(1 for d, c, n in want if c is None and n == 0)
    assert len(firsts) == len({c for _, c, _ in want if c is not None}) + alone
    assert all(r.doc_id == r.class_id for r in firsts)
    one = near_join.one_per_class(df)
    assert one.columns == df.columns and sorted((r.doc_id for r in one.collect()), key=repr) == sorted((r.doc_id for r in firsts), key=repr)


def test_united_leaves_keep_who_meets_whom(spark):
    rng = np.random.default_rng(3)
    groups = [rng.choice(10_000, 60, replace=False) for _ in range(4)]  # near copies: most share any one token
    leaves = [set(rng.choice(g, 55, replace=False).tolist()) for g in groups for _ in range(12)]
    leaves += [set(rng.choice(10_000, 40, replace=False).tolist()) for _ in range(30)]  # whoever shares a passage
    rows = [(int(m) - 5000, k * 7 - 50, len(x)) for k, x in enumerate(leaves) for m in x]
    df = spark.createDataFrame(rows, "rep long, key long, in_leaf long")

    def together(found):
        held = defaultdict(set)
        for r in found:
            held[r.key].add(r.rep)
        assert all(r.in_leaf == len(held[r.key]) for r in found) and len(found) == sum(map(len, held.values()))
        return list(held.values())
    before, after = together(df.collect()), together(near_join._united(df).collect())
    assert all(any(x <= y for y in after) for x in before)
    assert sum(len(x) ** 2 for x in after) <= sum(len(x) ** 2 for x in before)
    assert sum(map(len, after)) < 0.6 * sum(map(len, before))
    assert near_join._united(df.where("false")).count() == 0


def test_one_of_the_buckets_of_near_copies_is_split(spark, monkeypatch):
    """Paths grow with the copies, by a few rows each; before, each of their buckets was split."""
    monkeypatch.setattr(near_join, "BLOCK", 20)
    made = []

    def counting(df, name):
        made.append(out := stored(df, name))
        return out if name != "paths" else made.append(("paths", out.count())) or out
    monkeypatch.setattr(near_join, "stored", counting)
    for copies in (100, 200):
        made.clear()
        rng = np.random.default_rng(copies)
        crowd = [f"w{int(x)}" for x in rng.integers(0, 5000, 200)]
        rows = [(k, edited(rng, crowd, int(rng.integers(0, 4)))) for k in range(copies)]
        rows += [(1000 + k, " ".join(f"v{int(x)}" for x in rng.integers(0, 5000, 40))) for k in range(50)]
        got = near_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == sorted(plain_classes(rows))
        assert sum(x[1] for x in made if isinstance(x, tuple) and x[0] == "paths") <= 40 * copies


def test_sets_fetched_by_join_when_many(spark, monkeypatch):
    monkeypatch.setattr(near_join, "SENT", 0)
    rows = near_rows(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_join.near_classes(df).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == sorted(plain_classes(rows), key=repr)


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_join.near_classes(df).collect() == [] and near_join.one_per_class(df).collect() == []


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(session, "x")


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 300) if k != 150] + [(900, 901), (902, 901)], "a long, b long")
    got = {r.rep: r.root for r in near_join.components(edges).collect()}
    assert got == {k: 0 for k in range(151)} | {k: 151 for k in range(151, 301)} | {k: 900 for k in (900, 901, 902)}


def test_runs_reach_the_recall():
    assert near_join.runs_for(0.8, 0.9) < near_join.runs_for(0.8, 0.9999) <= 24


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output over the given documents and some awkward ones."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = [(10**6, None, "en", "src1", None), (10**6 + 1, "", None, None, 0), (10**6 + 2, "12 !!", "en", "src1", 5), (None, "one more text of the end", "en", None, 24),
            (1, "a second text of one", None, "src2", 20)]
    steps = [stored(docs.unionByName(spark.createDataFrame(more, docs.schema)), "input")]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], sf), "step"))
    return [(s, s.collect()) for s in steps]


def test_stages_return_documents(stages):
    assert all(s.columns == stages[0][0].columns for s, _ in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language identification", "line dedup", "similarity join", "mixing", "packing"]


def test_language_stage_keeps_whatever_has_a_language(stages):
    before, after = stages[0][1], stages[1][1]
    gone = [r for r in before if r not in after]
    assert sorted(r.doc_id for r in gone if r.doc_id is not None and r.doc_id >= 10**6) == [10**6, 10**6 + 1, 10**6 + 2]
    assert len(gone) < 0.02 * len(before) + 3 and len(after) == len(before) - len(gone)


def test_line_stage(stages):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    found = defaultdict(set)
    for r in stages[1][1]:
        for line in r.text.split("\n"):
            found[key(line)].add(r.doc_id)
    want = ["\n".join(x for x in r.text.split("\n") if not key(x) or len(found[key(x)]) < 10) for r in stages[1][1]]
    assert sorted(r.text for r in stages[2][1]) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in stages[2][1])


def test_near_stage_keeps_one_of_each_class(stages):
    rows = [(r.doc_id, r.text) for r in stages[2][1]]
    classes = {c for _, c, _ in plain_classes(rows)}
    left = [r.doc_id for r in stages[3][1]]
    # identifier 1 stands for two texts, which are two classes
    assert len(left) == len(classes) + 1 and {d for d in left if d is not None} == {c for c in classes if c is not None}


def test_mixing_stage_meets_the_targets(stages):
    size = lambda r: len(r.text.encode().split())
    before, after = defaultdict(int), defaultdict(int)
    for held, rows in ((before, stages[3][1]), (after, stages[4][1])):
        for r in rows:
            held[r.source] += size(r)
    assert sum(after.values()) == pytest.approx(1.5 * sum(before.values()), rel=0.1)
    times = defaultdict(int)
    for r in stages[4][1]:
        times[r.doc_id, r.text] += 1
    assert max(times.values()) <= 2 and set(times) <= {(r.doc_id, r.text) for r in stages[3][1]}


def test_packing_stage_holds_every_piece(stages):
    held, lengths = defaultdict(list), defaultdict(int)
    for r in stages[5][1]:
        held[r.sequence_id].append((r.offset, r.length))
        lengths[r.doc_id] += r.length
    for pieces in held.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 1024
    assert set(lengths) == {r.doc_id for r in stages[4][1]}
    assert len(held) <= sum(lengths.values()) / 1024 * 1.02 + 2


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "piece", "length", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100
