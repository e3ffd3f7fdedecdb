"""Whitened vectors against numpy on exact integers."""

import math

import numpy as np
import pytest

from indicatrix.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, n int"


def by_hand(vectors):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(v[i] for v in x) for i in range(d)]
    deviation = [sum((n * v[i] - s[i]) ** 2 for i in range(d)) for v in x]
    centred = np.array([[(n * v[i] - s[i]) / n for i in range(d)] for v in x])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    return deviation, centred @ directions / np.sqrt(np.maximum(values, 1e-30)), values / values.sum()


def held(spark, rows):
    return whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()


def test_rows_equal_numpy(spark):
    random = np.random.default_rng(3)
    vectors = (random.normal(size=(400, 6)) @ random.normal(size=(6, 6)) * 3 + 2).tolist()
    odd = [(1000, None, 0), (1001, [1.0, None] * 3, 0), (1002, [float("nan")] * 6, 0), (1003, [float("inf")] + [0.0] * 5, 0),
           (1004, [1.0, 2.0], 0), (1005, [], 0), (1006, [3e38] + [0.0] * 5, 0)]
    vectors += vectors[:3]  # rows that repeat
    out = held(spark, [(i, v, 7) for i, v in enumerate(vectors)] + odd)
    deviation, whitened, explained = by_hand(vectors)
    assert len(out) == len(vectors) * 6 and {r["n"] for r in out} == {len(vectors)}
    assert {r["component"] for r in out} == set(range(1, 7))
    got = np.zeros((len(vectors), 6))
    for r in out:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
    signs = np.sign((got * whitened).sum(0))
    assert np.abs(got - whitened * signs).max() < 1e-6


def test_large_entries_stay_exact(spark):
    vectors = [[1e9 + 64 * i, -5.0 * i, 2.0] for i in range(50)]
    out = held(spark, [(i, v, 0) for i, v in enumerate(vectors)])
    deviation, whitened, _ = by_hand(vectors)
    assert all(r["deviation"] == deviation[r["vec_id"]] for r in out)
    assert {r["component"] for r in out} == {1}  # the other directions hold no deviation of their own
    got = np.array([r["whitened"] for r in sorted(out, key=lambda r: r["vec_id"])])
    assert np.abs(np.abs(got) - np.abs(whitened[:, 0])).max() < 1e-6


def test_more_dimensions_than_components_or_rows(spark):
    random = np.random.default_rng(4)
    out = held(spark, [(i, random.normal(size=40).tolist(), 0) for i in range(200)])
    assert {r["component"] for r in out} == set(range(1, 33)) and len(out) == 200 * 32
    few = held(spark, [(i, random.normal(size=40).tolist(), 0) for i in range(5)])
    assert {r["component"] for r in few} == {1, 2, 3, 4} and max(r["identity_error"] for r in few) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]])
def test_nothing_to_whiten(spark, rows):
    assert held(spark, rows) == []
    assert whiten(spark.createDataFrame(rows, SCHEMA)).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
