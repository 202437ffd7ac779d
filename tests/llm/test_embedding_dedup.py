import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm.embedding_dedup import embedding_dedup, may_reach, quantised, roots

DDL = "vec_id long, embedding array<float>, label int, kept string"


@given(st.integers(0, 10_000), st.integers(2, 40), st.floats(-0.9, 0.99))
@settings(max_examples=100, deadline=None)
def test_bound_misses_no_pair(seed, dim, threshold):
    r = np.random.default_rng(seed)
    x = r.normal(size=(30, dim)) * r.choice([1, 1, 50], size=(30, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = set(zip(*map(list, may_reach(quantised(x), quantised(x), threshold)), strict=True))
    assert set(zip(*np.nonzero(x @ x.T >= threshold), strict=True)) <= found


def brute(rows, threshold):
    def able(v, label):
        return label is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)

    good = [k for k, (i, v, label, _) in enumerate(rows) if i is not None and able(v, label)]
    a, b, n = [], [], [0] * len(rows)
    for p in good:
        for q in good:
            v, w = (np.array(np.array(rows[k][1], np.float32), np.float64) for k in (p, q))
            if p != q and rows[p][2] == rows[q][2] and len(v) == len(w):
                if v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                    a.append(p), b.append(q)
                    n[p] += 1
    for p in good:  # rows of one id are one node
        for q in good:
            if rows[p][0] == rows[q][0]:
                a.append(p), b.append(q)
    root = roots(len(rows), np.array(a, int), np.array(b, int))
    out = []
    for k, (i, *_) in enumerate(rows):
        low = min((rows[m][0] for m in range(len(rows)) if root[m] == root[k]), default=None, key=lambda x: (x is None, x))
        out.append((i, n[k], low, i is not None and i == low))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [4, 1024])
def test_matches_brute_force(spark, block):
    r = np.random.default_rng(9)
    rows = []
    for k in range(120):
        base = np.random.default_rng(k % 23).normal(size=8)
        rows.append((k, [float(c) for c in (base + r.normal(scale=0.15, size=8)).astype(np.float32)], k % 3, "x"))
    rows += [(200 + k, rows[5][1], rows[5][2], "copy") for k in range(30)]
    rows += [
        (300, None, 1, ""), (301, [], 1, ""), (302, [0.0] * 8, 1, ""), (303, [1.0, None] * 4, 1, ""),
        (304, [float("nan")] * 8, 1, ""), (305, [float("inf")] * 8, 1, ""), (306, rows[5][1], None, ""),
        (307, rows[5][1][:4], rows[5][2], ""), (None, rows[5][1], rows[5][2], ""),
        (308, [2 * c for c in rows[7][1]], rows[7][2], ""), (308, [2 * c for c in rows[7][1]], rows[7][2], ""),
    ]
    frame = spark.createDataFrame(rows, DDL).repartition(3)
    got = sorted(map(tuple, embedding_dedup(frame, 0.93, block=block).collect()), key=repr)
    assert got == brute(rows, 0.93)


def test_empty_table(spark):
    assert embedding_dedup(spark.createDataFrame([], DDL)).collect() == []
