import hashlib
import random
import zlib

import numpy as np
import pytest
from frames import awkward_docs, empty_docs, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.llm import periodic_runs as module
from tripmart.llm.periodic_runs import LEAST, TIMES, best_run, collapse, periodic_runs
from tripmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(w):
    """All runs ``start, period, length`` by trying each period at each place."""
    n, found = len(w), {}
    for q in range(1, n // TIMES + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(LEAST, TIMES * q):
                found.setdefault((i, j - i + q), q)  # the smallest period of this stretch
            i = j + 1
    return sorted((a, q, m) for (a, m), q in found.items())


def by_tiles(w):
    """The same through tiles, with the stitching in plain Python."""
    pieces = {}
    for low, high, stride, first, ids, marks in module.tiles(module.numbered(w)):
        for q, a, b in module.solve(low, high, stride, first, ids.tolist(), marks.tolist()):
            pieces.setdefault(q, []).append((a, b))
    found = {}
    for q in sorted(pieces):
        whole = []
        for a, b in sorted(pieces[q]):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(whole[-1][1], b)
            else:
                whole.append([a, b])
        for a, b in whole:
            if b - a + q >= max(LEAST, TIMES * q):
                found.setdefault((a, b - a + q), q)
    return sorted((a, q, m) for (a, m), q in found.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=120), st.integers(1, 3))
def test_small_alphabets(w, times):
    assert by_tiles(w * times) == brute(w * times)


@pytest.mark.parametrize("tile", [16, 4096])
def test_planted_runs(tile, monkeypatch):
    """Runs of all periods at all places, between words of their own, also over many small tiles."""
    monkeypatch.setattr(module, "TILE", tile)
    monkeypatch.setattr(module, "TILE_PERIODS", 2)
    r = random.Random(5)
    for case in range(150):
        w = []
        for part in range(r.randint(1, 4)):
            w += [f"x{case}.{part}.{k}".encode() for k in range(r.randint(0, 40))]
            period = r.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 50, 64])
            unit = [r.choice([b"a", b"b", f"y{part}.{k}".encode()]) for k in range(period)]
            length = r.randint(2 * period, 9 * period + 3)
            w += (unit * (length // period + 1))[:length]
        assert by_tiles(w) == brute(w)


def test_one_word_alone():
    assert by_tiles([b"a"] * 3000) == [(0, 1, 3000)]


def test_plain_text_gives_no_tiles():
    assert list(module.tiles(module.numbered([w.encode() for w in words(4, 3000)]))) == []


def test_z_function():
    s = [1, 1, 2, 1, 1, 2, 1]
    assert module.z_function(s, 7) == [7, 1, 0, 4, 1, 0, 1] and module.z_function([], 3) == []


def test_best_and_collapse():
    runs = [{"start": 0, "length": 8, "period": 2}, {"start": 8, "length": 12, "period": 3}, {"start": 30, "length": 41, "period": 10}]
    assert best_run(runs) == runs[2] and best_run(runs[:2]) == runs[0] and best_run([]) is None
    w = [str(k).encode() for k in range(10)]
    assert collapse(w, runs[:1]) == b"0 1 8 9" and collapse(w, []) == b" ".join(w)


def expected(text):
    w = (text or "").encode().split()
    runs = [{"start": a, "length": m, "period": q} for a, q, m in brute(w)]
    return len(w), runs, best_run(runs), collapse(w, runs).decode()


def test_rows(spark):
    more = [
        (20, "go " * 7 + "stop", ""), (21, "a b c d " * 50, ""), (21, "a b c d " * 50, ""), (None, "x y " * 9, ""),
        (22, "é ü " * 6 + "\x0b\x0cq", ""), (23, " ".join(words(3, 500)), ""),
        (24, "\n".join([" ".join(words(k, 30)) for k in (1, 2)] * 60), ""),
    ]
    docs = awkward_docs(spark, more)
    docs = docs.withColumns({c: F.col("row") for c in ("words", "runs", "low", "first")})
    got = [(r.doc_id, r.n_words, [x.asDict() for x in r.runs], r.best and r.best.asDict(), r.collapsed) for r in periodic_runs(docs).collect()]
    want = [(r.doc_id, *expected(r.text)) for r in docs.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {len(x[2]) for x in got} >= {0, 1}
    assert periodic_runs(empty_docs(spark)).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(rows) == len(docs)
    planted = 0
    for d, text in docs:
        w = (text or "").encode().split()
        h, n = zlib.crc32(str(d).encode()), len(w)
        if h % 10 == 0 and n:
            planted += 1
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        runs = [{"start": a, "length": m, "period": q} for a, q, m in brute(w)]
        best = best_run(runs)
        listed = "".join(f"{x['start']},{x['length']},{x['period']}\n" for x in runs)
        first = (best["start"], best["length"], best["period"], 1000 * best["length"] // best["period"]) if best else (None,) * 4
        assert tuple(rows[d]) == (
            d, len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapse(w, runs)).hexdigest()
        )
    assert planted > 5


def test_numbers_are_by_word():
    assert np.array_equal(module.numbered([b"b", b"a", b"b"]), [0, 1, 0])


def test_a_task_holds_one_python_step(spark):
    """Two in a row are two workers for each task of an executor."""
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b " * 9)], "doc_id long, text string")
    found = periodic_runs(docs)
    plan = found._jdf.queryExecution().analyzed()

    def steps(node):
        below = max((steps(node.children().apply(k)) for k in range(node.children().size())), default=0)
        return below + (node.nodeName() == "MapInArrow")

    # the runs' own branch is cut by a join, whose shuffle ends the task
    assert plan.collectLeaves().size() > 1
    plain = [b for b in (plan.children().apply(k) for k in range(plan.children().size())) if "Join" not in b.toString()]
    assert len(plain) == 1
    assert steps(plain[0]) == 1
    assert {(r.doc_id, r.n_words, len(r.runs)) for r in found.collect()} == {(1, 3, 0), (2, 18, 1)}
