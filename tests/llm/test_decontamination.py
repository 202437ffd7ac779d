import random
import re

import pytest
from frames import awkward_docs, empty_docs, words
from pyspark.sql import functions as F

from tripmart.llm.decontamination import decontaminate, normal_words

ITEMS = "item_id long, text string, answer string, number string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(text):
    """Words as small letters, and their places."""
    small = {k: k + 32 for k in range(65, 91)}
    return [(m[0].translate(small), *m.span()) for m in WORD.finditer(text or "")]


def brute(docs, items, window, parts=1):
    grams = {}
    for item, *texts in items:
        for text in texts[:parts]:
            w = [x[0] for x in plain(text)]
            size = min(window, len(w))
            for k in range(len(w) - size + 1 if size else 0):
                grams.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w = plain(text)
        hit, found = set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                of = grams.get(tuple(x[0] for x in w[k : k + size]))
                if of:
                    hit |= set(range(k, k + size))
                    found |= of
        spans = []
        for k in sorted(hit):
            if k - 1 in hit:
                spans[-1][1] = w[k][2]
            else:
                spans.append([w[k][1], w[k][2]])
        out.append((doc_id, len(w), len(hit), spans, sorted(str(i) for i in found if i is not None)))
    return sorted(map(repr, out))


def rows_of(found):
    return sorted(repr((r.doc_id, r.n_words, r.n_hit, [list(s) for s in r.spans], r["items"])) for r in found.collect())


def corpus():
    r = random.Random(2)
    items = [(k, " ".join(words(k, 12 + k % 20)), " ".join(words(100 + k, 4)), "n") for k in range(30)]
    items += [(30, "Short One", None, "n"), (31, items[3][1], "", "n"), (31, "tail of the item", None, "n"),
              (None, " ".join(words(77, 12)), None, "n"), (33, None, None, "n"), (34, " ., ", None, "n"), (35, "Ünï ça", "x", "n")]
    docs = []
    for d in range(40):
        w = words(1000 + d, 60)
        if d % 2:
            item = r.choice(items[:30])[1].split()
            part = item[r.randint(0, 3) :][: r.randint(7, 14)]
            w[20:20] = [x.upper() if r.random() < 0.3 else x for x in part]
        docs.append((d, "  ".join(w) if d % 3 else "--\t".join(w)))
    docs += [(40, "so short one, it is"), (41, "shortone"), (42, " ".join(words(77, 12))), (43, "é ÜNï ça ünï ça"),
             (44, "Short\none short one"), (45, items[3][1] + " " + items[4][1])]
    return docs, items


@pytest.mark.parametrize("size", [8_000, 4 << 20])
def test_against_brute_force(spark, size):
    """Also with a benchmark dealt over many automata."""
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, ITEMS)
    assert rows_of(decontaminate(frame, bench, automaton_bytes=size)) == brute(docs, items, 10)


def test_parts_and_other_windows(spark):
    docs, items = corpus()
    docs = [(d, f"{t} {items[d % 30][2]}") for d, t in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows_of(decontaminate(frame, spark.createDataFrame(items, ITEMS), window=5, parts=("text", "answer")))
    assert got == brute(docs, items, 5, parts=2)


def test_awkward_rows(spark):
    _, items = corpus()
    docs = awkward_docs(spark, [(70, "word " * 30 + "Short.One" * 2, "")])
    docs = docs.withColumns({c: F.col("row") for c in ("number", "windows", "block", "first")})
    items = [*items, (50, "word", None, "n")]
    want = brute([(r.doc_id, r.text) for r in docs.collect()], items, 10)
    bench = spark.createDataFrame(items, ITEMS)
    assert rows_of(decontaminate(docs, bench)) == want
    assert decontaminate(empty_docs(spark), bench).collect() == []
    none = decontaminate(docs, bench.limit(0)).collect()
    assert len(none) == docs.count() and all(r.n_hit == 0 and r["items"] == [] and r.spans == [] for r in none)


def test_normal_words():
    assert normal_words("A-b_C1 Ünï {x}") == ["a", "b", "c1 Ünï", "x"] or normal_words("A-b") == [b"a", b"b"]
    assert normal_words("Don't É3") == [b"don", b"t", "É3".encode()]
