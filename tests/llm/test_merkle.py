import hashlib
import random
from collections import defaultdict

from frames import awkward_docs, empty_docs
from pyspark.sql import functions as F

from tripmart.llm.merkle import WIDTH, climb, fold, merkle_manifest, siblings


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([digest(*now[k : k + 3]) for k in range(0, len(now), 3)])
    return levels


def proof(levels, k):
    out = []
    for now in levels[:-1]:
        out.append(("".join(now[k - k % 3 : k]), "".join(now[k + 1 : k - k % 3 + 3])))
        k //= 3
    return out


def brute(rows):
    """``doc_id, source, leaf, subroot, root, path`` of ``doc_id, source, text`` rows."""
    groups = defaultdict(list)
    for doc_id, source, text in rows:
        groups[source].append((doc_id is not None, doc_id or 0, leaf(doc_id, source, text), doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for k, (_, _, own, doc_id) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            out.append((doc_id, s, own, trees[s][-1][0], top[-1][0], proof(trees[s], k) + proof(top, at)))
    return sorted(map(repr, out))


def rows_of(found):
    return sorted(repr((r.doc_id, r.tree, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path])) for r in found)


FIELDS = ["doc_id", "source", "text"]


def test_trees_of_all_sizes(spark):
    """Over a kept row's width, at powers of three, alone in their source; and so many sources
    that their tree has kept levels, too."""
    sizes = {"hot": 2 * WIDTH + 7, "édge": WIDTH, "one more": WIDTH + 1, None: 5, "": 1, "three": 3, "four": 4}
    sizes |= {f"s{k}": 1 + k % 2 for k in range(WIDTH + 20)}
    rows, ids = [], list(range(sum(sizes.values())))
    random.Random(1).shuffle(ids)
    for source, n in sizes.items():
        rows += [(ids.pop(), source, f"text {n} \n {k}") for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    claim = {"text": F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    found = merkle_manifest(docs, FIELDS, claimed=claim).collect()
    assert rows_of(found) == brute(rows)
    for r in found:
        assert (r.folded_root == r.root) == (r.doc_id % 2 == 1)


def test_awkward_rows(spark):
    docs = awkward_docs(spark, [(4, "one line", "d"), (80, "é\n", "d")])
    docs = docs.withColumns({c: F.col("row") for c in ("source", "total", "path", "tree", "place")})
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    found = merkle_manifest(docs, FIELDS).collect()
    assert rows_of(found) == brute(rows)
    assert all(r.folded_root == r.root for r in found)
    empty = empty_docs(spark).withColumnRenamed("extra", "source")
    assert merkle_manifest(empty, FIELDS).collect() == []
    single = docs.where("doc_id = 80")
    row = merkle_manifest(single, FIELDS).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.path == []


def test_climb_and_fold():
    names = [str(k) for k in range(10)]
    made = climb(names, -1)
    assert made == tree(names) and climb(["x"], -1) == [["x"]]
    assert climb(["x"], 2) == [["x"], [digest("x")], [digest(digest("x"))]]
    for k, name in enumerate(names):
        path = siblings(made, k)
        assert fold(name, path) == made[-1][0] and fold("other", path) != made[-1][0]
        assert [(s["left"], s["right"]) for s in path] == proof(made, k)
