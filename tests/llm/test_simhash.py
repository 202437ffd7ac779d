import random
import re

import numpy as np
import xxhash
from frames import awkward_docs, empty_docs, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.llm.embedding_dedup import roots
from tripmart.llm.simhash import hex_of, near_links, simhash, simhash_dedup, simhash_keep


def plain(text, shingle=4):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not found:
        return 0
    parts = [" ".join(found[k : k + shingle]) for k in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aB É\t\n\x0b\x1c\xa0漢Z", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash(text) % (1 << 64) == plain(text)


def components(prints, distance):
    a = np.array(prints, dtype=np.int64).view(np.uint64)
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ a[None]) <= distance)
    return roots(len(a), i, j)


def test_links_of_dense_and_sparse_groups(spark):
    r = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for size in (300, 40, 3, 2, 2):
        base = r.getrandbits(64)
        for _ in range(size):
            flips = r.sample(range(64), r.randint(0, 7))
            prints.add(base ^ sum(1 << f for f in flips))
    prints |= {r.getrandbits(64) for _ in range(500)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4).collect()
    low = {r.node: r.component for r in found}
    root = components(signed, 4)
    expected = [min(s for s, o in zip(signed, root, strict=True) if o == c) for c in root]
    assert [low.get(p, p) for p in signed] == expected


def test_documents(spark):
    base = words(1, 4000)
    near = [*base[:200], "changed", *base[201:]]  # four shingles of 3997
    docs = awkward_docs(spark, [(20, " ".join(base), ""), (19, " ".join(near), ""), (30, " ".join(words(2, 300)), "")])
    got = simhash_dedup(docs).select("doc_id", hex_of(F.col("fp")).alias("hex"), "component_id").collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 8)}
    assert by_id[20].component_id == by_id[19].component_id == 19 and by_id[30].component_id == 30
    assert by_id[1].hex == by_id[2].hex == "0" * 16 and by_id[2].component_id == by_id[3].component_id == 1
    assert by_id[4].component_id == by_id[5].component_id == 4
    kept = simhash_keep(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert [i for i in ids if i is not None and i != 8] == sorted([1, 4, 6, 7, 19, 30], key=repr) and ids.count(None) == 2
    assert simhash_dedup(empty_docs(spark)).collect() == []


def test_rows_that_share_an_id_or_have_none(spark):
    """One row of each group stays, also where an id is repeated or null."""
    clean, other, lone = (" ".join(words(k, 200)) for k in (50, 51, 52))
    rows = [(1, other, "a"), (7, other, "copy"), (7, clean, "b"), (8, clean, "copy")]
    rows += [(None, lone, "c")] * 3 + [(9, None, "d"), (9, None, "d")]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(parts)
        kept = sorted((tuple(r) for r in simhash_keep(docs).collect()), key=repr)
        assert kept == sorted([(1, other, "a"), (7, clean, "b"), (None, lone, "c"), (9, None, "d")], key=repr)


def test_variants_are_not_broadcast(spark, monkeypatch):
    """A fingerprint's variants are dozens of rows, of which Spark's estimate knows nothing: a
    broadcast of them goes through the driver's memory."""
    plans = []

    def planned(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    for module in ("buckets", "components"):
        monkeypatch.setattr(f"tripmart.llm.{module}.stored", planned)
    base = " ".join(words(60, 300))
    docs = [(k, f"{base} {word}") for k, word in enumerate(words(61, 40))] + [(100 + k, " ".join(words(k, 90))) for k in range(40)]
    found = simhash_dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len({r.component_id for r in found.collect()}) < 80
    assert sum("SortMergeJoin" in plan for plan in plans) > 3 and not any("Broadcast" in plan for plan in plans)
