import hashlib
from collections import defaultdict

import pytest
from frames import awkward_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm.exact_dedup import PatriciaTrie, exact_dedup


@given(st.lists(st.binary(max_size=6), max_size=60))
@settings(max_examples=200, deadline=None)
def test_trie_keeps_each_string_once(keys):
    trie = PatriciaTrie()
    for k in keys:
        trie.insert(k).append(k)
    found = dict(trie.terminals())
    assert set(found) == set(keys)
    assert all(v == [k] * keys.count(k) for k, v in found.items())


@given(st.lists(st.binary(min_size=3, max_size=3), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_release_takes_subtrees_but_the_one_that_stays(keys):
    trie = PatriciaTrie()
    for k in keys:
        trie.insert(k).append(k)
    out = [k for k, _ in trie.release(0, keys[-1])]
    left = [k for k, _ in trie.terminals()]
    assert keys[-1] in left and sorted([*out, *left]) == sorted(set(keys))


def brute(rows, largest):
    groups = defaultdict(list)
    for k, (doc_id, text, *_) in enumerate(rows):
        groups[text or ""].append((doc_id, k))
    out = []
    for text, members in groups.items():
        ids = [d for d, _ in members if d is not None]
        keep = (max(ids) if largest else min(ids)) if ids else None
        first = True
        for doc_id, _ in sorted(members, key=lambda m: m[1]):
            kept = doc_id == keep and first
            first = first and not kept
            out.append((doc_id, keep, len(members), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("memory", [1 << 20, 2_000])
def test_matches_brute_force(spark, keep, memory):
    rows = [(k, f"text {k % 37} {'y' * (k % 5)}", "x") for k in range(400)]
    docs = awkward_docs(spark, rows).repartition(5)
    got = exact_dedup(docs, keep, memory_bytes=memory)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute([tuple(r) for r in docs.collect()], keep == "largest")


def test_empty_table_and_bad_keep(spark):
    assert exact_dedup(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError, match="keep"):
        exact_dedup(empty_docs(spark), keep="first")
