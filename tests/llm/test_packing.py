import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from frames import awkward_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmart.llm import packing
from tripmart.llm.packing import pack_documents, segments, sequences, solve, solve_lp
from tripmart.llm.word_ids import word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODER = word_ids(PATH)
TEXT = st.text(st.one_of(st.sampled_from("aAeéß İΣς 12'sll!\n\t\x1c\x85́"), st.characters(codec="utf-8")), max_size=40)


@given(TEXT, st.sampled_from(["", "<|endoftext|>", " <|startoftext|> x"]))
@settings(max_examples=500, deadline=None)
def test_same_ids_as_the_library(text, special):
    text += special
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(CODER.encode(text), "<u4").tolist() == expected


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20))
@settings(max_examples=100, deadline=None)
def test_solution_covers_the_histogram(counts):
    solution = solve(counts, 64)
    used = Counter()
    for config, times in solution:
        assert sum(s * n for s, n in config) <= 64 and times > 0
        for s, n in config:
            used[s] += n * times
    assert used == Counter(counts)
    assert len(segments(solution)) == sum(n for c, _ in solution for _, n in c)


def test_close_to_the_lower_bound():
    r = random.Random(3)
    counts = Counter(min(2048, int(r.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    used = sum(n for _, n in solve(counts, 2048))
    _, bound = solve_lp(counts, 2048, rounds=5)
    assert bound <= used <= 1.01 * bound + 1


def test_the_program_carries_the_packing(monkeypatch):
    """Most pieces are placed by the linear program at any size, the rest greedily."""
    greedy, rest = packing._best_fit, []
    monkeypatch.setattr(packing, "_best_fit", lambda left, capacity: rest.append(left.copy()) or greedy(left, capacity))
    for n in (200, 2000):
        r = random.Random(3)
        counts = Counter(min(2048, int(r.lognormvariate(6, 1)) + 1) for _ in range(n))
        used = sum(times for _, times in solve(counts, 2048))
        assert used <= sum(times for _, times in greedy(counts, 2048)) + 1
        assert len(rest) == 1 and sum(rest.pop().values()) < 0.5 * n


def test_documents(spark):
    r = random.Random(4)
    more = [(100 + k, " ".join(r.choice("the a cat sat mat on".split()) for _ in range(r.randint(1, 90))), "") for k in range(300)]
    docs = awkward_docs(spark, more).repartition(4)
    packed = pack_documents(docs, PATH, end_id=0, capacity=64, with_ids=True)
    rows = packed.collect()
    of = defaultdict(list)
    for x in rows:
        of[x.sequence_id].append((x.offset, x.length))
    for parts in of.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(of) <= 1.02 * sum(x.length for x in rows) / 64 + 1
    got = Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in rows)
    expected = Counter()
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at : at + 64], "<u4").tobytes()
            expected[doc_id, p, at, len(part) // 4, zlib.crc32(part)] += 1
    assert got == expected
    whole = sequences(packed).collect()
    assert sum(len(x.ids) for x in whole) == 4 * sum(x.length for x in rows)
    assert pack_documents(empty_docs(spark), PATH).collect() == []
