"""Each query of the driver over its small tables: against SQL where there is some, else
against a plain computation."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tripmart.llm.bpe import read_ranks
from tripmart.llm.embedding_dedup import roots
from tripmart.llm.queries import ORACLE_SQL, QUERIES
from tripmart.llm.simhash import simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    result = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, result.fetchall()))


def test_simhash(spark, docs):
    prints = np.array([simhash(t) for t in docs.values()], dtype=np.int64).view(np.uint64)
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None]) <= 4)
    ids = list(docs)
    want = {(d, f"{int(p):016x}", ids[r]) for d, p, r in zip(ids, prints, roots(len(ids), i, j), strict=True)}
    assert set(map(tuple, QUERIES["op3_simhash"](spark, SF).collect())) == want


def test_quality(spark, docs):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    rows = QUERIES["op4_quality"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == list(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    known = [(r.predicted, labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert np.mean([p == q for p, q in known]) > 0.85


def test_quality_of_rows_that_taught_nothing(spark):
    sf = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = [(r.score, labels[r.doc_id]) for r in QUERIES["op4_quality"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    good, bad = (np.array([s for s, q in rows if q == k]) for k in (1, 0))
    auc = (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2
    assert len(good) > 500 and len(bad) > 100 and auc > 0.99
    assert (good >= 0.3).mean() > 0.99 and (bad >= 0.3).mean() < 0.05


def test_byte_bpe(spark, docs):
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op5_byte_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_line_dedup(spark, docs):
    seen = set()
    rows = {r.doc_id: r for r in QUERIES["op6_line_dedup"](spark, SF).collect()}
    assert sorted(rows) == list(docs)
    for doc_id, text in docs.items():
        lines, left = text.split("\n"), rows[doc_id].text.split("\n")
        if rows[doc_id].n_dropped == len(lines):  # all gone: the empty text counts as no line then
            assert left.pop() == "" and not left
        assert rows[doc_id].n_lines == len(lines) and rows[doc_id].n_dropped == len(lines) - len(left)
        kept = [x.strip(" ") for x in left if x.strip(" ")]
        assert not seen & set(kept) and len(kept) == len(set(kept))  # no equal lines anywhere
        seen |= set(kept)


def _ids(docs, end):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {d: [*library.encode(t, add_special_tokens=False).ids, end] for d, t in docs.items()}


def test_packing(spark, docs):
    rows = QUERIES["op8_best_fit_packing"](spark, SF).collect()
    want = set()
    for d, ids in _ids(docs, 0).items():
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            want.add((d, p, at, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048 and len(at) <= 1.03 * sum(at.values()) / 2048 + 1


def test_secret_scan(spark, docs):
    rules = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    ]
    for r in QUERIES["op9_secret_scan"](spark, SF).collect():
        spans = []
        for rank, (kind, pattern, group, least) in enumerate(rules):
            spans += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(docs[r.doc_id]) if len(m[group]) >= least]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == k for s in spans) for k, *_ in rules]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_token_store(spark, docs):
    start = 0
    rows = {r.doc_id: r for r in QUERIES["op10_token_store"](spark, SF).collect()}
    for d, ids in _ids(docs, 2).items():
        data = np.array(ids, "<u4").tobytes()
        assert tuple(rows[d]) == (d, start, len(ids), zlib.crc32(data))
        start += len(ids)
