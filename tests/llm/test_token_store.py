import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from frames import awkward_docs, empty_docs, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmart.llm.token_store import Shard, read_shards, train_dictionary, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(docs):
    rows = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        rows.append((doc_id, [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]))
    return rows


def test_round_trip_and_random_access(spark):
    r = random.Random(6)
    more = [(100 + k, " ".join(r.choice("some words that come again".split()) for _ in range(r.randint(0, 200))), "") for k in range(200)]
    docs = awkward_docs(spark, more).repartition(6)
    manifest = write_shards(docs, PATH, end_id=2)
    got = read_shards(spark, manifest).withColumn("crc", F.crc32("ids")).orderBy("start").collect()
    want = expected(docs)
    assert sorted(((g.doc_id, np.frombuffer(g.ids, "<u4").tolist()) for g in got), key=repr) == sorted(want, key=repr)
    assert [g.doc_id for g in got] == sorted((d for d, _ in want), key=lambda d: (d is not None, d))
    start = 0
    for g in got:
        assert g.start == start and g.n_tokens == len(g.ids) // 4 and g.crc == zlib.crc32(g.ids)
        start += g.n_tokens
    first = manifest.orderBy(F.desc("docs")).first()
    with open(first.dictionary.removeprefix("file:"), "rb") as f:
        dictionary = f.read()
    shard = Shard(first.path, dictionary)
    k = first.docs // 2
    assert shard.document(k).tolist() == list(shard.documents())[k][1].tolist()
    with pytest.raises(ValueError, match="dictionary"):
        Shard(first.path, dictionary + b"x")


def test_dictionary_from_all_of_a_document(spark):
    """What comes after the first 2,048 ids is trained on, too."""
    phrase = " " + " ".join(words(1, 40))
    rows = [(k, " ".join(words(100 + k, 1200)) + phrase * 100) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = LIBRARY.encode(phrase * 3, add_special_tokens=False).ids
    width = 2 if LIBRARY.get_vocab_size() <= 1 << 16 else 4
    parts = {np.array(ids[k : k + 6]).astype(f"<u{width}").tobytes() for k in range(len(ids) - 6)}
    for _, text in rows:
        head = np.array(LIBRARY.encode(text, add_special_tokens=False).ids[:2048]).astype(f"<u{width}").tobytes()
        assert not any(p in head for p in parts)
    dictionary = train_dictionary(docs, PATH, 2)
    assert any(p in dictionary for p in parts)


def test_empty_table(spark):
    manifest = write_shards(empty_docs(spark), PATH, end_id=2)
    assert manifest.collect() == [] and read_shards(spark, manifest).collect() == []
