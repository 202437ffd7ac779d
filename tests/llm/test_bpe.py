import codecs

import public_tokenizers
import tiktoken
from frames import awkward_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
ENCODER, DECODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN), bpe.Decoder(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXT = st.text(st.one_of(st.sampled_from("aeinrst 'sll12!=\n\t\x1c\x85"), st.characters(codec="utf-8")), max_size=60)


def ids(text):
    data = ENCODER.encode(text)
    return [int.from_bytes(data[k : k + 4], "little") for k in range(0, len(data), 4)]


@given(TEXT)
@settings(max_examples=500, deadline=None)
def test_same_ids_as_the_library_and_round_trip(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert DECODER.feed(ids(text)) + DECODER.end() == text


@given(st.binary(max_size=40))
@settings(max_examples=300, deadline=None)
def test_transducer_is_the_merge_rule(data):
    small = bpe.Transducer(RANKS, max_states=50)
    assert small.encode(data) == ([LIBRARY.encode_single_token(data)] if data in RANKS else small.merged(data))


@given(st.randoms(use_true_random=False), st.booleans())
@settings(max_examples=150, deadline=None)
def test_small_vocabularies(r, rising):
    """Also with ranks that don't rise from merge to merge, and with neighbours of one rank."""
    tokens = [b"a", b"b", b"c"]
    for _ in range(r.randint(3, 20)):
        token = r.choice(tokens) + r.choice(tokens)
        if len(token) < 7 and token not in tokens:
            tokens.append(token)
    numbers = list(range(len(tokens)))
    if not rising:
        r.shuffle(numbers)
    ranks = dict(zip(tokens, numbers, strict=True))
    coder = bpe.Transducer(ranks, max_states=20)
    for _ in range(20):
        data = bytes(r.choices(b"abc", k=r.randint(1, 14)))
        assert coder.encode(data) == ([ranks[data]] if data in ranks else coder.merged(data))


@given(st.lists(st.binary(max_size=5), max_size=8))
@settings(max_examples=500, deadline=None)
def test_utf8_machine_streams(parts):
    whole = codecs.getincrementaldecoder("utf-8")("replace")
    pending, got = b"", ""
    for p in parts:
        text, pending = bpe.utf8_machine(pending, p)
        got += text
    assert got + ("�" if pending else "") == "".join(whole.decode(p) for p in parts) + whole.decode(b"", True)


def test_frames(spark):
    docs = awkward_docs(spark)
    coded = bpe.bpe_encode(docs, PATH, public_tokenizers.PATTERN)
    back = bpe.bpe_decode(coded, PATH).collect()
    given_texts = sorted((t or "" for (t,) in docs.select("text").collect()))
    assert sorted(r.text for r in back) == given_texts
    assert all(r.ids == LIBRARY.encode_ordinary(r.text) for r in back)
    assert bpe.bpe_encode(empty_docs(spark), PATH, public_tokenizers.PATTERN).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe.bpe_decode(none, PATH).first().text == ""
