"""Byte BPE takes its pieces of Latin-1 texts from the standard library's expression."""

import re

import public_tokenizers
from tripmart.llm.bpe import Encoder, Transducer, read_ranks


def test_byte_pieces_of_latin_and_other_texts():
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    latin, wide = Encoder(ranks, public_tokenizers.PATTERN), Encoder(ranks, public_tokenizers.PATTERN)
    assert isinstance(latin.latin_pieces.__self__, re.Pattern)
    wide.latin_pieces = wide.pieces
    for text in ["", "It's  über\xa0\x85 12½ x\n\n y", "漢字 it's \x1c ÿ", "a" * 40 + " \t"]:
        assert latin.encode(text) == wide.encode(text)


def test_entries_tell_tokens_from_beginnings():
    entries = Transducer({b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"abc": 4}).entries
    assert entries == {
        b"a": (0, True), b"b": (1, True), b"c": (2, False), b"bc": (3, False), b"ab": (None, True), b"abc": (4, False)
    }
