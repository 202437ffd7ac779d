"""Split patterns in the standard library's expressions, and the memo behind the pieces."""

import random

import public_tokenizers
import pytest
import regex
from tripmart.llm.latin import is_latin, latin_pattern, latin_pieces
from tripmart.llm.memo import Memo
from tripmart.llm.word_ids import WordIds

WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ODD = "  \n\t\r\x0b\x1c\x85\xa0'sredlvm12²½ªºµßÿÀ×÷_-."


@pytest.mark.parametrize("pattern", [WORDS, public_tokenizers.PATTERN])
def test_same_matches_in_latin_texts(pattern):
    assert latin_pattern(pattern)
    found, want, pick = latin_pieces(pattern), regex.compile(pattern).findall, random.Random(3)
    for _ in range(3000):
        text = "".join(chr(pick.randrange(256)) if pick.random() < 0.4 else pick.choice(ODD) for _ in range(25))
        assert is_latin(text) and found(text) == want(text)


@pytest.mark.parametrize("pattern", [r"(?i:'s)|\p{L}+", r"\p{N}{1,3}", r"[\S]+", r"[a-z]+", r"\w+", r"[^\p{Han}]+", "[]"])
def test_other_patterns_stay(pattern):
    assert latin_pattern(pattern) is None


def test_unknown_does_not_walk_the_memo():
    class Large(Memo):
        def keys(self):
            raise AssertionError("as many steps as the memo has entries")

    memo = Large(len, 10)
    memo.update({"a": 1, "b": 1})
    memo.reserve = {"cc": 2}
    assert memo.unknown({"a", "cc", "ddd"}) == ["ddd"]
    assert memo["cc"] == 2


def test_mixed_texts_known_and_new():
    coder = WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", "the house", "the house 漢字 über-the\nhouse", "漢字 漢字", "The HOUSE's x1½ house", "new wörds\x85the é"]
    for _ in range(2):  # new pieces first, then known ones
        assert coder.encode_many(texts) == [coder.whole(t) for t in texts]
