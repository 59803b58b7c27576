import random

import public_tokenizers
import pytest
from helpers import AWKWARD, frame, with_extras
from tokenizers import Tokenizer

from vitrine.llm.token_counts import Counter, Vocabulary, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(Vocabulary.read(PATH))


def _texts():
    draw = random.Random(4)
    alphabet = list("abcdeABC 'stsdmrev.,!?-_\n\t\r\x0b\x0c\x1c\x1d\x1f\x00\x85\xa0   　0123456789éÉèßİıΣσςñÑ漢字かなカ한글😀👍🏽♥®̧́̈ﬁ½²Ⅷ٣क्षि") + ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "the", "'re", "ing"]
    for _ in range(1500):
        yield "".join(draw.choice(alphabet) for _ in range(draw.randrange(60)))
    yield "a" * 5000
    yield "é" * 700 + "漢" * 700
    for _, text, *_ in AWKWARD:
        yield text or ""


def test_counts_equal_the_library(library, counter):
    for text in _texts():
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_proved_words_are_one_token_each(library, counter):
    proved = list(counter.vocabulary.proved)
    assert len(proved) > 30_000
    for word in random.Random(1).sample(proved, 1500):
        assert counter.vocabulary.pieces(word) == [word.encode() and counter.vocabulary.pieces(word)[0]]


def test_query_rows(spark, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_counts(with_extras(frame(spark)).repartition(3), PATH).collect())
    rows = [(i, t or "") for i, t, *_ in AWKWARD]
    assert got == sorted((i is None, i or 0, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in rows)
    assert token_counts(frame(spark, []), PATH).count() == 0
