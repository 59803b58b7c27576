import hashlib
import random

import public_tokenizers
import pytest
from helpers import AWKWARD, frame, with_extras
from sentencepiece import SentencePieceProcessor

from vitrine.llm import sentence_pieces
from vitrine.llm.sentence_pieces import Codec, Pieces, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(Pieces.read(PATH))


def _texts():
    draw = random.Random(4)
    alphabet = list("abcdeABC  'stsdmrev.,!?-_\n\t\r\x0b\x1c\x00\x85\xa0▁0123456789éÉèßİΣñ漢字かな한글😀👍🏽♥®̧") + ["<s>", "</s>", "<0x41>", "<unk>", "the", "tion", "  ", "    ", ");\r\n", "▁▁"]
    for _ in range(2500):
        yield "".join(draw.choice(alphabet) for _ in range(draw.randrange(60)))
    for _ in range(800):
        yield "".join(draw.choice("aenrstio") for _ in range(draw.randrange(40)))
    for n in range(40):
        yield " " * n
        yield "x" + " " * n + "y"
        yield " " * n + "\n" + " " * n
    yield "a" * 3000
    yield "漢字" * 500 + "ꙮ" * 200
    for _, text, *_ in AWKWARD:
        yield text or ""


def test_ids_and_text_equal_the_library(library, codec):
    for text in _texts():
        ids = codec.encode(text)
        assert ids == library.encode(text), repr(text)
        n, joined, decoded = codec.both(text)
        assert (n, joined) == (len(ids), ",".join(map(str, ids)))
        assert decoded == codec.decode(ids) == library.decode(ids), repr(text)


def test_decoding_any_ids(library, codec):
    draw = random.Random(9)
    for _ in range(300):
        ids = [draw.choice([draw.randrange(3, 259), draw.randrange(259, 32000)]) for _ in range(draw.randrange(1, 12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_query_rows(spark, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in encode(with_extras(frame(spark)).repartition(3), PATH, ids=True).collect())
    expected = []
    for i, t, *_ in AWKWARD:
        ids = library.encode(t or "")
        expected.append((i is None, i or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((library.decode(ids) if ids else "").encode()).hexdigest(), tuple(ids)))
    assert got == sorted(expected)
    assert encode(frame(spark, []), PATH).count() == 0


def test_runs_of_spaces_go_through_the_backtracking(library, codec, monkeypatch):
    merges = []
    monkeypatch.setattr(sentence_pieces, "merged", lambda text, scores, plain=sentence_pieces.merged: merges.append(text) or plain(text, scores))
    for n in range(2, 150):
        for tail in ("", "word", "the", "漢", "ꙮ", "9", ".x", "unbelievably", "\n"):
            text = " " * n + tail
            codec.known.clear(), codec.odd.clear()
            assert codec.both(text) == (len(ids := library.encode(text)), ",".join(map(str, ids)), library.decode(ids)), (n, tail)
    assert max(map(len, merges)) <= 2 * max(map(len, codec.pieces.ids))  # only pairs of neighbours


def test_text_is_decoded_from_the_ids():
    pieces = Pieces.read(PATH)
    own = Codec(pieces)
    own.by_decimal[str(pieces.ids["▁the"])] = "▁THE"
    assert own.both("of the day")[2] == "of THE day"
