"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

A sequence of pieces is the encoder's own result if, and only if, merging each two neighbours' text afresh gives just
these two pieces. So the encoder walks a text from the left with the longest piece that an Aho-Corasick automaton finds
there, checks it against its left neighbour by re-merging (results are remembered), takes the next shorter piece if they
do not fit, and steps back where none fits; a bitfield marks positions from which no way on was found.

Text is cut into units first: at a space sign after another character, and around line ends. `Pieces` proves from
the vocabulary that no piece spans such a cut. Pieces of nothing but space signs share one score, the lowest, and have no
other signs beside them: the leftmost grows as far as there is a piece for it, after all other merges, so the sequence
of a run depends on its length alone, and neighbours merged afresh tell it as they do any other.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.bpe import merge
from vitrine.llm.common import per_worker

SPACE = "▁"
REMEMBERED = 500_000


class Pieces:
    """Vocabulary of a merge-type model with byte fallback; small and of fixed size, so it may be broadcast."""

    def __init__(self, ids: dict[str, int], scores: dict[str, float], byte_ids: list[int]):
        self.ids, self.scores, self.byte_ids = ids, scores, byte_ids
        for piece in ids:
            if SPACE in piece.lstrip(SPACE) or "\n" in piece and len(piece) > 1:
                raise ValueError(f"piece {piece!r} spans the cut between units")

    @classmethod
    def read(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids, scores, by_byte = {}, {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                by_byte[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                ids[piece], scores[piece] = i, model.get_score(i)
        if len(by_byte) != 256:
            raise ValueError("the model has no byte fallback")
        return cls(ids, scores, [by_byte[b] for b in range(256)])


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The pieces of a text by merging: the best score first."""

    def rank(a: str, b: str):
        score = scores.get(a + b)
        return None if score is None else -score

    return merge(text, rank)


class Codec:
    """Encodes and decodes; one per worker."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        # Only pieces that the merges can make; `shorter`: the next shorter one of them that begins each.
        alone = {p for p in pieces.ids if len(p) == 1 or merged(p, pieces.scores) == [p]}
        self.shorter: dict[str, str] = {}
        for piece in alone:
            self.automaton.add_word(piece)
            if len(piece) > 1:
                self.shorter[piece] = next((piece[:k] for k in range(len(piece) - 1, 1, -1) if piece[:k] in alone), piece[0])
        self.automaton.make_automaton()
        self.units = regex.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        self.fits = lru_cache(1_000_000)(self._fits)
        self.by_id = {i: p for p, i in pieces.ids.items()}
        self.byte_of = {i: b for b, i in enumerate(pieces.byte_ids)}
        self.decimal = {p: str(i) for p, i in pieces.ids.items()}
        self.by_decimal = {str(i): p for i, p in self.by_id.items()}
        self.known: dict[str, str] = {}  # ids of units, in decimal
        self.odd: dict[str, str] = {}  # those of them whose ids decode to another text, with that text

    def _fits(self, a: str, b: str) -> bool:
        return merged(a + b, self.pieces.scores) == [a, b]

    def split(self, text: str) -> list[str]:
        """The pieces (or single unknown characters) of a unit."""
        if len(text) < 2:
            return [text] if text else []
        n = len(text)
        open_ends = bytearray(b"\xff" * (n // 8 + 1))  # bit i: a way on from i may exist
        out: list[str] = []
        at, piece = 0, self._longest(text, 0)
        while at < n:
            before = out[-1] if out else None
            while piece is not None:
                end = at + len(piece)
                if open_ends[end >> 3] >> (end & 7) & 1 and (before is None or self.fits(before, piece)):
                    break
                piece = self.shorter.get(piece)
            if piece is None:
                open_ends[at >> 3] &= ~(1 << (at & 7))
                piece = out.pop()
                at -= len(piece)
                piece = self.shorter.get(piece)
                continue
            out.append(piece)
            at = end
            if at < n:
                piece = self._longest(text, at)
        return out

    def _longest(self, text: str, at: int) -> str:
        """The longest piece that begins at `at`; a character that is none stands for itself."""
        for end, size in self.automaton.iter_long(text, at):
            if end - size + 1 == at:
                return text[at : end + 1]
            break
        return text[at]

    def encode_unit(self, unit: str) -> list[int]:
        ids, byte_ids = self.pieces.ids, self.pieces.byte_ids
        out: list[int] = []
        for piece in self.split(unit):
            i = ids.get(piece)
            if i is None:
                out += [byte_ids[b] for b in piece.encode()]
            else:
                out.append(i)
        return out

    def _unit(self, unit: str) -> tuple[str, str]:
        """Ids of a unit, in decimal, and the text that they decode to."""
        found = list(map(self.decimal.get, self.split(unit)))
        if None in found:
            ids = self.encode_unit(unit)
            found, decoded = list(map(str, ids)), self._joined(ids)
        else:
            decoded = "".join(map(self.by_decimal.get, found))
        joined = ",".join(found)
        if len(unit) <= 40:
            if len(self.known) >= REMEMBERED:
                self.known.clear(), self.odd.clear()
            self.known[unit] = joined
            if decoded != unit and decoded != unit.replace(SPACE, " "):
                self.odd[unit] = decoded
        return joined, decoded

    def _parts(self, text: str) -> tuple[list[str], list[str]]:
        """Ids of each unit, and the text that they decode to (its space signs may still be such)."""
        units = self.units(SPACE + text.replace(" ", SPACE)) if text else []
        found = list(map(self.known.get, units))
        told = list(map(self.odd.get, units, units)) if self.odd else units
        if None in found:
            told = list(told)
            for i, ids in enumerate(found):
                if ids is None:
                    unit = units[i]
                    ids = self.known.get(unit)
                    found[i], told[i] = self._unit(unit) if ids is None else (ids, self.odd.get(unit, unit))
        return found, told

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids in self._parts(text)[0] for i in ids.split(",")]

    def _joined(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            out.append(self.by_id.get(i, ""))
        out.append(_utf8(run))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        return self._joined(ids).removeprefix(" ")

    def both(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids in decimal joined by commas, and the text decoded from them.

        Units end at whole characters, so decoding them apart gives what decoding all ids gives.
        """
        found, told = self._parts(text)
        joined = ",".join(found)
        return (joined.count(",") + 1 if joined else 0), joined, "".join(told).replace(SPACE, " ").removeprefix(" ")


def _utf8(run: bytearray) -> str:
    """Bytes as text; a byte that belongs to no character becomes U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                size = 1
                out.append("�")
            at += size
        return "".join(out)


def encode(documents: DataFrame, path: str, *, ids: bool = False) -> DataFrame:
    """One row per row of `documents`: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (text
    decoded from the ids, UTF-8), and with `ids` the ids themselves. No begin or end ids.

    Null and empty texts have no ids; their digests are those of the empty string. No rows, no result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(Pieces.read(path))
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = per_worker(token, lambda: Codec(shared.value))
        sha = hashlib.sha256
        for batch in batches:
            counts, id_digests, text_digests, lists = [], [], [], []
            for text in batch.column(1).to_pylist():
                n, joined, decoded = codec.both(text or "")
                counts.append(n)
                id_digests.append(sha(joined.encode()).hexdigest())
                text_digests.append(sha(decoded.encode()).hexdigest())
                if ids:
                    lists.append([int(i) for i in joined.split(",")] if n else [])
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns, names = [*columns, pa.array(lists, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
