"""Token counts of a byte-level BPE with word ends, by a whole-token shortcut.

Before the scan, each string of the vocabulary is merged once; those that end up as one token are proved to encode alone
(`prove`). A pre-token of a text that is proved counts as one token; only the rest is merged. The proved strings and the
merge ranks are broadcast: their size is that of the vocabulary file, not of the data.

Texts are taken apart at white space first. That is safe: special strings hold none, normal form C joins nothing across
it, and no pre-token contains it. Counts of white-space chunks are remembered per worker, in a table of bounded size.
"""

from __future__ import annotations

import json
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.bpe import merge
from vitrine.llm.common import per_worker

REMEMBERED = 400_000
#: Python parts texts at these, too; the library's pattern takes them for ordinary characters.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPACES = r"[^\t-\r \x85\xa0  -     　]+"


def byte_letters() -> list[str]:
    """Byte-level alphabets print bytes as letters: printable Latin-1 as itself, the others from code point 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in printable else chr(extra))
        extra += b not in printable
    return out


@dataclass
class Vocabulary:
    ranks: dict[tuple[str, str], int]
    pattern: str
    specials: list[str]
    suffix: str
    proved: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a `tokenizers` file with NFC, white space and lower case as normal form, and a split pattern."""
        whole = json.loads(Path(path).read_text())
        model = whole["model"]
        steps = [x["type"] for x in whole["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or model["byte_fallback"] or model["ignore_merges"]:
            raise ValueError("not a vocabulary of the kind this operator reads")
        split = whole["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        vocabulary = cls(
            ranks={tuple(pair): i for i, pair in enumerate(model["merges"])}, pattern=split,
            specials=[t["content"] for t in whole["added_tokens"]], suffix=model["end_of_word_suffix"] or "",
        )
        vocabulary.prove(model["vocab"])
        return vocabulary

    def symbols(self, word: str) -> list[str]:
        letters = [LETTERS[b] for b in word.encode()]
        letters[-1] += self.suffix
        return letters

    def pieces(self, word: str) -> list[str]:
        return merge(self.symbols(word), lambda a, b: self.ranks.get((a, b)))

    def prove(self, strings) -> None:
        """Keep the words that the merges turn into one token of the vocabulary."""
        values = {letter: b for b, letter in enumerate(LETTERS)}
        for string in strings:
            if string.endswith(self.suffix) and len(string) > len(self.suffix):
                try:
                    word = bytes(values[c] for c in string[: len(string) - len(self.suffix)]).decode()
                except (UnicodeDecodeError, KeyError):
                    continue
                if self.pieces(word) == [string]:
                    self.proved[word] = 1


LETTERS = byte_letters()


class Counter:
    """Counts tokens; one per worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known, self.merged = vocabulary, {}, {}
        self.find = regex.compile(vocabulary.pattern).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.specials, key=len, reverse=True))) + ")") if vocabulary.specials else None
        self.chunks = regex.compile(SPACES).findall

    def _plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        total, proved = 0, self.vocabulary.proved
        for word in self.find(text):
            if word in proved:
                total += 1
                continue
            n = self.merged.get(word)
            if n is None:
                n = len(self.vocabulary.pieces(word))
                if len(word) <= 40:
                    if len(self.merged) >= REMEMBERED:
                        self.merged.clear()
                    self.merged[word] = n
            total += n
        return total

    def _chunk(self, chunk: str) -> int:
        if self.special is None:
            return self._plain(chunk)
        parts = self.special.split(chunk)
        return sum(1 if i % 2 else self._plain(part) for i, part in enumerate(parts))

    def count(self, text: str) -> int:
        chunks = self.chunks(text) if any(c in text for c in SEPARATORS) else text.split()
        known = self.known
        counts = list(map(known.get, chunks))
        if None in counts:
            for i, n in enumerate(counts):
                if n is None:
                    chunk = chunks[i]
                    n = counts[i] = known[chunk] if chunk in known else self._chunk(chunk)
                    if len(chunk) <= 40:
                        known[chunk] = n
            if len(known) > REMEMBERED:
                known.clear()
        return sum(counts)


def token_counts(documents: DataFrame, path: str) -> DataFrame:
    """One row per row of `documents`: doc_id, n_bytes (UTF-8), n_tokens by the vocabulary file at `path`.

    No begin or end tokens are added; special strings inside a text count as the one token they are. Null texts count
    as empty: no bytes, no tokens. No rows, no result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(token, lambda: Counter(shared.value))
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            sizes = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(b or b"") for b in sizes], pa.int64()), pa.array([counter.count(t) for t in texts], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
