"""Token counts under a unigram vocabulary, without building the tokens (operator 4).

Aho-Corasick finds every vocabulary piece that ends at a place; dynamic programming carries, per
place, the best score of a segmentation up to it and the number of its tokens. Ties go as in the
tokenizers library: of equal scores the one whose last piece starts first stays. A character that
is no piece costs ten more than the worst piece and counts one token per byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import column, read_file, send, slices, text_of

MARK = "▁"
UNKNOWN_COST = 10.0  # what an unknown character costs beyond the worst piece; fixed by the library
KEPT_WORDS = 300_000  # counted words a worker keeps


def pieces_of(model: bytes) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file, in the order of their ids."""
    file = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [(file.id_to_piece(i), file.get_score(i)) for i in range(file.get_piece_size())]


class Counter:
    """Counts tokens of a text. The vocabulary has a token for each byte."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_COST
        names = {p for p, _ in pieces}
        if not all(f"<0x{b:02X}>" in names for b in range(256)):
            raise ValueError("the vocabulary has no byte pieces")
        # Where no piece holds a character and a mark only begins pieces, words are counted on their own.
        self.apart = not any("\n" in p or MARK in p.lstrip(MARK) for p in names)
        self.known: dict[str, int] = {}

    def _count(self, word: str) -> int:
        n = len(word)
        best: list[float | None] = [0.0] + [None] * n
        tokens = [0] * (n + 1)
        alone = 0  # characters that have been looked at as unknown ones
        for last, (length, score) in self.automaton.iter(word):  # by place, longest piece first
            end = last + 1
            while alone < last:
                alone += 1
                if best[alone] is None or not self._single(word[alone - 1]):
                    self._skip(word, alone, best, tokens)
            start = end - length
            total = best[start] + score
            if best[end] is None or total > best[end]:
                best[end], tokens[end] = total, tokens[start] + 1
        while alone < n:
            alone += 1
            if best[alone] is None or not self._single(word[alone - 1]):
                self._skip(word, alone, best, tokens)
        return tokens[n]

    def _single(self, character: str) -> bool:
        return character in self.automaton

    def _skip(self, word: str, end: int, best: list, tokens: list[int]) -> None:
        """The character before ``end`` as an unknown one: the candidate that starts last."""
        if self._single(word[end - 1]):
            return
        total = best[end - 1] + self.unknown
        if best[end] is None or total > best[end]:
            best[end], tokens[end] = total, tokens[end - 1] + len(word[end - 1].encode())

    def _word(self, word: str) -> int:
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        count = self.known[word] = self._count(word)
        return count

    def count(self, text: str) -> int:
        """Spaces become marks and the text begins with one; an empty text has no token."""
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if not text.startswith(MARK):
            text = MARK + text
        if not self.apart:
            return sum(self._count(MARK + w) for w in text.split(MARK)[1:])
        total, known = 0, self.known.get
        for i, line in enumerate(text.split("\n")):
            total += i > 0  # the line feed is an unknown character of one byte
            for k, word in enumerate(line.split(MARK)):
                if k:
                    word = MARK + word
                elif not word:
                    continue
                found = known(word)
                total += self._word(word) if found is None else found
        return total


@lru_cache(maxsize=2)
def _counter(digest: str, content: bytes) -> Counter:
    return Counter(pieces_of(content))


def count_tokens(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``n_tokens`` of each row's whole text, one row out per row in.

    Null and empty texts have 0 tokens. Repeated rows are counted each; other columns are not read.
    One pass without a shuffle; a worker keeps a bounded number of counted words.
    """
    sent = send(docs.sparkSession, content := read_file(path))
    digest = hashlib.sha256(content).hexdigest()
    rows = docs.select(*[column(c) for c in keep], text_of().alias("text" if "text" not in keep else "text_"))
    text = rows.columns[-1]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), "n_tokens bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(digest, sent.value)
        for batch in slices(batches, text):
            values = batch.column(batch.num_columns - 1).to_pylist()
            counts = np.fromiter(map(counter.count, values), np.int64, len(values))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(counts)], names=[*keep, "n_tokens"])

    return rows.mapInArrow(run, schema)


def op4_token_counts(spark, folder: str, path: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{folder}/documents.parquet"), path)
