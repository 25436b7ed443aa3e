"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton lists all vocabulary pieces that end at each character; dynamic
programming carries the best score and, beside it, the number of pieces on that path.
Ties go as in the tokenizer: of equal scores the earliest start wins. A character that is no
piece costs ten less than the worst piece and counts one piece per UTF-8 byte.

Blanks become the piece mark and a text begins with one. No piece runs over the start of a
mark or over a line feed, so counts add up over the stretches in between; each task keeps
the counts of stretches it has seen, in a table of bounded size. Null and empty texts have
no tokens. One row out per row in, whatever the ids; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def pieces_of(model_file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts pieces of texts; ``limit`` bounds the remembered stretches."""

    def __init__(self, pieces: list[tuple[str, float]], limit: int = 400_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and not self.automaton.exists(piece):
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        if any(MARK in p.lstrip(MARK) or "\n" in p for p, _ in pieces):
            raise ValueError("a piece runs over the start of a word or a line")
        self.known: dict[str, int] = {}
        self.limit = limit

    def viterbi(self, text: str) -> int:
        n = len(text)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        done = 0  # ends up to here are settled
        single, unknown = self.single, self.unknown
        best: float | None = None
        # a piece that starts anywhere before its end rests on a settled end
        for last, (length, gain) in self.automaton.iter(text):
            end = last + 1
            while done < end - 1:
                done += 1
                self._settle(text, done, best, score, count, single, unknown)
                best = None
            start = end - length
            candidate = score[start] + gain
            if best is None or candidate > best:
                best, score[end], count[end] = candidate, candidate, count[start] + 1
        while done < n:
            done += 1
            self._settle(text, done, best, score, count, single, unknown)
            best = None
        return count[n]

    @staticmethod
    def _settle(text: str, end: int, best: float | None, score: list[float], count: list[int], single: set[str], unknown: float) -> None:
        """Last candidate of an end: its character on its own, if that is no piece."""
        char = text[end - 1]
        if char not in single:
            candidate = score[end - 1] + unknown
            if best is None or candidate > best:
                score[end], count[end] = candidate, count[end - 1] + len(char.encode())

    def stretch(self, text: str) -> int:
        found = self.known.get(text)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.known[text] = self.viterbi(text)
        return found

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text or "  " in text:  # runs of marks belong to the word after them
            marked = (MARK + text).replace(" ", MARK)
            total = marked.count("\n")
            for line in marked.split("\n"):
                at = 0
                while at < len(line):
                    end = at
                    while end < len(line) and line[end] == MARK:
                        end += 1
                    while end < len(line) and line[end] != MARK:
                        end += 1
                    total += self.stretch(line[at:end])
                    at = end
            return total
        stretch, lines = self.stretch, text.split("\n")
        total = len(lines) - 1
        for number, line in enumerate(lines):
            words = line.split(" ")
            # only the first word of a later line has no mark before it
            if number:
                total += stretch(words[0]) if words[0] else 0
                words = words[1:]
            for word in words:
                total += stretch(MARK + word)
        return total


_counters: dict[str, Counter] = {}


def counter(model_file: str) -> Counter:
    """One counter per worker process and file."""
    if model_file not in _counters:
        _counters[model_file] = Counter(pieces_of(model_file))
    return _counters[model_file]


def count_tokens(documents: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, n_chars, n_tokens`` for every row. The file lies on every executor at the same path."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(model_file)
        for texts in batches:
            yield pd.Series([count(t or "") for t in texts], dtype="int64")

    text = T.text_or_empty()
    return documents.select("doc_id", F.length(text).cast("long").alias("n_chars"), run(text).alias("n_tokens"))
