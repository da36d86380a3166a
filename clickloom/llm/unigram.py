"""Token counts under a unigram vocabulary, without making the tokens.

A vocabulary gives each piece a score; a text's segmentation is the one with
the greatest sum. An Aho-Corasick automaton over the vocabulary reports every
piece that ends at a character, and dynamic programming carries, for each
character, the best score and the number of pieces of the best path. Ties are
resolved as the tokenizer does it: starts are tried from the left, and only a
strictly better sum replaces a path, so among equal sums the longest last piece
stays. A character that is no piece is taken as unknown at the least score
minus 10 and counts its UTF-8 bytes (byte fallback), or once where the
vocabulary lacks the byte pieces, with neighbouring unknowns fused.

Spaces become the word mark and each mark begins a word; words are segmented
one by one, so each word's count is remembered, up to a bound.

Defined cases. Null or empty text: 0 tokens. Repeated rows, null ids: counted
like others. Whole texts are read; only the named columns are used.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.llm.common import text_of

# Fixed values of the tokenizer format: the word mark and the penalty of unknown characters.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 300_000

Vocabulary = Sequence[tuple[str, float]]


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) pairs of a sentencepiece model file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


class Counter:
    """Counts the pieces of texts."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        names = {piece for piece, _ in vocabulary}
        self.by_bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.cache: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        """Pieces of the best segmentation of one word."""
        n = len(word)
        score, pieces = [0.0] * (n + 1), [0] * (n + 1)
        # The ends whose best path closes with an unknown character.
        unknown: set[int] = set()

        def settle(end: int, best: float, start: int, single: bool) -> None:
            fallback = score[end - 1] + self.unknown
            if start >= 0 and (single or fallback <= best):
                score[end], pieces[end] = best, pieces[start] + 1
                return
            score[end] = fallback
            if self.by_bytes:
                pieces[end] = pieces[end - 1] + len(word[end - 1].encode("utf-8", "replace"))
            else:
                pieces[end] = pieces[end - 1] + (end - 1 not in unknown)
            unknown.add(end)

        # Matches come by their end, and for one end the longest piece first: starts from the left.
        at, best, start, single = 1, -math.inf, -1, False
        for last, (length, value) in self.automaton.iter(word):
            if last >= at:
                while at <= last:
                    if single and start >= 0:
                        score[at], pieces[at] = best, pieces[start] + 1
                    else:
                        settle(at, best, start, single)
                    at += 1
                    best, start, single = -math.inf, -1, False
            begin = at - length
            total = score[begin] + value
            if total > best:
                best, start = total, begin
            if length == 1:
                single = True
        while at <= n:
            settle(at, best, start, single)
            at += 1
            best, start, single = -math.inf, -1, False
        return pieces[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = text.replace(" ", MARK).split(MARK)
        # A mark is put in front of the text unless it has one.
        words = [first, *rest] if first else rest
        cache, total = self.cache, 0
        for word in words:
            n = cache.get(word)
            if n is None:
                n = self.count_word(MARK + word)
                if len(cache) >= CACHE:
                    cache.clear()
                if len(word) <= 64:
                    cache[word] = n
            total += n
        return total


def token_count(text: str | Column, vocabulary_path: str,
                read: Callable[[str], Vocabulary] = read_vocabulary) -> Column:
    """Number of pieces of each text; the vocabulary file is read once per task."""

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(read(vocabulary_path))
        for texts in batches:
            yield texts.map(counter.count).astype("int64")

    each.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(each, "long")(text_of(text))
