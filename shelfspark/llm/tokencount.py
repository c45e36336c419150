"""Token counts by a count-only Viterbi pass.

The piece vocabulary with its scores is read as a unigram model.  An Aho-Corasick automaton
over the normal and user-defined pieces lists every piece that ends at each character; dynamic
programming carries only the best score and the number of pieces of that best path, never the
pieces themselves.

Tie rules of the tokenizer: a later candidate for the same end replaces an earlier one only
if its score is greater, and candidates arrive by their start, so the longest last piece wins
a tie.  A character without a piece of its own is unknown, at the lowest score less ten;
user-defined pieces score their length times the best score, less 0.1.  A run of unknown
characters is one token, or one per byte with byte fallback.  Sums are double precision.

Words (normalised text between space markers) are counted by themselves and remembered where
no piece has the marker behind another character: every path then cuts there.

Cases: null and empty texts have 0 tokens; extra columns stay, clashing names get an
underscore; repeated rows are each counted; long texts are counted whole.
"""

from __future__ import annotations

import functools
import math

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfspark.llm.common import add_columns, fresh
from shelfspark.llm.sentencepieces import CACHED, DEFAULT_MODEL, Remembered, normalise, units_of, words_apart
from shelfspark.llm.spmodel import MARK, NORMAL, USER_DEFINED, Model, parse

UNKNOWN_PENALTY = 10.0


class Counter:
    def __init__(self, model: Model, cached: int = 2 * CACHED):
        self.automaton = ahocorasick.Automaton()
        used = [(p, s, t) for p, s, t in zip(model.pieces, model.scores, model.types) if t in (NORMAL, USER_DEFINED) and p]
        normal = [s for _, s, t in used if t == NORMAL] or [0.0]
        self.unknown, top = min(normal) - UNKNOWN_PENALTY, max(normal)
        for piece, score, kind in used:
            size = len(piece)
            bonus = len(piece.encode()) * top - 0.1
            self.automaton.add_word(piece, (size, bonus if kind == USER_DEFINED else score))
        self.any = bool(used)
        if used:
            self.automaton.make_automaton()
        self.by_byte = model.byte_fallback and len(model.byte_ids) == 256
        self.singles = {p for p, _, _ in used if len(p) == 1}
        self.normalise = normalise(model)
        self.apart = words_apart(model) and model.escape_spaces and model.dummy_prefix and not model.suffix_mark
        self.known = Remembered(cached)

    def viterbi(self, unit: str) -> int:
        """Tokens on the best path over one unit."""
        if not self.singles.issuperset(unit):
            return self._with_unknown(unit)
        best, count = [0.0] + [-math.inf] * len(unit), [0] * (len(unit) + 1)
        for last, (size, score) in self.automaton.iter(unit):  # by end; for one end, the longest first
            begin = last + 1 - size
            total = best[begin] + score
            if total > best[last + 1]:
                best[last + 1], count[last + 1] = total, count[begin] + 1
        return count[-1]

    def _with_unknown(self, unit: str) -> int:
        n = len(unit)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if self.any:
            for last, piece in self.automaton.iter(unit):
                matches[last].append(piece)
        best, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, tokens, open_run = -math.inf, 0, False
            for size, score in matches[end - 1]:
                total = best[end - size] + score
                if total > top:
                    top, tokens, open_run = total, count[end - size] + 1, False
            if unit[end - 1] not in self.singles:
                total = best[end - 1] + self.unknown
                if total > top:
                    if self.by_byte:
                        more = len(unit[end - 1].encode("utf-8", "surrogatepass"))
                    else:
                        more = 0 if unknown[end - 1] else 1
                    top, tokens, open_run = total, count[end - 1] + more, True
            best[end], count[end], unknown[end] = top, tokens, open_run
        return count[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.apart:
            return self.viterbi(self.normalise(text))
        words = units_of(self.normalise, text)
        known = self.known.complete(set(words), lambda new: [(word, self.viterbi(MARK + word)) for word in new])
        return sum(map(known.__getitem__, words))


@functools.lru_cache(maxsize=2)
def counter_of(raw: bytes) -> Counter:
    """One counter per Python worker, so that tasks share the words it remembers."""
    return Counter(parse(raw))


def count_tokens(docs: DataFrame, model_path: str = DEFAULT_MODEL, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with the number of tokens; and that column's name.

    The vocabulary file, of fixed size, is broadcast; documents are not shuffled.
    """
    (name,) = fresh(docs.columns, "n_tokens")
    with open(model_path, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def start():
        counter = counter_of(sent.value)
        return lambda texts: {name: [counter.count(value) for value in texts]}

    return add_columns(docs, text, [(name, T.LongType())], start), name


def report(docs: DataFrame, model_path: str = DEFAULT_MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    counted, _ = count_tokens(docs.select(key, text), model_path, text)
    return counted.drop(text)
