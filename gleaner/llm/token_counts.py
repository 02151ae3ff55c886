"""Token counts by a count-only Viterbi over a unigram vocabulary.

For each text the operator finds how many pieces the best (highest scoring)
segmentation has, without building the pieces.  An Aho-Corasick automaton
lists the vocabulary pieces that end at each position; dynamic programming
carries (best score, number of pieces) from position to position.

Tie rules are those of the unigram tokenizers: candidates for a position are
tried by ascending start, and a later one replaces an earlier one only if its
score is strictly higher, so the longest last piece wins a tie.  A character
no piece starts and ends with scores ``lowest score - 10`` and counts as its
UTF-8 bytes (byte fallback).

The text is cut before each U+2581 after blanks became U+2581 and one was put
in front, and pieces never span such a cut.  So a segmentation is the sum of
its words' segmentations, and a bounded cache holds words already counted.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField

from gleaner.llm.common import Recent, documents, map_texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value
CACHE_WORDS = 300_000  # words in each of a Python worker's two cache generations
CACHE_CHARS = 64  # longer words are counted, not held


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a sentencepiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class PieceCounter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if MARK not in piece[1:]:  # no unit holds a second mark
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.cache = Recent(CACHE_WORDS)

    def unit(self, unit: str) -> tuple[int, float]:
        """(pieces, score) of one unit's best segmentation."""
        score, pieces, size = [0.0], [0], len(unit)
        done = 0  # positions decided so far
        best, n, single = None, 0, False
        for end, (length, value) in chain(self.automaton.iter(unit), ((size, (0, 0.0)),)):
            while done < end:  # position done + 1 has had all its candidates
                if not single:
                    candidate = score[done] + self.unknown
                    if best is None or candidate > best:
                        best, n = candidate, pieces[done] + len(unit[done].encode())
                score.append(best)
                pieces.append(n)
                best, single, done = None, False, done + 1
            start = end + 1 - length  # per end: longest, i.e. earliest start, first
            if start <= end and (best is None or score[start] + value > best):
                best, n = score[start] + value, pieces[start] + 1
            single = length == 1  # the shortest comes last
        return pieces[-1], score[-1]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = text.replace(" ", MARK)
        units = (marked[1:] if marked[0] == MARK else marked).split(MARK)
        total, score, cache = 0, 0.0, self.cache
        for u, got in zip(units, map(cache.young.get, units)):
            if got is None:
                got = cache.get(u)
            if got is None:
                got = self.unit(MARK + u)
                if len(u) <= CACHE_CHARS:
                    cache.put(u, got)
            total += got[0]
            score += got[1]
        return total, score


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(read_vocabulary(path))


FIELDS = [StructField("n_tokens", LongType()), StructField("viterbi_score", DoubleType())]


def token_counts(df: DataFrame, text_col: str = "text", vocabulary: str | None = None,
                 carry: list[str] | None = None) -> DataFrame:
    """One row per input row: the columns ``carry`` (default: all but the
    text) with ``n_tokens`` and ``viterbi_score``.

    ``vocabulary``: path of the vocabulary file, readable on every executor.
    A null text counts as empty: 0 tokens, score 0.  Repeated rows are counted
    each.  A column of the input named like an output column is replaced.  An
    empty table gives an empty result.
    """
    path = vocabulary or default_vocabulary()

    def start():
        c = counter(path)

        def run(texts):
            found = [c.text(t.decode()) if t else (0, 0.0) for t in texts]
            return [x[0] for x in found], [x[1] for x in found]

        return run

    return map_texts(df, text_col, start, FIELDS, carry)


def op1_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir, "doc_id", "text"))
