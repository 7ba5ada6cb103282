"""Token counts under a unigram vocabulary, without making the tokens.

The best segmentation of a text into pieces is the one with the highest sum of scores. An
Aho-Corasick automaton gives all pieces that end at a character; dynamic programming carries, for
each position, the best sum up to it and the number of pieces that it takes, and nothing else.

The rules are those of the published unigram tokenizer: spaces become the meta symbol, one is put in
front; between equal sums the piece that starts first wins; a character that no piece covers alone
can be an unknown piece, whose score is the lowest one less 10; unknown pieces next to each other
count once. With byte fallback, which op4 uses as the model has byte pieces, every byte in UTF-8 of an
unknown character counts as a piece instead.

No piece holds the meta symbol after another character (this is checked when a vocabulary is
loaded; one that does is taken over the whole text). So a text is cut before each run of meta
symbols, and counts of cuts met before are kept.

Defined results: null and empty texts have no pieces; texts of any length are taken whole, a cut of
any length in one pass; repeated rows get equal counts; an empty table gives an empty result; columns
of any other name are kept by ``count_column``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegrid.llm.common import fresh, table

META = "▁"
#: By how much an unknown character scores below the lowest piece (fixed by the tokenizer).
UNKNOWN_PENALTY = 10.0
#: Cuts whose counts a Python worker keeps; longer ones are not kept.
KNOWN_CUTS = 400_000
KNOWN_LENGTH = 40


class Known(dict):
    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, cut: str) -> int:
        value = self.count(cut)
        if len(cut) <= KNOWN_LENGTH:
            if len(self) >= KNOWN_CUTS:
                self.clear()
            self[cut] = value
        return value


class Unigram:
    """Pieces with their scores; ``unknown`` is the piece that stands for unknown characters, unless their bytes do."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: str = "<unk>", byte_fallback: bool = False):
        self.byte_fallback = byte_fallback
        scores = {p: s for p, s in pieces if p and p != unknown}
        self.lowest = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if scores:
            self.automaton.make_automaton()
        self.empty = not scores
        self.known = Known(self.best_count)
        # sums of cuts add up to the sum of the text only if no piece reaches over a cut
        whole = any(META in p.lstrip(META) for p in scores) or META not in scores
        self.cuts = (lambda text: [text]) if whole else re.compile(f"{META}+[^{META}]*|[^{META}]+").findall

    def best_count(self, text: str) -> int:
        """Pieces of the best segmentation of ``text``."""
        n = len(text)
        if self.empty:
            return len(text.encode()) if self.byte_fallback else min(n, 1)
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        open_end = [False] * (n + 1)  # whether the best segmentation ends with an unknown piece
        at = 0  # characters settled so far

        def settle(end: int, matches: list[tuple[int, float]]) -> None:
            # matches come longest first, so of equal sums the one that starts first stays
            found, top, start = False, 0.0, 0
            alone = False
            for size, score in matches:
                total = best[end - size] + score
                if not found or total > top:
                    found, top, start = True, total, end - size
                alone = alone or size == 1
            if not alone:
                total = best[end - 1] + self.lowest
                if not found or total > top:
                    best[end], open_end[end] = total, True
                    more = len(text[end - 1].encode()) if self.byte_fallback else not open_end[end - 1]
                    count[end] = count[end - 1] + more
                    return
            best[end], count[end] = top, count[start] + 1

        waiting: list[tuple[int, float]] = []
        for last, match in self.automaton.iter(text):
            end = last + 1
            if end != at:
                if at:
                    settle(at, waiting)
                for missing in range(at + 1, end):
                    settle(missing, [])
                at, waiting = end, []
            waiting.append(match)
        if at:
            settle(at, waiting)
        for missing in range(at + 1, n + 1):
            settle(missing, [])
        return count[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = META + text.replace(" ", META)
        return sum(map(self.known.__getitem__, self.cuts(marked)))


@lru_cache(maxsize=4)
def load(path: str, byte_fallback: bool = False) -> Unigram:
    """Pieces and scores of the sentencepiece model at ``path``, once for each Python process.

    Control and byte pieces are left out, as they never match text; with ``byte_fallback``, unknown
    characters count as their bytes if the model has byte pieces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    has_bytes = any(model.is_byte(i) for i in range(model.get_piece_size()))
    return Unigram(vocabulary(model), model.id_to_piece(model.unk_id()), byte_fallback and has_bytes)


def vocabulary(model) -> list[tuple[str, float]]:
    return [
        (model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]


def count_column(
    docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens", keep: list[str] | None = None, byte_fallback: bool = False
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the number of pieces of every text."""
    kept = docs.columns if keep is None else keep
    name = fresh(kept, name)
    hidden = fresh([*kept, name], "_text")
    given = docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"].alias(hidden))
    schema = T.StructType(
        [f for f in given.schema.fields if f.name != hidden] + [T.StructField(name, T.LongType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load(path, byte_fallback).count
        for batch in batches:
            counts = [count(t.as_py()) for t in batch.column(hidden)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(counts, pa.int64())], names=schema.names
            )

    return given.mapInArrow(run, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_column(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"], byte_fallback=True)
