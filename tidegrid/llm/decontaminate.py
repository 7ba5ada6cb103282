"""Benchmark passages in documents, found by latent semantic retrieval.

Words are hashed to terms, and every document is cut into passages. Spark counts in how many
passages each term is and multiplies the TF-IDF matrix of all passages, transposed and plain, with
a random matrix; from that product the driver gets the leading right singular vectors (a randomised
SVD in one pass, by Nystroem's formula). Its size is a constant: terms times dimensions.

Benchmark items, in segments of at most 64 words, and windows of the documents, of about the same
length and of the largest length not above it, are projected on these vectors, each weighted against how common it is. A window whose cosine with a segment reaches a limit is a
candidate. For each candidate the longest common subsequence of words is taken between the segment
and the text around the window. It is a leak if most of the segment is found in order, or somewhat
less of it together with its answer, the words the segment ends with (or the item's own answer if a
column holds it). Items of few words are searched for as they are, all words in a row.

Words are runs of letters, digits and underscores; in scripts written without spaces every character
is a word.

All passages take part in counts and vectors, all windows of whole texts in the search; candidates
are not limited in number. Items are searched for in blocks, each of which is broadcast, so their
number is not bounded by memory; documents are never shuffled.

Defined results: null and empty texts match nothing; an item without words matches nothing; items
with equal words match alike; a document shorter than a window is a window; texts are sliced with
overlap, so the longest need no more memory; repeated rows match alike; empty tables give empty
results; ``drop_leaks`` carries columns of any name along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh32_digest

from tidegrid.llm.common import fresh, table
from tidegrid.session import materialise

#: Buckets that terms are hashed to in the TF-IDF matrix.
TERMS = 1 << 13
#: Dimensions of the latent space. Those whose singular value is a thousandth of the largest are left out.
DIRECTIONS = 48
LEAST_VALUE = 1e-3
#: Terms that are so frequent that a matrix of their counts is worth while.
FREQUENT = 1024
#: Words of a passage of the TF-IDF matrix.
PASSAGE = 64
#: Window lengths in words; a segment is compared with the windows nearest to its length, and with the
#: largest that are not longer than itself, of which some can lie wholly inside the passage.
SCALES = (16, 32, 64)
#: Windows start every quarter of their length, which is a multiple of so many words.
STEP = 4
#: Least cosine of a candidate.
COSINE = 0.55
#: Least share of a segment's words found in order: alone, and together with the answer.
SHARE = 0.75
SHARE_WITH_ANSWER = 0.6
#: Words at the end of a segment that count as its answer.
ANSWER_WORDS = 4
#: Segments shorter than this are leaks only if all their words follow each other.
LEAST_WORDS = 8
#: Items that are broadcast at once.
BLOCK = 20_000
#: Words that are taken at once, in searching and in counting.
SEARCHED_AT_ONCE = 32_000
COUNTED_AT_ONCE = 64 * 1024

#: Thai, Lao, Burmese, Khmer, kana and Han, which are written without spaces.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
#: ASCII characters that are no part of a word.
MARKS = re.sub(r"\w", "", "".join(map(chr, range(128))))
WORD = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+")
#: Odd factor of the numbers that rows of a few words are looked up by.
FACTOR = 0x9E3779B97F4A7C15
KNOWN_WORDS = 200_000


class TermHashes(dict):
    """The numbers of the words in a piece of text without white space, 32 bits of hash of each in lower case."""

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        word = piece.strip(MARKS)
        if word.isalnum() and max(word) < UNSPACED[0]:  # one word, as most pieces are
            value = xxh32_digest(word.lower())[::-1]
        else:
            value = b"".join(xxh32_digest(w.lower())[::-1] for w in WORD.findall(piece))
        self[piece] = value
        return value


def term_bytes(text: str | None, known: TermHashes) -> bytes:
    return b"".join(map(known.__getitem__, (text or "").split()))


def terms_of(text: str | None, known: TermHashes) -> np.ndarray:
    return np.frombuffer(term_bytes(text, known), "<u4")


def _groups(arrays: Iterator[np.ndarray], reach: int, size: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Documents together up to ``size`` words; longer ones in slices that overlap by ``reach``.

    Gives the parts and the number of the document of each.
    """
    owners: list[int] = []
    parts: list[np.ndarray] = []
    held = 0
    for number, words in enumerate(arrays):
        start = 0
        while True:
            part = words[start : start + size + reach]
            if held and held + len(part) > size + reach:
                yield owners, parts
                owners, parts, held = [], [], 0
            owners.append(number)
            parts.append(part)
            held += len(part)
            start += size
            if start >= len(words):
                break
    if owners:
        yield owners, parts


def _passages(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Passage, term bucket and count of each non-zero entry, and the number of passages."""
    rows, base = [], 0
    for part in parts:
        rows.append(base + np.arange(len(part)) // PASSAGE)
        base += -(-len(part) // PASSAGE)
    words = np.concatenate(parts) & np.uint32(TERMS - 1)
    keys, counts = np.unique(np.concatenate(rows) * TERMS + words, return_counts=True)
    return keys // TERMS, keys % TERMS, counts, base


def passage_counts(terms: DataFrame) -> DataFrame:
    """``term``, number of passages with it; the number of passages is under term -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for _, parts in _groups(arrays_of(batch.column(0)), 0, COUNTED_AT_ONCE):
                _, buckets, _, passages = _passages(parts)
                found += np.bincount(buckets, minlength=TERMS)
                total += passages
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(found[some], total), pa.int64())],
            names=["term", "n"],
        )

    return terms.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))


def random_directions() -> np.ndarray:
    return np.random.default_rng(20240229).standard_normal((TERMS, DIRECTIONS)).astype(np.float32)


def products(terms: DataFrame, idf: np.ndarray) -> DataFrame:
    """The TF-IDF matrix, transposed, times itself, times the random directions; a row for each term."""
    shared = terms.sparkSession.sparkContext.broadcast(idf)
    names = [f"y{i}" for i in range(DIRECTIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        # a row of zeros for what fills up a passage
        omega = np.vstack([random_directions() * weight[:, None], np.zeros((1, DIRECTIONS))]).astype(np.float32)
        # what goes back to the most frequent terms, those of most words, is a product of matrices
        frequent = np.argsort(weight, kind="stable")[:FREQUENT]
        place = np.full(TERMS, -1, np.int64)
        place[frequent] = np.arange(FREQUENT)
        y = np.zeros((TERMS, DIRECTIONS), order="F")
        for batch in batches:
            for _, parts in _groups(arrays_of(batch.column(0)), 0, COUNTED_AT_ONCE):
                rows, buckets, counts, passages = _passages(parts)
                if not passages:
                    continue
                squares = np.bincount(rows, (counts * weight[buckets]) ** 2, passages)
                words, at = np.full(passages * PASSAGE, TERMS, np.int64), 0
                for part in parts:
                    words[at : at + len(part)] = part & np.uint32(TERMS - 1)
                    at += -(-len(part) // PASSAGE) * PASSAGE
                projected = omega.take(words, axis=0).reshape(passages, PASSAGE, DIRECTIONS).sum(axis=1)
                projected /= np.maximum(squares, 1e-18)[:, None].astype(np.float32)
                often = place[buckets]
                usual, rare = often >= 0, often < 0
                matrix = np.zeros((passages, FREQUENT), np.float32)
                matrix[rows[usual], often[usual]] = counts[usual]
                y[frequent] += matrix.T @ projected
                by_term, row, times = buckets[rare], rows[rare], counts[rare].astype(np.float32)
                for k, column in enumerate(projected.T.copy()):
                    y[:, k] += np.bincount(by_term, column[row] * times, TERMS)
        y *= weight[:, None]
        some = np.flatnonzero(y.any(axis=1))
        columns = [pa.array(some, pa.int32())] + [pa.array(y[some, i], pa.float64()) for i in range(DIRECTIONS)]
        yield pa.RecordBatch.from_arrays(columns, names=["term", *names])

    schema = "term int, " + ", ".join(f"{n} double" for n in names)
    summed = terms.select("terms").mapInArrow(run, schema).groupBy("term")
    return summed.agg(*[F.sum(n).alias(n) for n in names])


def leading_vectors(y: np.ndarray, omega: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors and values from ``y`` = A'A omega: Nystroem's formula for the matrix A'A."""
    shift = 1e-7 * np.linalg.norm(y) + 1e-12
    y = y + shift * omega
    core = omega.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max() * 1e-10
    half = y @ (vectors[:, good] / np.sqrt(values[good]))
    left, values, _ = np.linalg.svd(half, full_matrices=False)
    kept = values > values.max() * LEAST_VALUE
    return left[:, kept], values[kept]


@dataclass
class Segment:
    """A stretch of an item's words, its window length, and its answer."""

    item: int
    words: np.ndarray
    scale: int
    answer: tuple[int, ...]
    places: dict[int, int] = field(default_factory=dict)

    def __post_init__(self):
        for i, w in enumerate(self.words.tolist()):
            self.places[w] = self.places.get(w, 0) | (1 << i)

    def scales(self) -> set[int]:
        return {self.scale, max((s for s in SCALES if s <= len(self.words)), default=self.scale)}

    def common(self, words: list[int]) -> int:
        """Length of the longest common subsequence with ``words``, all of a segment at once as bits."""
        full = (1 << len(self.words)) - 1
        v = full
        for w in words:
            m = self.places.get(w)
            if m:
                u = v & m
                v = ((v + u) | (v - u)) & full
        return len(self.words) - v.bit_count()

    def answered(self, words: list[int]) -> bool:
        """Whether the answer's words follow each other in ``words``."""
        n = len(self.answer)
        first = self.answer[0] if n else None
        return n > 0 and any(
            w == first and tuple(words[i : i + n]) == self.answer for i, w in enumerate(words)
        )


def segments(item: int, text: str | None, answer: str | None = None) -> list[Segment]:
    known = TermHashes()
    words = terms_of(text, known)
    out = []
    longest = max(SCALES)
    pieces = max(1, -(-len(words) // longest))
    for part in np.array_split(words, pieces):
        if not len(part):
            continue
        # none if it is looked for as it is
        scale = 0 if len(part) < LEAST_WORDS else min(SCALES, key=lambda s: abs(np.log(s / len(part))))
        own = terms_of(answer, known) if answer else part[-ANSWER_WORDS:]
        out.append(Segment(item, part, scale, tuple(own.tolist())))
    return out


@dataclass
class Searcher:
    """Projection of terms, and the segments of one block of items by window length."""

    vectors: np.ndarray
    by_scale: dict[int, tuple[np.ndarray, list[Segment]]]
    #: Segments that are looked for as they are: by length, sorted keys, words of each, segments of each.
    exact: dict[int, tuple[np.ndarray, np.ndarray, list[list[Segment]]]]

    @classmethod
    def build(cls, vectors: np.ndarray, wanted: list[Segment]) -> Searcher:
        by_scale = {}
        for scale in SCALES:
            some = [s for s in wanted if scale in s.scales()]
            if some:
                rows = np.stack([vectors[s.words & np.uint32(TERMS - 1)].sum(axis=0) for s in some])
                by_scale[scale] = (_unit(rows), some)
        exact = {}
        for length in range(1, LEAST_WORDS):
            alike: dict[tuple[int, ...], list[Segment]] = {}
            for s in wanted:
                if len(s.words) == length:
                    alike.setdefault(tuple(s.words.tolist()), []).append(s)
            if alike:
                words = np.array(list(alike), np.uint32)
                keys = _keys(words.ravel(), length)[::length]
                order = np.argsort(keys, kind="stable")
                exact[length] = (keys[order], words[order], [list(alike.values())[i] for i in order])
        return cls(vectors, by_scale, exact)

    def search(self, arrays: Iterator[np.ndarray]) -> Iterator[tuple[int, Segment, float, int, bool]]:
        """Number of the document, segment, cosine, common words and answer of every leak."""
        table = np.vstack([self.vectors, np.zeros((1, self.vectors.shape[1]), np.float32)])
        longest = max(SCALES)
        for owners, parts in _groups(arrays, 2 * longest, SEARCHED_AT_ONCE):
            yield from self._verbatim(owners, parts)
            # Windows start and end every STEP words, so sums over as many words are enough. After each
            # part come as many empty steps as a window has, so that none reaches into the next.
            starts = np.concatenate([[0], np.cumsum([-(-len(p) // STEP) + longest // STEP for p in parts])])
            ids = np.full(starts[-1] * STEP, TERMS, np.int64)
            for p, part in enumerate(parts):
                ids[starts[p] * STEP : starts[p] * STEP + len(part)] = part & np.uint32(TERMS - 1)
            ids = ids.reshape(-1, STEP)
            sums = table.take(ids[:, 0], axis=0)
            for k in range(1, STEP):
                sums += table.take(ids[:, k], axis=0)
            length = STEP
            for scale in SCALES:
                while length < scale:  # sums over twice as many words, at the places of the shorter ones
                    sums[: len(sums) - length // STEP] += sums[length // STEP :].copy()
                    length *= 2
                if scale in self.by_scale:
                    rows, wanted = self.by_scale[scale]
                    step = scale // 4 // STEP
                    yield from self._candidates(owners, parts, starts, sums[::step], step, scale, rows, wanted)

    def _verbatim(self, owners, parts):
        """The segments of few words, once in each part."""
        if not self.exact:
            return
        line = np.concatenate(parts)
        ends = np.cumsum([len(p) for p in parts])
        for length, (keys, words, wanted) in self.exact.items():
            if len(line) < length:
                continue
            own = _keys(line, length)
            which = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            at = np.flatnonzero(keys[which] == own)
            p, which = np.searchsorted(ends, at, "right"), which[at]
            good = (at + length <= ends[p]) & (line[at[:, None] + np.arange(length)] == words[which]).all(axis=1)
            at, p, which = at[good], p[good], which[good]
            for i in np.unique(p * len(keys) + which, return_index=True)[1].tolist():
                begin = int(at[i] - ends[p[i]]) + len(parts[p[i]])
                near = parts[p[i]][max(0, begin - length // 2) : begin + length + length // 2].tolist()
                for segment in wanted[which[i]]:
                    yield owners[p[i]], segment, 1.0, length, segment.answered(near)

    def _candidates(self, owners, parts, starts, windows, step, scale, rows, wanted):
        least = COSINE * np.sqrt(np.einsum("ij,ij->i", windows, windows)) + 1e-12
        cosines = windows @ rows.T
        for hit in np.flatnonzero(cosines >= least[:, None]).tolist():
            w, s = divmod(hit, len(wanted))
            segment, length = wanted[s], len(wanted[s].words)
            p = int(np.searchsorted(starts, w * step, "right")) - 1
            begin = int(w * step - starts[p]) * STEP
            near = parts[p][max(0, begin - length // 2) : begin + scale + length // 2].tolist()
            # the common subsequence cannot be longer than the number of the segment's words here
            if sum(map(segment.places.__contains__, near)) < SHARE_WITH_ANSWER * length:
                continue
            common = segment.common(near)
            if common < SHARE_WITH_ANSWER * length:
                continue
            answered = segment.answered(near)
            if common >= SHARE * length or answered:
                yield owners[p], segment, float(cosines[w, s] / least[w] * COSINE), common, answered


def _keys(words: np.ndarray, length: int) -> np.ndarray:
    """A number for each row of ``length`` words, from the place where it starts."""
    keys = np.zeros(len(words) - length + 1, np.uint64)
    for k in range(length):
        keys = keys * np.uint64(FACTOR) + words[k : k + len(keys)]
    return keys


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return (rows / np.maximum(norms, 1e-9)[:, None]).astype(np.float32)


def with_terms(docs: DataFrame, keep: list[str], name: str) -> DataFrame:
    """The columns ``keep`` with the terms of each text as 32-bit numbers, written to the shared folder."""
    hidden = fresh([*keep, name], "_text")
    given = docs.select(*[docs[f"`{c}`"] for c in keep], docs["`text`"].alias(hidden))
    schema = T.StructType([f for f in given.schema.fields if f.name != hidden] + [T.StructField(name, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TermHashes()
        for batch in batches:
            rows = [term_bytes(t.as_py(), known) for t in batch.column(hidden)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(rows, pa.binary())], names=schema.names
            )

    return materialise(given.mapInArrow(run, schema), "terms")


def arrays_of(column: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(t.as_buffer(), "<u4") for t in column)


def latent_vectors(terms: DataFrame) -> np.ndarray:
    """IDF-weighted projection of each term bucket, from the ``terms`` of all texts.

    The first dimensions tell languages and kinds of text apart and are much alike in any two
    passages of a kind; divided by the squares of the singular values, those that tell passages
    apart decide.
    """
    counts = {r["term"]: r["n"] for r in passage_counts(terms).collect()}
    total = counts.pop(-1, 0)
    found = np.zeros(TERMS)
    for term, n in counts.items():
        found[term] = n
    idf = np.log((total + 1) / (found + 1)) + 0.01
    y = np.zeros((TERMS, DIRECTIONS))
    for row in products(terms, idf).collect():
        y[row["term"]] = row[1:]
    if not y.any():
        return np.zeros((TERMS, 1), np.float32)
    vectors, values = leading_vectors(y, random_directions().astype(np.float64))
    return (vectors * idf[:, None] * (values[-1] / values) ** 2).astype(np.float32)


def _blocks(benchmark: DataFrame) -> Iterator[list]:
    """The items, a bounded number at a time."""
    columns = ["item_id", "text"] + (["answer"] if "answer" in benchmark.columns else [])
    items = materialise(benchmark.select(*columns), "items")
    number = -(-items.count() // (BLOCK // 2))
    for k in range(number):
        yield items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k).collect()


def _vectors_for(termed: DataFrame, name: str, benchmark: DataFrame) -> np.ndarray:
    own = with_terms(benchmark, [], "terms")
    return latent_vectors(termed.select(F.col(name).alias("terms")).unionByName(own))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document (its columns but ``text``) and item found in it.

    Adds ``item_id``, ``cosine``, ``common_words``, ``segment_words`` and ``answered``; names that ``docs`` has get underscores.
    """
    kept = [c for c in docs.columns if c != "text"]
    name = fresh(kept, "_terms")
    termed = with_terms(docs, kept, name)
    vectors = _vectors_for(termed, name, benchmark)
    extra = T.StructType.fromDDL("item_id long, cosine double, common_words int, segment_words int, answered boolean")
    for field_ in extra.fields:
        field_.name = fresh(kept, field_.name)
    schema = T.StructType([f for f in docs.schema.fields if f.name != "text"] + extra.fields)
    out = None
    for rows in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(Searcher.build(vectors, _segments_of(rows)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best = {}
                for row, s, cosine, common, answered in shared.value.search(arrays_of(batch.column(name))):
                    # of an item's matches in a document, the best: share found, cosine
                    rank = (common / len(s.words), cosine)
                    if (row, s.item) not in best or best[row, s.item][0] < rank:
                        best[row, s.item] = (rank, cosine, common, len(s.words), answered)
                keys = sorted(best, key=lambda k: (k[0], k[1] is None, k[1] or 0))
                at = pa.array([k[0] for k in keys], pa.int64())
                values = [pa.array([k[1] for k in keys], pa.int64())] + [
                    pa.array([best[k][i] for k in keys], t)
                    for i, t in ((1, pa.float64()), (2, pa.int32()), (3, pa.int32()), (4, pa.bool_()))
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(at) for c in kept], *values], names=schema.names
                )

        found = termed.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _segments_of(rows: list) -> list[Segment]:
    return [
        s for r in rows for s in segments(r["item_id"], r["text"], r["answer"] if "answer" in r else None)
    ]


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with the columns of ``docs``."""
    name = fresh(docs.columns, "_terms")
    termed = with_terms(docs, docs.columns, name)
    vectors = _vectors_for(termed, name, benchmark)
    for rows in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(Searcher.build(vectors, _segments_of(rows)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = {row for row, *_ in shared.value.search(arrays_of(batch.column(name)))}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

        termed = termed.mapInArrow(run, termed.schema)
    return termed.drop(name)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks(docs, table(spark, sf_dir, "benchmark"))
