"""Documents scored by masked pseudo-likelihood: every word predicted from both its sides.

The network sees the ``REACH`` words to the left and to the right of a word, not the word itself. A
table for each place of the window gives each neighbour's share of a hidden layer; from its tanh the
word's class is predicted, and then the word among those of its class, which makes the output of a
thousand words cost that of sixty-four. The score of a document is the sum of the logarithms of the
probabilities of all its words.

Words are counted over the whole corpus. The most frequent have a place of their own in the
vocabulary, the others share some by hash. The network predicts the place; the word's probability is
that of its place times the word's share of it, its count among all of the place and one more, which
stands for words never seen. The counts are found by a hash of 63 bits, those of the ``OFTEN`` most frequent
words in every task and the others by a join; words with equal hashes count as one. Training is spread: in each round every task starts from
the same parameters, goes through its own part of the corpus in small batches, and Spark averages the
results, weighted by the words seen. A round takes every second word of every document as a target and
the next round the others, so each word of the corpus is predicted once in training. Vocabulary and
parameters have a fixed size.

The average is a sum of doubles whose order Spark does not fix; parameters are rounded to single
precision afterwards, so scores of two runs agree to about six digits.

Defined results: null and empty texts have no words and score 0 with a null mean; words beyond the
ends count as a pad; documents of any length are taken in slices that overlap by the window; equal
texts get equal scores; an empty table gives an empty result; columns of any other name are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidegrid.llm.common import table
from tidegrid.session import materialise

CLASSES = 32
PER_CLASS = 32
WORDS = CLASSES * PER_CLASS
#: Places of the vocabulary that infrequent words share.
SHARED = 64
KNOWN = WORDS - SHARED
#: Neighbours on each side, and the width of the hidden layer.
REACH = 2
HIDDEN = 24
#: One in so many words is a target in a round; a round for each offset, so that every word is one.
STRIDE = 2
ROUNDS = STRIDE
BATCH = 1024
RATE = 0.1
#: Words taken at once when scoring; of these, so many go through the network together.
AT_ONCE = 1 << 15
IN_CACHE = 1 << 12
#: Words that a task gathers before it counts them and passes the counts on.
COUNTED = 1 << 21
#: Infrequent words whose counts every task holds; the counts of all others are joined.
OFTEN = 1 << 17
#: Bytes of texts split at once, or one text.
SPLIT_BYTES = 4 << 20

PAD = WORDS
#: Where the table of each place of the window starts in all of them.
OFFSETS = np.arange(2 * REACH) * (WORDS + 1)


@dataclass
class Network:
    """``near``: shares of the hidden layer by place and word; then class and word layers."""

    near: np.ndarray
    base: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        """Small random shares; the output starts at the words' frequencies."""
        rng = np.random.default_rng(7)
        share = (counts + 1.0).reshape(CLASSES, PER_CLASS)
        of_class = share.sum(axis=1)
        return cls(
            (rng.standard_normal((2 * REACH, WORDS + 1, HIDDEN)) * 0.1).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            np.zeros((HIDDEN, CLASSES), np.float32),
            np.log(of_class / of_class.sum()).astype(np.float32),
            np.zeros((CLASSES, HIDDEN, PER_CLASS), np.float32),
            np.log(share / of_class[:, None]).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.near, self.base, self.to_class, self.class_bias, self.to_word, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*out)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        rows = self.near.reshape(-1, HIDDEN)
        total = rows.take(around[:, 0], axis=0)
        for k in range(1, 2 * REACH):
            total += rows.take(around[:, k] + OFFSETS[k], axis=0)
        total += self.base
        return np.tanh(total, out=total)

    def in_class(self, h: np.ndarray, kind: np.ndarray, runs: list[tuple[int, slice]]) -> np.ndarray:
        """What the word layer gives for the words of each row's class, a column for each row."""
        out = np.empty((PER_CLASS, len(h)), np.float32)
        for c, cut in runs:
            np.matmul(self.to_word[c].T, h[cut].T, out=out[:, cut])
        out += self.word_bias[kind].T
        return out

    def log_probabilities(self, words: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Of each word given its neighbours."""
        out = np.empty(len(words), np.float32)
        for at in range(0, len(words), IN_CACHE):
            cut = slice(at, at + IN_CACHE)
            order = np.argsort(words[cut], kind="stable")  # words of a class together
            h = self.hidden(around[cut].take(order, axis=0))
            kind, inner = np.divmod(words[cut][order], PER_CLASS)
            logs = _picked(self.to_class.T @ h.T + self.class_bias[:, None], kind)
            logs += _picked(self.in_class(h, kind, _runs(kind)), inner)
            out[at + order] = logs
        return out

    def step(self, words: np.ndarray, around: np.ndarray, seen: list[np.ndarray]) -> None:
        """One batch of gradient ascent on the log-probabilities; ``seen`` has the squares summed so far."""
        n = len(words)
        order = np.argsort(words, kind="stable")  # words of a class together
        words, around = words[order], around.take(order, axis=0)
        h = self.hidden(around)
        kind, inner = np.divmod(words, PER_CLASS)
        up_class = _errors(self.to_class.T @ h.T + self.class_bias[:, None])
        up_class[kind, np.arange(n)] += 1
        up_h = up_class.T @ self.to_class.T
        runs = _runs(kind)
        up = _errors(self.in_class(h, kind, runs))
        up[inner, np.arange(n)] += 1
        to_word, word_bias = np.zeros((CLASSES, PER_CLASS, HIDDEN), np.float32), np.zeros_like(self.word_bias)
        back, down = self.to_word.transpose(0, 2, 1).copy(), np.empty_like(h)
        for c, cut in runs:
            some = up[:, cut]
            np.matmul(some, h[cut], out=to_word[c])
            np.matmul(some.T, back[c], out=down[cut])
        up_h += down
        word_bias[[c for c, _ in runs]] = np.add.reduceat(up, [cut.start for _, cut in runs], axis=1).T
        up_in = up_h * (1 - h * h)
        slopes = [up_in.sum(axis=0), (up_class @ h).T, up_class.sum(axis=1), to_word.transpose(0, 2, 1).copy(), word_bias]
        for part, slope, squares in zip(self.parts()[1:], slopes, seen[1:], strict=True):
            _climb(part, slope, squares, n)
        # rows of words that are nobody's neighbour here have no slope and stay as they are
        rows = (around + OFFSETS).T.ravel()
        here = np.zeros(2 * REACH * (WORDS + 1), bool)
        here[rows] = True
        hit = np.flatnonzero(here)
        number = (np.cumsum(here) - 1)[rows]
        near, column = np.empty((HIDDEN, len(hit))), np.empty((2 * REACH, n))
        for k in range(HIDDEN):
            column[:] = up_in[:, k]
            near[k] = np.bincount(number, column.ravel(), len(hit))
        every, every_seen = self.near.reshape(-1, HIDDEN), seen[0].reshape(-1, HIDDEN)
        part, squares = every.take(hit, axis=0), every_seen.take(hit, axis=0)
        _climb(part, near.T.copy(), squares, n)
        every[hit], every_seen[hit] = part, squares


def _climb(part: np.ndarray, slope: np.ndarray, squares: np.ndarray, n: int) -> None:
    slope = (slope / n).astype(np.float32)
    squares += slope * slope
    scale = np.sqrt(squares)
    scale += 1e-6
    slope *= RATE
    slope /= scale
    part += slope


def _runs(kind: np.ndarray) -> list[tuple[int, slice]]:
    """The classes in the ascending ``kind``, each with its rows."""
    stops = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    return [(c, slice(low, high)) for c, (low, high) in enumerate(zip(stops, stops[1:], strict=False)) if low < high]


def _errors(x: np.ndarray) -> np.ndarray:
    """Softmax of each column with the sign changed; ``x`` is overwritten."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= -x.sum(axis=0)
    return x


def _picked(x: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Log-softmax of ``x`` at one place of each column; ``x`` is overwritten."""
    x -= x.max(axis=0)
    at = x[which, np.arange(x.shape[1])]
    np.exp(x, out=x)
    return at - np.log(x.sum(axis=0))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\x20\x09-\x0D]+`` of ``texts`` one after the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    words, owners = pc.list_flatten(lists), pc.list_parent_indices(lists)
    found = pc.greater(pc.binary_length(words), 0)  # spaces at the ends of a text leave empty strings
    return words.filter(found), np.bincount(owners.filter(found).to_numpy(), minlength=len(texts))


def parts_of(batch: pa.RecordBatch, texts: str = "text") -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of up to about ``SPLIT_BYTES`` of texts."""
    sizes = pc.binary_length(batch[texts]).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // SPLIT_BYTES
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for low, high in zip(edges, edges[1:], strict=False):
        yield batch.slice(low, high - low)


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word occurs in the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            counts = pc.value_counts(pa.chunked_array(held, pa.string()))
            return pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])

        held: list[pa.Array] = []
        for batch in batches:
            for part in parts_of(batch):
                held.append(split_words(part["text"])[0].cast(pa.string()))
                if sum(map(len, held)) >= COUNTED:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Places(dict):
    """Place of each frequent word in the vocabulary; for others a hash from ``WORDS`` on, as ``hash_of`` gives it."""

    def __missing__(self, word: str) -> int:
        return xxh64_intdigest(word, 42) | WORDS


def hash_of(word: str) -> Column:
    return F.xxhash64(word).bitwiseOR(F.lit(WORDS))


def places_of(texts: pa.Array, place: Callable[[str], int]) -> list[np.ndarray]:
    """What ``place`` gives for the words of each text; it is asked once for each word of ``texts``."""
    words, lengths = split_words(texts)
    coded = words.dictionary_encode()
    numbers = np.fromiter(map(place, coded.dictionary.to_numpy(zero_copy_only=False)), "<u8", len(coded.dictionary))[coded.indices.to_numpy()]
    ends = np.cumsum(lengths)
    return [numbers[end - n : end] for end, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


def numbered_words(docs: DataFrame, places: Places) -> DataFrame:
    """``doc_id``, a number of the row, the words of every text as 16-bit numbers, and its infrequent ones.

    ``rare`` has the 64-bit hashes of the words without a place of their own, ``times`` how often each is there.
    """
    shared = docs.sparkSession.sparkContext.broadcast(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.__getitem__
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in parts_of(batch):
                rows, rare, times = [], [], []
                for numbers in places_of(part["text"], place):
                    others = numbers >= WORDS
                    hashes, often = np.unique(numbers[others], return_counts=True)
                    numbers[others] = KNOWN + numbers[others] % SHARED
                    rows.append(numbers.astype("<u2").tobytes())
                    rare.append(hashes.tobytes())
                    times.append(often.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(np.arange(row, row + len(rows))), *[pa.array(x, pa.binary()) for x in (rows, rare, times)]],
                    names=["doc_id", "row", "words", "rare", "times"],
                )
                row += len(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, row long, words binary, rare binary, times binary"
    )


def windows(words: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """The neighbours of the words at ``targets``, left to right; ``words`` has pads at both ends."""
    offsets = [o for o in range(-REACH, REACH + 1) if o]
    return np.stack([words[targets + o] for o in offsets], axis=1)


def padded(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with pads between documents; the place of each word, and its document's number."""
    pad = np.full(REACH, PAD, np.int64)
    pieces, places, owners, at = [pad], [], [], REACH
    for number, words in enumerate(arrays):
        pieces += [words.astype(np.int64), pad]
        places.append(np.arange(at, at + len(words)))
        owners.append(np.full(len(words), number))
        at += len(words) + REACH
    empty = np.empty(0, np.int64)
    return np.concatenate(pieces), np.concatenate([empty, *places]), np.concatenate([empty, *owners])


def trained_parts(words: DataFrame, network: Network, turn: int) -> DataFrame:
    """Parameters of all tasks added up, each times the words it has seen; under ``at`` -1 those words."""
    shared = words.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.filled(shared.value.flat())
        seen = [np.zeros_like(p) for p in own.parts()]
        total, held, targets, around = 0, 0, [], []
        for batch in batches:
            for value in batch.column(0):
                ids = np.frombuffer(value.as_buffer(), "<u2")
                # which words are targets follows from the document alone
                first = (turn + int(ids[:16].sum())) % STRIDE
                if len(ids) <= first:
                    continue
                line = np.concatenate([np.full(REACH, PAD), ids, np.full(REACH, PAD)]).astype(np.int64)
                places = np.arange(first + REACH, len(ids) + REACH, STRIDE)
                targets.append(line[places])
                around.append(windows(line, places))
                held += len(places)
                if held >= BATCH:
                    total += _train(own, seen, targets, around)
                    held, targets, around = 0, [], []
        if held:
            total += _train(own, seen, targets, around)
        if total:
            values = np.append(own.flat().astype(np.float64) * total, total)
            places = np.append(np.arange(len(values) - 1), -1)
            for at in range(0, len(values), 1 << 16):
                cut = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places[cut], pa.int32()), pa.array(values[cut], pa.float64())], names=["at", "value"]
                )

    return words.select("words").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))


def _train(network: Network, seen: list[np.ndarray], targets: list[np.ndarray], around: list[np.ndarray]) -> int:
    words, near = np.concatenate(targets), np.concatenate(around)
    for at in range(0, len(words), BATCH):
        network.step(words[at : at + BATCH], near[at : at + BATCH], seen)
    return len(words)


def prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Counts of all words, the numbered words of all documents, and how often each place of the vocabulary occurs."""
    counts = materialise(word_counts(docs), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(KNOWN).collect()
    places = Places((row["word"], i) for i, row in enumerate(top))
    words = materialise(numbered_words(docs, places), "numbered-words")
    frequency = np.zeros(WORDS)
    for i, row in enumerate(top):
        frequency[i] = row["n"]
    of_place = counts.groupBy(F.pmod(hash_of("word"), F.lit(SHARED)).alias("place")).agg(F.sum("n").alias("n"))
    for row in of_place.collect():
        frequency[KNOWN + row["place"]] = row["n"]
    for row in top:
        frequency[KNOWN + Places().__missing__(row["word"]) % SHARED] -= row["n"]
    return counts, words, frequency


def trained(words: DataFrame, frequency: np.ndarray) -> Network:
    network = Network.start(frequency)
    for turn in range(ROUNDS):
        summed = trained_parts(words, network, turn).toArrow()
        at, value = summed["at"].to_numpy(), summed["value"].to_numpy()
        if not len(at):
            break
        flat = np.zeros(len(at) - 1)
        flat[at[at >= 0]] = value[at >= 0] / value[at < 0][0]
        network = network.filled(flat)
    return network


def train(docs: DataFrame) -> tuple[Network, DataFrame]:
    """The network, and the numbered words of all documents as written for it."""
    _, words, frequency = prepared(docs)
    return trained(words, frequency), words


@dataclass
class Often:
    """The most frequent of the words, as ascending hashes with the logarithms of their counts."""

    hashes: np.ndarray
    logs: np.ndarray
    #: Logarithms of the totals of the shared places.
    totals: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, frequency: np.ndarray) -> Often:
        top = counts.orderBy(F.desc("n"), "word").limit(OFTEN).select(hash_of("word").alias("hash")).distinct()
        # words that share a hash with one of them belong to its count
        found = counts.select(hash_of("word").alias("hash"), "n").join(F.broadcast(top), "hash").groupBy("hash").agg(F.sum("n").alias("n")).toArrow()
        hashes = found["hash"].to_numpy()
        order = np.argsort(hashes)
        return cls(hashes[order], np.log(found["n"].to_numpy()[order]), np.log(frequency[KNOWN:] + 1))

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are here, and where these are."""
        at = np.searchsorted(self.hashes, hashes)
        here = at < len(self.hashes)
        here[here] = self.hashes[at[here]] == hashes[here]
        return here, at[here]

    def sums(self, rare: list[np.ndarray], times: list[np.ndarray]) -> np.ndarray:
        """Of each array of hashes, the summed logarithms of the shares of those that are here."""
        hashes = np.concatenate(rare)
        here, at = self.places(hashes)
        owners = np.repeat(np.arange(len(rare)), [len(r) for r in rare])[here]
        shares = self.logs[at] - self.totals[hashes[here] % SHARED]
        return np.bincount(owners, np.concatenate(times)[here] * shares, len(rare))


def shares(words: DataFrame, counts: DataFrame, often: Often) -> DataFrame:
    """``row`` and the summed logarithms of the shares of its infrequent words that ``often`` lacks."""
    totals = F.array(*[F.lit(float(n)) for n in often.totals])
    shared = words.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                part = batch.slice(low, 100)
                rare = [np.frombuffer(r.as_buffer(), "<i8") for r in part.column(1)]
                times = [np.frombuffer(t.as_buffer(), "<u4") for t in part.column(2)]
                rows = np.repeat(part.column(0).to_numpy(), [len(r) for r in rare])
                hashes = np.concatenate(rare)
                left = ~shared.value.places(hashes)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[left]), pa.array(hashes[left]), pa.array(np.concatenate(times)[left].astype(np.int32))],
                    names=["row", "hash", "times"],
                )

    pairs = words.select("row", "rare", "times").mapInArrow(run, "row long, hash long, times int")
    counted = counts.groupBy(hash_of("word").alias("hash")).agg(F.sum("n").alias("n"))
    share = F.log(F.coalesce("n", F.lit(1))) - F.element_at(totals, (F.pmod("hash", F.lit(SHARED)) + 1).cast("int"))
    return pairs.join(counted, "hash", "left").groupBy("row").agg(F.sum(F.col("times") * share).alias("share"))


def score(words: DataFrame, network: Network, *more: str, often: Often | None = None) -> DataFrame:
    """``doc_id``, the columns ``more``, number of words, summed and mean log-probability of every document's places in the vocabulary.

    With ``often``, the shares of its words are added.
    """
    shared = words.sparkSession.sparkContext.broadcast((network, often))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value
        for batch in batches:
            arrays = [np.frombuffer(w.as_buffer(), "<u2") for w in batch.column(0)]
            sums = np.zeros(len(arrays))
            start = 0
            while start < len(arrays):
                stop, held = start, 0
                while stop < len(arrays) and held < AT_ONCE:
                    held += len(arrays[stop])
                    stop += 1
                line, places, owners = padded(arrays[start:stop])
                for at in range(0, len(places), AT_ONCE):
                    cut = places[at : at + AT_ONCE]
                    logs = own.log_probabilities(line[cut], windows(line, cut))
                    sums[start:stop] += np.bincount(owners[at : at + AT_ONCE], logs.astype(np.float64), stop - start)
                start = stop
            if known:
                for at in range(0, len(arrays), 100):
                    rare, times = (
                        [np.frombuffer(x.as_buffer(), kind) for x in batch[c].slice(at, 100)]
                        for c, kind in (("rare", "<i8"), ("times", "<u4"))
                    )
                    sums[at : at + 100] += known.sums(rare, times)
            lengths = [len(a) for a in arrays]
            means = [s / n if n else None for s, n in zip(sums.tolist(), lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1 : 2 + len(more)], pa.array(lengths, pa.int64()), pa.array(sums, pa.float64()), pa.array(means, pa.float64())],
                names=["doc_id", *more, "n_words", "score", "mean_score"],
            )

    schema = "".join(f"{c} long, " for c in ("doc_id", *more)) + "n_words long, score double, mean_score double"
    return words.select("words", "doc_id", *more, *(["rare", "times"] if often else [])).mapInArrow(run, schema)


def word_scores(words: DataFrame, network: Network, counts: DataFrame, frequency: np.ndarray) -> DataFrame:
    """``doc_id``, number of words, summed and mean log-probability of every document's words."""
    total = F.col("score") + F.coalesce("share", F.lit(0.0))
    often = Often.of(counts, frequency)
    return score(words, network, "row", often=often).join(shares(words, counts, often), "row", "left").select(
        "doc_id", "n_words", total.alias("score"), F.try_divide(total, F.col("n_words")).alias("mean_score")
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-log-likelihood of every document."""
    counts, words, frequency = prepared(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return word_scores(words, trained(words, frequency), counts, frequency)
