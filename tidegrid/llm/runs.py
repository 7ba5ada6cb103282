"""Periodic runs of words: stretches that repeat one group of words at least four times.

A run is a maximal stretch of words with smallest period q and at least ``max(MIN_LENGTH, MIN_REPEATS * q)``
words. Every run holds Lyndon words as long as its period (its Lyndon roots), and each of those, unless
it starts where the run starts, is the longest Lyndon word at its place under one of two opposite
orders of the words. So:

1. Ukkonen's suffix trees are built of the words and of the words reversed.
2. Walking the tree with children in either order ranks the suffixes; the next suffix that ranks lower
   ends the longest Lyndon word at each place, which makes at most two candidates a place.
3. An Euler tour of each tree gives longest common extensions as least depths between two leaves, in
   constant time; each candidate is extended to both sides by one such look-up and kept if long enough.

Every word of a run occurs ``MIN_REPEATS`` times in it. So words that occur less often in a stretch
cannot be in a run of it, and cut it into pieces that are looked at on their own, until each
word of a piece occurs often enough in that piece; a run never crosses such a cut, and the word beside it
never prolongs one. Only those pieces get trees, which leaves little of ordinary text.

Defined results: null and empty texts have no words and no runs; texts are taken whole, whatever their
length, by one task each in memory linear in their words; repeated rows give repeated results; an empty
table gives an empty one; columns whose names clash with the results keep theirs and the results get underscores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.common import fresh, table

#: Least number of words of a run.
MIN_LENGTH = 6
#: Least number of times that the period goes into a run.
MIN_REPEATS = 4
#: Places of an Euler tour that share a cell of the sparse table.
BLOCK = 32


class SuffixTree:
    """Ukkonen's tree of ``word`` (small numbers), which must end with a number that it has nowhere else."""

    def __init__(self, word: list[int]):
        size = len(word)
        self.word = word
        #: an edge into a node has the letters start[node] .. stop[node]; leaves end with the word
        self.start, self.stop, self.link = [-1], [-1], [0]
        self.children: list[dict[int, int] | None] = [{}]
        start, stop, link, children = self.start, self.stop, self.link, self.children
        node, edge, depth, pending = 0, 0, 0, 0
        for i, letter in enumerate(word):
            pending += 1
            last = 0  # the inner node that still lacks its suffix link
            while pending:
                if depth == 0:
                    edge = i
                below = children[node]
                child = below.get(word[edge])
                if child is None:
                    below[word[edge]] = len(start)
                    start.append(i), stop.append(size), link.append(0), children.append(None)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    length = (stop[child] if stop[child] < i + 1 else i + 1) - start[child]
                    if depth >= length:
                        edge += length
                        depth -= length
                        node = child
                        continue
                    if word[start[child] + depth] == letter:
                        depth += 1
                        if last and node:
                            link[last] = node
                        break
                    split = len(start)
                    start.append(start[child]), stop.append(start[child] + depth), link.append(0)
                    leaf = split + 1
                    start.append(i), stop.append(size), link.append(0)
                    start[child] += depth
                    children.append({letter: leaf, word[start[child]]: child})
                    children.append(None)
                    below[word[edge]] = split
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if node == 0 and depth:
                    depth -= 1
                    edge = i - pending + 1
                elif node:
                    node = link[node]

    def tour(self) -> tuple[list[int], list[int], list[int]]:
        """Depths in letters along the Euler tour, the place of each suffix in it, and suffixes in order."""
        start, stop, children = self.start, self.stop, self.children
        size = len(self.word)
        depths, place, order = [], [0] * size, []
        deep = [0] * len(start)
        todo = [0]
        while todo:
            node = todo.pop()
            if node < 0:
                depths.append(deep[~node])
                continue
            here = deep[node]
            below = children[node]
            if below is None:
                place[size - here] = len(depths)
                order.append(size - here)
            else:
                back = ~node
                for letter in sorted(below, reverse=True):
                    child = below[letter]
                    deep[child] = here + stop[child] - start[child]
                    todo.append(back)
                    todo.append(child)
            depths.append(here)
        return depths, place, order

    def opposite(self) -> list[int]:
        """Suffixes under the opposite order of letters, where the end of the word still comes first."""
        start, stop, children = self.start, self.stop, self.children
        size = len(self.word)
        end = self.word[-1]
        order, todo, depth = [], [0], [0]
        while todo:
            node, here = todo.pop(), depth.pop()
            below = children[node]
            if below is None:
                order.append(size - here)
                continue
            for letter in sorted(below):
                if letter != end:
                    child = below[letter]
                    todo.append(child)
                    depth.append(here + stop[child] - start[child])
            if end in below:
                child = below[end]
                todo.append(child)
                depth.append(here + stop[child] - start[child])
        return order


class Extensions:
    """Longest common extensions of pairs of places, from the Euler tour of a suffix tree."""

    def __init__(self, depths: list[int], place: list[int]):
        tour = np.array(depths, np.int32)
        rows = -(-len(tour) // BLOCK)
        padded = np.full(rows * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(tour)] = tour
        grid = padded.reshape(rows, BLOCK)
        self.tour, self.place = padded, np.array(place, np.int64)
        self.to_left = np.minimum.accumulate(grid, 1).ravel()
        self.to_right = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
        self.levels = [grid.min(1)]
        while 2 << (len(self.levels) - 1) <= rows:
            level, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(level[:-step], level[step:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal letters onward from each pair of different places."""
        x, y = self.place[a], self.place[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        first, last = x // BLOCK, y // BLOCK
        least = np.minimum(self.to_right[x], self.to_left[y])
        near = np.flatnonzero(first == last)
        if len(near):
            spot, stop = x[near], y[near]
            low = self.tour[spot]
            for _ in range(BLOCK - 1):
                spot = np.minimum(spot + 1, stop)
                low = np.minimum(low, self.tour[spot])
            least[near] = low
        far = np.flatnonzero(last - first > 1)
        if len(far):
            left, count = first[far] + 1, last[far] - first[far] - 1
            level = np.frexp(count.astype(np.float64))[1] - 1
            low = least[far]
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                cells = self.levels[k]
                low[at] = np.minimum(low[at], np.minimum(
                    cells[left[at]], cells[left[at] + count[at] - (1 << int(k))]))
            least[far] = low
        return least


def next_lower(order: list[int]) -> list[int]:
    """For each suffix the next one to the right that comes earlier in ``order``; the word's size if none."""
    size = len(order)
    rank = [0] * size
    for r, suffix in enumerate(order):
        rank[suffix] = r
    after, waiting = [size] * size, []
    for i, r in enumerate(rank):
        while waiting and rank[waiting[-1]] > r:
            after[waiting.pop()] = i
        waiting.append(i)
    return after


def runs_of_letters(letters: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``letters`` (numbers from 1), by start and period."""
    size = len(letters)
    if size < MIN_LENGTH:
        return []
    forward = SuffixTree([*letters, 0])
    depths, place, order = forward.tour()
    begin = np.arange(size, dtype=np.int64)
    word = np.array([*letters, 0], np.int64)
    roots = []
    for ranked in (order, forward.opposite()):
        end = np.array(next_lower(ranked), np.int64)[:size]
        # in a run another copy of the root follows, so the same word stands at its end
        held = (end < size) & (word[np.minimum(end, size)] == word[begin])
        roots.append(np.stack([begin[held], end[held]]))
    first, second = np.unique(np.concatenate(roots, 1), axis=1)
    if not len(first):
        return []
    onward = Extensions(depths, place).of(first, second)
    period = second - first
    # four periods have three roots behind one another: the first of them goes on for two periods at least
    long = np.flatnonzero(onward >= (MIN_REPEATS - 2) * period)
    if not len(long):
        return []
    first, second, period, onward = first[long], second[long], period[long], onward[long]
    depths, place, _ = SuffixTree([*letters[::-1], 0]).tour()
    # the suffix of the reversal that starts at place size - i has the letters before i, backwards
    backward = Extensions(depths, place).of(size - first, size - second)
    start = first - backward
    length = second + onward - start
    found = np.unique(np.stack([start, period, length])[:, (
        length >= np.maximum(MIN_LENGTH, MIN_REPEATS * period))], axis=1)
    return [(int(s), int(n), int(q)) for s, q, n in found.T]


def pieces_of(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches that may hold runs: each word of one occurs ``MIN_REPEATS`` times in it."""
    todo = [(0, len(codes))]
    while todo:
        low, high = todo.pop()
        part = codes[low:high]
        _, place, count = np.unique(part, return_inverse=True, return_counts=True)
        often = count[place] >= MIN_REPEATS
        if often.all():
            yield low, high
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]).astype(np.int8)))
        for a, b in edge.reshape(-1, 2):
            if b - a >= MIN_LENGTH:
                todo.append((low + int(a), low + int(b)))


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start and period."""
    counts = Counter(words)
    code = {w: i for i, (w, n) in enumerate(counts.items(), 1) if n >= MIN_REPEATS}
    if not code:
        return []
    codes = np.array([code.get(w, 0) for w in words], np.int64)
    found = []
    edge = np.flatnonzero(np.diff(np.concatenate([[False], codes > 0, [False]]).astype(np.int8))).reshape(-1, 2)
    for a, b in edge[edge[:, 1] - edge[:, 0] >= MIN_LENGTH]:
        for low, high in pieces_of(codes[a:b]):
            _, letters = np.unique(codes[a + low : a + high], return_inverse=True)
            offset = int(a) + low
            found += [(s + offset, n, q) for s, n, q in runs_of_letters((letters + 1).tolist())]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are in no run, or among the first period of each run they are in, joined by spaces."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept))


def mark_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists (start, length, period) in words, by start and period; ``collapsed`` is the text
    with one period left of each run, its words joined by spaces. Names that ``docs`` has get underscores.
    """
    kept = docs.columns if keep is None else keep
    names = [fresh(kept, n) for n in ("n_words", "runs", "collapsed")]
    hidden = fresh([*kept, *names], "_text")
    given = docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"].alias(hidden))
    run_type = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
    schema = T.StructType([f for f in given.schema.fields if f.name != hidden] + [
        T.StructField(names[0], T.LongType(), False),
        T.StructField(names[1], T.ArrayType(run_type, False), False),
        T.StructField(names[2], T.StringType(), False),
    ])
    arrow_runs = pa.list_(pa.field("element", pa.struct(
        [pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, collapsed = [], [], []
            for value in batch.column(hidden):
                words = (value.as_py() or "").encode("utf-8").split()  # bytes split at x20, x09 to x0D only
                runs = find_runs(words)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                collapsed.append(collapse(words, runs).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(counts, pa.int64()),
                 pa.array(found, arrow_runs), pa.array(collapsed, pa.string())], names=schema.names)

    return given.mapInArrow(run, schema)


#: The text of a document whose words from ``a`` on become a period of ``p`` words over and over.
#: Documents are chosen, and ``a`` and ``p`` set, by the id; a null id is not chosen.
PLANTED = """
CASE WHEN crc32(CAST(doc_id AS STRING)) % 10 = 0 THEN (
  transform(
    array(named_struct('w', filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> ''),
                       'g', crc32(CAST(doc_id AS STRING)) div 10)),
    t -> transform(
      array(named_struct('w', t.w, 'a', CAST(t.g % greatest(size(t.w), 1) AS INT),
                         'd', CAST(3 + t.g % 8 AS INT))),
      u -> array_join(transform(u.w, (x, i) -> CASE WHEN i < u.a THEN x
        ELSE u.w[u.a + (i - u.a) % (1 + (size(u.w) - u.a) div u.d)] END), ' '))[0])[0])
ELSE text END
"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which get a repeated stretch: the strongest one and digests of all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(PLANTED).alias("text"))
    marked = mark_runs(docs, keep=["doc_id"])
    best = F.expr("""
        aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
          (b, r) -> CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)""")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return marked.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
