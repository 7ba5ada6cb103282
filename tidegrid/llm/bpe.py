"""Byte-level BPE: encoding and decoding whole texts by a published rank file.

Each match of the pattern is merged on its own. A rank queue holds the adjacent pairs that can
still merge: one bucket of positions per rank, and over the buckets a bitmap of two levels, in
which find-first-set gives the lowest rank in a fixed number of steps however many pairs wait.
Positions form a linked list. A merge changes at most two pairs; what it makes stale stays in its
bucket and is skipped when its turn comes, so a match of n bytes takes O(n) queue operations plus
the ordering of equal ranks. That suits matches of any length.

Lower ranks merge first, equal ranks from left to right, and a match that is a token itself is
taken whole, as the published library does.

Defined results: null and empty texts have no ids; texts of any length are taken whole; repeated
rows are encoded alike; an empty table gives an empty result; columns of any other name are kept
by ``encode_column``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegrid.llm.common import fresh, table

#: Matches kept with their ids in each Python worker, from one task to the next.
CACHE_SIZE = 600_000
#: Longer matches are not kept, so the store stays below 225 MB.
CACHE_LENGTH = 40
#: What the classes of the pattern hold up to U+00FF, for use within a class.
LATIN = {
    r"\p{L}": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff",
    r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe",
    r"\s": "\t-\r \x85\xa0",
    r"\S": "^\t-\r \x85\xa0",
}

#: Letters and numbers of Unicode versions after 16, which the published library does
#: not know as such yet; the pattern takes them for other characters.
NEWER = (
    "558-558 58B-58C 88F-88F C5C-C5C CDC-CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD"
    " A7E2-A7E2 A7F1-A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB"
    " 11DE0-11DE9 11DF1-11DF1 1246F-1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6"
    " 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168"
    " 1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5"
    " 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NEWER_SET = "[" + "".join("-".join(f"\\U{int(x, 16):08x}" for x in r.split("-")) for r in NEWER.split()) + "]"


class Known(dict):
    """The ids of each match met lately, as little-endian unsigned 32-bit integers.

    When it has ``CACHE_SIZE`` / 2 matches they are put aside; those met again come back, the others go with the next time.
    """

    def __init__(self, merge):
        super().__init__()
        self.merge = merge
        self.aside: dict[str, bytes] = {}

    def __missing__(self, match: str) -> bytes:
        ids = self.aside.get(match)
        if ids is None:
            ids = np.array(self.merge(match.encode("utf-8")), "<u4").tobytes()
        if len(match) <= CACHE_LENGTH:
            if len(self) >= CACHE_SIZE // 2:
                self.aside = self.copy()
                self.clear()
            self[match] = ids
        return ids


def latin_pattern(pattern: str) -> str:
    """``pattern`` with its classes spelled out for characters up to U+00FF."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        name = next((c for c in LATIN if pattern.startswith(c, i)), None)
        if name:
            out.append(LATIN[name] if inside else f"[{LATIN[name]}]")
            i += len(name)
            continue
        step = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
        inside = (inside or step == "[") and step != "]"
        out.append(step)
        i += len(step)
    return "".join(out)


class BytePairs:
    """A rank file and the pattern that splits text before merging."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        size = max(ranks.values(), default=-1) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.low = [0] * ((size >> 8) + 1)
        self.known = Known(self.merge)
        self.matches = regex.compile(pattern).findall
        self.newer = regex.compile(NEWER_SET).search
        strict = pattern
        for known in (r"\p{L}", r"\p{N}"):
            strict = strict.replace(known, f"[{known}--{NEWER_SET}]")
        self.strict = regex.compile("(?V1)" + strict).findall
        #: the same pattern for texts without characters above U+00FF, which most are
        self.latin = re.compile(latin_pattern(pattern)).findall

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, with the classes of characters the library knows."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return (self.strict if self.newer(text) else self.matches)(text)
        return self.latin(text)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one match.

        The queue is spelled out here, as calls would cost more than its steps: ``buckets`` has the
        positions waiting at a rank, ``low`` a bit for each rank with a bucket, ``top`` one for each
        word of ``low`` that is not zero. The lowest set bit of ``top`` names the word, the lowest
        of that word the rank. All words are zero again at the end.
        """
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))  # where the part that starts here ends, 0 if none starts here
        before = list(range(-1, n))  # where the part starts that ends here
        # rank of the part that starts here joined to the next, -1 if none
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        low, top = self.low, 0
        buckets: dict[int, list[int]] = {}
        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    low[rank >> 8] |= 1 << (rank & 255)
                    top |= 1 << (rank >> 8)
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            bit = bits & -bits
            rank = (word << 8) + bit.bit_length() - 1
            low[word] = bits = bits ^ bit
            if not bits:
                top ^= 1 << word
            positions = buckets.pop(rank)
            if len(positions) > 1:
                positions.sort()
            for i in positions:
                if pair[i] != rank:
                    continue  # stale
                j = end[i]
                stop = end[i] = end[j]
                end[j], pair[j] = 0, -1
                before[stop] = i
                if stop < n:
                    joined = pair[i] = rank_of(piece[i : end[stop]], -1)
                    if joined >= 0:
                        if joined in buckets:
                            buckets[joined].append(i)
                        else:
                            buckets[joined] = [i]
                            low[joined >> 8] |= 1 << (joined & 255)
                            top |= 1 << (joined >> 8)
                else:
                    pair[i] = -1
                if i:
                    h = before[i]
                    joined = pair[h] = rank_of(piece[h:stop], -1)
                    if joined >= 0:
                        if joined in buckets:
                            buckets[joined].append(h)
                        else:
                            buckets[joined] = [h]
                            low[joined >> 8] |= 1 << (joined & 255)
                            top |= 1 << (joined >> 8)
        return [rank_of(piece[i:stop]) for i, stop in enumerate(end) if stop]

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.split(text or "")))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids; an id outside the file is an error."""
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> BytePairs:
    """The rank file at ``path``, once for each Python process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return BytePairs(ranks, pattern)


def encode_column(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    ``with_ids`` adds ``ids``. Names that ``docs`` has already get underscores. The rank file lies
    at ``path`` on every executor. Texts are encoded one at a time, so beside the batch a task
    holds the ids of one text.
    """
    kept = docs.columns if keep is None else keep
    names = [fresh(kept, n) for n in ("n_tokens", "ids_sha256", "decoded_sha256", "ids")]
    fields = [
        T.StructField(names[0], T.LongType(), False),
        T.StructField(names[1], T.StringType(), False),
        T.StructField(names[2], T.StringType(), False),
    ]
    if with_ids:
        fields.append(T.StructField(names[3], T.ArrayType(T.IntegerType(), False), False))
    hidden = fresh(kept, "_text")
    given = docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"].alias(hidden))
    schema = T.StructType([f for f in given.schema.fields if f.name != hidden] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, pattern)
        for batch in batches:
            counts, digests, decoded, all_ids = [], [], [], []
            for value in batch.column(hidden):
                packed = model.encode_bytes(value.as_py())
                ids = np.frombuffer(packed, "<u4")
                counts.append(len(ids))
                digests.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(model.decode(ids.tolist())).hexdigest())
                if with_ids:
                    all_ids.append(pa.array(ids.astype("int32"), pa.int32()))
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                ends = np.cumsum([0, *map(len, all_ids)], dtype="int32")
                flat = pa.concat_arrays(all_ids) if all_ids else pa.array([], pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(run, schema)


def multilingual() -> tuple[str, str]:
    """Place and pattern of the installed public rank file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every document."""
    path, pattern = multilingual()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_column(docs, path, pattern, keep=["doc_id"], with_ids=False)
