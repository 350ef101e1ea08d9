"""Encoding of texts with a public byte-level BPE tokenizer.

A text is split by the tokenizer's pattern; each piece starts as single bytes
in a doubly linked list, and a priority queue holds the ranks of neighbouring
pairs.  The pair of the lowest rank (the leftmost of equal ones) is merged; an
entry whose pair has meanwhile changed is stale and skipped.  Decoding
concatenates the strings of the vocabulary.

Scale: texts are encoded where they lie, in Arrow batches, without a shuffle.
The vocabulary is a file of a fixed size; it is read once on the driver and
sent to the executors once.  A piece of n bytes takes O(n log n), however long
it is; frequent pieces are kept in a bounded table of each Python worker.

Defined results: null and empty texts have an empty list; blank texts are
encoded as written; strings of special tokens are ordinary text; repeated
texts have equal lists.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import spread

#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces kept by each worker; each is at most this many characters long.
KEPT_PIECES, KEPT_CHARS = 200_000, 24


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line for each, the bytes in base 64 and the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class ByteBpe:
    """An encoder and decoder for one set of ranks; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, pattern
        self.words = {v: k for k, v in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.kept: dict[str, list[int]] = {}
        # ids of the single bytes, and of joined pairs of ids, so that merging works on numbers
        self.bytes = [ranks.get(bytes([b])) for b in range(256)]
        self.pairs: dict[tuple[int, int], int | None] = {}

    def __reduce__(self):
        return ByteBpe, (self.ranks, self.pattern)

    def _pair(self, a: int, b: int) -> int | None:
        key = (a, b)
        found = self.pairs.get(key, -1)
        if found == -1:
            found = self.ranks.get(self.words[a] + self.words[b])
            if len(self.pairs) < 4 * KEPT_PIECES:
                self.pairs[key] = found
        return found

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids = [self.bytes[b] for b in piece]
        n = len(ids)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pair = self._pair
        queue = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pair(ids[i], ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pair(rank, ids[k])) is not None:
                    heapq.heappush(queue, (r, i, rank, ids[k]))
            h = before[i]
            if h >= 0 and (r := pair(ids[h], rank)) is not None:
                heapq.heappush(queue, (r, h, ids[h], rank))
        return [x for x in ids if x >= 0]

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        kept = self.kept
        for piece in self.split(text or ""):
            ids = kept.get(piece)
            if ids is None:
                ids = self.merge(piece.encode("utf-8", "replace"))
                if len(piece) <= KEPT_CHARS and len(kept) < KEPT_PIECES:
                    kept[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.words[int(i)] for i in ids).decode("utf-8", "replace")


def token_ids(spark: SparkSession, text: Column | str, ranks_path: str, pattern: str = PATTERN) -> Column:
    """The ids of a text column as array<int>."""
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    @F.pandas_udf(T.ArrayType(T.IntegerType(), False))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = ByteBpe(shared.value, pattern)
        for texts in batches:
            yield pd.Series([bpe.encode(t) for t in texts], dtype=object)

    return encode(F.coalesce(text, F.lit("")) if isinstance(text, Column) else F.coalesce(F.col(text), F.lit("")))


def token_text(spark: SparkSession, ids: Column | str, ranks_path: str) -> Column:
    """The text of a column of ids: the strings of the vocabulary, put together.  No ids are the empty text;
    bytes that are no text come out as the replacement character."""
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = ByteBpe(shared.value)
        for lists in batches:
            yield pd.Series([bpe.decode(ids) for ids in lists], dtype=object)

    return decode(F.coalesce(F.col(ids) if isinstance(ids, str) else ids, F.array().cast("array<int>")))


def encode_documents(documents: DataFrame, ranks_path: str, pattern: str = PATTERN) -> DataFrame:
    """doc_id, ids: a row per document."""
    return spread(documents.select("doc_id", "text")).select("doc_id", token_ids(documents.sparkSession, "text", ranks_path, pattern).alias("ids"))


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, text of encoded documents."""
    return encoded.select("doc_id", token_text(encoded.sparkSession, "ids", ranks_path).alias("text"))
