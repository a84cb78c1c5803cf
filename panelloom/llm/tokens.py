"""Encoding of whole texts with the rank file of a public byte-level BPE vocabulary.

A text is split by the vocabulary's pattern, and each piece is merged by a segment tree over the ranks of its adjacent
pairs: the root holds the leftmost lowest rank, and a merge changes three leaves, so a piece of n bytes takes
O(n log n) however long it is. Pieces of the corpus repeat, so each worker keeps a bounded table of recent ones.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.plans.parallel import spread

#: Where the public vocabularies lie; a parameter of every query that uses one.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the public pattern that splits a text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces kept per worker, and the longest piece kept.
KEPT, KEPT_BYTES = 200_000, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank (its id) of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PairTree:
    """A segment tree over the pairs of neighbouring parts; the root names the leftmost pair of the lowest rank."""

    def __init__(self, keys: list[int], none: int):
        self.size = 1 << max(0, len(keys) - 1).bit_length()
        self.nodes = [none] * self.size + keys + [none] * (self.size - len(keys))
        for i in range(self.size - 1, 0, -1):
            left, right = self.nodes[2 * i], self.nodes[2 * i + 1]
            self.nodes[i] = left if left <= right else right

    def put(self, at: int, key: int) -> None:
        nodes, at = self.nodes, at + self.size
        nodes[at] = key
        at >>= 1
        while at:
            left, right = nodes[2 * at], nodes[2 * at + 1]
            least = left if left <= right else right
            if nodes[at] == least:
                return
            nodes[at] = least
            at >>= 1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the leftmost adjacent pair of the lowest rank is merged until none has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    none = (len(ranks) + 1) * n  # a key is rank * n + position, so the lowest is the leftmost of the lowest rank
    get, end = ranks.get, list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def key(i: int) -> int:
        j = end[i]
        if j >= n:
            return none
        r = get(piece[i : end[j]])
        return none if r is None else r * n + i

    tree = PairTree([key(i) for i in range(n - 1)] or [none], none)
    while (least := tree.nodes[1] if tree.size > 1 else tree.nodes[-1]) < none:
        i = least % n
        j = end[i]
        end[i] = end[j]
        if end[i] < n:
            before[end[i]] = i
        if j < n - 1:
            tree.put(j, none)
        tree.put(i, key(i)) if i < n - 1 else None
        if before[i] >= 0:
            tree.put(before[i], key(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Texts to ids; made once per worker task."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex

        self.ranks, self.split, self.known = ranks, regex.compile(PATTERN).findall, {}

    def ids(self, text: str | None) -> list[int]:
        """[] for an empty or null text."""
        out: list[int] = []
        if not text:
            return out
        known = self.known
        for piece in self.split(text):
            got = known.get(piece)
            if got is None:
                raw = piece.encode("utf-8", "surrogatepass")
                got = merge(raw, self.ranks)
                if len(raw) <= KEPT_BYTES:
                    if len(known) >= KEPT:
                        known.clear()
                    known[piece] = got
            out += got
        return out


def encode(documents: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) of every row, without special tokens; [] for an empty or null text.

    Strings of special tokens are ordinary text. Repeated rows are encoded each; an empty table gives no rows; further
    columns are ignored. The vocabulary (bounded by its file) is broadcast, so executors need no file.
    """
    ranks = documents.sparkSession.sparkContext.broadcast(read_ranks(f"{tokenizers}/{vocabulary}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks.value)
        for pdf in batches:
            yield pd.DataFrame({"_key": pdf["_key"], "ids": [np.asarray(encoder.ids(t), dtype=np.int32) for t in pdf["_text"]]})

    kind = documents.schema[key].dataType.simpleString()
    named = spread(documents.select(key, text)).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return named.mapInPandas(run, f"_key {kind}, ids array<int>").withColumnRenamed("_key", key)


def token_counts(documents: DataFrame, *, keep: tuple[str, ...] = (), key: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """key, `keep` and tokens (the number of ids) of every row; texts don't leave the worker."""
    ranks = documents.sparkSession.sparkContext.broadcast(read_ranks(f"{tokenizers}/{vocabulary}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks.value)
        for pdf in batches:
            yield pdf.drop(columns="_text").assign(tokens=[len(encoder.ids(t)) for t in pdf["_text"]])

    df = spread(documents.select(key, *keep, F.col(text).alias("_text")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "_text")
    return df.mapInPandas(run, schema + ", tokens bigint")


def vocabulary_table(spark: SparkSession, *, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, token) of a rank file, tokens as binary."""
    return spark.createDataFrame([(r, bytearray(t)) for t, r in read_ranks(f"{tokenizers}/{vocabulary}").items()], "id int, token binary")
