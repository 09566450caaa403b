"""Byte-level BPE: a minimal perfect hash resolves whole pre-tokens of the vocabulary, misses merge with a heap.

Tier one: bytes of a pre-token are hashed once; a displacement per bucket sends every vocabulary entry to a slot of its own
(as many slots as entries), where one comparison decides. Tier two: bytes form a linked list, and a heap holds the rank of
every adjacent pair; the lowest rank, then the leftmost pair, is merged until no pair is in the vocabulary. A heap keeps very
long pre-tokens at n log n steps. Recent pre-tokens are remembered with their ids, up to a fixed number of bytes.

Null or empty text has no ids and decodes to empty bytes; null ids stay null; repeated rows are encoded each; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame

from threatframe.llm.common import Memory, id_and_text, slices

REMEMBERED, AT_ONCE = 96 << 20, 1_000_000
MASK, STEP = (1 << 64) - 1, 0x9E3779B97F4A7C15


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def slot_of(code: int, displacement: int, slots: int) -> int:
    x = ((code ^ (displacement * STEP)) * 0xD6E8FEB86659FD93) & MASK
    return (x >> 32) % slots


class PerfectHash:
    """Minimal perfect hash over byte strings: bucket by hash, a displacement per bucket, single buckets name their slot."""

    def __init__(self, keys: list[bytes], per_bucket: int = 3):
        self.slots, self.buckets = len(keys), max(1, len(keys) // per_bucket)
        members: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            code = xxhash.xxh3_64_intdigest(key)
            members[code % self.buckets].append((i, code))
        self.displacement, self.entry = [0] * self.buckets, [-1] * self.slots
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            group = members[bucket]
            if len(group) < 2:
                break
            d = 1
            while True:
                places = [slot_of(code, d, self.slots) for _, code in group]
                if len(set(places)) == len(places) and all(self.entry[p] < 0 for p in places):
                    break
                d += 1
            self.displacement[bucket] = d
            for place, (i, _) in zip(places, group, strict=True):
                self.entry[place] = i
        free = (p for p, i in enumerate(self.entry) if i < 0)
        for bucket, group in enumerate(members):
            if len(group) == 1:
                place = next(free)
                self.displacement[bucket], self.entry[place] = -1 - place, group[0][0]

    def find(self, key: bytes) -> int:
        """Number of the only entry that can equal ``key``."""
        code = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[code % self.buckets]
        return self.entry[-1 - d if d < 0 else slot_of(code, d, self.slots)]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token that is no vocabulary entry."""
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j >= n or end[j] != to:  # one of the two has changed since
            continue
        gone[j], end[i], after[i] = 1, to, after[j]
        if after[i] < n:
            k = after[i]
            before[k] = i
            if (rank := ranks.get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (rank, i, end[k]))
        if (h := before[i]) >= 0 and (rank := ranks.get(piece[h:to])) is not None:
            heapq.heappush(heap, (rank, h, to))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = after[i]
    return ids


class ByteBpe:
    loaded: dict = {}

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.keys = list(self.ranks)
        self.ids = [self.ranks[k] for k in self.keys]
        self.hash, self.split, self.known = PerfectHash(self.keys), regex.compile(pattern), Memory(self.code, REMEMBERED)
        self.tokens = {rank: token for token, rank in self.ranks.items()}

    @classmethod
    def of(cls, path: str, pattern: str) -> ByteBpe:
        if (path, pattern) not in cls.loaded:
            cls.loaded[path, pattern] = cls(path, pattern)
        return cls.loaded[path, pattern]

    def code(self, word: str) -> bytes:
        piece = word.encode("utf-8", "replace")
        i = self.hash.find(piece)
        ids = [self.ids[i]] if self.keys[i] == piece else merge_bytes(piece, self.ranks)
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.split.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers) of every whole text; no special tokens."""

    def coded(batches):
        bpe = ByteBpe.of(ranks_path, pattern)
        for batch in batches:
            texts = batch["text"].tolist()
            for low, high in slices([len(t) for t in texts], AT_ONCE):
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[low:high].astype("Int64"), "ids": [bpe.encode(t) for t in texts[low:high]]})

    return id_and_text(docs, id_col, text_col).mapInPandas(coded, "doc_id long, ids binary")


def decode(coded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``coded`` (doc_id, ids) with the column ``bytes``; ids that are null give null, unknown ids an error."""

    def plain(batches):
        bpe = ByteBpe.of(ranks_path, pattern)
        for batch in batches:
            ids = batch["ids"].tolist()
            for low, high in slices([len(x or b"") for x in ids], AT_ONCE):
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[low:high].astype("Int64"), "ids": ids[low:high], "bytes": [None if x is None else bpe.decode(x) for x in ids[low:high]]})

    return coded.select("doc_id", "ids").mapInPandas(plain, "doc_id long, ids binary, bytes binary")
