"""Tokenizing into pieces and best-fit packing by exact-complement hashing.

Packing is planned over the histogram of piece lengths, which has at most ``capacity`` rows whatever the input. Starting
with the longest piece left, the gap is looked up in the tables of single, pair and triple length sums; a combination that
fills it exactly is consumed as often as all its lengths are available. If there is none, the largest piece that fits goes
in (best fit) and the smaller gap is looked up again. A plan row says which ranks of a length go where; each length is
used up at least once per pattern or two, so the plan stays in proportion to ``capacity`` and can be broadcast.

Pieces get their rank among equal lengths from a running count within their task, written down with the task's number,
plus the counts of earlier tasks. No piece is shuffled by length, so a length with a third of all rows is no hot key.

Null or empty text has the closing id only. Repeated rows are packed each. An empty table gives an empty result. Null ids
stay null.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from threatframe.llm.common import id_and_text, slices
from threatframe.session import stage

PIECES = "doc_id long, piece int, start long, length long, ids binary"
#: Bytes of words with their ids that a worker remembers, characters it works on at a time, and bytes from which a word is long.
REMEMBERED, AT_ONCE, LONG, PUNCTUATION = 96 << 20, 2_000_000, 64, ".,;:!?"


class WordTokenizer:
    """Ids of whole texts for a tokenizer that never joins across white space: each distinct word is encoded once.

    Words are split at ASCII white space only, which such tokenizers drop; what is inside a word is left to the library. New words
    of letters go to it in long lines, whose ids are cut after each that ends a word; punctuation after letters is looked up
    by itself. Both hold for tokenizers with a word-end suffix that split letters from punctuation (``lined``); for any
    other, and for a line with more or fewer ends than words, every word is encoded by itself.
    """

    loaded: dict = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.known, self.held = Tokenizer.from_file(path), {}, 0
        self.tokenizer.encode_special_tokens = True
        model = json.loads(self.tokenizer.to_str())
        suffix = model["model"].get("end_of_word_suffix")
        self.lower = "Lowercase" in json.dumps(model["normalizer"])
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.lined = bool(suffix) and [len(x.tokens) for x in self.tokenizer.encode_batch(["a", "...", "a..."], add_special_tokens=False)][2] > 1
        if self.lined:
            for token, i in self.tokenizer.get_vocab().items():
                self.ends[i] = token.endswith(suffix)

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def each(self, words: list[str]) -> None:
        for at in range(0, len(words), 10_000):
            part = words[at : at + 10_000]
            for word, code in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[word.encode()] = array("I", code.ids).tobytes()

    def lines(self, words: list[str], size: int = 500) -> None:
        """Words of letters, ``size`` to a line."""
        parts = [words[at : at + size] for at in range(0, len(words), size)]
        for some in range(0, len(parts), 20):
            own = parts[some : some + 20]
            for part, code in zip(own, self.tokenizer.encode_batch_fast([" ".join(x) for x in own], add_special_tokens=False), strict=True):
                ids = np.array(code.ids, dtype="<u4")
                stops = np.flatnonzero(self.ends[ids]) + 1
                if len(stops) != len(part) or stops[-1] != len(ids):
                    self.each(part)
                    continue
                data, low = ids.tobytes(), 0
                for word, high in zip(part, (stops * 4).tolist(), strict=True):
                    self.known[word.encode()] = data[low:high]
                    low = high

    def learn(self, words: set[bytes]) -> None:
        known, joined, odd, letters = self.known, [], set(), set()
        for word in words:
            text = word.decode()
            body = text.rstrip(PUNCTUATION) if self.lined else ""
            # a letter whose small form is not letters alone would join the punctuation
            if body.isalpha() and (body.isascii() or unicodedata.normalize("NFC", body).lower().isalpha()):
                if len(body) == len(text):
                    letters.add(text)
                    continue
                tail = text[len(body) :]
                joined.append((word, body.encode(), tail.encode()))
                if joined[-1][1] not in known:
                    letters.add(body)
                if joined[-1][2] not in known:
                    odd.add(tail)
            else:
                odd.add(text)
        self.each(list(odd))
        self.lines(list(letters))
        for word, body, tail in joined:
            known[word] = known[body] + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        data = [t.encode("utf-8", "replace") for t in texts]
        words = [(d.lower() if self.lower else d).split() for d in data]
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        new = set().union(*words).difference(self.known)
        before = len(self.known)
        self.learn(new)
        self.held += 250 * (len(self.known) - before)
        ids = self.known.__getitem__
        out = [b"".join(map(ids, ws)) for ws in words]
        for word in new:  # long words hardly repeat
            if len(word) > LONG:
                del self.known[word]
        return out


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document's ids with ``end_id`` after them: doc_id, piece, start, length, ids."""
    tail = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches):
        coder = WordTokenizer.of(tokenizer)
        for batch in batches:
            texts = batch["text"].tolist()
            for low, high in slices([len(t) for t in texts], AT_ONCE):
                out = []
                for doc_id, code in zip(batch["doc_id"].iloc[low:high], coder.encode(texts[low:high]), strict=True):
                    code += tail
                    doc_id = None if pd.isna(doc_id) else int(doc_id)
                    for k, at in enumerate(range(0, len(code), 4 * capacity)):
                        part = code[at : at + 4 * capacity]
                        out.append((doc_id, k, at // 4, len(part) // 4, part))
                frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids"])
                yield frame.astype({"doc_id": "Int64", "piece": "int32"})

    return id_and_text(docs, id_col, text_col).mapInPandas(pieces, PIECES)


def exact_fill(gap: int, have: np.ndarray, left: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap``, the largest first. ``have``: lengths with left > 0, ascending."""
    if left[gap] > 0:
        return (gap,)
    fit = have[: np.searchsorted(have, gap)]
    if not len(fit) or gap > 3 * fit[-1]:
        return None

    def pair(total: int, without: int = 0) -> tuple[int, int] | None:
        one = fit[np.searchsorted(fit, (total + 1) // 2) : np.searchsorted(fit, total)]
        if len(one):
            rest = total - one
            need = 1 + (rest == one) + (rest == without) if without else 1 + (rest == one)
            good = np.flatnonzero((left[rest] >= need) & (left[one] >= 1 + (one == without)))
            if len(good):
                a = int(one[good[-1]])
                return a, total - a
        return None

    if found := pair(gap):
        return found
    for a in fit[::-1].tolist():
        if 3 * a < gap:
            break
        if found := pair(gap - a, a):
            return a, *found
    return None


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """The better plan of two: with exact fills, or (rarely) best fit alone."""
    return min((plan_with(counts, capacity, exact) for exact in (True, False)), key=lambda p: p[1])


def plan_with(counts: dict[int, int], capacity: int, exact: bool) -> tuple[np.ndarray, int]:
    """Plan rows (length, from_rank, first_sequence, times, offset) sorted by length and rank, and the number of sequences.

    Rank r of a length is in the row with the largest from_rank <= r: sequence first + (r - from) // times, at
    offset + (r - from) % times * length.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    used, rows, sequences = np.zeros(capacity + 1, dtype=np.int64), [], 0
    have = np.flatnonzero(left)
    while len(have):
        top = int(have[-1])
        take, gap = Counter({top: 1}), capacity - top
        left[top] -= 1
        while gap > 0:
            now = have[left[have] > 0]
            if exact and (combination := exact_fill(gap, now, left)):
                for x in combination:
                    take[x] += 1
                    left[x] -= 1
                break
            at = int(np.searchsorted(now, gap, side="right"))
            if not at:
                break
            best = int(now[at - 1])
            take[best] += 1
            left[best] -= 1
            gap -= best
        times = min(1 + int(left[x]) // k for x, k in take.items())
        offset = 0
        for x, k in sorted(take.items(), reverse=True):
            rows.append((x, int(used[x]), sequences, k, offset))
            left[x] -= k * (times - 1)
            used[x] += k * times
            offset += k * x
        sequences += times
        have = have[left[have] > 0]
    table = np.array(rows or np.empty((0, 5)), dtype=np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))], sequences


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (with ``length``, 1 to ``capacity``) and two more columns: sequence_id and offset (gapless from 0)."""
    spark = pieces.sparkSession
    schema = T.StructType([*pieces.schema.fields, T.StructField("__task", T.LongType()), T.StructField("__rank", T.LongType())])

    def ranked(batches):
        seen, task = np.zeros(capacity + 1, dtype=np.int64), TaskContext.get().partitionId()
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.array([], dtype=bool)
            begin = np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
            rank = np.empty(len(ordered), dtype=np.int64)
            rank[order] = np.arange(len(ordered)) - begin + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), task)), pa.array(rank)], names=[*batch.schema.names, "__task", "__rank"])

    placed = stage(pieces.mapInArrow(ranked, schema))
    per_task = placed.groupBy("__task", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = stage(per_task.selectExpr("__task", "length", "n", "sum(n) over (partition by length order by __task) - n as before"))
    counts = {r.length: r.n for r in earlier.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    rows, _ = plan(counts, capacity)
    shared = spark.sparkContext.broadcast(rows)

    @pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table, n, r = shared.value, length.to_numpy(dtype=np.int64), rank.to_numpy(dtype=np.int64)
        row = table[np.searchsorted((table[:, 0] << 44) | table[:, 1], (n << 44) | r, side="right") - 1]
        turn = r - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 2] + turn // row[:, 3], "offset": row[:, 4] + turn % row[:, 3] * n})

    joined = placed.join(earlier.select("__task", "length", "before"), ["__task", "length"])
    found = joined.withColumn("__place", place(F.col("length"), F.col("before") + F.col("__rank")))
    return found.select(*pieces.columns, "__place.sequence_id", "__place.offset")
