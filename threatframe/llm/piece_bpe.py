"""SentencePiece models of merge type: encoding by backtracking over longest matches, and decoding.

The library joins neighbouring symbols, the best score first and of equal scores the leftmost, until no two make a piece. The
same ids come from a search: an Aho-Corasick automaton gives the longest piece at every place of a word; the search takes it
if it is compatible with the piece before it, else the next shorter prefix of it that is a piece, and steps back one piece where
none is left. Two pieces are compatible when merging the characters of both anew gives just these two. A sequence whose
neighbours are all compatible is the one the merges give: the first merge that went across a border in the whole text would also be
the first to do so in the two pieces alone. A bitfield holds the places from which the search failed, so no place fails twice
and the work is linear in the text for any text.

Pieces that merging never makes (their own characters merge to something else) are left out. A character in no piece never
merges: it becomes the ids of its bytes, and the text is cut around it. The text is also cut before a run of spaces, and between a
letter and a mark, where no piece holds the two; each word of a task is worked out once and remembered, up to a fixed number of bytes.

Models must have byte fallback, no character map, no user-defined pieces, and keep white space as it is; others are refused.
Null text is empty: no ids, which decode to the empty text. Null ids of documents stay null, repeated rows are coded each, texts
of any length are coded whole; other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threatframe.llm.common import Memory, id_and_text, slices

AT_ONCE, PAIRS, REMEMBERED = 2_000_000, 1_000_000, 128 << 20
SPACE = "▁"
#: Numbers of a model file: kinds of pieces, and the type of the model that merges.
NORMAL, UNKNOWN, CONTROL, BYTE, MERGES = 1, 2, 3, 6, 2


def fields(data: bytes):
    """(number, value) of each field of a protocol buffer message; integers, or bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            at += size
            yield key >> 3, data[at - size : at]


class PieceModel:
    """Pieces of a model file and the settings that matter here."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(fields(file.read()))
        self.pieces, self.scores, self.kinds = [], [], []
        for _, piece in (p for p in parts if p[0] == 1):
            own = dict(fields(piece))
            self.pieces.append(own[1].decode())
            self.scores.append(struct.unpack("<f", own.get(2, bytes(4)))[0])
            self.kinds.append(own.get(3, NORMAL))
        trainer = dict(fields(next((v for k, v in parts if k == 2), b"")))
        normalizer = dict(fields(next((v for k, v in parts if k == 3), b"")))
        self.prefix, self.surface = bool(normalizer.get(3, 1)), trainer.get(44, " ⁇ ".encode()).decode()
        known = trainer.get(3, 1) == MERGES and trainer.get(35, 0) and not trainer.get(24, 0) and self.kinds.count(BYTE) == 256
        if not known or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: not a model of merges with byte fallback and unchanged text")
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}


def merged(text: str, ranks: dict[str, int]) -> list[str]:
    """The symbols that merging leaves, by its definition; for short texts."""
    symbols, none = list(text), len(ranks)
    found = [ranks.get(a + b, none) for a, b in zip(symbols, symbols[1:])]
    while found and (best := min(found)) < none:
        i = found.index(best)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        del found[i]
        if i:
            found[i - 1] = ranks.get(symbols[i - 1] + symbols[i], none)
        if i < len(found):
            found[i] = ranks.get(symbols[i] + symbols[i + 1], none)
    return symbols


class PieceBpe:
    loaded: dict = {}

    def __init__(self, path: str):
        self.model = model = PieceModel(path)
        own = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == NORMAL}
        order = {s: n for n, s in enumerate(sorted({model.scores[i] for i in own.values()}, reverse=True))}
        self.ranks = {p: order[model.scores[i]] for p, i in own.items()}
        letters = set().union(*own)
        if letters - own.keys():
            raise ValueError(f"{path}: characters of pieces that are no pieces themselves")
        self.texts = [p for p in own if len(p) == 1 or merged(p, self.ranks) == [p]]
        self.ids = [own[p] for p in self.texts]
        number = {p: t for t, p in enumerate(self.texts)}
        self.size = [len(p) for p in self.texts]
        # the longest piece that a piece begins with
        self.shorter = [next((number[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in number), -1) for p in self.texts]
        # single characters match where they stand, without the automaton
        self.single = {p: t for p, t in number.items() if len(p) == 1}
        self.matches = ahocorasick.Automaton()
        for p, t in number.items():
            if len(p) > 1:
                self.matches.add_word(p, t)
        self.matches.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.unknown = re.compile(f"([^{re.escape(''.join(sorted(letters)))}])")
        odd = re.escape("".join(c for c in map(chr, range(128)) if c not in letters and c != " "))
        inside = any(SPACE in p.lstrip(SPACE) for p in own)
        after = set("".join(m for p in own for m in re.findall(r"(?<=[^\W\d_])[\W\d_]", p)))
        tail = re.escape("".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in after))
        cut = f"[^\\W\\d_]++(?=[{tail}])|" if tail else ""
        self.words = re.compile(f"[^{odd}]+|[{odd}]" if inside else f"{SPACE}*(?:{cut}[^{SPACE}{odd}]+)|[{odd}]|{SPACE}+")
        self.plain = [model.surface.encode() if k == UNKNOWN else b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()
                      for p, k in zip(model.pieces, model.kinds, strict=True)]

    @classmethod
    def of(cls, path: str) -> PieceBpe:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the characters of two pieces leaves the two pieces."""
        key = a * len(self.size) + b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            left, right = self.texts[a], self.texts[b]
            found = self.pairs[key] = merged(left + right, self.ranks) == [left, right]
        return found

    def search(self, word: str) -> list[int]:
        """Numbers of the pieces of a text made of known characters."""
        n, size, shorter, pairs, many = len(word), self.size, self.shorter, self.pairs, len(self.size)
        longest = array("i", map(self.single.__getitem__, word)) if n > 1000 else list(map(self.single.__getitem__, word))
        for end, t in self.matches.iter(word):  # by end, so the last of a place is its longest
            longest[end + 1 - size[t]] = t
        failed, stuck = bytearray(n // 8 + 1), False
        out, at, last, token = [], 0, -1, longest[0]
        while at < n:
            while token >= 0:
                end = at + size[token]
                if not (stuck and failed[end >> 3] >> (end & 7) & 1):
                    if last < 0:
                        break
                    fits = pairs.get(last * many + token)
                    if fits or (fits is None and self.fits(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = end, token
                token = longest[at] if at < n else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                stuck = True
                token = shorter[out.pop()]
                at -= size[last]
                last = out[-1] if out else -1
        return out

    def code(self, word: str) -> bytes:
        """Ids of a word with its white space, as little-endian 32-bit integers."""
        ids = []
        for i, part in enumerate(self.unknown.split(word)):
            if i % 2:
                ids += [self.model.bytes[b] for b in part.encode("utf-8", "replace")]
            elif part:
                ids += map(self.ids.__getitem__, self.search(part))
        return array("i", ids).tobytes()

    def encode(self, text: str, known) -> bytes:
        if not text:
            return b""
        return b"".join(map(known.__getitem__, self.words.findall((SPACE if self.model.prefix else "") + text.replace(" ", SPACE))))

    def decode(self, ids: list[int]) -> str:
        return self.text_of(b"".join(map(self.plain.__getitem__, ids)), ids)

    def text_of(self, data: bytes, ids) -> str:
        """The text of ids whose pieces joined are ``data``."""
        # the space put before the text goes; only a normal piece loses one, and only where nothing stands before it
        if self.model.prefix and data.startswith(b" ") and self.model.kinds[next(i for i in ids if self.model.kinds[i] != CONTROL)] == NORMAL:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self.mended(ids)

    def mended(self, ids: list[int]) -> str:
        """Decoding of ids whose byte pieces are no valid text: every byte outside a whole character becomes U+FFFD."""
        out, held = [], b""
        for i in [*ids, None]:
            if i is not None and self.model.kinds[i] == BYTE:
                held += self.plain[i]
                continue
            while held:
                size = next((n for n in (1, 2, 3, 4) if valid(held[:n])), 0)
                out.append(held[:size].decode() if size else "�")
                held = held[size or 1 :]
            if i is not None:
                text = self.plain[i].decode()
                out.append(text[1:] if not any(out) and self.model.prefix and self.model.kinds[i] == NORMAL and text.startswith(" ") else text)
        return "".join(out)


def valid(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every whole text, without begin or end."""

    def coded(batches):
        coder = PieceBpe.of(model_path)
        known = Memory(coder.code, REMEMBERED)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for low, high in slices([len(t) for t in texts], AT_ONCE):
                found = [coder.encode(t, known) for t in texts[low:high]]
                ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
                yield pa.RecordBatch.from_arrays([ids.slice(low, high - low), pa.ListArray.from_arrays(pa.array(ends), values)], names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(coded, "doc_id long, ids array<int>")


def decode(coded: DataFrame, model_path: str) -> DataFrame:
    """``coded`` (doc_id, ids) with the column ``text``; null ids give null, an id the model does not have is an error."""

    def plain(batches):
        coder = PieceBpe.of(model_path)
        sizes = np.array([len(p) for p in coder.plain])
        for batch in batches:
            lengths = batch.column(1).value_lengths().fill_null(0).to_pylist()
            for low, high in slices(lengths, AT_ONCE):
                part = batch.slice(low, high - low)
                ids = part.column(1).flatten().to_numpy(zero_copy_only=False)
                data = b"".join(map(coder.plain.__getitem__, ids.tolist()))
                ends = np.cumsum([0, *lengths[low:high]])
                cuts = np.r_[0, np.cumsum(sizes[ids])][ends].tolist()
                texts = [None if null else coder.text_of(data[cuts[k] : cuts[k + 1]], ids[ends[k] : ends[k + 1]]) for k, null in enumerate(part.column(1).is_null().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return coded.select("doc_id", "ids").mapInArrow(plain, "doc_id long, ids array<int>, text string")
