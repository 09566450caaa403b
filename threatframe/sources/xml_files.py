"""XML files of any layout and size, cut into records by many tasks.

A file is split at ``>``, which every tag, comment, CDATA section and instruction ends with, so pieces are small and splits are
independent. What a block (a split of a file) does to the scan is a small row: for each state it may begin in (text, comment, CDATA,
instruction, DTD, an open quote in a tag) the state it ends in, the record tags it closes and those it leaves open. Folded over the
blocks of a file, these give the state and the open tags each block begins with. Then all blocks are cut at once:

* a record is an element with one of the given names outside of a record. In a record such a name is a field, but an element named like
  the record around it is a record of its own, cut out of the outer one;
* the first element of a file is no record if it holds an element with one of the names;
* tags in comments, CDATA sections and attribute values are text. As a value cannot hold ``<``, an open quote ends there;
* a closing tag without its opening tag closes everything, so what follows is read anew;
* a record that is not closed, and text outside of records, is rejected. Comments, instructions and tags outside of records are neither.

Only records that go over blocks travel to be joined. What would be longer than ``MOST`` characters is not put together but rejected in parts.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threatframe.session import stage

MOST = 1 << 27  # characters of a record that is put together from parts
ENDS = {"comment": "-->", "cdata": "]]>", "instruction": "?>"}
# an open quote in a tag; E: in the opening tag of a record name
STATES = ["text", *ENDS, "dtd", '"', "'", 'E"', "E'"]
BODY = r"""(?:[^<>"']++|"[^<"]*+"|'[^<']*+')*+"""
TAG = re.compile(r"<(/?)(?:[\w.-]+:)?([\w.-]+)" + BODY)
CLOSED = {q: re.compile(rf"[^<{q}]*+{q}{BODY}") for q in "\"'"}


def pieces(spark: SparkSession, path: str, names: list[str], files: list[str] | None = None) -> DataFrame:
    """Pieces in file order. ``plain``: one complete tag that is not of a record, after any text."""
    meta = F.col("_metadata")
    rows = spark.read.text(path, lineSep=">").select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"))
    if files is not None:
        rows = rows.filter(F.col("file").isin(files))
    tag = F.substring_index("value", "<", -1)
    record = rf"^/?(?:[\w.-]+:)?(?:{'|'.join(map(re.escape, names))})(?![\w.-])"
    single = F.length("value") - F.length(F.replace("value", F.lit("<"), F.lit(""))) == 1
    open_quote = F.regexp_replace(tag, "\"[^\"]*\"|'[^']*'", "").rlike("[\"']")
    plain = single & tag.rlike(r"^/?[A-Za-z_][\w:.-]*(?=[\s/]|$)") & ~tag.rlike(record) & ~open_quote & ~F.col("value").rlike(r"(?:--|\]\s*|\?)$")
    return rows.select("file", "block", F.monotonically_increasing_id().alias("row"), "value", plain.alias("plain"))


class Scan:
    """State of the scan; what is found goes to the methods ``text``, ``hidden``, ``other``, ``open`` and ``shut``."""

    def __init__(self, state: str, names: frozenset[str]):
        self.state, self.names = state, names

    def take(self, piece: str) -> None:
        """One piece with the ``>`` it ends with."""
        state, at = self.state, 0
        if state in ENDS:
            self.hidden(piece, state)
            self.state = "text" if piece.endswith(ENDS[state]) else state
            return
        if state == "dtd":
            self.hidden(piece, state)
            self.state = "text" if re.search(r"\]\s*>$", piece) else state
            return
        if state != "text":
            found = CLOSED[state[-1]].match(piece)
            end = found.end() if found else 0
            low = piece.find("<", end)
            if low < 0:
                self.other(piece)
                if found and piece[end : end + 1] == ">":
                    self.state = "text"
                    if state[0] == "E" and piece[end - 1] == "/":
                        self.shut(None, "")
                elif found and end < len(piece):
                    self.state = state[:-1] + piece[end]
                return
            self.other(piece[:low])
            self.state, at = "text", low
        while at < len(piece):
            low = piece.find("<", at)
            if low != at:
                self.text(piece[at : low if low >= 0 else len(piece)])
            if low < 0:
                return
            at = self.markup(piece, low)

    def markup(self, piece: str, low: int) -> int:
        """What begins with the ``<`` at ``low``; returns where it ends."""
        size = len(piece) - low
        for start, state, least in (("<!--", "comment", 7), ("<![CDATA[", "cdata", 12), ("<?", "instruction", 4)):
            if piece.startswith(start, low):
                self.hidden(piece[low:], state)
                if size < least or not piece.endswith(ENDS[state]):
                    self.state = state
                return len(piece)
        if piece.startswith("<!", low):
            self.hidden(piece[low:], "dtd")
            if "[" in piece[low:] and not re.search(r"\]\s*>$", piece):
                self.state = "dtd"
            return len(piece)
        tag = TAG.match(piece, low)
        after = piece.find("<", tag.end() if tag else low + 1)
        end = after if after >= 0 else len(piece)
        part = piece[low:end]
        if tag is None:
            self.text(part)
            return end
        closing, name = tag.groups()
        record = name in self.names
        if record:
            self.shut(name, part) if closing else self.open(name, part)
        else:
            self.other(part)
        if after < 0 and tag.end() < len(piece):
            if piece[tag.end()] in "\"'":
                self.state = ("E" if record and not closing else "") + piece[tag.end()]
            elif record and not closing and piece[tag.end() - 1] == "/":
                self.shut(None, "")
        return end


class Outline(Scan):
    """Record tags a block closes and leaves open, not knowing what is open before it."""

    def __init__(self, state: str, names: frozenset[str]):
        super().__init__(state, names)
        self.closes, self.stack, self.opened, self.tags = [], [], 0, False

    def text(self, part): pass

    def hidden(self, part, state): pass

    def other(self, part):
        self.tags = True

    def plain(self):
        """Any number of plain pieces."""
        if self.state not in ENDS and self.state != "dtd":
            self.state, self.tags = "text", True

    def open(self, name, part):
        self.stack.append([name, self.opened, not self.tags])
        self.opened, self.tags = self.opened + 1, True

    def shut(self, name, part):
        if not close(self.stack, name):
            self.closes.append(name)
            self.stack.clear()


def close(stack: list, name: str | None) -> list:
    """Takes the last open tag of this name (None: the last one) with all after it from ``stack``, and returns them."""
    for k in range(len(stack) - 1, -1, -1):
        if name is None or stack[k][0] == name:
            gone = stack[k:]
            del stack[k:]
            return gone
    return []


def outlines(names: frozenset[str]):
    def run(batches):
        def row():
            return pd.DataFrame([[*now, json.dumps({s.begun: [s.state, s.closes, s.stack] for s in scans})]], columns=["file", "block", "outline"])

        now = None
        for batch in batches:
            for file, block, value, plain in zip(*(batch[c].tolist() for c in ("file", "block", "value", "plain")), strict=True):
                if now != (file, block):
                    if now:
                        yield row()
                    now, scans, same = (file, block), [Outline(s, names) for s in STATES], False
                    for s in scans:
                        s.begun = s.state
                if plain and same:
                    continue
                for s in scans:
                    s.plain() if plain else s.take(value + ">")
                same = plain
        if now:
            yield row()
    return run


def entries(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state and the open tags (name, id, whether it is the first of the file) each block of a file begins with."""
    blocks = blocks.sort_values("block")
    state, stack, out = "text", [], []
    for file, block, outline in zip(blocks["file"], blocks["block"], blocks["outline"], strict=True):
        first = not out
        out.append((file, block, state, json.dumps(stack), first))
        state, closes, opens = json.loads(outline)[state]
        for name in closes:
            if not close(stack, name):
                stack.clear()
        stack += [[name, f"{block}:{n}", root and first] for name, n, root in opens]
    frame = pd.DataFrame(out, columns=["file", "block", "state", "stack", "first"])
    return frame.assign(last=frame["block"] == frame["block"].max())


ENTRY = "file string, block long, state string, stack string, first boolean, last boolean"
PART = "file string, block long, id string, name string, whole boolean, closed boolean, wrapper boolean, text string"


class Cutter(Scan):
    """Cuts one block. Frames of open tags: name, id, whether it is the first of the file, whether it is a record, texts, whether records are in it, whether it began here."""

    def __init__(self, state: str, names: frozenset[str], stack: list, first: bool):
        super().__init__(state, names)
        self.frames, self.rows, self.loose, self.opened, self.tags = [], [], [], 0, not first
        for name, key, root in stack:
            self.push(name, key, root, False)

    def push(self, name, key, root, here):
        owner = self.owner()
        record = owner is None or owner[2] or owner[0] == name
        if owner and record:
            owner[5] = True
        self.frames.append([name, key, root, record, [], False, here])

    def owner(self):
        return next((f for f in reversed(self.frames) if f[3]), None)

    def keep(self, part):
        owner = self.owner()
        if owner is None:
            return False
        if not owner[5] or part.strip():  # between the records of an outer one blanks are not kept
            owner[4].append(part)
        return True

    def text(self, part):
        if not self.keep(part):
            self.loose.append(part)

    def hidden(self, part, state):
        if not self.keep(part):
            if state == "cdata":
                self.loose.append(part)
            else:
                self.flush()

    def other(self, part):
        self.tags = True
        if not self.keep(part):
            self.flush()

    def open(self, name, part):
        self.flush()
        self.push(name, None, not self.tags, True)
        self.frames[-1][1] = self.opened
        self.opened, self.tags = self.opened + 1, True
        self.keep(part)

    def shut(self, name, part):
        gone = close(self.frames, name)
        if gone and not gone[0][3]:  # a field
            self.keep(part)
        elif gone:
            gone[0][4].append(part)
        for frame in gone[1:]:
            self.emit(frame, False, True)
        if gone:
            self.emit(gone[0], True, True)
        else:
            for frame in self.frames:
                self.emit(frame, False, True)
            self.frames = []
            self.loose.append(part)

    def emit(self, frame, closed, ended):
        name, key, root, record, parts, inner, here = frame
        if record and (parts or inner):
            self.rows.append((key, name, here and ended, closed, root and inner, "".join(parts)))

    def flush(self):
        loose = "".join(self.loose).strip().lstrip("﻿")
        if loose:
            self.rows.append((None, None, True, False, False, loose))
        self.loose = []

    def finish(self, last):
        self.flush()
        for frame in self.frames:
            self.emit(frame, False, last)


def cut(names: frozenset[str]):
    """Rows of ``PART``: records, rejected texts, and parts of records that go over blocks."""
    def run(batches):
        def made():
            rows, cutter.rows = cutter.rows, []
            return pd.DataFrame([(*now, f"{now[1]}:{r[0]}" if isinstance(r[0], int) else r[0], *r[1:]) for r in rows],
                                columns=["file", "block", "id", "name", "whole", "closed", "wrapper", "text"])

        def rest():
            # the last piece of a file need not end with the sign
            cutter.take(held if last and cutter.state == "text" and "<" not in held else held + ">")
            cutter.finish(last)
            return made()

        now = held = None
        for batch in batches:
            for file, block, state, stack, first, is_last, value in zip(*(batch[c].tolist() for c in ("file", "block", "state", "stack", "first", "last", "value")), strict=True):
                if now != (file, block):
                    if now:
                        yield rest()
                    now, last, cutter = (file, block), is_last, Cutter(state, names, json.loads(stack), first)
                else:
                    cutter.take(held + ">")
                held = value
            if now:
                yield made()
        if now:
            yield rest()
    return run


def bare(text: Column) -> Column:
    """Text outside of tags, comments and instructions."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?s)<!--.*?-->|<\?.*?\?>", ""), "<[^<>]*>", ""), F.lit(" \t\r\n"))


def texts(spark: SparkSession, path: str, names: list[str], files: list[str] | None = None) -> DataFrame:
    """(value, name, record): elements with one of these names, and with ``record`` false the texts that are rejected (see above)."""
    known = frozenset(names)
    rows = pieces(spark, path, names, files)
    light = rows.select("file", "block", F.when(~F.col("plain"), F.col("value")).alias("value"), "plain")
    begun = light.mapInPandas(outlines(known), "file string, block long, outline string").groupBy("file").applyInPandas(entries, ENTRY)
    ordered = rows.drop("plain").join(begun, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "row")
    parts = stage(ordered.mapInPandas(cut(known), PART))
    split = parts.filter(~F.col("whole")).withColumn("size", F.length("text"))
    fits = split.groupBy("file", "id").agg(F.sum("size").alias("total"))
    split = split.join(fits, ["file", "id"])
    joined = split.filter(F.col("total") <= MOST).groupBy("file", "id").agg(
        F.max("name").alias("name"), F.max("closed").alias("closed"), F.max("wrapper").alias("wrapper"), F.sort_array(F.collect_list(F.struct("block", "text"))).alias("all"))
    joined = joined.select("name", "closed", "wrapper", F.array_join("all.text", "").alias("text"))
    longer = split.filter(F.col("total") > MOST).select("name", F.lit(False).alias("closed"), "wrapper", "text")
    both = parts.filter("whole").select("name", "closed", "wrapper", "text").unionByName(joined).unionByName(longer)
    out = both.select(F.when(F.col("wrapper"), bare(F.col("text"))).otherwise(F.trim("text")).alias("value"), "name", (F.col("closed") & ~F.col("wrapper")).alias("record"))
    return out.filter("value <> ''")
