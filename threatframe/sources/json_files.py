"""JSON files of any layout and size, cut into records by many tasks.

A file is split at ``}``, which every record ends with, so pieces are small and splits are independent. What a block (a split of a file)
does to the state of the scan is a small row: whether a string is open at its end, how many open brackets of earlier blocks it
closes, and which it leaves open, for a block that begins inside a string and for one that does not. Folded over the blocks of a
file, these give the state each block begins with. Then all blocks are cut at once:

* a line feed outside of all brackets ends a value, and so does one between a ``}`` and an opening bracket: valid JSON has
  a comma between, so a broken record ends there whatever it left open;
* an array (or the array under the key ``member`` of an object) that goes over lines, over ``LONG`` characters or over a block is cut
  into elements after each object; a shorter one is judged as a whole;
* strings hold no line feeds in JSON, so an open quote ends with its line.

Only the first and the last text of a block travel to be joined with those of its neighbours. What would be longer than ``MOST``
characters is not put together but rejected in parts.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threatframe.session import stage

LONG = 1 << 16
KEPT = 3  # open brackets whose kind is kept
MOST = 1 << 27  # characters of a record that is put together from parts


def pieces(spark: SparkSession, path: str, member: str | None) -> DataFrame:
    """Pieces in file order with what the scan needs of each: brackets and line feeds outside of strings, if it begins outside (s0) or inside one (s1)."""
    meta = F.col("_metadata")
    rows = spark.read.text(path, lineSep="}").select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("file_size"))
    clean = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))

    def brackets(text):
        return F.regexp_replace(F.regexp_replace(text, '"[^"\n]*(?:"|(?=\n)|$)', ""), r"[^\[\]{}\n]", "")

    last_line = F.substring_index(clean, "\n", -1)
    found = F.col("value").rlike(rf'"{re.escape(member)}"\s*:\s*\[') if member else F.lit(False)
    return rows.select(
        "file", "block", F.monotonically_increasing_id().alias("row"), "file_size", "value", F.octet_length("value").alias("size"),
        F.contains("value", F.lit("\n")).alias("breaks"), (F.length(last_line) - F.length(F.replace(last_line, F.lit('"'), F.lit("")))).bitwiseAND(1).alias("quote"),
        brackets(clean).alias("s0"), brackets(F.regexp_replace(clean, '^[^"\n]*(?:"|(?=\n)|$)', "")).alias("s1"),
        F.col("value").rlike(r"^[ \t\r]*\n\s*[{\[]").alias("anew"), found.alias("member"))


class Brackets:
    """Open brackets: how many, and the kinds of the outermost; ``M`` is the array whose elements are the records. ``below`` counts closing ones without an opening one."""

    def __init__(self, kinds: str = "", depth: int = 0):
        self.kinds, self.depth, self.below, self.anew = kinds, depth, 0, False

    def restart(self) -> None:
        self.kinds, self.depth, self.below, self.anew = "", 0, 0, True

    def take(self, bracket: str, member: bool = False) -> None:
        if bracket in "{[":
            if self.depth < KEPT:
                self.kinds += "M" if member and bracket == "[" and self.depth == 1 else bracket
            self.depth += 1
        elif self.depth:
            self.depth -= 1
            self.kinds = self.kinds[: self.depth]
        else:
            self.below += 1


BLOCK = "file string, block long, file_size long, size long, n long, " + ", ".join(f"string{i} int, anew{i} boolean, below{i} long, depth{i} long, kinds{i} string" for i in (0, 1))


def summaries(batches):
    """One row per block: what it does to the state, beginning outside (0) and inside (1) of a string."""
    def row():
        out = list(now) + [size, n]
        for string, state in zip(strings, states, strict=True):
            out += [string, state.anew, state.below, state.depth, state.kinds]
        return pd.DataFrame([out], columns=[x.split()[0] for x in BLOCK.split(", ")])

    now = None
    for batch in batches:
        for file, block, file_size, length, breaks, quote, s0, s1, anew, member in zip(*(batch[c].tolist() for c in ("file", "block", "file_size", "size", "breaks", "quote", "s0", "s1", "anew", "member")), strict=True):
            if now != (file, block, file_size):
                if now:
                    yield row()
                now, size, n, strings, states = (file, block, file_size), 0, 0, [0, 1], [Brackets(), Brackets()]
            for i in (0, 1):
                state = states[i]
                if anew and not strings[i]:
                    state.restart()
                for c in s1 if strings[i] else s0:
                    if c != "\n":
                        # in a block of its own the depth of a member's array is not known yet; it is an array in an object
                        state.take(c, member)
                strings[i] = quote if breaks else strings[i] ^ quote
                if not strings[i]:
                    state.take("}")
            size, n = size + length + 1, n + 1
    if now:
        yield row()


def entries(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state each block of a file begins with, and how the file's last piece ends."""
    blocks = blocks.sort_values("block")
    string, state, out = 0, Brackets(), []
    for b in blocks.to_dict("records"):
        out.append((b["file"], b["block"], string, state.depth, state.kinds))
        i = string
        string = b[f"string{i}"]
        depth = 0 if b[f"anew{i}"] else max(0, state.depth - b[f"below{i}"])
        kinds = state.kinds[:depth] + b[f"kinds{i}"][: max(0, KEPT - depth)]
        state = Brackets(kinds, depth + b[f"depth{i}"])
    extra = blocks["size"].sum() - blocks["file_size"].iloc[0]
    frame = pd.DataFrame(out, columns=["file", "block", "string", "depth", "kinds"])
    last = frame["block"] == frame["block"].max()
    # 0: the last piece ends with a bracket, 1: it does not, 2: the size of the file does not tell (it is packed)
    return frame.assign(first=frame["block"] == frame["block"].min(), last=last, ending=0 if extra == 0 else 1 if extra == 1 else 2)


ENTRY = "file string, block long, string int, depth long, kinds string, first boolean, last boolean, ending int"
PART = "file string, block long, place int, begins string, ends string, text string"
WHOLE, TAIL, HEAD, MIDDLE = range(4)


class Cutter:
    """Cuts the pieces of one block. ``begins``: v(alue), f(irst element), e(lement), or c(ontinued from the block before);
    ``ends``: v(alue), e(lement) or r(est of an array)."""

    def __init__(self, string: int, depth: int, kinds: str, first: bool):
        self.string, self.state, self.rows = string, Brackets(kinds, depth), []
        self.text, self.begins, self.length = [], "v" if first else "c", 0
        self.level = self.container() if depth else 0  # of the elements that are cut now; 0: none
        self.over = False  # behind the last of them
        # an array not cut yet: the level of its elements, where they begin in ``text``, and whether it goes over lines
        self.pending, self.marks, self.lines = 0, [], False

    def container(self) -> int:
        return 1 if self.state.kinds[:1] == "[" else 2 if self.state.kinds[1:2] == "M" else 0

    def close(self, ends: str, begins: str) -> None:
        if self.text:
            self.rows.append((self.begins, ends, "".join(self.text)))
        elif self.begins == "c":
            self.rows.append(("c", ends, ""))
        self.text, self.begins, self.length, self.pending, self.marks, self.lines = [], begins, 0, 0, [], False

    def commit(self) -> None:
        """The array that began in this text is cut."""
        text, marks, begins = self.text, self.marks, "f"
        self.level = self.pending
        if self.begins == "c":
            begins = "c"
        for low, high in zip([0, *marks], marks):
            self.rows.append((begins, "e", "".join(text[low:high])))
            begins = "e"
        self.text, self.begins, self.length, self.pending, self.marks, self.lines = text[marks[-1] if marks else 0 :], begins, 0, 0, [], False

    def take(self, value, breaks, quote, s0, s1, anew, member, brace) -> None:
        state = self.state
        if not self.string:
            if anew:
                self.new_value()
                state.restart()
            elif self.level and state.depth == self.level and (self.text or self.begins == "c"):
                self.close("e", "e")
            elif self.pending and state.depth == self.pending and self.text:
                self.marks.append(len(self.text))
        feed, done = -1, 0
        for c in s1 if self.string else s0:
            if c == "\n":  # strings have none, so these are the line feeds of the text
                feed = value.index("\n", feed + 1)
                if state.depth == 0:
                    self.text.append(value[done:feed])
                    done = feed
                    self.new_value()
                else:
                    self.lines = bool(self.pending)
                continue
            state.take(c, member)
            if self.level:
                if state.depth < self.level:
                    self.level, self.over = 0, True
            elif self.pending:
                if state.depth < self.pending:
                    self.ended()
            elif not self.over and state.depth == self.container():
                self.pending = state.depth
        self.text.append(value[done:] + ("}" if brace else ""))
        self.length += len(value)
        self.string = quote if breaks else self.string ^ quote
        if brace and not self.string:
            state.take("}")
            if self.level and state.depth < self.level:
                self.level, self.over = 0, True
            elif self.pending and state.depth < self.pending:
                self.ended()
        if self.pending and (self.lines and self.marks or self.length > LONG):
            self.commit()

    def new_value(self) -> None:
        """What was read so far ends; on the next line something new begins."""
        if self.text or self.begins == "c":
            self.close("r" if self.level or self.over else "v", "v")
        self.begins, self.level, self.pending, self.over, self.lines = "v", 0, 0, False, False

    def ended(self) -> None:
        """The array is complete: over lines it is cut, in a line of its own it is judged with what follows."""
        if self.lines and self.marks:
            self.commit()
            self.level, self.over = 0, True
        self.pending, self.marks, self.lines = 0, [], False

    def finish(self, last: bool) -> None:
        if self.pending and not last:
            self.commit()
        self.close("r" if self.over or (self.level and (last or self.state.depth != self.level)) else "e" if self.level else "v", "v")


def cut(batches):
    """Rows of ``PART``: texts that are complete, and those that go on in a neighbouring block."""
    def made(final: bool = False):
        rows, keep = cutter.rows, 0 if final else 1  # whether the last one goes on is known at the end of the block
        out = [(*now, HEAD if r[0] == "c" else WHOLE, *r) for r in rows[: len(rows) - keep]]
        del rows[: len(rows) - keep]
        if final and out and not last:
            out[-1] = (*now, MIDDLE if out[-1][2] == HEAD else TAIL, *out[-1][3:])
        return pd.DataFrame(out, columns=["file", "block", "place", "begins", "ends", "text"])

    def rest():
        *piece, brace = held
        if brace is None:
            brace = not cutter.string and cutter.state.depth + sum((c in "{[") - (c in "}]") for c in piece[3]) > 0
        cutter.take(*piece, brace)
        cutter.finish(last)
        return made(final=True)

    now = held = None
    names = ["file", "block", "string", "depth", "kinds", "first", "last", "ending", "value", "breaks", "quote", "s0", "s1", "anew", "member"]
    for batch in batches:
        for file, block, string, depth, kinds, first, is_last, ending, *piece in zip(*(batch[c].tolist() for c in names), strict=True):
            if now != (file, block):
                if now:
                    yield rest()
                now, last, cutter = (file, block), is_last, Cutter(string, depth, kinds, first)
            else:
                cutter.take(*held[:-1], True)
            # only the last piece of a file may end without a bracket
            held = (*piece, True if not is_last or ending == 0 else False if ending == 1 else None)
        if now:
            yield made()
    if now:
        yield rest()


def texts(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """(value, listed): texts of single values or lines of broken ones, or with ``listed`` of the elements of an array between commas."""
    rows = pieces(spark, path, member)
    blocks = rows.mapInPandas(summaries, BLOCK)
    begun = blocks.groupBy("file").applyInPandas(entries, ENTRY)
    ordered = rows.join(begun, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "row")
    parts = stage(ordered.mapInPandas(cut, PART))
    # what goes on in the next block: a last text, and the first one of the block after it
    by_block = Window.partitionBy("file").orderBy("block", F.when(F.col("place") == TAIL, 1).otherwise(0))
    edges = parts.filter(F.col("place") != WHOLE).withColumn("n", F.sum(F.when(F.col("place") == TAIL, 1).otherwise(0)).over(by_block))
    edges = edges.withColumn("total", F.sum(F.length("text")).over(Window.partitionBy("file", "n")))
    part = F.struct("block", F.when(F.col("place") == TAIL, 1).otherwise(2).alias("k"), "begins", "ends", "text")
    joined = edges.filter(F.col("total") <= MOST).groupBy("file", "n").agg(F.sort_array(F.collect_list(part)).alias("all"))
    fitting = joined.select(F.col("all")[0]["begins"].alias("begins"), F.element_at("all", -1)["ends"].alias("ends"), F.array_join("all.text", "").alias("text"))
    longer = edges.filter(F.col("total") > MOST).select(F.lit("v").alias("begins"), F.lit("x").alias("ends"), "text")
    both = parts.filter(F.col("place") == WHOLE).select("begins", "ends", "text").unionByName(fitting).unionByName(longer)

    start = rf'^(?s:.*?)"{re.escape(member)}"\s*:\s*\[|^\s*\[' if member else r"^\s*\["
    # what began as an element and ends in no array is the rest of the object around it
    both = both.withColumn("ends", F.when(F.col("begins").isin("e", "f") & (F.col("ends") == "v"), "r").otherwise(F.col("ends")))
    body = F.when(F.col("begins") == "f", F.regexp_replace("text", start, "")).otherwise(F.col("text"))
    listed = F.col("ends").isin("e", "r")
    rest = F.regexp_replace(body, r"^[\s,]+|[\s,]+$", "")
    # after the last element of an array comes its end; of a member's array also the end of what it is in
    rest = F.when(F.col("ends") == "r", F.regexp_replace(rest, r"\s*\](?s:.*)\}\s*$|\s*\]$" if member else r"\s*\]$", "")).otherwise(rest)
    out = both.select(F.when(listed, rest).otherwise(F.regexp_replace("text", "^﻿?\\s+|\\s+$|^﻿", "")).alias("value"), listed.alias("listed"))
    return out.filter("value <> ''")
