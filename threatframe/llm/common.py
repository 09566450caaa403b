"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, every other character left alone."""
    return F.translate(column, UPPER, LOWER)


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that other columns can have any name; null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(lengths, limit: int):
    """(from, to) ranges of consecutive items whose lengths sum to about ``limit``; every range holds one item at least."""
    begin = total = 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield begin, len(lengths)


class Memory(dict):
    """What ``make`` gave for recent words, in at most about ``limit`` bytes. Long words, which hardly repeat, are not remembered."""

    def __init__(self, make, limit: int = 48 << 20, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.held = make, limit, longest, 0

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.longest:
            if self.held > self.limit:
                self.clear()
                self.held = 0
            self.held += 200 + 2 * len(word)
            self[word] = value
        return value
