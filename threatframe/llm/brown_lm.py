"""Language-model scoring with Brown classes: class transitions times word emissions, classes found by exchange.

Tokens are words (runs of anything but ASCII white space, A-Z lower-cased) and one end per text. Words that make up ``share`` of
all training tokens or more are units of an exchange on the driver (1/``share`` at most, whatever the corpus). Every other word seen
``least`` times or more gets a class of its own on Spark, from its own contexts. Only rarer words, about whose contexts little is known,
and unknown ones go by their last three bytes, in ``shapes`` units that take part in the exchange.

Texts are written once as blocks of neighbouring rows: numbers of the tokens within the block, and its distinct words. A word's training
count and unit are joined once to the blocks that have it, with a number that stands for the word from then on, and each pass over the
texts reads a block with its own words; nothing of the size of the vocabulary is held anywhere. Frequent words, which most blocks have,
take no part in the joins by word. The first pass takes words but the most frequent by their ending, with the most frequent units as
contexts; the other ``passes`` gather sparse counts of context classes found so far, per unit and per word. Then units move one by
one to the class in which the likelihood of all contexts is largest, words all at once to the class whose sums make
their contexts most likely, in turn until nothing moves; each step gains likelihood, and only class sums travel.

P(w | v) = weight * P(class w | class v) * P(w | class w) + (1 - weight) * P(w), with P(w) the add-one unigram share, add-one
transitions, and emissions that keep ``spare`` of a count for each word of the class and for unknown ones. A text begins after an
end. The score is the log10 probability of all its tokens, ``perplexity`` turns it into one.

Null text is empty: its end only. Null ids are training rows; repeated rows count and are scored each. Without training tokens
all words are unknown (N = V = 0). An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatframe.llm.common import slices
from threatframe.session import Scratch, small_batches

END = b" "  # no word has a space
AT_ONCE, FLUSH, SENT = 4_000_000, 400_000, 20_000


def tokens_of(text: str) -> list[bytes]:
    words = text.encode("utf-8", "replace").lower().split()
    words.append(END)
    return words


@dataclass
class Units:
    """Unit of each word: its own number if it is frequent, else that of its ending."""

    frequent: dict[bytes, int]
    shapes: int
    cache: dict = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.frequent) + self.shapes

    def of(self, word: bytes) -> int:
        unit = self.frequent.get(word)
        return len(self.frequent) + zlib.crc32(word[-3:]) % self.shapes if unit is None else unit

    def numbers(self, words: list[bytes]) -> np.ndarray:
        cache = self.cache
        if len(cache) > FLUSH:
            cache.clear()
        for w in words:
            if w not in cache:
                cache[w] = self.of(w)
        return np.fromiter(map(cache.__getitem__, words), dtype=np.int64, count=len(words))

    def column(self, words: pa.Array) -> np.ndarray:
        """As ``numbers``, of a column of words: frequent words are looked up at once, endings are hashed once each."""
        found = pc.index_in(words, value_set=pa.array(list(self.frequent), words.type))
        endings = pc.binary_slice(words, -3).dictionary_encode()
        hashed = np.fromiter((zlib.crc32(x) % self.shapes for x in endings.dictionary.to_pylist()), dtype=np.int64, count=len(endings.dictionary))
        unit = len(self.frequent) + hashed[endings.indices.to_numpy(zero_copy_only=False)]
        known = found.is_valid().to_numpy(zero_copy_only=False)
        unit[known] = np.fromiter(self.frequent.values(), dtype=np.int64, count=len(self.frequent))[found.drop_null().to_numpy(zero_copy_only=False)]
        return unit


def numbered(texts: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of texts laid end to end, the end first and the others in order of appearance; number of each token; tokens of each text.

    The same tokens as those of ``tokens_of``, found column by column."""
    lower = pc.ascii_lower(pc.ascii_trim_whitespace(texts.cast(pa.large_string())))
    some = pc.greater(pc.binary_length(lower), 0)
    split = pc.ascii_split_whitespace(lower.filter(some))
    split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
    found = split.flatten().dictionary_encode()
    sizes = np.ones(len(texts), dtype=np.int64)
    sizes[some.to_numpy(zero_copy_only=False) if isinstance(some, pa.Array) else some.to_numpy()] += pc.list_value_length(split).to_numpy(zero_copy_only=False)
    tokens = np.zeros(sizes.sum(), dtype="<i4")
    word = np.ones(len(tokens), dtype=bool)
    word[np.cumsum(sizes) - 1] = False
    tokens[word] = found.indices.to_numpy(zero_copy_only=False) + 1
    return pa.concat_arrays([pa.array([END], pa.large_binary()), found.dictionary.cast(pa.large_binary())]), tokens, sizes


def coded(texts: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of neighbouring rows, with two kinds of rows: of texts (``ids``: number of each token in its block, compressed) and of the block's
    distinct words (``n``: training count; the end is number 0)."""
    kinds = dict(zip(CODED, (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.binary(), pa.int64()), strict=True))

    def in_blocks(batches):
        made, rows, size = 0, [], 0

        def sent(most, **columns):
            block = (TaskContext.get().partitionId() << 32) | made
            for at in range(0, most, SENT):
                part = {k: x[at : at + SENT] for k, x in columns.items()}
                held = min(SENT, most - at)
                part["block"] = np.full(held, block)
                part = {k: x.cast(kinds[k]) if isinstance(x, pa.Array) else pa.array(x, kinds[k]) for k, x in part.items()}
                yield pa.RecordBatch.from_arrays([part[k] if k in part else pa.nulls(held, t) for k, t in kinds.items()], names=CODED)

        def frames():
            docs = pa.Table.from_batches(rows)
            words, tokens, sizes = numbered(docs["text"])
            ends = np.cumsum(sizes).tolist()
            ids = [zlib.compress(tokens[low:high].tobytes(), 1) for low, high in zip([0, *ends[:-1]], ends, strict=True)]
            held = docs["held_out"].to_pylist()
            # once for the block: a row's own count would be as long as the words of all its rows
            learnt = np.repeat(~np.array(held, dtype=bool), sizes)
            count = np.bincount(tokens[learnt], minlength=len(words))
            yield from sent(len(ids), doc_id=docs["doc_id"].to_pylist(), held_out=held, ids=ids)
            yield from sent(len(words), local=np.arange(len(words)), word=words, n=count)

        for batch in batches:
            low = 0
            for i, n in enumerate(pc.utf8_length(batch["text"]).to_pylist()):
                size += n + 100
                if size >= block_bytes:
                    rows.append(batch.slice(low, i + 1 - low))
                    yield from frames()
                    made, rows, low, size = made + 1, [], i + 1, 0
            if low < batch.num_rows:
                rows.append(batch.slice(low))
        if rows:
            yield from frames()

    small_batches(texts.sparkSession)
    found = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("held_out", F.lit(False)).alias("held_out"), "text")
    return found.mapInArrow(in_blocks, "block long, doc_id long, held_out boolean, ids binary, local int, word binary, n long")


CODED = ["block", "doc_id", "held_out", "ids", "local", "word", "n"]
ENTRY = np.dtype([("context", "<u2"), ("n", "<i8")])


def packed(table: np.ndarray) -> list[bytes]:
    """The entries of each row that are not zero."""
    at, context = np.nonzero(table)
    entries = np.empty(len(at), dtype=ENTRY)
    entries["context"], entries["n"] = context, table[at, context]
    data = entries.tobytes()
    ends = (np.cumsum(np.bincount(at, minlength=len(table))) * ENTRY.itemsize).tolist()
    return [data[low:high] for low, high in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def counted(cells: np.ndarray, width: int) -> tuple[np.ndarray, list[bytes]]:
    """Rows with any cell (row * width + context, once for each count), ascending, and their entries; ``cells`` is sorted in place."""
    cells.sort()
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, dtype=np.int64)
    entries = np.empty(len(first), dtype=ENTRY)
    entries["n"] = np.diff(np.r_[first, len(cells)])
    found = cells[first]
    entries["context"] = found % width
    rows, sizes = np.unique(found // width, return_counts=True)
    data, ends = entries.tobytes(), (np.cumsum(sizes) * ENTRY.itemsize).tolist()
    return rows, [data[low:high] for low, high in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def unpacked(rows: list[bytes], width: int) -> np.ndarray:
    entries = np.frombuffer(b"".join(rows), dtype=ENTRY)
    at = np.repeat(np.arange(len(rows)), [len(r) // ENTRY.itemsize for r in rows])
    return np.bincount(at * width + entries["context"], weights=entries["n"], minlength=len(rows) * width).reshape(len(rows), width)


def block_classes(words: pd.DataFrame, label: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
    """The words of a block by number, and their classes: own ones (``class``), else those of their units."""
    words = words.sort_values("local")
    own = words["class"].to_numpy(dtype=np.float64, na_value=-1).astype(np.int64)
    return words, np.where(own >= 0, own, label[words["unit"].to_numpy(dtype=np.int64)])


def laid_out(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of texts laid end to end, and how many tokens each text has."""
    ids = [zlib.decompress(data) for data in rows["ids"]]
    return np.frombuffer(b"".join(ids), dtype="<i4"), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4


def gathered(training: DataFrame, lexicon: DataFrame, label: np.ndarray, classes: int) -> DataFrame:
    """(unit, key, class, contexts): sparse counts of each unit (key is -1) and of each word with contexts of its own (unit is -1)."""
    shared, width = training.sparkSession.sparkContext.broadcast(label), 2 * classes

    def tally(key, rows: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"unit": [], "key": [], "class": [], "part": []})
        words, c = block_classes(words, shared.value)
        own, unit = words["key"].to_numpy() >= 0, words["unit"].to_numpy(dtype=np.int64)
        keys, row = np.unique(np.where(own, -1 - np.arange(len(words)), unit), return_inverse=True)
        tokens = np.r_[0, laid_out(rows)[0]]
        at, context = row[tokens] * width, c[tokens]
        cells = np.empty(2 * (len(tokens) - 1), dtype=np.int64)
        np.add(at[1:], context[:-1], out=cells[: len(tokens) - 1])
        np.add(at[:-1], context[1:] + classes, out=cells[len(tokens) - 1 :])
        del at, context, tokens
        some, entries = counted(cells, width)
        keys = keys[some]
        at = np.where(keys < 0, -1 - keys, 0)
        found = pd.DataFrame({"unit": np.maximum(keys, -1), "key": np.where(keys < 0, words["key"].to_numpy()[at], -1)})
        found["class"], found["part"] = np.where(keys < 0, c[at], -1), entries
        return found

    def summed(batches):
        for batch in batches:
            rows = [b"".join(parts) for parts in batch["parts"]]
            yield batch[["unit", "key", "class"]].assign(contexts=packed(unpacked(rows, width)))

    words = lexicon.select("block", "local", "unit", F.coalesce("key", F.lit(-1)).alias("key"), "class")
    parts = training.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(tally, "unit int, key long, class int, part binary")
    return parts.groupBy("unit", "key", "class").agg(F.collect_list("part").alias("parts")).mapInPandas(summed, "unit int, key long, class int, contexts binary")


def shares(sums: np.ndarray) -> np.ndarray:
    """Logarithms of the shares of contexts before and after in each class, with one count more that is spread like all contexts."""
    half = sums.shape[1] // 2
    sides = []
    for x in (sums[:, :half], sums[:, half:]):
        spread = (x.sum(axis=0) + 1) / (x.sum() + half)
        sides.append((x + spread) / (x.sum(axis=1, keepdims=True) + 1))
    return np.log(np.concatenate(sides, axis=1))


def chosen(batch: pd.DataFrame, sums: np.ndarray | None, open_classes: int, table: np.ndarray) -> np.ndarray:
    """The class in which the contexts of each word are most likely; without ``sums`` the class it came with."""
    if sums is None:
        return batch["class"].to_numpy(dtype=np.int64)
    return np.argmax(table @ shares(sums)[:open_classes].T, axis=1)


def regrouped(words: DataFrame, before: np.ndarray | None, now: np.ndarray | None, classes: int, open_classes: int) -> tuple[np.ndarray, int]:
    """Context sums of the words' classes by the sums ``now``, and how many words had another class by those ``before``."""
    width = 2 * classes
    shared = words.sparkSession.sparkContext.broadcast((before, now))

    def totals(batches):
        old, new = shared.value
        out = np.zeros(classes * width + 1)
        for batch in batches:
            table = unpacked(batch["contexts"].tolist(), width)
            c = chosen(batch, new, open_classes, table)
            out[-1] += (c != chosen(batch, old, open_classes, table)).sum()
            for k in np.unique(c):
                out[k * width : (k + 1) * width] += table[c == k].sum(axis=0)
        at = np.flatnonzero(out)
        yield pd.DataFrame({"cell": at, "n": out[at].astype(np.int64)})

    out = np.zeros(classes * width + 1)
    for r in words.select("class", "contexts").mapInPandas(totals, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out[:-1].reshape(classes, width), int(out[-1])


def contexts(training: DataFrame, units: Units, classes: np.ndarray, count: int) -> np.ndarray:
    """units x 2 x count: how often each unit stands after (0) and before (1) a token of each context class."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast((units.frequent, units.shapes, classes))
    columns = [f"c{i}" for i in range(2 * count)]

    def tally(batches):
        frequent, shapes, classed = shared.value
        own, width = Units(frequent, shapes), 2 * count
        total = np.zeros(len(own) * width, dtype=np.int32)
        for batch in batches:
            texts = batch["text"]
            for low, high in slices(pc.utf8_length(texts).to_pylist(), AT_ONCE):
                words, tokens, _ = numbered(texts.slice(low, high - low))
                u = own.column(words)[np.r_[0, tokens]]
                c = classed[u]
                total += np.bincount(np.concatenate([u[1:] * width + c[:-1], u[:-1] * width + count + c[1:]]), minlength=len(total)).astype(np.int32)
        table = total.reshape(len(own), width)
        some = np.flatnonzero(table.any(axis=1))
        for at in range(0, len(some), 5000):
            part = some[at : at + 5000]
            cells = table[part]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *[pa.array(cells[:, i]) for i in range(width)]], names=["unit", *columns])

    rows = training.select("text").mapInArrow(tally, "unit int, " + ", ".join(f"{c} int" for c in columns))
    found = rows.groupBy("unit").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()  # one row per unit
    out = np.zeros((len(units), 2 * count))
    out[found["unit"].to_numpy(dtype=np.int64)] = found[columns].to_numpy(dtype=np.float64)
    return out


def x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(sums: np.ndarray) -> np.ndarray:
    """Log-likelihood of the contexts in each class, ``sums`` being theirs."""
    half = sums.shape[-1] // 2
    return x_log_x(sums).sum(axis=-1) - x_log_x(sums[..., :half].sum(axis=-1)) - x_log_x(sums[..., half:].sum(axis=-1))


def exchange(table: np.ndarray, start: np.ndarray, classes: int, sweeps: int | None = None, others: np.ndarray | None = None) -> np.ndarray:
    """Class of each unit: units move, most frequent first, to the class that gains most likelihood of their contexts, until none does.

    ``others`` are sums of what is in the classes besides.
    """
    label = start.copy()
    sums = np.zeros((classes, table.shape[1])) if others is None else others[:classes].copy()
    np.add.at(sums, label, table)
    worth = likelihood(sums)
    order = np.argsort(-table.sum(axis=1), kind="stable")
    order = order[table[order].any(axis=1)]
    least = 1e-9 + 1e-13 * float(x_log_x(sums.sum()))  # less is rounding

    def movable(order: np.ndarray):
        """Units that could move as the classes are when their turn is near; those that others set free come in the next sweep."""
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            rows, now = table[part], label[part]
            gain = likelihood(sums + rows[:, None]) - worth
            stay = worth[now] - likelihood(sums[now] - rows)
            gain[np.arange(len(part)), now] = stay
            yield from part[gain.max(axis=1) > stay + least].tolist()

    for _ in itertools.count() if sweeps is None else range(sweeps):
        moved = 0
        for u in movable(order):
            row = table[u]
            a = label[u]
            without = sums[a] - row
            there = likelihood(sums + row)
            gain = there - worth
            gain[a] = worth[a] - likelihood(without)
            b = int(np.argmax(gain))
            if b != a and gain[b] > gain[a] + least:
                sums[a], worth[a] = without, likelihood(without)
                sums[b] = sums[b] + row
                worth[b] = there[b]
                label[u] = b
                moved += 1
        if not moved:
            break
    return label


@dataclass
class ClassModel:
    units: Units
    classes: np.ndarray
    transitions: np.ndarray
    members: np.ndarray
    tokens: int
    vocabulary: int
    weight: float
    spare: float


def fit(texts: DataFrame, docs: DataFrame, words: DataFrame, scratch: Scratch, **settings) -> tuple[ClassModel, DataFrame]:
    """Model of the training texts, and the words of each block with number, training count, unit and class (null: that of the unit).

    ``texts``: training texts; ``docs`` and ``words``: rows of ``coded``; the settings are those of ``trained``. ``word`` is null for words without a class of their own.
    """
    model, lexicon, vocabulary = trained(texts, docs, words, scratch, **settings)
    return model, lexicon.join(vocabulary.select("key", "word"), "key", "left")


def trained(texts: DataFrame, docs: DataFrame, words: DataFrame, scratch: Scratch, classes: int = 32, share: float = 1e-5, shapes: int = 2048, least: int = 3,
        passes: int = 2, sweeps: int = 3, weight: float = 0.85, spare: float = 0.5) -> tuple[ClassModel, DataFrame, DataFrame]:
    """Model of the training texts, the words of each block with number, training count, unit, class and, if the class is their own, ``key``, and the table of all words."""
    spark = docs.sparkSession
    # a number for each word: that of one of its rows, of which a word has one in each block
    numbered = words.withColumn("key", F.monotonically_increasing_id())
    counts = scratch.write("counts", numbered.groupBy("word").agg(F.sum("n").alias("n"), F.min("key").alias("key")))
    known = counts.where("n > 0")
    totals = known.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = totals.n or 0, totals.v
    common = known.where((F.col("n") >= share * n) | (F.col("word") == F.lit(bytearray(END)))).orderBy(F.desc("n"), "word").collect()  # 1 / share at most
    units = Units({bytes(r.word): i for i, r in enumerate(common)}, shapes)
    head = spark.createDataFrame([(bytearray(r.word), i, r.n) for i, r in enumerate(common)], "word binary, unit int, n long")
    head = scratch.write("head", head)  # a table has a size, by which Spark decides to broadcast it
    ending = (F.crc32(F.expr("substring(word, -3, 3)")) % shapes + len(units.frequent)).cast("int")
    rest = counts.join(head.select("word"), "word", "left_anti")
    key = F.when(F.col("n") >= least, F.col("key")).alias("key")
    places = words.select("block", "local", "word")
    frequent = places.join(head, "word").select("block", "local", "n", "unit", F.lit(None).cast("long").alias("key"))
    others = places.join(head.select("word"), "word", "left_anti").join(counts, "word").select("block", "local", "n", ending.alias("unit"), key)
    lexicon = scratch.write("lexicon", frequent.unionByName(others))
    of_units = rest.where(F.col("n").between(1, least - 1)).groupBy(ending.alias("unit")).count().collect()  # one row per unit
    vocabulary = counts.where(F.col("n") >= least)
    training = docs.where(~F.col("held_out")).select("block", "ids")
    end, open_classes = units.of(END), max(1, classes - 1)  # the end of a text is a class of its own: no text has two

    def with_end(label: np.ndarray) -> np.ndarray:
        label = label.copy()
        label[end] = classes - 1
        return label

    # contexts of the first pass, over the ends of all words but the most frequent: the most frequent units, each for itself, and all others
    table = contexts(texts, units, np.minimum(np.arange(len(units)), classes - 1), classes)
    table[end] = 0
    label = with_end(exchange(table, np.arange(len(units)) % open_classes, open_classes, sweeps))
    current, assigned = lexicon.withColumn("class", F.lit(None).cast("int")), None
    for k in range(max(1, passes - 1)):
        found = scratch.write(f"contexts{k}", gathered(training, current, label, classes))
        rows = found.where("unit >= 0").toPandas()  # one row per unit
        table = np.zeros((len(units), 2 * classes))
        table[rows["unit"].to_numpy(dtype=np.int64)] = unpacked(rows["contexts"].tolist(), 2 * classes)
        table[end] = 0
        own, before, worth = found.where("unit < 0"), None, None
        # words of the first round come from their endings and have no say yet; the frequent ones make the classes
        others = regrouped(own, None, None, classes, open_classes)[0] if k else np.zeros((classes, 2 * classes))
        while True:
            label = with_end(exchange(table, np.where(np.arange(len(units)) == end, 0, label), open_classes, None, others))
            sums = others.copy()
            np.add.at(sums, label, table)
            others, moved = regrouped(own, before, sums, classes, open_classes)
            before, last = sums, worth
            worth = float(likelihood(sums).sum())
            # moves without gain are ties, which could go on for ever
            if not moved or (last is not None and worth - last <= 1e-12 * abs(worth)):
                break
        shared = spark.sparkContext.broadcast(before)

        def final(batches, shared=shared):
            for batch in batches:
                table = unpacked(batch["contexts"].tolist(), 2 * classes)
                yield pd.DataFrame({"key": batch["key"], "class": chosen(batch, shared.value, open_classes, table)})

        assigned = scratch.write(f"assigned{k}", own.mapInPandas(final, "key long, class int"))
        # rows without a key, a hot group, stay out of the join
        joined = lexicon.where("key is not null").join(assigned, "key", "left").select("block", "local", "n", "unit", "key", "class")
        current = scratch.write(f"classes{k}", joined.unionByName(lexicon.where("key is null").withColumn("class", F.lit(None).cast("int"))))
        scratch.drop(f"contexts{k}")
        if k:
            scratch.drop(f"classes{k - 1}", f"assigned{k - 1}")
    scratch.drop("lexicon")
    shared = spark.sparkContext.broadcast(label)

    def steps(key, rows: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"cell": [], "n": []})
        c = block_classes(words, shared.value)[1][np.r_[0, laid_out(rows)[0]]]
        out = np.bincount(c[:-1] * classes + c[1:], minlength=classes * classes)
        return pd.DataFrame({"cell": np.flatnonzero(out), "n": out[out > 0]})

    transitions, members = np.zeros(classes * classes), np.zeros(classes)
    pairs = training.groupBy("block").cogroup(current.select("block", "local", "unit", "class").groupBy("block")).applyInPandas(steps, "cell int, n long")
    for r in scratch.write("transitions", pairs.groupBy("cell").agg(F.sum("n").alias("n"))).collect():  # a table, so that the shuffles go
        transitions[r.cell] = r.n
    members += np.bincount(label[: len(common)], minlength=classes)  # each is known
    for r in of_units:
        members[label[r.unit]] += r["count"]
    for r in assigned.groupBy("class").count().collect():
        members[r["class"]] += r["count"]
    return ClassModel(units, label, transitions.reshape(classes, classes), members, int(n), int(v), weight, spare), current, vocabulary


def log_probabilities(model: ClassModel, words: list[bytes], counts: np.ndarray, classes: np.ndarray | None = None) -> np.ndarray:
    """log10 P of each token of texts laid end to end, each with its end; ``counts``: of each token in training; ``classes``: if not those of the units."""
    if classes is None:
        classes = model.classes[model.units.numbers(words)]
    before = np.r_[model.classes[model.units.of(END)], classes[:-1]]
    size = len(model.transitions)
    step = (model.transitions[before, classes] + 1) / (model.transitions.sum(axis=1)[before] + size)
    totals = model.transitions.sum(axis=0)
    # an end that nothing precedes in training still has a transition, as each text begins after one
    emission = np.where(counts > 0, np.maximum(counts - model.spare, 0), 0)
    left = totals - np.where(totals > 0, totals - model.spare * np.minimum(model.members, totals), 0)
    reserved = np.where(totals > 0, left, 1.0) / (model.members + 1)
    emission = (emission + reserved[classes]) / np.where(totals > 0, totals, 1.0)[classes]
    base = (counts + 1) / (model.tokens + model.vocabulary + 1)
    return np.log10(model.weight * step * emission + (1 - model.weight) * base)


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 16 << 20, **settings) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; rows not held out are learnt from."""
    texts = docs.withColumn("__held", F.coalesce(held_out, F.lit(False)))
    texts = texts.select("__held", F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumnRenamed("__held", "held_out")
    scratch = Scratch(docs.sparkSession)
    blocks = scratch.write("coded", coded(texts, block_bytes))
    coded_docs, words = blocks.where("ids is not null").select("block", "doc_id", "held_out", "ids"), blocks.where("word is not null").select("block", "local", "word", "n")
    model, lexicon, _ = trained(texts.where(~F.col("held_out")), coded_docs, words, scratch, **settings)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(key, rows: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        words, classes = block_classes(words, model.classes)
        tokens, n = laid_out(rows)
        count, begin = words["n"].to_numpy(dtype=np.float64), np.cumsum(n) - n
        known, base, logs = np.zeros(len(n), dtype=np.int64), np.zeros(len(n)), np.zeros(len(n))
        for low, high in slices(n, AT_ONCE // 8):  # every text begins after an end, so any can be scored by itself
            part = tokens[begin[low] : begin[high - 1] + n[high - 1]]
            c, at = count[part], begin[low:high] - begin[low]
            known[low:high] = np.add.reduceat((c > 0).astype(np.int64), at)
            base[low:high] = np.add.reduceat(np.log10((c + 1) / (model.tokens + model.vocabulary + 1)), at)
            logs[low:high] = np.add.reduceat(log_probabilities(model, [], c, classes[part]), at)
        done = pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").to_numpy(), "held_out": rows["held_out"].to_numpy(), "n_tokens": n})
        done["n_known"], done["train_tokens"], done["base_score"], done["score"] = known, model.tokens, base, logs
        return done

    pairs = coded_docs.groupBy("block").cogroup(lexicon.select("block", "local", "n", "unit", "class").groupBy("block"))
    return pairs.applyInPandas(scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(score: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score / n_tokens)
