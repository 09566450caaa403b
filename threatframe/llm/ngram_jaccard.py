"""Near duplicates by Jaccard similarity of word n-grams: a join with adaptive multi-match prefixes.

A document's set are the hashes (64 bit) of its distinct n-grams of lower-cased (A-Z) words, words being runs of anything but ASCII white space; fewer
than n words are one n-gram. Equal sets are one class from the start. Under one order of all n-grams, two sets of
similarity t or more share l n-grams among the first |x| - ceil(t |x|) + l of each: the l-prefix. Every set gets its own l:
a longer prefix costs more shared n-grams to list, but asks for more of them before a pair is verified, so l is
where the estimated cost (entries listed, plus pairs to verify) is least. A pair must share as many as the smaller l of the two.

Order. n-grams are ordered by hash, which spreads them evenly, in three ranks. Document frequencies are counted exactly for
the third with the smallest hashes (``counted``); those with ``frequent`` or more go last, by frequency. The others of the
third come first, so that most sets need no n-gram beyond it. Sets that do (short ones, or those made of passages that many
share) are read again in full; the rest of their n-grams come between, frequent ones among them (counted over such sets) last as well.

Pairs. A list of a shared n-gram is never paired with itself first. In each of ``stars`` rounds all sets of a list are paired
with its most central one only (whose n-grams occur in most other sets), verified, and merged into classes. What is left are lists
with several classes; their pairs across classes are all joined, counted and verified, so no link between classes is lost.
A shared n-gram is only listed for a pair where its places in both sets leave room for enough others (``possible``).

Null text is empty; without words a set is empty and linked with nothing. Rows repeated with id and text are rows of one
class. Null ids are larger than any other. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatframe.llm.common import id_and_text, slices, unused
from threatframe.llm.graph import components
from threatframe.llm.url_filter import block_and_masks, build_filter
from threatframe.session import Scratch, stage

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
LONGEST, VERIFY_COST = 4, 10.0
REMEMBERED, LONG, AT_ONCE, FILTER_BYTES = 300_000, 64, 1_000_000, 64 << 20


class Words(dict):
    """64-bit hash of each word met; long ones, which hardly repeat, are not remembered."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG:
            self[word] = code
        return code


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(texts: list[str], n: int, words: Words) -> list[np.ndarray]:
    """Sorted distinct hashes (uint64) of each text's n-grams."""
    if len(words) > REMEMBERED:
        words.clear()
    tokens = [t.encode("utf-8", "replace").lower().split() for t in texts]
    codes = np.fromiter(map(words.__getitem__, itertools.chain.from_iterable(tokens)), dtype=np.uint64, count=sum(map(len, tokens)))
    h = np.full(max(0, len(codes) - n + 1), n, dtype=np.uint64)
    for i in range(n):
        h = h * MULTIPLIER + codes[i : i + len(h)]
    h, out, at = mixed(h), [], 0
    for ws in tokens:
        if len(ws) >= n:
            out.append(np.unique(h[at : at + len(ws) - n + 1]))
        elif ws:  # a short text is one n-gram of its own length
            one = np.full(1, len(ws), dtype=np.uint64)
            for code in codes[at : at + len(ws)]:
                one = one * MULTIPLIER + code
            out.append(mixed(one))
        else:
            out.append(h[:0])
        at += len(ws)
    return out


def shingled(docs: DataFrame, n: int, share: float | None, wanted=None) -> DataFrame:
    """doc_id, mark, n_shingles, digest of every row, and ``head``: all hashes, or those below ``share`` of their range.

    ``wanted``, a broadcast Bloom filter over the hash of ids, leaves out rows that it can't hold."""
    bound = np.uint64(int(share * 2**63) * 2) if share else None

    def rows(batches):
        words = Words()
        for batch in batches:
            if wanted is not None:
                batch = batch[holds(wanted.value, batch["key"].to_numpy())]
            texts = batch["text"].tolist()
            for low, high in slices([len(t) for t in texts], AT_ONCE):
                sets = shingles(texts[low:high], n, words)
                heads = [(s if bound is None else s[: np.searchsorted(s, bound)]).view(np.int64) for s in sets]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[low:high].astype("Int64"), "mark": batch["mark"].iloc[low:high], "n_shingles": np.array([len(s) for s in sets], dtype=np.int64), "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "head": heads})

    return docs.mapInPandas(rows, "doc_id long, mark long, n_shingles long, digest binary, head array<long>")


def unsigned(column):
    """Long column moved so that its order is the unsigned one."""
    return column.bitwiseXOR(F.lit(-(2**63)))


def prefix_plans(n: np.ndarray, owner: np.ndarray, places: np.ndarray, dfs: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """l and prefix length of sets of ``n`` n-grams, of which those at ``places`` of the order are in ``dfs`` sets; ``owner``: the set of each."""
    base = n - -(-percent * n // 100)
    most = np.maximum(1, np.minimum(LONGEST, n - base))
    costs = np.full((LONGEST, len(n)), np.inf)
    for k in range(1, LONGEST + 1):
        inside = places < base[owner] + k
        listed = np.bincount(owner[inside], weights=dfs[inside] - 1.0, minlength=len(n))
        costs[k - 1] = np.where(k <= most, listed * (1 + VERIFY_COST / k), np.inf)
    best = 1 + np.argmin(costs, axis=0)
    return best, base + best


def postings(sets: DataFrame, percent: int) -> DataFrame:
    """(h, uid, n, l, central, at) of each n-gram in a set's prefix that several sets have; ``at`` is its place in the order. ``sets``: uid, n, k (how many of its
    n-grams have a place), known array<struct<h, df, rank, place>>: those of several sets, with their place by hash."""

    def listed(batches):
        for batch in batches:
            for low, high in slices(batch.column(3).value_lengths().to_pylist(), AT_ONCE):
                part = batch.slice(low, high - low)
                uid, n, size = (part.column(i).to_numpy() for i in range(3))
                known = part.column(3).flatten()
                h, df, rank, place = (known.field(c).to_numpy(zero_copy_only=False) for c in ("h", "df", "rank", "place"))
                owner = np.repeat(np.arange(len(n)), part.column(3).value_lengths().to_numpy())
                # frequent ones leave their places and follow all others, by frequency, then hash
                order = np.lexsort((place, owner))
                h, df, last, place, owner = h[order], df[order], rank[order] == 2, place[order], owner[order]
                frequent = np.bincount(owner, weights=last, minlength=len(n)).astype(np.int64)
                final = place - (np.cumsum(last) - (np.cumsum(frequent) - frequent)[owner])
                behind = np.flatnonzero(last)
                behind = behind[np.lexsort((h[behind].view(np.uint64), df[behind], owner[behind]))]
                whose = owner[behind]
                final[behind] = (size - frequent)[whose] + np.arange(len(behind)) - (np.cumsum(frequent) - frequent)[whose]
                matches, length = prefix_plans(n, owner, final, df, percent)
                central = np.bincount(owner, weights=np.log(df), minlength=len(n)) / size
                chosen = final < length[owner]
                who = owner[chosen]
                columns = [h[chosen], uid[who], n[who], matches[who].astype(np.int32), central[who], final[chosen]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "uid", "n", "l", "central", "at"])

    return sets.selectExpr("uid", "n", "cast(k as long) as k", "known").mapInArrow(listed, "h long, uid long, n long, l int, central double, at long")


def possible(percent: int) -> str:
    """Condition on a shared n-gram of two sets (n, l, at and m, k, to: size, own l and its place) that holds for the first n-grams
    a similar pair shares. Such a pair shares ``least`` n-grams or more. Those before the place and those after it bound what can
    be shared; and as many as are asked for lie where enough others can follow in both sets."""
    least = f"(({percent} * (n + m) + {99 + percent}) div {100 + percent})"
    follow = f"at < n - {least} + least(l, k) and to < m - {least} + least(l, k)"
    return f"100 * least(n, m) >= {percent} * greatest(n, m) and {follow} and least(at, to) + 1 + least(n - at - 1, m - to - 1) >= {least}"


COUNTED = 0.34


def shared_places(sets: DataFrame, column: str, several: DataFrame, first_place: int = 0) -> DataFrame:
    """(uid, h, df, rank, place) of the n-grams in ``column`` (sorted) that ``several`` (h, df, rank) has; a Bloom filter over
    these keeps most others out of the shuffle."""
    words = sets.sparkSession.sparkContext.broadcast(build_filter(several.select("h"), 12, FILTER_BYTES))

    def possible(batches):
        for batch in batches:
            sizes = batch[column].map(len).to_numpy()
            if not sizes.sum():
                continue
            h = np.concatenate(batch[column].to_numpy()).astype(np.int64)
            begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
            uid, place = np.repeat(batch["uid"].to_numpy(), sizes), np.arange(len(h)) - begin
            hit = holds(words.value, h)
            yield pd.DataFrame({"uid": uid[hit], "h": h[hit], "place": place[hit]})

    return sets.select("uid", column).mapInPandas(possible, "uid long, h long, place long").join(several, "h")


def link(docs: DataFrame, n: int = 5, percent: int = 75, frequent: int = 64, stars: int = 2, id_col: str = "doc_id", text_col: str = "text",
         marked: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id (if ``marked``, also the text's hash) of every row; documents link at 100 * shared >= percent * united n-grams."""
    texts = id_and_text(docs, id_col, text_col).withColumns({"mark": F.xxhash64("text"), "key": F.xxhash64("doc_id")})
    tables = Scratch(docs.sparkSession)
    first = tables.write("first", shingled(texts, n, COUNTED))
    light = stage(first.drop("head"))
    sets = first.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("head").alias("tokens"))
    sets = tables.write("sets", sets.withColumns({"uid": F.monotonically_increasing_id(), "k": F.size("tokens")}))
    tables.drop("first")
    names = tables.write("names", sets.select("uid", "n", "k", "digest", "first_id"))

    # frequencies within the counted third, and the n-grams of it that several sets have
    entries = sets.select(F.explode("tokens").alias("h"))
    several = tables.write("several", entries.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1").withColumn("rank", F.when(F.col("df") >= frequent, 2).otherwise(0)))
    entry = F.struct("h", "df", "rank", "place")
    known = tables.write("known", shared_places(sets, "tokens", several).groupBy("uid").agg(F.collect_list(entry).alias("known"), F.sum(F.when(F.col("rank") == 2, 1).otherwise(0)).alias("last")))
    tables.drop("sets", "several")
    none = F.array().cast("array<struct<h:bigint,df:bigint,rank:int,place:bigint>>")
    joined = names.join(known, "uid", "left")
    needed = F.col("n") - F.ceil(F.col("n") * percent / 100) + F.least(F.lit(LONGEST), F.ceil(F.col("n") * percent / 100))
    inside = F.col("k") - F.coalesce("last", F.lit(0)) >= needed
    enough = joined.where(inside & F.col("known").isNotNull())
    short = tables.write("short", joined.where(~inside).select("uid", "n", "digest", "first_id", F.coalesce("known", none).alias("known")))

    # the others in full
    full = tables.write("full", full_sets(texts, short.select("uid", "digest", "first_id"), n))
    bound = int(COUNTED * 2**63) * 2 - 2**63
    beyond = full.select(F.explode("tokens").alias("h")).where(unsigned(F.col("h")) >= F.lit(bound))
    again = beyond.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1").withColumn("rank", F.when(F.col("df") >= frequent, 2).otherwise(1))
    more = shared_places(full, "tokens", tables.write("again", again)).groupBy("uid").agg(F.collect_list(entry).alias("more"))
    lacking = short.join(more, "uid", "left").select("uid", "n", F.col("n").alias("k"), F.concat("known", F.coalesce("more", none)).alias("known")).where("size(known) > 0")
    lists = tables.write("postings", postings(enough, percent).unionByName(postings(lacking, percent)))
    tables.drop("known", "short", "full", "again")
    several = lists.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h")
    lists = tables.write("lists-0", lists.join(several, "h").withColumn("c", F.col("uid")))
    tables.drop("postings")

    links, classed = None, None
    for turn in range(stars + 1):
        centre = F.max(F.struct(F.col("central"), (-F.col("uid")).alias("uid"), "n", "l", "c", "at"))
        several = tables.write("centres", lists.groupBy("h").agg(centre.alias("p"), F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("h", "p"))
        if turn < stars:
            pairs = lists.join(several, "h").select(F.col("uid").alias("x"), "n", "l", "c", "at", F.col("p.at").alias("to"), (-F.col("p.uid")).alias("y"), F.col("p.n").alias("m"), F.col("p.l").alias("k"), F.col("p.c").alias("d"))
        else:
            still = tables.write("still", lists.join(several.select("h"), "h", "left_semi").select("h", "uid", "n", "l", "c", "at"))
            right = still.select("h", F.col("uid").alias("y"), F.col("n").alias("m"), F.col("l").alias("k"), F.col("c").alias("d"), F.col("at").alias("to"))
            pairs = still.withColumnRenamed("uid", "x").join(right, "h").where("x < y")
        pairs = pairs.where("c <> d").where(possible(percent))
        pairs = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared"), F.first("n").alias("n"), F.first("m").alias("m"), F.least(F.first("l"), F.first("k")).alias("asked"))
        pairs = tables.write("pairs", pairs.where("shared >= asked").select("x", "y", "n", "m"))
        ids = pairs.select(F.col("x").alias("uid")).unionByName(pairs.select(F.col("y").alias("uid"))).distinct()
        tokens = tables.write("tokens", full_sets(texts, tables.write("wanted", names.select("uid", "digest", "first_id").join(ids, "uid")), n))
        new = verify(pairs, tokens, percent)
        links = tables.write(f"links-{turn}", new if links is None else links.unionByName(new))
        tables.drop("pairs", "wanted", "tokens", "still", f"links-{turn - 1}")
        classed = stage(components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))))
        if turn < stars:
            # classes only grow: a list that is one class by now stays one and need not be carried on
            named = lists.drop("c").join(several.select("h"), "h", "left_semi").join(classed.withColumnRenamed("node", "uid"), "uid", "left")
            lists = tables.write(f"lists-{turn + 1}", named.withColumn("c", F.coalesce("component", "uid")).drop("component"))
        tables.drop(f"lists-{turn}", "centres")

    members = names.select("uid", "digest", "first_id").join(classed.withColumnRenamed("node", "uid"), "uid", "left").withColumn("c", F.coalesce("component", "uid"))
    members = tables.write("members", members.select("digest", "first_id", "c"))
    least = tables.write("least", members.groupBy("c").agg(F.min("first_id").alias("component_id")))
    by_digest = stage(members.join(least, "c").select("digest", "component_id"))
    tables.drop("names", f"links-{stars}", "members", "least")
    out = light.join(by_digest, "digest", "left")
    return out.select("doc_id", *(["mark"] if marked else []), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def full_sets(texts: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(uid, tokens) of the sets ``wanted`` (uid, digest, first_id), from a document that has the set. A Bloom filter over the
    ids picks the documents, so that texts are not shuffled; the join by digest is exact."""
    words = build_filter(wanted.select(F.xxhash64("first_id").alias("h")), 16, FILTER_BYTES)
    found = shingled(texts, n, None, texts.sparkSession.sparkContext.broadcast(words)).select("digest", F.col("head").alias("tokens"))
    one = found.join(wanted.select("digest", "uid"), "digest")
    return one.groupBy("uid").agg(F.first("tokens").alias("tokens"))


def holds(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter may hold."""
    block, masks = block_and_masks(hashes, len(words))
    return ((words[block] & masks) == masks).all(axis=1)


def verify(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """(x, y) of the pairs (x, y, n, m) that are similar enough."""
    left = pairs.join(tokens.select(F.col("uid").alias("x"), F.col("tokens").alias("tx")), "x")
    both = left.join(tokens.select(F.col("uid").alias("y"), F.col("tokens").alias("ty")), "y")
    common = F.size(F.array_intersect("tx", "ty"))
    return both.where(100 * common >= percent * (F.col("n") + F.col("m") - common)).select("x", "y")


def keep_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with one document of each class: the one with the smallest id. Documents without words stay. Of rows
    repeated with id and text the first stays; rows that share an id, but not their text, are told apart."""
    linked = link(docs, id_col=id_col, text_col=text_col, marked=True, **settings)
    id_key, mark = unused(docs, "dropped"), unused(docs, "mark")
    staying = F.col("doc_id").eqNullSafe(F.col("component_id"))
    dropped = stage(linked.where(~staying).select(F.col("doc_id").alias(id_key), F.col("mark").alias(f"{mark}_dropped")).distinct())
    rows = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = rows.join(dropped, F.col(id_col).eqNullSafe(F.col(id_key)) & (F.col(mark) == F.col(f"{mark}_dropped")), "left_anti")
    if not linked.where(staying).groupBy("doc_id", "mark").count().where("count > 1").isEmpty():
        rows = rows.dropDuplicates([id_col, mark])
    return rows.drop(mark)
