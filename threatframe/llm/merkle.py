"""Merkle manifest of a data set: a tree of SHA-256 digests per group, over the groups a root, and a proof for every row.

A leaf is the digest of a row's columns. The leaves of a group stand in order of their ids; runs of ``arity`` neighbours become one
node until one is left, the group's subroot, and the subroots in order of their groups (null first, then by bytes) become the root the same way.

Places without sorting. Ids of a group are a compressed bitmap: words of 64 bits, of which only those with a bit are kept, made by
``bit_or`` per task and merged. A directory counts the rows under each word, under each 1,024 neighbouring words, and so on up until
the ids of all groups share one node, with the count of what lies before among at most 1,024 siblings. The place of a leaf is
the sum of the counts before on the way down to its word and the bits before its own. So no window holds more than 1,024
rows, however large a group is. A leaf's place over ``arity`` is the key of its run, the rest its slot; a level is an aggregation to
arrays of at most ``arity`` slots, which are at once what proofs need.

Null ids come first in their group, rows repeated by group and id follow by their leaf digest; equal ones among them are any order's
(their leaves are equal, each has a place). Their number is added to the counts; their order comes from counts per
four hexadecimal digits of the leaf, so that a repeated id with a third of all rows is no single task's. A group of one leaf is its
own subroot, one group's subroot the root. Other columns are not read. An empty table gives an empty result (and no root).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatframe.llm.common import unused
from threatframe.session import Scratch

WORD_BITS, FAN_BITS = 6, 10
#: Number of an id's word, from 0: words of negative ids come first, and all numbers meet in one node after some shifts.
WORD = f"shiftright(id, {WORD_BITS}) + {1 << (63 - WORD_BITS)}L"


def field(column: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon, and the value as text."""
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def before(keys: list[str], order: list[str]) -> Column:
    """Rows of siblings that come earlier."""
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))


def directory(leaves: DataFrame, tables: Scratch) -> DataFrame:
    """(grp, word, bits, n, base) of each word of the bitmaps: ``n`` rows, ``base`` rows with ids of earlier words."""
    bit = "shiftleft(1L, cast(id & 63 as int))"
    words = leaves.where("id is not null").groupBy("grp", F.expr(WORD).alias("word"))
    words = tables.write("words", words.agg(F.expr(f"bit_or({bit})").alias("bits"), F.count(F.lit(1)).alias("n")))
    ends = words.agg(F.min("word").alias("low"), F.max("word").alias("high")).first()
    low, high, levels = ends.low or 0, ends.high or 0, []
    level = words.select("grp", F.col("word").alias("key"), "n")
    while True:  # at most (64 - WORD_BITS) / FAN_BITS times
        known = level.withColumn("parent", F.expr(f"shiftright(key, {FAN_BITS})"))
        if low == high:  # one node a group
            break
        levels.append(tables.write(f"level{len(levels)}", known.select("grp", "key", "parent", "n", before(["grp", "parent"], ["key"]).alias("before"))))
        level = levels[-1].groupBy("grp", F.col("parent").alias("key")).agg(F.sum("n").alias("n"))
        low, high = low >> FAN_BITS, high >> FAN_BITS
    base = None
    for own in reversed(levels):
        if base is None:
            base = own.select("grp", "key", F.col("before").alias("base"))
        else:
            up = base.withColumnRenamed("key", "parent")
            base = own.join(up, ["grp", "parent"]).select("grp", "key", (F.col("base") + F.col("before")).alias("base"))
    if base is None:
        return words.withColumn("base", F.lit(0).cast("long"))
    return tables.write("directory", words.join(base.withColumnRenamed("key", "word"), ["grp", "word"]))


def order_of_copies(rows: DataFrame) -> DataFrame:
    """(row, turn): the place of each row among those of the same group and id, by leaf, then as they stand in the staged table."""
    rows = rows.select("grp", F.coalesce(F.col("id").cast("string"), F.lit("-")).alias("key"), "leaf", "row")
    rows = rows.withColumns({"part": F.shiftright("row", 33), "head": F.substring("leaf", 1, 4)})
    same = rows.groupBy("grp", "key", "head", "leaf", "part").agg(F.count(F.lit(1)).alias("n"))
    heads = same.groupBy("grp", "key", "head").agg(F.sum("n").alias("n")).select("grp", "key", "head", before(["grp", "key"], ["head"]).alias("first"))
    same = same.select("grp", "key", "head", "leaf", "part", before(["grp", "key", "head"], ["leaf", "part"]).alias("second"))
    within = F.row_number().over(Window.partitionBy("grp", "key", "head", "leaf", "part").orderBy("row")) - 1
    turned = rows.withColumn("third", within).join(same, ["grp", "key", "head", "leaf", "part"]).join(heads, ["grp", "key", "head"])
    return turned.select("row", (F.col("first") + F.col("second") + F.col("third")).alias("turn"))


def places(leaves: DataFrame, tables: Scratch) -> DataFrame:
    """``leaves`` (grp, id, row, leaf, ...) with ``place``: rows of the group before it."""
    words = directory(leaves, tables)
    nulls = leaves.where("id is null").groupBy("grp").agg(F.count(F.lit(1)).alias("nulls"))
    lower = "bits & ~shiftleft(-1L, cast(id & 63 as int))"
    plain = leaves.where("id is not null").withColumn("word", F.expr(WORD))
    found = plain.join(words, ["grp", "word"]).withColumn("place", F.expr(f"base + bit_count({lower})"))
    some_null = not nulls.isEmpty()
    if some_null:
        found = found.join(nulls, "grp", "left").withColumn("place", F.col("place") + F.coalesce("nulls", F.lit(0)))
    odd = words.where("n <> bit_count(bits)").select("grp", "word")
    if not some_null and odd.isEmpty():
        return found.select(*leaves.columns, "place")

    # words with repeated ids: copies of lower ids of the word beyond the first, and the order of a row's own copies
    doubled = plain.join(odd, ["grp", "word"]).groupBy("grp", "word", "id").agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0")
    extra = doubled.groupBy("grp", "word").agg(F.collect_list(F.struct("id", "n")).alias("extra"))  # at most 64 a word
    added = F.aggregate(F.filter("extra", lambda x: x["id"] < F.col("id")), F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    found = found.join(extra, ["grp", "word"], "left").withColumn("place", F.col("place") + F.coalesce(added, F.lit(0)))
    copies = leaves.where("id is not null").join(doubled.select("grp", "id"), ["grp", "id"], "left_semi")
    turns = order_of_copies(copies.select("grp", "id", "leaf", "row").unionByName(leaves.where("id is null").select("grp", "id", "leaf", "row")))
    found = found.select(*leaves.columns, "place").unionByName(leaves.where("id is null").select("*", F.lit(0).cast("long").alias("place")))
    return found.join(turns, "row", "left").withColumn("place", F.col("place") + F.coalesce("turn", F.lit(0))).select(*leaves.columns, "place")


def slots(nodes: DataFrame, arity: int, place: str, *inside: str) -> DataFrame:
    """(grp, run, kids): the nodes of each run in an array by slot."""
    kid = F.struct(F.pmod(F.col(place), F.lit(arity)).alias("slot"), *inside)
    runs = nodes.groupBy("grp", F.floor(F.col(place) / arity).alias("run"))
    return runs.agg(F.sort_array(F.collect_list(kid)).alias("kids"))


def digest_of(kids: str, part: str) -> Column:
    return F.sha2(F.array_join(F.col(f"{kids}.{part}"), ""), 256)


def higher(nodes: DataFrame, most: int, arity: int, tables: Scratch, name: str) -> list[DataFrame]:
    """Levels above ``nodes`` (grp, i, h, n; n: nodes of the group on this level, ``most`` at most): (grp, i, h, n, kids), lowest first."""
    levels = []
    while most > 1:
        parents = slots(nodes.where("n > 1"), arity, "i", "h", "n").withColumn("n", F.ceil(F.col("kids")[0]["n"] / arity))
        levels.append(tables.write(f"{name}{len(levels)}", parents.select("grp", F.col("run").alias("i"), digest_of("kids", "h").alias("h"), "n", F.expr("kids.h").alias("kids"))))
        nodes, most = levels[-1].select("grp", "i", "h", "n"), -(-most // arity)
    return levels


def beside(kids: str, at: str) -> Column:
    """What stands left and right of the digest in place ``at`` (from 0) of an array of digests."""
    left = F.array_join(F.slice(F.col(kids), F.lit(1), F.col(at)), "")
    right = F.array_join(F.slice(F.col(kids), F.col(at) + 2, F.size(kids)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def paths(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """(grp, i, subroot, path) of the lowest level's kids. ``tops``: (grp, height, subroot, path), the path from the subroot on."""
    above = None
    for k in reversed(range(len(levels))):
        here = tops.where(F.col("height") == k + 1).select("grp", F.lit(0).cast("long").alias("i"), "subroot", "path")
        known = here if above is None else above.unionByName(here)
        each = levels[k].select("grp", "i", "kids").join(known, ["grp", "i"]).select("grp", "i", "kids", "subroot", "path", F.posexplode("kids").alias("at", "h"))
        above = each.select("grp", (F.col("i") * arity + F.col("at")).alias("i"), "subroot", F.concat(F.array(beside("kids", "at")), "path").alias("path"))
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda acc, step: F.sha2(F.concat(step["left"], acc, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on the path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def ranked_groups(groups: DataFrame, tables: Scratch) -> DataFrame:
    """``groups`` (grp, h) with their number ``i`` by the bytes of ``grp``; range partitions are counted, so there may be any number of them."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = tables.write("groups", groups.repartitionByRange(n, "grp").withColumn("part", F.spark_partition_id()))
    firsts = parted.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before([], ["part"]).alias("first"))  # one row a partition
    within = F.row_number().over(Window.partitionBy("part").orderBy("grp")) - 1
    return parted.withColumn("within", within).join(firsts, "part").select("grp", "h", (F.col("first") + F.col("within")).alias("i"))


def manifest(docs: DataFrame, columns: list[str], changed: Column | None = None, group_col: str = "source", id_col: str = "doc_id", arity: int = 16) -> DataFrame:
    """One row per row of ``docs``: grp (``=`` and the group, empty for null), id, place, leaf, changed, subroot, root, path (of siblings left and right).

    ``columns`` make the leaf; ``changed`` is a column carried along, such as a leaf seen elsewhere.
    """
    tables = Scratch(docs.sparkSession)
    row = unused(docs, "row")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    seen = F.lit(None).cast("string") if changed is None else changed
    leaves = tables.write("leaves", rows.select(group.alias("grp"), F.col(id_col).cast("long").alias("id"), F.col(row).alias("row"), leaf_of([F.col(c) for c in columns]).alias("leaf"), seen.alias("changed")))

    sizes = tables.write("sizes", leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
    runs = slots(places(leaves, tables), arity, "place", "id", "leaf", "changed").join(sizes, "grp")
    runs = tables.write("runs", runs.select("grp", F.col("run").alias("i"), "n", "kids", digest_of("kids", "leaf").alias("h")))
    tables.drop("leaves", "words", "directory")
    most = sizes.agg(F.max("n")).first()[0] or 0
    level_sizes, height = [], 0
    while most > 1:
        most, height = -(-most // arity), height + 1
        level_sizes.append(most)

    # subroots: of a lone leaf itself, else the last node left
    first = runs.where("n > 1").select("grp", "i", "h", F.ceil(F.col("n") / arity).alias("n"))
    levels = higher(first, level_sizes[0], arity, tables, "inner") if level_sizes else []
    lone = runs.where("n = 1").select("grp", F.col("kids")[0]["leaf"].alias("h"), F.lit(0).alias("height"))
    ends = [x.where("n = 1").select("grp", "h", F.lit(k + 1).alias("height")) for k, x in enumerate([first, *levels])]
    subroots = tables.write("subroots", reduce(DataFrame.unionByName, ends, lone))

    # the same over the groups
    numbered = tables.write("numbered", ranked_groups(subroots.select("grp", "h"), tables).withColumnRenamed("grp", "name"))
    count = numbered.count()
    nodes = numbered.select(F.lit("").alias("grp"), "i", "h", F.lit(count).cast("long").alias("n"))
    outer = higher(nodes, count, arity, tables, "outer")
    top = (outer[-1] if outer else numbered).select("h").first()
    root = F.lit(top.h if top else None).cast("string")
    none = F.array().cast("array<struct<left:string,right:string>>")
    if outer:
        start = docs.sparkSession.range(1).select(F.lit("").alias("grp"), F.lit(len(outer)).alias("height"), root.alias("subroot"), none.alias("path"))
        named = numbered.join(paths(outer, start, arity).select("i", "path"), "i").select(F.col("name").alias("grp"), "path")
    else:
        named = numbered.select(F.col("name").alias("grp"), none.alias("path"))
    tops = tables.write("tops", subroots.join(named, "grp").select("grp", "height", F.col("h").alias("subroot"), "path"))

    # down to the runs, then to their leaves; runs are on level 1, so the levels above them are from 2 on
    own = tops.where("height < 2").select("grp", F.lit(0).cast("long").alias("i"), "subroot", "path")
    if levels:
        own = own.unionByName(paths(levels, tops.withColumn("height", F.col("height") - 1), arity))
    each = runs.join(own, ["grp", "i"]).select("grp", "i", "n", "subroot", "path", F.expr("kids.leaf").alias("hashes"), F.posexplode("kids").alias("at", "kid"))
    path = F.when(F.col("n") > 1, F.concat(F.array(beside("hashes", "at")), "path")).otherwise(F.col("path"))
    return each.select("grp", F.col("kid.id").alias("id"), (F.col("i") * arity + F.col("at")).alias("place"), F.col("kid.leaf").alias("leaf"), F.col("kid.changed").alias("changed"),
                       "subroot", root.alias("root"), path.alias("path"))
