"""URL filter: a blocked Bloom filter over listed canonical URLs, then an exact hash join that removes false positives.

A canonical URL is its host (after ``://``, A-Z lower-cased) and path, without query and fragment. Entries are rules
(host, path, verdict), which fit the host with all subdomains and every path that starts with theirs, and listed URLs,
which are blocked as a whole. From each distinct URL come the keys it could match, one per shape (number of host labels,
length of path) that the rules have; keys the filter can't hold go at once, the others meet the entries in a join.

The longest rule wins (of equally long ones the first by text). Without a rule a listed URL is blocked, any other allowed.
A null URL or one without ``://`` has an empty host and path and no rule. Repeated rows are each judged; an empty page
table gives an empty result, an empty rule table allows all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from threatframe.llm.common import lower_ascii
from threatframe.session import stage

# odd multipliers of split-block filters (fixed values of the public Parquet format)
SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], dtype=np.uint32)
WORDS = [f"w{i}" for i in range(8)]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def block_and_masks(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number and the eight one-bit words of each 64-bit hash."""
    h = hashes.astype(np.int64).view(np.uint64)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    bits = (low[:, None] * SALTS[None, :]) >> np.uint32(27)
    return block.astype(np.int64), np.uint32(1) << bits


def build_filter(hashes: DataFrame, bits_per_key: int, max_bytes: int) -> np.ndarray:
    """Filter words (blocks x 8) over the column ``h``. Built in tasks; the driver gets ``max_bytes`` at most, and more keys
    than that has room for only mean more false positives, which the join removes."""
    keys = hashes.count()
    blocks = int(min(max(1, keys * bits_per_key // 256 + 1), max(1, max_bytes // 32)))

    def partial(batches):
        for batch in batches:
            block, masks = block_and_masks(batch["h"].to_numpy(), blocks)
            yield pd.DataFrame({"block": block, **{w: masks[:, i].astype(np.int64) for i, w in enumerate(WORDS)}})

    rows = hashes.mapInPandas(partial, "block long, " + ", ".join(f"{w} long" for w in WORDS))
    merged = rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS]).toPandas()
    words = np.zeros((blocks, 8), dtype=np.uint32)
    words[merged["block"].to_numpy(dtype=np.int64)] = merged[WORDS].to_numpy(dtype=np.int64).astype(np.uint32)
    return words


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          bits_per_key: int = 16, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. ``rules``: host, path, verdict; ``listed``: url."""
    spark = pages.sparkSession
    rule = F.concat("host", "path")
    entries = rules.select(F.concat(F.lit("r"), rule).alias("key"), rule.alias("rule"), "verdict").where("rule is not null").groupBy("key", "rule").agg(F.max("verdict").alias("verdict"))
    if listed is not None:
        whole = listed.select(F.concat(F.lit("u"), host_of(F.col("url")), path_of(F.col("url"))).alias("key"), F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict")).where("key <> 'u'")
        entries = entries.unionByName(whole.distinct())
    entries = stage(entries)
    # few even for long rule lists: at most (labels of a host) x (distinct lengths of a path)
    shapes = rules.where("host is not null and path is not null").select(F.size(F.split("host", r"\.")).alias("n"), F.length("path").alias("l")).distinct().collect()
    words = build_filter(entries.select(F.xxhash64("key").alias("h")), bits_per_key, max_filter_bytes)
    shared = spark.sparkContext.broadcast(words)

    @pandas_udf("boolean")
    def may_hold(hashes: pd.Series) -> pd.Series:
        block, masks = block_and_masks(hashes.to_numpy(), len(shared.value))
        return pd.Series(((shared.value[block] & masks) == masks).all(axis=1))

    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    labels = F.size(F.split("host", r"\."))
    keys = [F.when((labels >= s.n) & (F.length("path") >= s.l), F.concat(F.lit("r"), F.substring_index("host", ".", -s.n), F.substring("path", 1, s.l))) for s in shapes]
    keys.append(F.when(F.col("host") != "", F.concat(F.lit("u"), "host", "path")) if listed is not None else F.lit(None).cast("string"))
    found = rows.select("host", "path").distinct().select("host", "path", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    found = found.where(may_hold(F.xxhash64("key"))).join(entries, "key")
    # smallest of (-length, text) is the longest rule; a listed URL comes after every rule
    order = F.struct(F.coalesce(-F.length("rule"), F.lit(1)).alias("rank"), "rule", "verdict")
    best = stage(found.groupBy("host", "path").agg(F.min(order).alias("best")).select("host", "path", "best.rule", "best.verdict"))
    return rows.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
