"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosine, connected components.

Each table hashes a vector to the signs of its products with ``bits`` random planes. Bits grow with the logarithm of the
number of vectors, and tables are as many as find a pair at the threshold with probability ``recall`` (closer ones more
surely). Vectors of one label and length that share a bucket are compared exactly, in double precision, and only in the first table
they share, which their signatures tell, so that links are counted once without listing pairs. Buckets with over ``block`` rows
are cut into blocks, and every pair of blocks is a task's work of its own: a bucket with a third of all rows is spread out, whole.
What leaves a task is, per vector, a count and one edge to the first of its class there.

A vector that is null, empty, zero or has null or non-finite components, or whose label or id is null, links with nothing. Rows equal
in all three columns count and are returned once. Without a link a vector is its own component; a null id has a null one. An
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatframe.llm.graph import components
from threatframe.session import stage

PAIRS_AT_ONCE = 50_000


def layout(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Planes per table and tables, for so many vectors."""
    bits = min(28, max(6, math.ceil(math.log2(max(rows, 1) / 64 + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def signatures(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """rows x tables of int32."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).normal(size=(vectors.shape[1], tables * bits))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype("<i4")


def linked_pairs(run: np.ndarray, ids: np.ndarray, block: np.ndarray, crossed: np.ndarray, table: np.ndarray, signs: np.ndarray, vectors: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the linked pairs within runs of equal ``run`` (sorted)."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    left, right, at = [], [], np.arange(len(run))
    distance = 1
    while True:
        at = at[at + distance < len(run)]
        at = at[run[at] == run[at + distance]]
        if not len(at):
            break
        i, j = at, at + distance
        fit = (ids[i] != ids[j]) & (~crossed[i] | (block[i] != block[j]))
        i, j = i[fit], j[fit]
        for a in range(0, len(i), PAIRS_AT_ONCE):
            p, q = i[a : a + PAIRS_AT_ONCE], j[a : a + PAIRS_AT_ONCE]
            earlier = (signs[p] == signs[q]) & (np.arange(signs.shape[1])[None, :] < table[p][:, None])
            fresh = ~earlier.any(axis=1)
            p, q = p[fresh], q[fresh]
            cosine = np.einsum("ij,ij->i", vectors[p], vectors[q]) / (norms[p] * norms[q])
            left.append(p[cosine >= threshold])
            right.append(q[cosine >= threshold])
        distance += 1
    none = np.array([], dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def classes(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest place reachable from each of n places by the pairs (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.9995, block: int = 1024, seed: int = 11,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label")).dropDuplicates()
    rows = stage(rows.withColumn("uid", F.monotonically_increasing_id()))
    usable = rows.where("vec_id is not null and label is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('inf')) and exists(v, x -> x <> 0)")
    bits, tables = layout(rows.count(), threshold, recall)

    def signed(batches):
        for batch in batches:
            sizes = batch["v"].map(len)
            for _, part in batch.groupby(sizes, sort=False):
                matrix = np.stack(part["v"].to_numpy())
                matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # same angles; squares stay finite
                signs = signatures(matrix, bits, tables, seed)
                yield pd.DataFrame({"uid": part["uid"], "vec_id": part["vec_id"], "label": part["label"], "v": [m.tobytes() for m in matrix], "signs": [s.tobytes() for s in signs], "buckets": list(signs)})

    prepared = stage(usable.mapInPandas(signed, "uid long, vec_id long, label string, v binary, signs binary, buckets array<int>"))
    places = prepared.select("uid", "label", F.length("v").alias("size"), F.posexplode("buckets").alias("t", "bucket"))
    key = ["label", "size", "t", "bucket"]
    sizes = stage(places.groupBy(*key).count().where("count > 1").select(*key, F.ceil(F.col("count") / block).alias("blocks")))
    full = prepared.select("uid", "vec_id", "label", "v", "signs", F.length("v").alias("size"), F.posexplode("buckets").alias("t", "bucket")).join(sizes, key)
    full = full.withColumn("own", F.pmod(F.xxhash64("uid"), "blocks"))
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    full = full.select(*key, F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "uid", "vec_id", "v", "signs")
    order = [*key, "b1", "b2"]

    def compare(batches):
        def work(frame: pd.DataFrame):
            run = frame.groupby(order, sort=False).ngroup().to_numpy()
            for size, part in frame.assign(run=run).groupby("size", sort=False):
                signs = np.frombuffer(b"".join(part["signs"]), dtype="<i4").reshape(len(part), -1)
                matrix = np.frombuffer(b"".join(part["v"]), dtype=np.float64).reshape(len(part), size // 8)
                runs, uid, ids = (part[c].to_numpy() for c in ("run", "uid", "vec_id"))
                i, j = linked_pairs(runs, ids, part["own"].to_numpy(), (part["b1"] != part["b2"]).to_numpy(), part["t"].to_numpy(), signs, matrix, threshold)
                if not len(i):
                    continue
                links = np.bincount(i, minlength=len(part)) + np.bincount(j, minlength=len(part))
                first = classes(len(part), i, j)
                hit = np.flatnonzero(links)
                yield pd.DataFrame({"uid": uid[hit], "links": links[hit], "a": ids[hit], "b": ids[first[hit]]})

        rest = None
        for batch in batches:  # sorted by `order`; the last run of a batch may go on in the next
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = frame[order].iloc[-1]
            open_run = (frame[order] == last).all(axis=1).to_numpy()
            rest = frame[open_run]
            yield from work(frame[~open_run])
        if rest is not None:
            yield from work(rest)

    grouped = full.repartition(*order).sortWithinPartitions(*order)
    found = stage(grouped.mapInPandas(compare, "uid long, links long, a long, b long"))
    links = found.groupBy("uid").agg(F.sum("links").alias("n_links"))
    classed = components(found.select("a", "b"))
    out = rows.select("uid", "vec_id").join(links, "uid", "left").join(classed.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
