"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes run through ``filters`` learned filters of ``width`` bytes at every position. Positions are cut into
chunks of ``chunk`` positions that overlap by half and cover the whole document; each filter keeps its maximum over a chunk
and the distinctness of its response there (maximum less mean), a small dense layer turns these into a chunk's logit, and
the mean logit of all chunks is the document's, whose sigmoid is the score. At run time the filters are tables over byte pairs.

It is trained on the driver on a bounded sample of the labelled rows: at most ``per_class`` of each label (default 1,500),
the ones with the smallest hash of their id, with ``sample_chunks`` chunks of each. All else covers every row and whole texts.

Null and empty text count as ``width`` zero bytes and get a score like any other. Null ids stay null; repeated rows are
scored each; an empty table gives an empty result. Labels that are null are not used; without any label, or with one label
only, the model is constant (its share of ones, 0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatframe.llm.common import id_and_text, slices, unused
from threatframe.session import small_batches

AT_ONCE = 200_000  # positions worked on at a time


@dataclass
class ByteCnn:
    """Weights. ``kernel``: width x 256 x filters; ``hidden``: 2 filters x units."""

    kernel: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    chunk: int

    @property
    def width(self) -> int:
        return self.kernel.shape[0]

    def pair_tables(self) -> list[np.ndarray]:
        """One table over byte pairs for every two positions of the filters."""
        k = self.kernel
        return [(k[i][:, None, :] + k[i + 1][None, :, :]).reshape(65536, -1).astype(np.float32) for i in range(0, self.width, 2)]

    def responses(self, data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Filter responses at each position of the bytes: (len - width + 1) x filters."""
        n = len(data) - self.width + 1
        pairs = (data[:-1].astype(np.int32) << 8) | data[1:]
        total = tables[0][pairs[:n]]
        for i, table in enumerate(tables[1:], 1):
            total += table[pairs[2 * i : 2 * i + n]]
        return total

    def head(self, pooled: np.ndarray) -> np.ndarray:
        """Logit of each row of pooled features."""
        return np.maximum(pooled @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def score(self, texts: list[str], tables: list[np.ndarray]) -> np.ndarray:
        data = [(t or "").encode("utf-8", "replace") for t in texts]
        data = [d + bytes(max(0, self.width - len(d))) for d in data]
        return np.concatenate([self._score(data[a:b], tables) for a, b in slices([len(d) for d in data], AT_ONCE)]) if data else np.zeros(0)

    def _score(self, data: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
        half = self.chunk // 2
        peaks, sums, sizes, owner = [], [], [], []
        if len(data) == 1:  # a text longer than AT_ONCE is worked on in steps of whole half chunks
            step = AT_ONCE // half * half
            parts = [(0, data[0][a : a + step + self.width - 1]) for a in range(0, len(data[0]) - self.width + 1, step)]
        else:
            parts = [(0, b"".join(data))]
        ends = np.cumsum([len(d) for d in data])
        for _, part in parts:
            values = self.responses(np.frombuffer(part, dtype=np.uint8), tables)
            if len(data) == 1:
                first, last, who = [0], [len(values)], [0]
            else:  # positions whose window lies within one text
                first, last, who = (ends - [len(d) for d in data]).tolist(), (ends - self.width + 1).tolist(), range(len(data))
            cuts, stop = [], []
            for f, e, w in zip(first, last, who, strict=True):
                at = np.arange(f, e, half)
                cuts.append(at)
                stop.append(np.r_[at[1:], e])
                owner.append(np.full(len(at), w))
            cuts, stop = np.concatenate(cuts), np.concatenate(stop)
            edges = np.empty(2 * len(cuts), dtype=np.int64)
            edges[::2], edges[1::2] = cuts, stop
            edges = edges if edges[-1] < len(values) else edges[:-1]
            peaks.append(np.maximum.reduceat(values, edges, axis=0)[::2])
            sums.append(np.add.reduceat(values, edges, axis=0)[::2])
            sizes.append(stop - cuts)
        peak, total, size, owner = np.concatenate(peaks), np.concatenate(sums), np.concatenate(sizes).astype(np.float32), np.concatenate(owner)
        same = owner[1:] == owner[:-1]
        # a chunk is two neighbouring halves; a text of one half is a chunk of its own
        alone = np.ones(len(owner), dtype=bool)
        alone[1:] &= ~same
        alone[:-1] &= ~same
        a, b = np.flatnonzero(same), np.flatnonzero(same) + 1
        pooled_peak = np.concatenate([np.maximum(peak[a], peak[b]), peak[alone]])
        pooled_mean = np.concatenate([(total[a] + total[b]) / (size[a] + size[b])[:, None], total[alone] / size[alone][:, None]])
        who = np.concatenate([owner[a], owner[alone]])
        logit = self.head(features(pooled_peak, pooled_mean, self.bias))
        mean = np.bincount(who, weights=logit, minlength=len(data)) / np.bincount(who, minlength=len(data))
        return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def features(peak: np.ndarray, mean: np.ndarray, bias: np.ndarray) -> np.ndarray:
    top = np.maximum(peak + bias, 0)
    return np.concatenate([top, peak - mean], axis=1)


def train(texts: list[str], labels: np.ndarray, filters: int = 16, width: int = 4, units: int = 16, chunk: int = 512,
          sample_chunks: int = 3, epochs: int = 14, rate: float = 0.01, seed: int = 7) -> ByteCnn:
    """Fit the network by Adam on chunks of the texts; both labels count alike in the loss, then the bias restores their shares."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, dtype=np.float64)
    kernel = rng.normal(0, 0.3, (width, 256, filters)).astype(np.float32)
    model = ByteCnn(kernel, np.zeros(filters, np.float32), rng.normal(0, 0.3, (2 * filters, units)), np.zeros(units), rng.normal(0, 0.3, units), 0.0, chunk)
    share = float(labels.mean()) if len(labels) else 0.5
    if len(labels) == 0 or share in (0.0, 1.0):
        model.out[:] = 0
        model.out_bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return model
    rows, target = [], []
    for text, label in zip(texts, labels, strict=True):
        data = (text or "").encode("utf-8", "replace")
        size = chunk + width - 1
        starts = [0] if len(data) <= size else [int(s) for s in rng.integers(0, len(data) - size + 1, sample_chunks)]
        for s in starts:
            part = data[s : s + size]
            rows.append(np.frombuffer(part + bytes(max(0, width - len(part))), dtype=np.uint8))
            target.append((label, 1 / len(starts)))
    target, weight = np.array([t for t, _ in target]), np.array([w for _, w in target])
    weight *= np.where(target == 1, 0.5 / (weight * target).sum(), 0.5 / (weight * (1 - target)).sum())
    names = ["kernel", "bias", "hidden", "hidden_bias", "out"]
    moments = {n: [np.zeros_like(getattr(model, n), dtype=np.float32), np.zeros_like(getattr(model, n), dtype=np.float32)] for n in [*names]}
    bias_moment, step, batch = [0.0, 0.0], 0, 128
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        tempo = rate * (1 - epoch / epochs)
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            tables = [k for k in model.kernel]
            data = [rows[i] for i in chosen]
            flat = np.concatenate(data)
            lengths = np.array([len(d) for d in data])
            ends = np.cumsum(lengths)
            total = tables[0][flat[: len(flat) - width + 1]]
            for i in range(1, width):
                total = total + tables[i][flat[i : len(flat) - width + 1 + i]]
            peak, where, mean = np.empty((len(data), filters), np.float32), np.empty((len(data), filters), np.int64), np.empty((len(data), filters), np.float32)
            for j, (e, n) in enumerate(zip(ends, lengths, strict=True)):
                part = total[e - n : e - width + 1]
                at = part.argmax(axis=0)
                where[j], peak[j], mean[j] = at + e - n, part[at, np.arange(filters)], part.mean(axis=0)
            x = features(peak, mean, model.bias)
            before = x @ model.hidden + model.hidden_bias
            after = np.maximum(before, 0)
            logit = after @ model.out + model.out_bias
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            d_logit = (p - target[chosen]) * weight[chosen] * len(rows) / len(chosen)
            d_before = np.outer(d_logit, model.out) * (before > 0)
            d_x = d_before @ model.hidden.T
            d_top = d_x[:, :filters] * (peak + model.bias > 0)
            d_peak, d_mean = d_top + d_x[:, filters:], -d_x[:, filters:]
            d_kernel = np.zeros_like(model.kernel)
            share_of = (d_mean / (lengths - width + 1)[:, None]).astype(np.float32)
            for i in range(width):
                np.add.at(d_kernel[i], (flat[where + i], np.arange(filters)[None, :]), d_peak.astype(np.float32))
                counts = np.stack([np.bincount(d[i : len(d) - width + 1 + i], minlength=256) for d in data]).astype(np.float32)
                d_kernel[i] += counts.T @ share_of
            gradients = {"kernel": d_kernel, "bias": d_top.sum(axis=0), "hidden": x.T @ d_before, "hidden_bias": d_before.sum(axis=0), "out": after.T @ d_logit}
            step += 1
            for n in names:
                m, v = moments[n]
                g = gradients[n]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                setattr(model, n, (getattr(model, n) - tempo * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
            g = float(d_logit.sum())
            bias_moment = [bias_moment[0] + 0.1 * (g - bias_moment[0]), bias_moment[1] + 0.001 * (g * g - bias_moment[1])]
            model.out_bias -= tempo * (bias_moment[0] / (1 - 0.9**step)) / ((bias_moment[1] / (1 - 0.999**step)) ** 0.5 + 1e-8)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, seed: int = 0) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels of at most ``per_class`` rows of each label, and the share of ones among all labelled rows."""
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # ids are drawn first, so that only the sample's texts move; each draw is a top-k that tasks reduce
    ids = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(per_class) for v in (0, 1)]
    chosen = ids[0].unionByName(ids[1])
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    total = sum(counts.values())
    return rows["text"].tolist(), rows["label"].to_numpy(), counts.get(1, 0) / total if total else 0.5


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = 1500, **settings) -> ByteCnn:
    """Train on the labelled rows of ``docs`` (doc_id, text); the logit is shifted so that scores reflect the labels' shares."""
    texts, marks, share = labelled_sample(docs, labels, label_col, per_class)
    model = train(texts, marks, **settings)
    if len(set(marks.tolist())) == 2:  # trained as if both were equally frequent
        model.out_bias += float(np.log(share / (1 - share)))
    return model


def score(docs: DataFrame, model: ByteCnn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row."""
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(model)

    def scored(batches):
        network = shared.value
        tables = network.pair_tables()
        for batch in batches:
            texts = batch["text"].tolist()
            for low, high in slices([len(t) for t in texts], 5 * AT_ONCE):
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[low:high].astype("Int64"), "score": network.score(texts[low:high], tables).astype(np.float64)})

    return id_and_text(docs, id_col, text_col).mapInPandas(scored, "doc_id long, score double")


def keep_good(docs: DataFrame, model: ByteCnn, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns; no row is shuffled."""
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(model)
    name = unused(docs, "score")

    @F.pandas_udf("double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        network = shared.value
        tables = network.pair_tables()
        for batch in batches:
            texts = batch.tolist()
            parts = [network.score(texts[low:high], tables) for low, high in slices([len(t) for t in texts], 5 * AT_ONCE)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(name, judged(F.coalesce(F.col(text_col), F.lit("")))).where(F.col(name) >= threshold).drop(name)
