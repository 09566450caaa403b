"""What a worker holds or does at once stays in proportion to its rows."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from threatframe.llm import brown_lm, quality

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_classifier_sends_texts_in_small_batches(spark):
    before = spark.conf.get(BATCH)
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abcd "), 800).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"bytes": [int(batch["text"].str.len().sum())]})

    try:
        spark.conf.set(BATCH, "64m")
        kept = quality.keep_good(docs, quality.train([], np.array([])), 0.0)
        assert kept.count() == 6000
        found = [r.bytes for r in docs.mapInPandas(sizes, "bytes long").collect()]
        assert sum(found) == 6000 * 4000 and max(found) <= 6 << 20
        spark.conf.set(BATCH, "1m")
        quality.score(docs, quality.train([], np.array([])))
        assert spark.conf.get(BATCH) == "1m"  # a smaller one stays
    finally:
        spark.conf.set(BATCH, before)


def test_tokens_by_column_are_those_of_each_text():
    r = random.Random(3)
    marks = ["a", "B", "é", "İ", "zz", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\u00a0", "\x00"]
    texts = ["", " ", " \t\n", "One  two\none", *["".join(r.choice(marks) for _ in range(r.randint(0, 30))) for _ in range(500)]]
    for column in (pa.array(texts), pa.chunked_array([texts[:7], texts[7:]]), pa.array(["", " "]), pa.array([], pa.string())):
        words, tokens, sizes = brown_lm.numbered(column)
        expected = [brown_lm.tokens_of(t) for t in column.to_pylist()]
        flat = [w for ws in expected for w in ws]
        assert sizes.tolist() == [len(ws) for ws in expected] and [words[i].as_py() for i in tokens.tolist()] == flat
        assert words.to_pylist() == list(dict.fromkeys([brown_lm.END, *flat]))
        units = brown_lm.Units({b"zz": 1, brown_lm.END: 0, b"a": 2}, 50)
        assert units.column(words).tolist() == units.numbers(words.to_pylist()).tolist()


def test_block_is_counted_once_for_all_its_rows(spark, monkeypatch):
    """A count for each row, as long as the words of its block, is quadratic."""
    taken = []
    monkeypatch.setattr(brown_lm.np, "bincount", lambda x, *a, f=np.bincount, **b: taken.append(len(x)) or f(x, *a, **b))
    monkeypatch.setattr(brown_lm.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    caught = {}
    texts = spark.createDataFrame([(i, i % 3 == 0, f"w{i} w{i + 1}") for i in range(50)], "doc_id long, held_out boolean, text string")
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(texts), name, lambda self, f, schema, name=name: caught.update({name: f}))
    brown_lm.coded(texts, 1 << 20)
    table = texts.toArrow() if "mapInArrow" in caught else texts.toPandas()
    for f in caught.values():
        list(f(iter(table.combine_chunks().to_batches() if "mapInArrow" in caught else [table])))
    assert len(taken) == 1
