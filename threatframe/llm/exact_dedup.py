"""Exact deduplication with a persistent index of text digests.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest (map-side), rows the index
already holds are taken out by a sort-merge anti-join that reads the buckets without shuffling them, and the rest is
appended bucket by bucket. Adding the same batch again changes nothing, so a failed run can be repeated. The table's layout is
stored beside it, so that later sessions go on with the same index.

Texts are equal when they are identical after each run of ASCII white space is replaced by one space. Null text is empty.
Of equal texts of one batch the smallest id stays; a text the index has from an earlier batch keeps its earlier id. Null
ids are larger than any other; a group of nulls only has keep_id null and all its rows are kept by ``dedup``;
``keep_documents`` leaves one row of rows repeated with id and text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatframe.llm.common import unused
from threatframe.session import shared_dir, stage

# a lone space is left as it is, so the engine only stops where something changes
WHITE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def digest_of(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with white space normalised."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ").cast("binary"), 256))


class DigestIndex:
    """Table (digest, keep_id), bucketed and sorted by digest, in the folder ``path``; it outlives the session.

    The number of buckets is chosen once, for the final size, and stored beside the table (``<path>-layout``); a session that does not
    know the table registers the stored files. A folder with files but without a stored layout is refused, never replaced.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.path = path or f"{shared_dir(spark)}/{name or f'digest_index_{uuid.uuid4().hex}'}"
        self.name = name or f"digest_index_{hashlib.md5(self.path.encode()).hexdigest()}"

    def holds(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return files.exists(place) and len(files.listStatus(place)) > 0

    def open(self) -> None:
        """Register the table, new or stored."""
        if self.spark.catalog.tableExists(self.name):
            return
        layout = f"{self.path}-layout"
        if self.holds(layout):
            self.buckets = self.spark.read.parquet(layout).first().buckets
        elif self.holds(self.path):
            raise ValueError(f"{self.path} holds files, but no stored layout of an index")
        else:
            self.spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(layout)
        self.spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet OPTIONS (path '{self.path}') CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS")

    def frame(self) -> DataFrame:
        self.open()
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unknown(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest is not in the index: a sort-merge anti-join against its buckets."""
        return groups.hint("merge").join(self.frame().select("digest"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add the digests of ``groups`` (digest, keep_id; each digest once) that are not in the index yet."""
        new = self.unknown(groups.select("digest", "keep_id")).repartition(self.buckets, "digest")
        new.write.mode("append").bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)


def by_id(digests: DataFrame, batches: int) -> list[DataFrame]:
    """``digests`` in ``batches`` even steps of ids, the smallest first, null ids last."""
    ends = digests.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    if batches < 2 or ends.low is None:
        return [digests]
    cuts = [ends.low + (ends.high - ends.low + 1) * k // batches for k in range(1, batches)]
    step = sum((F.when(F.col("doc_id") < c, 0).otherwise(1) for c in cuts), F.lit(0))
    return [digests.where(step == k) for k in range(batches)]


def dedup(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batches: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size (rows of ``docs``), kept; adds new texts to ``index``.

    With several ``batches`` the rows go through the index in steps of ids; the result is the same."""
    digests = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), digest_of(F.col(text_col)).alias("digest")))
    for part in by_id(digests, batches):
        index.append(part.groupBy("digest").agg(F.min("doc_id").alias("keep_id")))
    groups = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    # written, so that both sides of the last join are plain shuffles, which adaptive execution splits at a hot digest
    resolved = stage(groups.hint("merge").join(index.frame(), "digest"))
    return digests.join(resolved, "digest").select("doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def keep_documents(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns. The text is shuffled only where many rows go."""
    judged = dedup(docs, index, id_col, text_col)
    dropped = stage(judged.where(~F.col("kept")).select("doc_id", "digest").distinct())
    key, id_key, digest_key = (unused(docs, c) for c in ("digest", "__id", "__digest"))
    rows = docs.withColumn(key, digest_of(F.col(text_col)))
    dropped = dropped.select(F.col("doc_id").alias(id_key), F.col("digest").alias(digest_key))
    rows = rows.join(dropped, F.col(id_col).eqNullSafe(F.col(id_key)) & (F.col(key) == F.col(digest_key)), "left_anti")
    repeated = judged.where("kept").groupBy("doc_id", "digest").count().where("count > 1")
    if not repeated.isEmpty():  # rows repeated with id and text: the first of each, combined before the shuffle
        rows = rows.dropDuplicates([id_col, key])
    return rows.drop(key)
