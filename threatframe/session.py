"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # call sites of column expressions cost more time than planning large expressions
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
SHUFFLE_PARTITIONS = 200
BATCH_BYTES = 4 << 20


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on; anything passed in ``conf`` wins."""
    builder = SparkSession.builder.appName("threatframe")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that change results (time zone, duplicate map keys), and begin shuffles with ``SHUFFLE_PARTITIONS``.

    Adaptive execution joins small partitions of a shuffle but cannot cut a large one, so with few of them tasks grow with the input.
    """
    for key in ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy"):
        spark.conf.set(key, SETTINGS[key])
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = max(SHUFFLE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if int(spark.conf.get(first, None) or 0) < least:
        spark.conf.set(first, str(least))
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Send at most about ``BATCH_BYTES`` at once to Python. Batches of 10,000 texts are held several times over, by JVM and worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; on a cluster the
    setting is required, because a machine-local folder does not outlive its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="threatframe-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later passes see the very same rows, also after losing executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as the table at ``path``. Its shuffle files go when the table is complete, and not only when the driver collects garbage."""
    spark, cleanup = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """Write rows to a table in the shared folder and read it back.

    For rows many plans read: unlike a checkpoint, each reader then scans only its columns.
    """
    return written(df, f"{shared_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}")


class Scratch:
    """Named tables of one job in the shared folder, each dropped once all that is made from it is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        return written(df, f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables. Only for tables that no plan still to be run reads: a lost task of such a plan could not be repeated."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
