"""Reading test tables as streams and running a stream over all that is there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from threatframe.session import shared_dir

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def run_available(stream: DataFrame, start=None) -> DataFrame:
    """Process what is available, write it to the shared folder, and return it as a table."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        if start is None:
            query = (stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
                     .outputMode("append").trigger(availableNow=True).start())
        else:
            query = start(stream, f"{base}/out", f"{base}/state")
        query.awaitTermination()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    if start is None:
        return spark.read.schema(stream.schema).parquet(f"{base}/out")
    return spark.read.parquet(f"{base}/out")
