"""Log stream source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def log_stream(spark: SparkSession, fmt: str = "kafka", schema: StructType | str | None = None,
               options: Mapping[str, str] | None = None, path: str | None = None) -> DataFrame:
    """Streaming lines from any Spark source.

    For Kafka give ``subscribe`` and ``kafka.bootstrap.servers`` as options;
    only the message value is kept, as text. Parallelism follows the topic
    partitions and replay follows the query's checkpoint.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    stream = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        return stream.select(F.col("value").cast("string").alias("value"))
    return stream


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available into a Parquet folder, then stop."""
    query = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
