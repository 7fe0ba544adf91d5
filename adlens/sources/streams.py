"""Stream sources (SRC-5, SRC-6).

The reference reads a Kafka topic. The format is a parameter here: ``kafka``
on a cluster with the connector, a file source (parquet / json) in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.fixed import LOG_TOPIC


def open_log_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                    schema: T.StructType | None = None, options: dict | None = None) -> DataFrame:
    """A streaming frame of raw log records.

    kafka: subscribes to ``LOG_TOPIC`` from the earliest offset unless options say
    otherwise, and casts topic / key / value to text (SRC-6). File formats need a
    schema (no inference on a stream) and read ``path``.
    """
    opts = dict(options or {})
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts.setdefault("subscribe", LOG_TOPIC)
        opts.setdefault("startingOffsets", "earliest")
        df = reader.options(**opts).load()
        return df.select(*[F.col(c).cast("string").alias(c) for c in ("topic", "key", "value")])
    if schema is None:
        raise ValueError("file stream sources need an explicit schema")
    return reader.schema(schema).options(**opts).load(path)
