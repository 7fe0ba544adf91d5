"""Log scans (SRC-3, SRC-4, SRC-7) and table registration (SRC-1, SRC-2).

Logs are JSON lines, one file per month (``<root>/<yyyyMM>.log``), read with an
explicit schema: no inference pass, and ``local-day`` stays zero-padded text.
Reading one month's file is the reference's partition pruning; logs stored as
``month=/day=`` partitioned parquet get Spark's own pruning instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.operators.reports import RunDay


def yesterday(today: dt.date | None = None) -> RunDay:
    """SRC-7: the report day is the day before ``today`` (driver-side, one value)."""
    d = (today or dt.date.today()) - dt.timedelta(days=1)
    return RunDay(d.strftime("%Y%m%d"))


def month_path(root: str, month: str) -> str:
    return f"{root.rstrip('/')}/{month}.log"


def read_month(spark: SparkSession, root: str, month: str, schema: T.StructType) -> DataFrame:
    """SRC-3: one month's file."""
    return spark.read.schema(schema).json(month_path(root, month))


def read_months(spark: SparkSession, root: str, months, schema: T.StructType) -> DataFrame:
    """Several months' files in one scan."""
    return spark.read.schema(schema).json([month_path(root, m) for m in months])


def read_all(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """SRC-4: every file of the log directory."""
    return spark.read.schema(schema).json(root)


PARTITION_COLUMNS = ("local-month", "local-day")


def to_partitioned(spark: SparkSession, json_root: str, out_root: str, schema: T.StructType,
                   months=None, mode: str = "overwrite", files_per_day: int = 8) -> None:
    """One-time conversion of JSON month logs into parquet partitioned by month and day.

    Later report runs then prune to the partitions a filter names (a day, a month)
    and read only the columns a report needs. ``overwrite`` is dynamic per
    partition, so re-converting one month leaves the others alone. A day is dealt over up
    to ``files_per_day`` tasks and files by a hash of its rows, so one busy day is not one
    task's work; choose it by the largest day's size over the wanted file size."""
    df = read_months(spark, json_root, months, schema) if months else read_all(spark, json_root, schema)
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_day))
    (df.repartition(*PARTITION_COLUMNS, deal).write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*PARTITION_COLUMNS).parquet(out_root))


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A month/day partitioned log; month and day stay text (no type inference of
    partition values, so "05" is not read as 5)."""
    return spark.read.schema(schema).option("basePath", root).parquet(root)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10000) -> dict[str, str]:
    """Options of a parallel JDBC read; credentials come from the caller, never from code."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            opts[k] = v
    if partition_column:
        if None in (lower, upper, num_partitions):
            raise ValueError("a partitioned JDBC read needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    return opts


def index_options(nodes: str, port: int | str = 9200, user: str | None = None, password: str | None = None,
                  pushdown: bool = True, extra: dict | None = None) -> dict[str, str]:
    """Options of a search-index table read (SRC-2) for an index connector that takes
    ``es.*`` options; the connector jar and format name come from the deployment."""
    opts = {"es.nodes": nodes, "es.port": str(port), "pushdown": str(pushdown).lower()}
    if user is not None:
        opts["es.net.http.auth.user"] = user
    if password is not None:
        opts["es.net.http.auth.pass"] = password
    opts.update(extra or {})
    return opts


def register_table(spark: SparkSession, name: str, fmt: str, options: dict[str, str] | None = None,
                   path: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """SRC-1 / SRC-2: load a table in any format and expose it as a temp view.

    ``fmt="jdbc"`` with ``jdbc_options(...)`` for relational tables; a search-index
    connector's format name with its options (pushdown on) for index tables;
    ``parquet`` / ``json`` for files.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    df.createOrReplaceTempView(name)
    return df
