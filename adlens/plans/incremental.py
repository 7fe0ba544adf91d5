"""The all-days exposure report (R-2) without rescanning old logs.

The report's aggregate is mergeable: per (deal, day) a count and the attributes of the first
record. Here it is kept per log file. A run reads only files that are new or have changed
since the last run (their length or time differs), writes their partial rows, and commits by
writing one ledger file that says which run holds each file. The report merges the partial
rows that the ledger names: a few rows per deal, day and file instead of all records.

A run that dies before its ledger leaves rows that nothing names; the next run reads those
files again. A file that has grown (a month's log gets records every day) is read again and
replaces its own rows; a file that is gone no longer counts. First rows are ordered by
(file, place in the file), like the full run's.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens import schemas
from adlens.operators import reports
from adlens.sources import files


class IncrementalExposure:
    """State under ``path`` for the logs below one root. ``fmt``: json or parquet."""

    def __init__(self, path: str, fmt: str = "json", schema: T.StructType = schemas.EXPOSURE_LOG):
        self.path, self.fmt, self.schema = path.rstrip("/"), fmt, schema

    def ledger(self) -> dict[str, dict]:
        """{file: {size, time, run}} after the newest committed run."""
        found = files.names(f"{self.path}/_ledger")
        return json.loads(files.read(f"{self.path}/_ledger/{found[-1]}")) if found else {}

    def _listed(self, spark: SparkSession, root: str) -> dict[str, dict]:
        """The log's files, as Spark lists them. One entry per file is held by the driver."""
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)  # contents are not read
        rows = listing.select("path", "length", F.col("modificationTime").cast("double").alias("time")).collect()
        return {r["path"]: {"size": r["length"], "time": r["time"]} for r in rows if not os.path.basename(r["path"]).startswith((".", "_"))}

    def update(self, spark: SparkSession, root: str) -> list[str]:
        """Read what is new below ``root``; returns the files that were read."""
        old, now = self.ledger(), self._listed(spark, root)
        new = sorted(f for f, m in now.items() if f not in old or (old[f]["size"], old[f]["time"]) != (m["size"], m["time"]))
        if not new and old.keys() == now.keys():
            return []
        run = uuid.uuid4().hex[:12]
        if new:
            log = spark.read.schema(self.schema).format(self.fmt).option("basePath", root).load(new)
            log = log.withColumn("event_id", F.struct(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i")))
            part = f"{self.path}/run={run}"
            reports.exposure_partials(log, by=[F.col("event_id.f").alias("file")]).write.parquet(part)
            listed = spark.createDataFrame([(f,) for f in new], "file string")
            if not spark.read.parquet(part).join(listed, "file", "left_anti").isEmpty():
                raise RuntimeError("rows of a file that is named otherwise in the listing")  # its rows would not be counted
        ledger = {f: {**m, "run": run if f in new else old[f]["run"]} for f, m in now.items()}
        n = len(files.names(f"{self.path}/_ledger"))
        files.put(f"{self.path}/_ledger/{n:08d}.json", lambda out: out.write(json.dumps(ledger).encode()))
        return new

    def partials(self, spark: SparkSession) -> DataFrame | None:
        """Partial rows that the ledger names (None before the first file)."""
        ledger = self.ledger()
        if not ledger:
            return None
        rows = spark.read.parquet(*sorted({f"{self.path}/run={m['run']}" for m in ledger.values()}))
        runs = spark.createDataFrame([(f, m["run"]) for f, m in ledger.items()], "file string, _run string")  # one row per file
        rows = rows.withColumn("_run", F.regexp_extract(F.col("_metadata.file_path"), "/run=([0-9a-f]+)/", 1))
        return rows.join(runs, ["file", "_run"], "left_semi").drop("_run")

    def report(self, spark: SparkSession, ssp_tag: DataFrame) -> DataFrame:
        """R-2 over everything read so far."""
        rows = self.partials(spark)
        if rows is None:
            rows = reports.exposure_partials(spark.createDataFrame([], self.schema).withColumn(
                "event_id", F.lit(None).cast("struct<f:string,i:bigint>")), by=[F.lit("").alias("file")])
        return reports.exposure_from_partials(rows, ssp_tag)
