"""Helpers shared by the training-data operators: reading tables, staging, words, files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import scratch_path

# A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Columns ``cols`` of one input table (column pruning reaches the scan)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Later steps then start from files every executor can see: a lost executor
    costs a reread, not the work that made the rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once per row (a one-element transform binds it)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    """Words of a text in order; null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != F.lit(""))


def python_words(text: str | None) -> list[bytes]:
    """The same words in Python: ``bytes.split`` cuts at exactly these six characters."""
    return (text or "").encode("utf-8", "replace").split()


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI or plain path that every node can reach."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri else fs.FileSystem.from_uri(
        uri.replace("file:", "file://", 1) if uri.startswith("file:") else f"file://{uri}")


def write_file(folder: str, name: str, chunks: Iterable[bytes]) -> tuple[str, int]:
    """Write one file under ``folder``; returns (uri, bytes).

    The name gets a random suffix, so a retried or speculative task never
    overwrites another attempt's file. Only files named in the rows that the
    winning attempt returns are ever read.
    """
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}"
    size = 0
    with fs.open_output_stream(f"{base}/{leaf}") as out:
        for c in chunks:
            out.write(c)
            size += len(c)
    return f"{folder.rstrip('/')}/{leaf}", size


def open_file(uri: str):
    """Random-access file object of a file written by :func:`write_file`."""
    fs, path = filesystem(uri)
    return fs.open_input_file(path)
