"""Per-partition writers to outside stores (K-1 b, K-2, K-4, K-7).

The connection comes from a caller-supplied factory that is called inside each
task (it must be picklable), so no client crosses from driver to executors.
Errors are raised, not swallowed: the task fails, Spark retries it, and a
stream's batch is replayed from its checkpoint instead of being lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.fixed import UPSERT_BATCH_ROWS
from adlens.sources import index_table


def upsert_sql(table: str, keys: list[str], measures: list[str], attrs: list[str] = (),
               placeholder: str = "?") -> str:
    """INSERT ... ON DUPLICATE KEY UPDATE of the measures only (identifiers quoted)."""
    cols = [*keys, *attrs, *measures]
    q = lambda c: f"`{c}`"
    values = ",".join([placeholder] * len(cols))
    update = ",".join(f"{q(m)}=VALUES({q(m)})" for m in measures)
    return f"INSERT INTO {table}({','.join(q(c) for c in cols)}) VALUES({values}) ON DUPLICATE KEY UPDATE {update}"


def _batched(rows: Iterable, size: int):
    buf = []
    for r in rows:
        buf.append(r)
        if len(buf) == size:
            yield buf
            buf = []
    if buf:
        yield buf


def write_partitions_dbapi(df: DataFrame, connect: Callable[[], object], sql: str, columns: list[str],
                           batch_size: int = UPSERT_BATCH_ROWS, null_to_zero: tuple[str, ...] = ()) -> None:
    """K-1 b: each partition opens one DB-API connection, runs ``executemany`` in
    batches of ``batch_size`` and commits once (one transaction per partition).
    ``null_to_zero`` maps nulls of integer columns to 0, as the reference's sink did."""
    out = df.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in null_to_zero else F.col(c)
                      for c in columns])

    def run(rows):
        conn = connect()
        try:
            cur = conn.cursor()
            for chunk in _batched((tuple(r) for r in rows), batch_size):
                cur.executemany(sql, chunk)
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            conn.close()

    out.foreachPartition(run)


def add_counters(df: DataFrame, connect: Callable[[], object], key_col: str = "key",
                 value_col: str = "value") -> None:
    """K-2 against a KV store: ``incrby(key, n)`` for every row, one client per partition.
    The client needs ``incrby`` and ``close``. Replays add again: prefer
    ``sinks.merge.counter_add`` on a table, or a ledger, where exactly-once matters."""
    rows = df.select(key_col, value_col)

    def run(part):
        client = connect()
        try:
            for r in part:
                client.incrby(r[0], int(r[1]))
        finally:
            client.close()

    rows.foreachPartition(run)


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite", fmt: str = "json",
                    options: dict | None = None) -> None:
    """K-4: segment documents to a store. With the stable ``doc_id`` column an index
    connector can use it as document id (re-runs overwrite); for files, ``overwrite``.
    With the format of ``sources.index_table`` the documents are committed as a whole."""
    if fmt == index_table.FORMAT:
        index_table.register(docs.sparkSession)
    docs.write.format(fmt).mode(mode).options(**(options or {})).save(path)
