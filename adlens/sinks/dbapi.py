"""Transactional table writes through a DB-API connection (K-1 b, K-7).

``format("adlens_dbapi")`` is a data source writer. Tasks load their rows into a staging
table, each in one transaction, under (job, attempt). The driver's commit then merges the
attempts that Spark counted into the target and clears the job's staging rows, all in one
transaction; a job that fails clears its staging rows and leaves the target as it was.
Attempts that were lost or run twice are not merged, whatever they had loaded.

The connection factory is named (``package.module:function``), so options hold no secrets and
every task opens its own connection. Statements use ``?`` or another placeholder that the
driver takes.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from adlens.fixed import UPSERT_BATCH_ROWS
from adlens.sinks.writers import _batched

FORMAT = "adlens_dbapi"
TAGS = ["job", "attempt"]  # columns of the staging table before the target's


@dataclass
class Loaded(WriterCommitMessage):
    attempt: str
    rows: int


def factory(name: str):
    """The connection factory ``package.module:function``."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def statements(target: str, staging: str, keys: list[str], measures: list[str], attrs: list[str] = (),
               placeholder: str = "?") -> dict[str, str]:
    """The three statements of a staged INSERT ... ON DUPLICATE KEY UPDATE of the measures."""
    cols = [*keys, *attrs, *measures]
    q = lambda c: f"`{c}`"
    names, every = ",".join(map(q, cols)), ",".join(map(q, [*TAGS, *cols]))
    update = ",".join(f"{q(m)}=VALUES({q(m)})" for m in measures)
    return {"load": f"INSERT INTO {staging}({every}) VALUES({','.join([placeholder] * (len(cols) + 2))})",
            "merge": f"INSERT INTO {target}({names}) SELECT {names} FROM {staging} WHERE `job`={placeholder} AND `attempt`={placeholder} "
                     f"ON DUPLICATE KEY UPDATE {update}",
            "clear": f"DELETE FROM {staging} WHERE `job`={placeholder}"}


class DbApiWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.connect, self.columns = options["connect"], json.loads(options["columns"])
        self.load, self.merge, self.clear = options["load"], options["merge"], options["clear"]
        self.batch_rows = int(options.get("batch_rows", str(UPSERT_BATCH_ROWS)))
        self.job = uuid.uuid4().hex  # made on the driver, the same in every task

    def _transaction(self, run) -> None:
        conn = factory(self.connect)()
        try:
            run(conn.cursor())
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            conn.close()

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        attempt, n = uuid.uuid4().hex, 0

        def run(cur):
            nonlocal n
            for chunk in _batched(((self.job, attempt, *(r[c] for c in self.columns)) for r in iterator), self.batch_rows):
                cur.executemany(self.load, chunk)
                n += len(chunk)

        self._transaction(run)
        return Loaded(attempt, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        def run(cur):
            for m in messages:
                if m is not None and m.rows:
                    cur.execute(self.merge, (self.job, m.attempt))
            cur.execute(self.clear, (self.job,))

        self._transaction(run)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._transaction(lambda cur: cur.execute(self.clear, (self.job,)))


class DbApiSource(DataSource):
    """Options: ``connect``, ``columns`` (JSON list), ``load``, ``merge``, ``clear``, ``batch_rows``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return DbApiWriter(dict(self.options))


def upsert_dbapi(df: DataFrame, connect: str, target: str, staging: str, keys: list[str], measures: list[str],
                 placeholder: str = "?", batch_rows: int = UPSERT_BATCH_ROWS) -> None:
    """K-1 b as one transaction: all rows of ``df`` or none."""
    attrs = [c for c in df.columns if c not in keys and c not in measures]
    df.sparkSession.dataSource.register(DbApiSource)
    (df.write.format(FORMAT).mode("append").option("connect", connect).option("batch_rows", str(batch_rows))
     .option("columns", json.dumps([*keys, *attrs, *measures]))
     .options(**statements(target, staging, keys, measures, attrs, placeholder)).save())
