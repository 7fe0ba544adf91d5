"""An index table as a Spark data source (SRC-1, SRC-2, K-4, K-7).

``format("adlens_index")`` reads and writes a folder of documents with a block index:

* **Reading.** Filters are pushed into the source (``pushFilters``): blocks whose smallest and
  largest values rule them out are never opened, and the rows of the others are filtered
  in the reader, so Spark evaluates only what the source could not. Blocks are dealt over
  tasks. Columns are pruned by the schema given to the reader (:func:`read_index`).
* **Writing.** Every task writes files of its own and sends their block statistics in its
  commit message. The documents become visible all at once, when the driver's commit
  writes one manifest naming them; a job that fails leaves nothing to be read, whichever of
  its tasks had finished, and its files are removed.

Data files are Parquet; a block is one of their row groups. A task holds the rows of one block
while it writes or reads, so a block ends at a million rows or 64 MB of them, whichever
comes first. One manifest row per block is held by the driver: 100 TB make 1.6 million.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
                                    StringStartsWith, WriterCommitMessage)

from adlens.sources import files

FORMAT = "adlens_index"
MANIFESTS = "_manifests"
BLOCK_ROWS = 1 << 20
BLOCK_BYTES = 1 << 26  # of Arrow data: what one task holds
TEXT_BOUND = 64  # characters of a text kept as a block's bound
# Types whose order is the same in Spark and Arrow (floating-point numbers are not: NaN).
_ORDERED = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)
_RANGES = (EqualTo, EqualNullSafe, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In, StringStartsWith)


def _ordered(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, _ORDERED)]


def _arrow(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


# ------------------------------------------------------------------ writing

@dataclass
class FileWritten(WriterCommitMessage):
    """What one task wrote: the file's name and, per block, its rows and bounds."""
    name: str
    blocks: list[dict]


def text_above(prefix: str) -> str | None:
    """A text that sorts after every text with this prefix (none if there is no such text)."""
    for i in range(len(prefix) - 1, -1, -1):
        c = ord(prefix[i])
        if c < 0x10FFFF:
            return prefix[:i] + chr(0xE000 if c == 0xD7FF else c + 1)
    return None


def block_bounds(batch, columns: list[str]) -> dict:
    """{lo_c, hi_c, nulls_c} per column: a lower bound, an upper bound (null: none) and the null count."""
    import pyarrow.compute as pc
    out = {}
    for c in columns:
        values = batch.column(c)
        ends = pc.min_max(values).as_py()
        lo, hi = ends["min"], ends["max"]
        if isinstance(lo, str):
            lo, hi = lo[:TEXT_BOUND], (hi if len(hi) <= TEXT_BOUND else text_above(hi[:TEXT_BOUND]))
        out |= {f"lo_{c}": lo, f"hi_{c}": hi, f"nulls_{c}": values.null_count}
    return out


class IndexWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool, block_rows: int, block_bytes: int = BLOCK_BYTES):
        self.path, self.schema, self.overwrite = path.rstrip("/"), schema, overwrite
        self.block_rows, self.block_bytes = block_rows, block_bytes

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        import pyarrow as pa
        import pyarrow.parquet as pq
        schema, columns = _arrow(self.schema), _ordered(self.schema)
        name, blocks = f"docs-{uuid.uuid4().hex}.parquet", []

        def fill(out):
            held, n, size = [], 0, 0
            with pq.ParquetWriter(out, schema) as writer:
                def flush():
                    nonlocal held, n, size
                    block = pa.Table.from_batches(held, schema=schema)  # in pieces: no second copy
                    writer.write_table(block, row_group_size=n)
                    blocks.append({"rows": n, **block_bounds(block, columns)})
                    held, n, size = [], 0, 0
                for batch in iterator:
                    batch = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema)], schema=schema)
                    at = 0
                    while at < batch.num_rows:
                        piece = batch.slice(at, min(self.block_rows - n, self._rows_within(batch.slice(at), self.block_bytes - size)))
                        held.append(piece)
                        at, n, size = at + piece.num_rows, n + piece.num_rows, size + piece.nbytes
                        if n >= self.block_rows or size >= self.block_bytes or at < batch.num_rows:
                            flush()
                if n:
                    flush()

        files.put(f"{self.path}/{name}", fill)
        if not blocks:  # a task without rows leaves no file
            files.remove(f"{self.path}/{name}")
        return FileWritten(name, blocks)

    @staticmethod
    def _rows_within(batch, room: int) -> int:
        """How many first rows of ``batch`` take up to ``room`` bytes, at least one."""
        least, most = 1, batch.num_rows
        while least < most:
            half = (least + most + 1) // 2
            least, most = (half, most) if batch.slice(0, half).nbytes <= room else (least, half - 1)
        return least

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq
        columns = _ordered(self.schema)
        fields = [pa.field("name", pa.string()), pa.field("block", pa.int32()), pa.field("rows", pa.int64())]
        for f in _arrow(self.schema):
            if f.name in columns:
                fields += [pa.field(f"lo_{f.name}", f.type), pa.field(f"hi_{f.name}", f.type), pa.field(f"nulls_{f.name}", pa.int64())]
        rows = [{"name": m.name, "block": i, **b} for m in messages if m is not None for i, b in enumerate(m.blocks)]
        schema = pa.schema(fields, metadata={"documents": self.schema.json()})
        table = pa.Table.from_pylist(rows, schema=schema)
        # The number orders manifests; two jobs that commit at once differ in the rest of the name.
        taken = [int(n.split("-")[0]) for n in files.names(f"{self.path}/{MANIFESTS}")]
        kind = "replace" if self.overwrite else "append"
        leaf = f"{max(taken, default=-1) + 1:08d}-{kind}-{uuid.uuid4().hex[:12]}.parquet"
        files.put(f"{self.path}/{MANIFESTS}/{leaf}", lambda out: pq.write_table(table, out))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            if m is not None:
                files.remove(f"{self.path}/{m.name}")


# ------------------------------------------------------------------ reading

def manifests(path: str) -> list[str]:
    """Manifests that count, oldest first: those from the last replacement on."""
    found = files.names(f"{path}/{MANIFESTS}")
    last = max((i for i, n in enumerate(found) if n.split("-")[1] == "replace"), default=0)
    return found[last:]


class Blocks(InputPartition):
    """Blocks one task reads: [(file, block numbers), ...]."""


def may_hold(table, f: Filter):
    """Which blocks may hold rows that pass ``f`` (an Arrow boolean array, null: may)."""
    import pyarrow.compute as pc
    c = f.attribute[0]
    lo, hi, nulls, rows = table[f"lo_{c}"], table[f"hi_{c}"], table[f"nulls_{c}"], table["rows"]
    if isinstance(f, IsNull):
        return pc.greater(nulls, 0)
    some = pc.less(nulls, rows)  # a value that is not null
    if isinstance(f, IsNotNull):
        return some

    def between(least, most):
        inside = some
        if most is not None:
            inside = pc.and_(inside, pc.fill_null(pc.less_equal(lo, most), True))
        if least is not None:
            inside = pc.and_(inside, pc.fill_null(pc.greater_equal(hi, least), True))
        return inside

    if isinstance(f, EqualNullSafe) and f.value is None:
        return pc.greater(nulls, 0)
    if isinstance(f, (EqualTo, EqualNullSafe)):
        return between(f.value, f.value)
    if isinstance(f, In):
        out = None
        for v in f.value:
            if v is not None:
                out = between(v, v) if out is None else pc.or_(out, between(v, v))
        return pc.less(rows, 0) if out is None else out
    if isinstance(f, StringStartsWith):
        return pc.and_(between(f.value, None), pc.fill_null(pc.less_equal(pc.utf8_slice_codeunits(lo, 0, len(f.value)), f.value), True))
    if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
        return between(f.value, None)
    return between(None, f.value)


def passes(batch, f: Filter):
    """Which rows pass ``f``, as SQL decides: a null is not a pass."""
    import pyarrow as pa
    import pyarrow.compute as pc
    c = batch.column(f.attribute[0])
    if isinstance(f, IsNull):
        return pc.is_null(c)
    if isinstance(f, IsNotNull):
        return pc.is_valid(c)
    if isinstance(f, In):
        return pc.and_(pc.is_valid(c), pc.is_in(c, value_set=pa.array([v for v in f.value if v is not None], c.type)))
    if isinstance(f, EqualNullSafe) and f.value is None:
        return pc.is_null(c)
    if isinstance(f, StringStartsWith):
        mask = pc.starts_with(c, f.value)
    else:
        compare = {EqualTo: pc.equal, EqualNullSafe: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal,
                   LessThan: pc.less, LessThanOrEqual: pc.less_equal}[type(f)]
        mask = compare(c, pa.scalar(f.value, c.type))
    return pc.fill_null(mask, False)


class IndexReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, blocks_per_task: int):
        self.path, self.schema, self.blocks_per_task = path.rstrip("/"), schema, blocks_per_task
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        ordered = set(_ordered(self.schema))
        for f in filters:
            known = isinstance(f, _RANGES + (IsNull, IsNotNull)) and len(f.attribute) == 1 and f.attribute[0] in ordered
            if known and (isinstance(f, (IsNull, IsNotNull, EqualNullSafe)) or f.value is not None):
                self.filters.append(f)
            else:
                yield f  # Spark evaluates it

    def blocks(self) -> list[tuple[str, int]]:
        """(file, block) of every block that may hold rows that pass."""
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        stats = sorted({f"{p}_{f.attribute[0]}" for f in self.filters for p in ("lo", "hi", "nulls")})
        out = []
        for name in manifests(self.path):
            fs, path = files.filesystem(f"{self.path}/{MANIFESTS}/{name}")
            table = pq.read_table(path, filesystem=fs, columns=["name", "block", "rows", *stats])
            for f in self.filters:
                table = table.filter(pc.fill_null(may_hold(table, f), True))
            out += zip(table["name"].to_pylist(), table["block"].to_pylist())
        return out

    def partitions(self) -> list[InputPartition]:
        found = self.blocks()
        tasks = []
        for at in range(0, len(found), self.blocks_per_task):
            by_file: dict[str, list[int]] = {}
            for name, block in found[at:at + self.blocks_per_task]:
                by_file.setdefault(name, []).append(block)
            tasks.append(Blocks(list(by_file.items())))
        return tasks or [Blocks([])]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow.parquet as pq
        schema = _arrow(self.schema)
        for name, blocks in partition.value:
            fs, path = files.filesystem(f"{self.path}/{name}")
            with fs.open_input_file(path) as f:
                file = pq.ParquetFile(f, pre_buffer=False)
                for block in blocks:  # one at a time: a batch never spans blocks
                    for batch in file.iter_batches(batch_size=1 << 14, row_groups=[block], columns=schema.names):
                        for condition in self.filters:
                            batch = batch.filter(passes(batch, condition))
                        if batch.num_rows:
                            yield batch.select(schema.names).cast(schema)


class IndexSource(DataSource):
    """Options: ``path``; ``block_rows``, ``block_bytes`` (writing); ``blocks_per_task`` (reading)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        import pyarrow.parquet as pq
        path = self.options["path"].rstrip("/")
        found = manifests(path)
        if not found:
            raise FileNotFoundError(f"nothing was committed to {path}")
        fs, leaf = files.filesystem(f"{path}/{MANIFESTS}/{found[-1]}")
        return T.StructType.fromJson(json.loads(pq.read_schema(leaf, filesystem=fs).metadata[b"documents"]))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return IndexReader(self.options["path"], schema, int(self.options.get("blocks_per_task", "4")))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return IndexWriter(self.options["path"], schema, overwrite, int(self.options.get("block_rows", str(BLOCK_ROWS))),
                           int(self.options.get("block_bytes", str(BLOCK_BYTES))))


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let filters reach Python sources."""
    spark.dataSource.register(IndexSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_index(df: DataFrame, path: str, mode: str = "append", order: list[str] | None = None, files_wanted: int | None = None,
                block_rows: int = BLOCK_ROWS) -> None:
    """Write ``df`` in one commit. With ``order`` rows are range-sorted first, so blocks hold
    narrow ranges and filters on those columns skip most of them."""
    register(df.sparkSession)
    if order:
        n = files_wanted or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    df.write.format(FORMAT).mode(mode).option("block_rows", str(block_rows)).save(path)


def read_index(spark: SparkSession, path: str, columns: list[str] | None = None, blocks_per_task: int = 4) -> DataFrame:
    """The committed documents. Only ``columns`` are read from the files (Python sources are
    not told which columns a query needs, so the reader names them)."""
    register(spark)
    reader = spark.read.format(FORMAT).option("blocks_per_task", str(blocks_per_task))
    if columns:
        whole = IndexSource({"path": path}).schema()
        reader = reader.schema(T.StructType([whole[c] for c in columns]))
    return reader.load(path)
