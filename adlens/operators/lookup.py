"""Dimension lookups (J-1, J-2) with a checked broadcast.

A dimension side is broadcast only after counting it under a row bound
(``limit(bound + 1).count()`` reads at most bound + 1 rows). Above the bound
the join is left to the planner: a shuffled join, with AQE splitting skewed
fact partitions and converting to broadcast if runtime sizes allow it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.scalar import with_default

# Rows of these dimension tables are ~60 bytes: 200k rows is ~12 MB per copy,
# about Spark's own default broadcast threshold. Larger sides are shuffled.
DEFAULT_BROADCAST_ROWS = 200_000


def bounded_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(dim)`` if it has at most ``max_rows`` rows, else ``dim`` unchanged."""
    if max_rows > 0 and dim.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(dim)
    return dim


def left_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                take: dict[str, str], defaults: dict[str, str] | None = None,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """fact LEFT JOIN dim ON fact_key = dim_key, adding ``take`` columns (dim name -> out name).

    Dimension rows are not de-duplicated: two rows for one key give two fact rows,
    as in the reference. ``defaults`` maps an out name to the text used on no match.
    """
    defaults = defaults or {}
    d = dim.select(F.col(dim_key).alias("__dim_key"),
                   *[F.col(src).alias(f"__dim_{out}") for src, out in take.items()])
    d = bounded_broadcast(d, max_broadcast_rows)
    joined = fact.join(d, fact[fact_key] == d["__dim_key"], "left")
    out_cols = []
    for src, out in take.items():
        c = F.col(f"__dim_{out}")
        out_cols.append((with_default(c, defaults[out]) if out in defaults else c).alias(out))
    keep = [F.col(c) for c in fact.columns]
    return joined.select(*keep, *out_cols)
