"""Column expressions used by the reports (F-1 ... F-16).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.fixed import COUNTER_PREFIX


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_part(c, sep: str = "_") -> Column:
    """Text after the last ``sep``; the whole text when there is none; null stays null."""
    return F.substring_index(col_of(c), sep, -1)


def with_default(c, default: str) -> Column:
    """IFNULL with a text default. The value is cast to text first so that an
    integer column does not turn the default into a number (ANSI mode)."""
    return F.coalesce(col_of(c).cast("string"), F.lit(default))


def differs_flag(a, b) -> Column:
    """``if(a = b, 0, 1)``: 0 when equal, 1 when different or either is null."""
    return F.when(col_of(a) == col_of(b), F.lit(0)).otherwise(F.lit(1)).cast("int")


def dashed_day(month, day) -> Column:
    """yyyyMM + dd -> yyyy-MM-dd (null if a part is null)."""
    m = col_of(month)
    return F.concat(F.left(m, F.lit(4)), F.lit("-"), F.right(m, F.lit(2)), F.lit("-"), col_of(day))


def compact_day(month, day) -> Column:
    """yyyyMM + dd -> yyyyMMdd."""
    return F.concat(col_of(month), col_of(day))


def json_field(c, field: str) -> Column:
    """A top-level JSON field as text; numbers come back as text, bad JSON as null."""
    return F.get_json_object(col_of(c), f"$.{field}")


def first_element(arr) -> Column:
    """Element 0 of an array, null for an empty or null array (``imp[0]`` of 2.4)."""
    return F.get(col_of(arr), 0)


def null_safe_sum(c) -> Column:
    """IFNULL(SUM(x), 0)."""
    return F.coalesce(F.sum(col_of(c)), F.lit(0)).cast("bigint")


def row_count() -> Column:
    """sum(1) as bigint."""
    return F.count(F.lit(1))


def span_text(begin, end) -> Column:
    """``begin_end`` text of a segment."""
    return F.concat_ws("_", col_of(begin).cast("string"), col_of(end).cast("string"))


def clamp_low(c, low: int = 0) -> Column:
    return F.greatest(col_of(c), F.lit(low))


def flag_doc_id(dealid, day) -> Column:
    """Document id of a cap flag: deal id and day joined without a separator."""
    return F.concat(col_of(dealid), col_of(day))


def counter_key(dealid, prefix: str = COUNTER_PREFIX) -> Column:
    """Key of the additive exposure counter; a null deal id gives ``<prefix>null``."""
    return F.concat(F.lit(prefix), F.coalesce(col_of(dealid), F.lit("null")))
