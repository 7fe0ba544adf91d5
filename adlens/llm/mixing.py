"""Mixing sources to target weights (operator 9).

Every row gets a hash-random key. Rows are range-sorted by (source, key); each range
partition sums its sizes per source, the sums are carried forward, and a window inside
(partition, source) finishes the prefix sums. A source of any size is thus spread over
as many tasks as its rows need. A row takes what the source's exact budget leaves for
it: whole epochs first, then the part of the last epoch that lies before the cut. The
row at the cut is taken in part (its first words), so a source's taken words equal its
rounded target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import GAP, WORD, partitions, staged


def sizes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, text_md5, key, size) per row: words of the text (null: 0) and a hash-random key."""
    digest = F.md5(F.coalesce("text", F.lit("")))
    return docs.select(
        "doc_id", "source", digest.alias("text_md5"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest)).alias("key"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) per source.

    Sources in code point order, null last, get ``weights`` in turn and share the total
    size. A target stops at ``max_epochs`` times its source's size; the excess is shared
    by weight among the others until none is above. That is a water level: order the
    sources by cap / weight; those below the level take their cap, the others weight
    times level. One row per source flows through the two unpartitioned windows.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # The first source in this order that the level does not fill sets the level for all after it.
    per = per.withColumn("level", level).withColumn("filled", F.col("weight") * F.col("level") >= F.col("cap"))
    first = F.min(F.when(~F.col("filled"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(every)
    return (per.withColumn("water", first["level"])
            .select("source", "source_size",
                    F.when(F.col("water").isNull() | (F.col("weight") * F.col("water") >= F.col("cap")), F.col("cap").cast("double"))
                    .otherwise(F.col("weight") * F.col("water")).alias("target")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 0) -> DataFrame:
    """(doc_id, source, text_md5, occurrence, size, source_size, target, taken) per row of
    ``docs`` (doc_id, text, source).

    A null source is a source of its own; null and empty texts have size 0 and take 0;
    equal rows are told apart by ``occurrence``; reruns give equal results. Extra columns
    are not carried. An empty table gives no rows.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    sized = staged(sizes(docs, seed), "sizes")
    goal = staged(targets(sized, weights, max_epochs), "targets")
    ranged = staged(sized.repartitionByRange(n, F.col("source").asc_nulls_last(), "key", "doc_id")
                    .withColumn("part", F.spark_partition_id()), "ranged")
    carry = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ranged.groupBy("source", "part").agg(F.sum("size").alias("held"))
               .select("source", "part", F.coalesce(F.sum("held").over(carry), F.lit(0)).alias("carried")))
    carried = carried.join(goal, carried["source"].eqNullSafe(goal["source"])).select(
        carried["source"].alias("s"), F.col("part").alias("p"), "carried", "source_size", "target")
    inside = Window.partitionBy("part", "source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("part", "source", "key", "doc_id").orderBy("text_md5")
    rows = (ranged.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(carried, (ranged["part"] == F.col("p")) & ranged["source"].eqNullSafe(F.col("s"))))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size")
    return (rows.withColumn("epochs", epochs)
            .withColumn("taken", F.col("epochs") * F.col("size")
                        + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("carried") - F.col("inside"))))
            .withColumn("occurrence", F.row_number().over(same))
            .select("doc_id", "source", "text_md5", "occurrence", "size", "source_size", "target",
                    F.col("taken").cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 0) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row once per epoch that takes it
    whole, and once more with its first words when the budget cuts inside it.

    A cut text ends after its last taken word; ``n_chars``, if there, follows the cut
    text. Rows of which nothing is taken go, except rows without words, which cost no
    budget and stay once.
    """
    taken = staged(mix(docs, weights, max_epochs, seed), "mix").select(
        *_identity(F.col("text_md5")), F.col("occurrence").alias("k5"), F.col("size").alias("whole_size"), "taken")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *_identity(F.md5(F.coalesce("text", F.lit("")))))
    keys = ["k0", "k1", "k2", "k3", "k4"]
    rows = rows.withColumn("k5", F.row_number().over(Window.partitionBy(*keys).orderBy("k4")))
    empty = F.col("whole_size") == 0
    whole = F.when(empty, F.lit(1)).otherwise(F.floor(F.col("taken") / F.col("whole_size"))).cast("int")
    rest = F.when(empty, F.lit(0)).otherwise(F.col("taken") % F.col("whole_size")).cast("long")
    copies = F.concat(F.array_repeat(F.col("whole_size"), whole),
                      F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    out = rows.join(taken, keys + ["k5"]).select("row", "whole_size", F.explode(copies).alias("take"))
    # The first words of a cut text, each with the gap before it.
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(f"((?:{GAP})?{WORD})"), F.lit(1)),
                                 1, F.col("take").cast("int")), "")
    out = out.select("row", F.when(F.col("take") < F.col("whole_size"), first).alias("cut"))
    changed = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("cut").cast(docs.schema["n_chars"].dataType)
    return out.select(*[F.coalesce(changed[c], F.col(f"row.`{c}`")).alias(c) if c in changed else F.col(f"row.`{c}`").alias(c)
                        for c in docs.columns])


def _identity(text_md5):
    """Join keys that tell rows apart, nulls included."""
    return [F.col("doc_id").isNull().alias("k0"), F.coalesce("doc_id", F.lit(0)).alias("k1"),
            F.col("source").isNull().alias("k2"), F.coalesce("source", F.lit("")).alias("k3"), text_md5.alias("k4")]
