"""One row per key, and dense ordinal keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# monotonically_increasing_id puts the partition number above the lowest 33 bits and the
# row's place in its partition into them.
_PLACE_BITS = 33
POSITION = "load_position"
#: Keys that are broadcast, at most, after they were counted.
MOST_BROADCAST = 1_000_000


def first_by_key(df: DataFrame, key: str) -> DataFrame:
    """Per key, the row that sorts first by the other columns in their order (NULLs first).

    Spark keeps one row per key on the map side before it shuffles (a window group limit),
    so a key with very many rows costs one row per map task.
    """
    others = [F.col(name) for name in df.columns if name != key]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*others))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def place_in_order(df: DataFrame, key: str) -> DataFrame:
    """Range-partition and sort by the (unique) key and note each row's place.

    The places mean something only for this one execution, since another one may sample
    other range bounds. Write the result and number the rows from the written table.
    """
    ordered = df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
    return ordered.withColumn(POSITION, F.monotonically_increasing_id())


def number_rows(written: DataFrame, name: str) -> DataFrame:
    """Replace the noted places by 1, 2, 3, … over the whole table, in key order."""
    part = F.shiftright(POSITION, _PLACE_BITS)
    place = F.col(POSITION).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    sizes = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per written range partition, so at most as many as shuffle partitions: this
    # window and the broadcast stay small whatever the table holds.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    others = [c for c in written.columns if c != POSITION]
    return (
        written.withColumns({"_part": part, "_place": place})
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + F.col("_place") + 1).alias(name), *others)
    )


def extend_keys(known: DataFrame, new_ids: DataFrame, key: str, name: str) -> DataFrame:
    """A key map (key, name) with the new ids in it: known ids keep their number, new ones follow the
    largest in key order. `known` is a stored map, `new_ids` a table written by place_in_order.

    An id that is lost from a later load stays in the map, so it has its old number when it returns.
    """
    largest = known.agg(F.max(name)).first()[0] or 0
    numbered = number_rows(new_ids.select(key, POSITION), name)
    return known.select(key, name).unionByName(numbered.select(key, (F.col(name) + F.lit(largest)).alias(name)))
