"""What changed between two loads of a table, found by comparing trees of row hashes.

A load is stored in ranges of the hash of its id: rows, a leaf (id and row hash) per row, and a
root (row count and hash) per range. Two loads with the same number of ranges differ only in ranges whose
roots differ, and of those alone leaves and rows are read. Leaves and roots alone (a tree) tell what changed; rows
are stored for loads whose rows are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.sources import storage

RANGE = "id_range"
#: Rows of a range, about, and ranges of a load, at most. A root is 40 bytes, so the roots that
#: are compared are 3 MB at most.
RANGE_ROWS, MOST_RANGES = 50_000, 1 << 16
INSERTED, CHANGED, DELETED, SAME = "inserted", "changed", "deleted", "same"


def row_hashes(names: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row, in its columns one way and the other, places of nulls included: two different rows
    agree in both by a chance of 1 in 2**128."""
    values = [F.col(f"`{n}`") for n in names]
    gaps = [v.isNull() for v in values]
    return [F.xxhash64(*values, *gaps), F.xxhash64(F.lit(7), *reversed(gaps), *reversed(values))]


def ranges_for(rows: int) -> int:
    return min(MOST_RANGES, max(1, -(-rows // RANGE_ROWS)))


def _place(key: str, ranges: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")


def write_rows(df: DataFrame, path: str, key: str, ranges: int) -> None:
    """Store the rows of a load below `path`; rows without a key are left out."""
    keyed = df.where(F.col(key).isNotNull()).withColumn(RANGE, _place(key, ranges))
    _write_columns(keyed, path, "rows")
    # adaptive execution merges small ranges into one task and splits large ones
    storage.write_table(keyed.hint("rebalance", RANGE), f"{path}/rows", if_exists="fail", partition_by=(RANGE,))


def _write_columns(table: DataFrame, path: str, name: str) -> None:
    storage.write_table(table.limit(0).coalesce(1), f"{path}/columns-{name}", if_exists="fail")  # tables in partitions without rows have no files


def write_tree(df: DataFrame, path: str, key: str, ranges: int, dealt: bool = False) -> None:
    """Store leaves and roots of a load below `path`, which is all that comparing loads reads: of a row, its key and
    two hashes are shuffled. `dealt`: rows lie by range already and stay where they are."""
    h1, h2 = row_hashes([c for c in df.columns if c != RANGE])
    leaves = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), h1.alias("h1"), h2.alias("h2"), _place(key, ranges).alias(RANGE))
    _write_columns(leaves, path, "leaves")
    storage.write_table(leaves if dealt else leaves.hint("rebalance", RANGE), f"{path}/leaves", if_exists="fail", partition_by=(RANGE,))
    leaves = storage.read_table(df.sparkSession, f"{path}/leaves", leaves.schema)
    roots = leaves.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    storage.write_table(roots.withColumn("ranges", F.lit(ranges)).coalesce(1), f"{path}/roots", if_exists="fail")


def write_load(df: DataFrame, path: str, key: str, ranges: int) -> None:
    """Store a load below `path`: rows, leaves and roots. `key` must be unique; rows without one are left out."""
    write_rows(df, path, key, ranges)
    write_tree(read_load(df.sparkSession, path), path, key, ranges, dealt=True)


def _part(spark: SparkSession, path: str, name: str) -> DataFrame:
    return storage.read_table(spark, f"{path}/{name}", storage.read_table(spark, f"{path}/columns-{name}").schema)


def read_load(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored load, with their range."""
    return _part(spark, path, "rows")


def _roots(spark: SparkSession, path: str) -> DataFrame:
    return storage.read_table(spark, f"{path}/roots")


def load_ranges(spark: SparkSession, path: str) -> int | None:
    """The number of ranges a load was stored in; None for one without rows."""
    return _roots(spark, path).agg(F.max("ranges")).first()[0]


def changed_ranges(spark: SparkSession, old: str, new: str) -> list[int]:
    """The ranges whose roots differ, at most MOST_RANGES numbers."""
    stored = {n for n in (load_ranges(spark, old), load_ranges(spark, new)) if n is not None}
    if len(stored) > 1:
        raise ValueError(f"loads in different numbers of ranges: {sorted(stored)}")
    a, b = _roots(spark, old).alias("a"), _roots(spark, new).alias("b")
    same = F.lit(True)
    for column in ("n", "h1", "h2"):
        same = same & F.col(f"a.{column}").eqNullSafe(F.col(f"b.{column}"))
    met = a.join(b, F.col(f"a.{RANGE}") == F.col(f"b.{RANGE}"), "full").where(~same)
    found = met.select(F.coalesce(F.col(f"a.{RANGE}"), F.col(f"b.{RANGE}"))).collect()
    return sorted(r[0] for r in found)


def _leaves(spark: SparkSession, path: str, ranges: list[int]) -> DataFrame:
    return _part(spark, path, "leaves").where(F.col(RANGE).isin(ranges))


def load_changes(spark: SparkSession, old: str, new: str) -> DataFrame:
    """(id, change) for every id that was inserted, changed or deleted from the old load to the new
    one. Only the leaves of ranges whose roots differ are read."""
    ranges = changed_ranges(spark, old, new)
    a, b = _leaves(spark, old, ranges).alias("a"), _leaves(spark, new, ranges).alias("b")
    met = a.join(b, F.col("a.id") == F.col("b.id"), "full")
    change = F.when(F.col("a.id").isNull(), INSERTED).when(F.col("b.id").isNull(), DELETED)
    change = change.when((F.col("a.h1") != F.col("b.h1")) | (F.col("a.h2") != F.col("b.h2")), CHANGED)
    return met.select(F.coalesce("a.id", "b.id").alias("id"), change.alias("change")).where("change IS NOT NULL")


def change_counts(spark: SparkSession, old: str, new: str, changes: DataFrame | None = None) -> DataFrame:
    """(change, row_count), one row per kind; rows that stayed the same are counted from the roots."""
    changes = load_changes(spark, old, new) if changes is None else changes
    counted = changes.agg(*[F.count_if(F.col("change") == c).alias(c) for c in (INSERTED, CHANGED, DELETED)])
    total = _roots(spark, old).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()[0]
    stayed = (F.lit(total) - F.col(CHANGED) - F.col(DELETED)).alias(SAME)
    counted = counted.select("*", stayed)
    return counted.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("change"), F.col(c).alias("row_count")) for c in (INSERTED, CHANGED, DELETED, SAME)]))
    )


def changed_rows(spark: SparkSession, old: str, new: str, key: str, changes: DataFrame | None = None) -> DataFrame:
    """The rows of the new load that were inserted or changed, read from the ranges that differ."""
    changes = load_changes(spark, old, new) if changes is None else changes
    rows = read_load(spark, new).where(F.col(RANGE).isin(changed_ranges(spark, old, new)))
    wanted = changes.where(F.col("change") != DELETED).select(F.col("id").alias(key))
    # ids are hashed and the wide rows stream past them, unsorted
    return rows.join(wanted.hint("shuffle_hash"), key, "left_semi").drop(RANGE)


def follow_load(spark: SparkSession, target: str, old: str, new: str) -> list[int]:
    """Bring a table that holds the rows of the old load, in the same ranges, to those of the new one: only
    ranges that differ are written again. Returns them.

    Each range is replaced as a whole when the write ends; a failed write can be run again. Ranges that
    the new load no longer has are replaced by nothing.
    """
    ranges = changed_ranges(spark, old, new)
    if ranges:
        rows = read_load(spark, new).where(F.col(RANGE).isin(ranges))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(RANGE).parquet(target)
        left = {r[0] for r in _roots(spark, new).select(RANGE).collect()}
        for gone in set(ranges) - left:
            storage.remove_folder(spark, f"{target}/{RANGE}={gone}")
    return ranges
