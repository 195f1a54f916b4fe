"""Data quality: table reports, key checks, row rules and job metrics."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from trialmart.functions.numbers import round_even
from trialmart.functions.text import valid_email
from trialmart.operators.clean import dates_in_order, enrollment_plausible, phase_known
from trialmart.operators.keys import repeated_keys
from trialmart.operators.warehouse import Star

JOB_RUN_SCHEMA = (
    "job_name string, step string, start_time timestamp, duration_seconds double, "
    "row_count bigint, rows_per_second double"
)


def missing_values(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, from one aggregate over the table."""
    names = df.columns
    by_place = df.toDF(*[f"c{i}" for i in range(len(names))])
    counts = by_place.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in by_place.columns]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(c).alias("missing_count"))
            for name, c in zip(names, by_place.columns)
        ]
    )
    share = F.try_divide(F.col("missing_count") * F.lit(100.0), F.col("n"))
    listed = counts.filter("n > 0").select("n", F.inline(pairs))
    return listed.select("column_name", "missing_count", round_even(share, 2).alias("missing_percentage"))


def _shape(column: Column, kind: DataType) -> list[Column]:
    """Where a value is null and how long its arrays are: what xxhash64 passes over."""
    found = [column.isNull()]
    if isinstance(kind, StructType):
        for field in kind.fields:
            found += _shape(column.getField(field.name), field.dataType)
    if isinstance(kind, ArrayType):
        found += [F.size(column), F.transform(column, lambda x: F.struct(*_shape(x, kind.elementType)))]
    return found


def quality_report(df: DataFrame, required: list[str]) -> DataFrame:
    """One row of table metrics. Required columns the table lacks are left out; with none
    present the table counts as complete. An empty table scores 0 throughout.

    Duplicates are rows equal to an earlier row in all columns. Rows are told apart by two
    64-bit hashes over all columns, in either order, and over the places of their nulls, which a hash of
    the values alone passes over. With the counts that is all that is shuffled. If the hashes behave as
    independent, two different rows in a table of a billion coincide with a chance of about 1 in 10^21.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    present = [names[df.columns.index(c)] for c in required if c in df.columns]
    nulls = [x for name, field in zip(names, df.schema.fields, strict=True) for x in _shape(F.col(name), field.dataType)]
    keys = [F.xxhash64(*names, *nulls).alias("h1"), F.xxhash64(F.lit("second"), *reversed(names), *nulls).alias("h2")]
    filled = sum((F.col(c).isNotNull().cast("int") for c in present), F.lit(0))
    rows = df.toDF(*names).select(*keys, filled.alias("filled"))
    groups = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.sum("filled").alias("filled"))
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("filled"), F.lit(0)).alias("filled"),
    )
    total = F.col("total_rows").cast("double")
    share = F.try_divide(F.col("duplicate_rows") * F.lit(100.0), total)
    complete = F.try_divide(F.col("filled") * F.lit(100.0), total * len(present)) if present else F.lit(100.0)
    complete = F.when(F.col("total_rows") > 0, complete).otherwise(0.0)
    shown = counts.select(
        "total_rows", "duplicate_rows", F.coalesce(share, F.lit(0.0)).alias("share"), complete.alias("complete")
    )
    score = F.lit(100.0) - F.col("share") * F.lit(2.0) - (F.lit(100.0) - F.col("complete"))
    return shown.select(
        "total_rows",
        "duplicate_rows",
        round_even(F.col("share"), 2).alias("duplicate_percentage"),
        round_even(F.col("complete"), 2).alias("completeness"),
        round_even(F.greatest(F.lit(0.0), score), 2).alias("quality_score"),
    )


def referential_integrity(star: Star) -> DataFrame:
    """Per dimension key of the fact: rows with no key, and rows whose key has no member.

    The fact is read once and counted by (column, key) before the join, so a key or gap shared by
    many facts is one row there.
    """
    members = {
        "sponsor_key": (star.sponsor, "sponsor_key"),
        "location_key": (star.location, "location_key"),
        "condition_key": (star.condition, "condition_key"),
        "intervention_key": (star.intervention, "intervention_key"),
        "start_date_key": (star.dates, "date_key"),
        "completion_date_key": (star.dates, "date_key"),
    }
    keys = F.array(*[F.struct(F.lit(c).alias("fact_column"), F.col(c).cast("bigint").alias("key")) for c in members])
    held = star.fact.select(F.inline(keys)).groupBy("fact_column", "key").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for column, (dim, key) in members.items():
        part = dim.select(F.lit(column).alias("fact_column"), F.col(key).cast("bigint").alias("key"), F.lit(True).alias("known"))
        known = part if known is None else known.unionByName(part)
    joined = held.join(known, ["fact_column", "key"], "left")
    gap = F.when(F.col("key").isNull(), F.col("n")).otherwise(0)
    orphan = F.when(F.col("key").isNotNull() & F.col("known").isNull(), F.col("n")).otherwise(0)
    return joined.groupBy("fact_column").agg(F.sum(gap).alias("null_keys"), F.sum(orphan).alias("orphan_keys"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return repeated_keys(df.filter(F.col(key).isNotNull()), key)


# Row rules over cleaned trials; each holds, fails, or (NULL) does not apply.
BUSINESS_RULES: dict[str, Callable[[], Column]] = {
    "dates_in_order": dates_in_order,
    "enrollment_in_range": enrollment_plausible,
    "phase_known": phase_known,
}


def business_rules(clean: DataFrame) -> DataFrame:
    """Rows that fail each rule, from one aggregate."""
    counts = clean.agg(*[F.count_if(~rule()).alias(name) for name, rule in BUSINESS_RULES.items()])
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(name).alias("failing_rows"))
            for name in BUSINESS_RULES
        ]
    )
    return counts.select(F.inline(pairs))


def email_rule(df: DataFrame, column: str) -> DataFrame:
    """Rows by whether the column holds a well-formed e-mail address."""
    return df.groupBy(valid_email(F.col(column)).alias("is_valid")).agg(F.count(F.lit(1)).alias("row_count"))


def run_observed(job_name: str, step: str, df: DataFrame, write: Callable[[DataFrame], None]) -> Row:
    """Write a frame and count its rows in the same pass; returns the job record."""
    observed = Observation(f"{job_name}.{step}")
    started, clock = dt.datetime.now(), time.monotonic()
    write(df.observe(observed, F.count(F.lit(1)).alias("row_count")))
    seconds = time.monotonic() - clock
    rows = int(observed.get["row_count"])
    return Row(
        job_name=job_name,
        step=step,
        start_time=started,
        duration_seconds=round(seconds, 2),
        row_count=rows,
        rows_per_second=round(rows / seconds, 2) if seconds > 0 else 0.0,
    )


def job_metrics(spark: SparkSession, records: list[Row]) -> DataFrame:
    """The run log: one row per step of a job."""
    return spark.createDataFrame(records, JOB_RUN_SCHEMA)
