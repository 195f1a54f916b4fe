"""Exact distinct counts over any span of days, from stored bitmaps of the dense dimension keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.operators.reports import DURATION, ENROLLMENT
from trialmart.operators.warehouse import Star

#: Report -> the columns whose distinct keys it counts.
COUNTED = {
    "all": ("sponsor_key", "condition_key", "location_key"),
    "condition_category": ("sponsor_key",),
    "intervention_type": ("condition_key",),
}
MEASURES = (ENROLLMENT, DURATION)


def _labelled(star: Star) -> DataFrame:
    """Facts with the label of each report; NULL where the report leaves the fact out."""
    category = star.condition.select("condition_key", "condition_category")
    kind = star.intervention.select("intervention_key", "intervention_type")
    facts = star.fact.join(category, "condition_key", "left").join(kind, "intervention_key", "left")
    labels = [
        F.lit("").alias("all"),
        F.when(F.col("sponsor_key").isNotNull(), F.col("condition_category")).alias("condition_category"),
        F.when(F.col("condition_key").isNotNull(), F.col("intervention_type")).alias("intervention_type"),
    ]
    return facts.select("start_date_key", *COUNTED["all"], *MEASURES, *labels)


def day_bitmaps(star: Star) -> DataFrame:
    """One row (report, label, start_date_key, column_name, bucket, bits) per 32,768 keys of a column that
    occur on a day under a label; a day without a date is NULL. Rows of several loads may be put together: bits are joined by OR.

    Distinct keys are found before there are bitmaps and dealt by group, so that what is shuffled and sorted are a few bytes
    a key, never bitmaps of 4 KB that hold a bit or two of each task's share."""
    facts = _labelled(star)
    parts = []
    for report, columns in COUNTED.items():
        for column in columns:
            rows = facts.where(F.col(column).isNotNull() & F.col(report).isNotNull())
            keys = rows.select(F.col(report).alias("label"), "start_date_key", F.col(column).alias("key")).distinct()
            keys = keys.withColumn("bucket", F.bitmap_bucket_number(F.col("key"))).repartition("label", "start_date_key", "bucket")
            bits = keys.groupBy("label", "start_date_key", "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("key"))).alias("bits"))
            parts.append(bits.select(F.lit(report).alias("report"), "label", "start_date_key", F.lit(column).alias("column_name"), "bucket", "bits"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def day_sums(star: Star) -> DataFrame:
    """One row (report, label, start_date_key, n, and count and sum of each measure) per day and label; rows add up."""
    facts = _labelled(star)
    parts = []
    for report in COUNTED:
        sums = [f for m in MEASURES for f in (F.count(m).alias(f"{m}_n"), F.sum(m).alias(f"{m}_sum"))]
        rows = facts.where(F.col(report).isNotNull()).groupBy(F.lit(report).alias("report"), F.col(report).alias("label"), "start_date_key")
        parts.append(rows.agg(F.count(F.lit(1)).alias("n"), *sums))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _of_span(rows: DataFrame, report: str, first: int | None, last: int | None) -> DataFrame:
    rows = rows.where(F.col("report") == report)
    if first is not None:
        rows = rows.where(F.col("start_date_key") >= first)
    return rows if last is None else rows.where(F.col("start_date_key") <= last)


def span_counts(bits: DataFrame, sums: DataFrame, report: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Per label: trials, distinct keys of each counted column (as `<column>s`), and means and sums of the measures
    over the days from `first` to `last` (yyyymmdd, either may be open; with both open, facts without a day count too)."""
    joined = _of_span(bits, report, first, last).groupBy("label", "column_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = joined.groupBy("label").agg(
        *[F.coalesce(F.sum(F.when(F.col("column_name") == c, F.bitmap_count("bits"))), F.lit(0)).alias(f"{c}s") for c in COUNTED[report]]
    )
    added = _of_span(sums, report, first, last).groupBy("label").agg(
        F.sum("n").alias("trial_count"),
        *[F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")).alias(f"avg_{m}") for m in MEASURES],
        *[F.sum(f"{m}_sum").alias(f"total_{m}") for m in MEASURES],
    )
    keys = [F.coalesce(F.col(f"{c}s"), F.lit(0)).alias(f"{c}s") for c in COUNTED[report]]
    names = ["label", "trial_count", *[f"avg_{m}" for m in MEASURES], *[f"total_{m}" for m in MEASURES]]
    return added.join(counted, "label", "left").select(*names, *keys)


def dash_metrics(bits: DataFrame, sums: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """The headline metrics of a span of days; one row, of zeros and NULLs where nothing started."""
    found = span_counts(bits, sums, "all", first, last)
    return found.agg(
        F.coalesce(F.sum("trial_count"), F.lit(0)).alias("total_trials"),
        *[F.coalesce(F.sum(f"{c}_keys"), F.lit(0)).alias(f"unique_{c}s") for c in ("sponsor", "condition", "location")],
        F.max(f"avg_{ENROLLMENT}").alias("avg_enrollment"),
        F.max(f"avg_{DURATION}").alias("avg_duration"),
    )


def condition_category(bits: DataFrame, sums: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    found = span_counts(bits, sums, "condition_category", first, last)
    return found.select(
        F.col("label").alias("condition_category"),
        "trial_count",
        F.col("sponsor_keys").alias("unique_sponsors"),
        F.col(f"avg_{ENROLLMENT}").alias("avg_enrollment"),
        F.col(f"avg_{DURATION}").alias("avg_duration"),
        F.col(f"total_{ENROLLMENT}").alias("total_enrollment"),
    ).orderBy(F.desc("trial_count"), "condition_category")


def intervention_types(bits: DataFrame, sums: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    found = span_counts(bits, sums, "intervention_type", first, last)
    return found.select(
        F.col("label").alias("intervention_type"),
        "trial_count",
        F.col(f"avg_{ENROLLMENT}").alias("avg_enrollment"),
        F.col(f"avg_{DURATION}").alias("avg_duration"),
        F.col("condition_keys").alias("unique_conditions"),
    ).orderBy(F.desc("trial_count"), "intervention_type")
