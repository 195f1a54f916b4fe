"""Summaries of facts that are kept up from load to load, and the roll-ups that read them.

A summary holds, per group of keys, the rows and the count, sum, minimum and maximum of each measure. A new
load is compared with the one before by hash trees; rows that came are added and rows that went
subtracted, so the unchanged ranges of the facts are not read. Only a minimum or maximum whose row
went, with none as extreme among those that came, is looked up in the new load again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.functions.dates import month_start
from trialmart.operators import differences
from trialmart.operators.warehouse import Star
from trialmart.sources import storage

ENROLLMENT, DURATION, LASTING = "enrollment_count", "duration_days", "lasting_days"
MEASURES = (ENROLLMENT, DURATION, LASTING)
#: Keys of the summaries that the roll-ups read.
BY_CONDITION = ("condition_key", "start_date_key")
BY_PLACE = ("location_key", "start_date_key")

_SIGN = "_sign"


def with_measures(facts: DataFrame) -> DataFrame:
    """Facts with the measure of durations above zero."""
    return facts.withColumn(LASTING, F.when(F.col(DURATION) > 0, F.col(DURATION)))


def _extremes(measures: tuple[str, ...], rows: str = "") -> list[Column]:
    """Minimum and maximum of each measure, over the rows for which `rows` holds."""
    value = (lambda m: F.when(F.expr(rows), F.col(m))) if rows else F.col
    return [f(value(m)).alias(f"{m}_{f.__name__}") for m in measures for f in (F.min, F.max)]


def summarise(rows: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """One row per group: keys, n, and `_n`, `_sum`, `_min` and `_max` of each measure (whole numbers).

    Null keys are groups of their own. The map side of the one grouping absorbs a hot group.
    """
    parts = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        parts += [F.count(m).alias(f"{m}_n"), F.sum(m).cast("bigint").alias(f"{m}_sum")]
    return rows.groupBy(*keys).agg(*parts, *_extremes(measures))


def moved_rows(spark: SparkSession, old: str, new: str, key: str) -> DataFrame:
    """Rows of the old load that were deleted or changed (sign -1) and of the new one that were inserted
    or changed (sign 1), read from the ranges that differ."""
    changes = storage.materialize(differences.load_changes(spark, old, new), "changes")
    came = differences.changed_rows(spark, old, new, key, changes).withColumn(_SIGN, F.lit(1))
    went = changes.where(F.col("change") != differences.INSERTED).select(F.col("id").alias(key))
    ranges = differences.changed_ranges(spark, old, new)
    rows = differences.read_load(spark, old).where(F.col(differences.RANGE).isin(ranges)).drop(differences.RANGE)
    return came.unionByName(rows.join(went, key, "left_semi").withColumn(_SIGN, F.lit(-1)))


def merged(summary: DataFrame, moved: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """The summary with moved rows added and subtracted, and `_lost` for each minimum and maximum that must be looked up.

    Groups without rows are gone. One grouping of the summary and of the moved rows' own sums.
    """
    signed = moved.groupBy(*keys).agg(
        F.sum(_SIGN).alias("n"),
        *[
            c
            for m in measures
            for c in (
                F.sum(F.when(F.col(m).isNotNull(), F.col(_SIGN))).alias(f"{m}_n"),
                F.sum(F.col(m) * F.col(_SIGN)).cast("bigint").alias(f"{m}_sum"),
            )
        ],
        *_extremes(measures, f"{_SIGN} > 0"),
        *[f(F.when(F.col(_SIGN) < 0, F.col(m))).alias(f"{m}_gone_{f.__name__}") for m in measures for f in (F.min, F.max)],
    )
    kept = [f"{m}_{f}" for m in measures for f in ("min", "max")]
    old = summary.withColumns({f"{c}_old": F.col(c) for c in kept}).drop(*kept)
    both = old.unionByName(signed, allowMissingColumns=True)
    adding = ["n", *[f"{m}_{f}" for m in measures for f in ("n", "sum")]]
    low, high = ([f"{m}_{when}{f}{after}" for m in measures for when, after in (("", ""), ("gone_", ""), ("", "_old"))] for f in ("min", "max"))
    sums = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in adding], *[F.min(c).alias(c) for c in low], *[F.max(c).alias(c) for c in high])

    def extreme(m: str, f: str) -> tuple[Column, Column]:
        came, went, old = F.col(f"{m}_{f}"), F.col(f"{m}_gone_{f}"), F.col(f"{m}_{f}_old")
        pick = F.least if f == "min" else F.greatest
        covered = F.coalesce(pick(came, went) == came, F.lit(False))
        lost = F.coalesce(went == old, F.lit(False)) & ~covered & (F.col(f"{m}_n") > 0)
        return F.when(F.col(f"{m}_n") > 0, pick(came, old)), lost

    out = [*keys, "n"]
    for m in measures:
        some = F.col(f"{m}_n") > 0
        out += [F.coalesce(f"{m}_n", F.lit(0)).cast("bigint").alias(f"{m}_n"), F.when(some, F.col(f"{m}_sum")).cast("bigint").alias(f"{m}_sum")]
        out += [extreme(m, f)[0].alias(f"{m}_{f}") for f in ("min", "max")]
    lost = reduce(lambda a, b: a | b, [extreme(m, f)[1] for m in measures for f in ("min", "max")])
    return sums.where("n > 0").select(*out, lost.alias("_lost"))


def follow_load(
    spark: SparkSession,
    summary: DataFrame,
    moved: DataFrame,
    new: DataFrame,
    keys: tuple[str, ...],
    measures: tuple[str, ...] = MEASURES,
) -> DataFrame:
    """The summary brought to the rows of a new load, given the rows that moved (`moved_rows`).

    Groups that lost a minimum or maximum are read from `new`, keys and measures alone, and only if
    there are such groups. The result is a stored table of the columns of `summarise`.
    """
    found = storage.materialize(merged(summary, moved, keys, measures), "merged-summary")
    lost = found.where("_lost").select(*[F.col(k).alias(f"_{k}") for k in keys])
    if lost.isEmpty():
        return found.drop("_lost")
    hit = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    again = new.join(lost, hit, "left_semi").groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*_extremes(measures))
    again = again.select(*[f"_{k}" for k in keys], *[F.col(f"{m}_{f}").alias(f"_{m}_{f}") for m in measures for f in ("min", "max")])
    mended = found.join(again, hit & F.col("_lost"), "left")
    extremes = {f"{m}_{f}": F.when(F.col("_lost"), F.col(f"_{m}_{f}")).otherwise(F.col(f"{m}_{f}")) for m in measures for f in ("min", "max")}
    return storage.materialize(mended.withColumns(extremes).select(*found.columns).drop("_lost"), "summary")


def _of_days(summary: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """Groups that started in a span of days (yyyymmdd); with both ends open, those without a day too."""
    if first is not None:
        summary = summary.where(F.col("start_date_key") >= first)
    return summary if last is None else summary.where(F.col("start_date_key") <= last)


def _mean(measure: str) -> Column:
    return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"))


def category_rollup(by_condition: DataFrame, star: Star, first: int | None = None, last: int | None = None) -> DataFrame:
    """Totals per category; the mean is that of the means of its conditions."""
    sums = _of_days(by_condition, first, last).groupBy("condition_key")
    sums = sums.agg(F.sum("n").alias("n"), *[F.sum(f"{ENROLLMENT}_{f}").alias(f"{ENROLLMENT}_{f}") for f in ("n", "sum")])
    names = star.condition.select("condition_key", "condition_name", "condition_category")
    each = sums.join(names, "condition_key").groupBy("condition_name", "condition_category")
    each = each.agg(F.sum("n").alias("trial_count"), _mean(ENROLLMENT).alias("avg_enrollment"))
    return each.where("condition_category IS NOT NULL").groupBy("condition_category").agg(
        F.sum("trial_count").alias("trial_count"), F.avg("avg_enrollment").alias("avg_enrollment")
    )


def country_rollup(by_place: DataFrame, star: Star, first: int | None = None, last: int | None = None) -> DataFrame:
    """Totals per country."""
    sums = _of_days(by_place, first, last).groupBy("location_key").agg(F.sum("n").alias("n"), F.sum(f"{ENROLLMENT}_sum").alias("enrolled"))
    places = star.location.where("country IS NOT NULL").select("location_key", "country")
    totals = sums.join(places, "location_key").groupBy("country")
    return totals.agg(F.sum("n").alias("trial_count"), F.coalesce(F.sum("enrolled"), F.lit(0)).alias("total_enrollment")).orderBy(
        F.desc("trial_count"), "country"
    )


def temporal_series(by_place: DataFrame, star: Star, since: int = 2020) -> DataFrame:
    """Monthly starts with the first day of each month."""
    days = star.dates.where(F.col("year") >= since).select(F.col("date_key").alias("start_date_key"), "year", "month_number", "month_name")
    sums = by_place.groupBy("start_date_key").agg(F.sum("n").alias("n"), *[F.sum(f"{ENROLLMENT}_{f}").alias(f"{ENROLLMENT}_{f}") for f in ("n", "sum")])
    months = sums.join(days, "start_date_key").groupBy("year", "month_number", "month_name")
    months = months.agg(F.sum("n").alias("trial_count"), _mean(ENROLLMENT).alias("avg_enrollment")).orderBy("year", "month_number")
    return months.select("year", "month_name", "trial_count", "avg_enrollment", month_start(F.col("year"), F.col("month_number")).alias("date"))


def duration_by_condition(by_condition: DataFrame, star: Star, first: int | None = None, last: int | None = None) -> DataFrame:
    """Trials that last at least a day, and how long, per category."""
    sums = _of_days(by_condition, first, last).where(F.col(f"{LASTING}_n") > 0)
    named = sums.join(star.condition.select("condition_key", "condition_category"), "condition_key")
    return (
        named.groupBy("condition_category")
        .agg(
            F.sum(f"{LASTING}_n").alias("trial_count"),
            _mean(LASTING).alias("avg_duration"),
            F.min(f"{LASTING}_min").alias("min_duration"),
            F.max(f"{LASTING}_max").alias("max_duration"),
        )
        .orderBy(F.desc("avg_duration"), "condition_category")
    )
