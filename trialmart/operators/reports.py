"""The report catalogue over the star.

Reports that group by a dimension attribute first sum the fact by the dimension key, then
join the dimension to these sums and finish. The map-side half of the first sum absorbs a key
that holds a large part of all trials, and the join moves one row per key, not per trial.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmart.functions.dates import first_year, month_start
from trialmart.functions.numbers import number_label, share
from trialmart.operators.warehouse import FACT_PARTITION, Star

ENROLLMENT, DURATION = "enrollment_count", "duration_days"


def _sums(df: DataFrame, keys: list[str], measures: list[str], extra: list[Column] | None = None) -> DataFrame:
    """Rows, and per measure the non-null count, sum, minimum and maximum, by key."""
    parts = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        parts += [
            F.count(m).alias(f"{m}_n"),
            F.sum(m).alias(f"{m}_sum"),
            F.min(m).alias(f"{m}_min"),
            F.max(m).alias(f"{m}_max"),
        ]
    return df.groupBy(*keys).agg(*parts, *(extra or []))


def _total(name: str = "n") -> Column:
    return F.sum(name)


def _mean(measure: str) -> Column:
    """Mean over the summed rows; NULL when no row has the measure."""
    return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"))


def _on_day(fact: DataFrame, days: DataFrame) -> Column:
    # Joining on the year as well lets Spark carry a year filter to the fact's partitions.
    return (fact["start_date_key"] == days["date_key"]) & (fact[FACT_PARTITION] == days["year"])


def _start_sums(star: Star, facts: DataFrame, years: Column, keys: list[str], extra: list[Column]) -> DataFrame:
    """Enrollment sums by start day and further keys, with the calendar columns of the day."""
    sums = _sums(facts, ["start_date_key", FACT_PARTITION, *keys], [ENROLLMENT], extra)
    days = star.dates.filter(years).select("date_key", "year", "month_number", "month_name")
    return sums.join(days, _on_day(sums, days))


def top_sponsors_year(star: Star, year: int = 2023, k: int = 10) -> DataFrame:
    # One year has at most 366 days, so this side is small enough to broadcast whatever
    # the calendar spans.
    days = F.broadcast(star.dates.filter(F.col("year") == year).select("date_key", "year"))
    started = star.fact.join(days, _on_day(star.fact, days))
    sums = _sums(started, ["sponsor_key"], [ENROLLMENT, DURATION])
    return (
        sums.join(star.sponsor.select("sponsor_key", "sponsor_name"), "sponsor_key")
        .groupBy("sponsor_name")
        .agg(
            _total().alias("trial_count"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _mean(DURATION).alias("avg_duration_days"),
        )
        .orderBy(F.desc("trial_count"), "sponsor_name")
        .limit(k)
    )


def common_conditions(star: Star, k: int = 20) -> DataFrame:
    known = star.fact.filter(F.col(DURATION).isNotNull())
    return (
        _sums(known, ["condition_key"], [ENROLLMENT, DURATION])
        .join(star.condition.select("condition_key", "condition_name", "condition_category"), "condition_key")
        .groupBy("condition_name", "condition_category")
        .agg(
            _total().alias("trial_count"),
            _mean(DURATION).alias("avg_duration_days"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            F.min(f"{DURATION}_min").alias("min_duration"),
            F.max(f"{DURATION}_max").alias("max_duration"),
        )
        .orderBy(F.desc("trial_count"), "condition_name", "condition_category")
        .limit(k)
    )


def geo_distribution(star: Star, k: int = 20) -> DataFrame:
    places = star.location.filter(F.col("country").isNotNull()).select("location_key", "country", "state")
    return (
        _sums(star.fact, ["location_key"], [ENROLLMENT, DURATION])
        .join(places, "location_key")
        .groupBy("country", "state")
        .agg(
            _total().alias("trial_count"),
            F.sum(f"{ENROLLMENT}_sum").alias("total_enrollment"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _mean(DURATION).alias("avg_duration"),
        )
        .orderBy(F.desc("trial_count"), "country", "state")
        .limit(k)
    )


def status_by_phase(star: Star) -> DataFrame:
    return (
        star.fact.filter(F.col("phase").isNotNull() & F.col("status").isNotNull())
        .groupBy("phase", "status")
        .agg(
            F.count(F.lit(1)).alias("trial_count"),
            F.avg(ENROLLMENT).alias("avg_enrollment"),
            F.avg(DURATION).alias("avg_duration"),
        )
        .orderBy("phase", F.desc("trial_count"), "status")
    )


def _monthly(star: Star, years: Column) -> DataFrame:
    return (
        _start_sums(star, star.fact, years, [], [])
        .groupBy("year", "month_number", "month_name")
        .agg(
            _total().alias("trial_count"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _total(f"{ENROLLMENT}_sum").alias("total_enrollment"),
        )
        .orderBy("year", "month_number")
    )


def monthly_activity(star: Star, as_of: dt.date) -> DataFrame:
    """Starts per month since the year two before `as_of`."""
    return _monthly(star, F.col("year") >= first_year(as_of, 2)).select(
        "year", "month_name", "trial_count", "avg_enrollment", "total_enrollment"
    )


def sponsor_performance(star: Star, k: int = 15, at_least: int = 5) -> DataFrame:
    """Completion share of sponsors; statuses are compared in their exact spelling."""
    by_status = [
        F.count_if(F.col("status") == "Completed").alias("completed"),
        F.count_if(F.col("status") == "Recruiting").alias("recruiting"),
    ]
    return (
        _sums(star.fact, ["sponsor_key"], [ENROLLMENT, DURATION], by_status)
        .join(star.sponsor.select("sponsor_key", "sponsor_name", "sponsor_type"), "sponsor_key")
        .groupBy("sponsor_name", "sponsor_type")
        .agg(
            _total().alias("total_trials"),
            _total("completed").alias("completed_trials"),
            _total("recruiting").alias("recruiting_trials"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _mean(DURATION).alias("avg_duration"),
        )
        .filter(F.col("total_trials") >= at_least)
        .withColumn("completion_rate", share(F.col("completed_trials"), F.col("total_trials")))
        .orderBy(F.desc("total_trials"), "sponsor_name", "sponsor_type")
        .limit(k)
    )


def condition_category(star: Star) -> DataFrame:
    return (
        _sums(star.fact, ["condition_key", "sponsor_key"], [ENROLLMENT, DURATION])
        .join(star.condition.select("condition_key", "condition_category"), "condition_key")
        .join(star.sponsor.select("sponsor_key"), "sponsor_key")
        .filter(F.col("condition_category").isNotNull())
        .groupBy("condition_category")
        .agg(
            _total().alias("trial_count"),
            F.count_distinct("sponsor_key").alias("unique_sponsors"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _mean(DURATION).alias("avg_duration"),
            F.sum(f"{ENROLLMENT}_sum").alias("total_enrollment"),
        )
        .orderBy(F.desc("trial_count"), "condition_category")
    )


def intervention_types(star: Star) -> DataFrame:
    return (
        _sums(star.fact, ["intervention_key", "condition_key"], [ENROLLMENT, DURATION])
        .join(star.intervention.select("intervention_key", "intervention_type"), "intervention_key")
        .join(star.condition.select("condition_key"), "condition_key")
        .filter(F.col("intervention_type").isNotNull())
        .groupBy("intervention_type")
        .agg(
            _total().alias("trial_count"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _mean(DURATION).alias("avg_duration"),
            F.count_distinct("condition_key").alias("unique_conditions"),
        )
        .orderBy(F.desc("trial_count"), "intervention_type")
    )


def quality_assessment(star: Star) -> DataFrame:
    """Score bands over all trials, and over those of industry sponsors."""
    score = F.col("data_completeness_score")
    bands = {
        "high_quality": score >= 90,
        "medium_quality": (score >= 70) & (score < 90),
        "low_quality": score < 70,
    }
    scores = ["data_completeness_score", "data_quality_score"]
    sums = _sums(
        star.fact, ["sponsor_key"], scores, [F.count_if(test).alias(name) for name, test in bands.items()]
    )
    industry = star.sponsor.filter(F.col("sponsor_type") == "Industry").select("sponsor_key")

    def summary(part: DataFrame, label: str) -> DataFrame:
        return part.agg(
            F.coalesce(_total(), F.lit(0)).alias("total_trials"),
            *[F.coalesce(_total(name), F.lit(0)).alias(name) for name in bands],
            _mean("data_completeness_score").alias("avg_completeness"),
            _mean("data_quality_score").alias("avg_quality"),
        ).select(F.lit(label).alias("metric"), "*")

    overall = summary(sums, "Overall")
    return overall.unionByName(summary(sums.join(industry, "sponsor_key"), "By Sponsor Type"))


def duration_by_condition(star: Star) -> DataFrame:
    lasting = star.fact.filter(F.col(DURATION) > 0)
    return (
        _sums(lasting, ["condition_key"], [DURATION])
        .join(star.condition.select("condition_key", "condition_category"), "condition_key")
        .groupBy("condition_category")
        .agg(
            _total().alias("trial_count"),
            _mean(DURATION).alias("avg_duration"),
            F.min(f"{DURATION}_min").alias("min_duration"),
            F.max(f"{DURATION}_max").alias("max_duration"),
        )
        .orderBy(F.desc("avg_duration"), "condition_category")
    )


def enrollment_by_year_phase(star: Star, since: int = 2020) -> DataFrame:
    size = F.col(ENROLLMENT)
    bands = [F.count_if(size > 1000).alias("large"), F.count_if(size <= 100).alias("small")]
    known = star.fact.filter(size.isNotNull() & F.col("phase").isNotNull())
    return (
        _start_sums(star, known, F.col("year") >= since, ["phase"], bands)
        .groupBy("year", "phase")
        .agg(
            _total().alias("trial_count"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _total(f"{ENROLLMENT}_sum").alias("total_enrollment"),
            _total("large").alias("large_trials"),
            _total("small").alias("small_trials"),
        )
        .orderBy(F.desc("year"), F.desc("trial_count"), "phase")
    )


def dash_metrics(star: Star) -> DataFrame:
    return star.fact.agg(
        F.count(F.lit(1)).alias("total_trials"),
        F.count_distinct("sponsor_key").alias("unique_sponsors"),
        F.count_distinct("condition_key").alias("unique_conditions"),
        F.count_distinct("location_key").alias("unique_locations"),
        F.avg(ENROLLMENT).alias("avg_enrollment"),
        F.avg(DURATION).alias("avg_duration"),
    )


def metric_labels(star: Star) -> DataFrame:
    """The headline metrics as display text."""
    metrics = dash_metrics(star)
    missing = "N/A (no valid data)"
    return metrics.select(
        *[
            number_label(F.col(name), "comma", missing, whole=kind == "bigint").alias(name)
            for name, kind in metrics.dtypes
        ]
    )


def dash_sponsors(star: Star, k: int = 20) -> DataFrame:
    return (
        _sums(star.fact, ["sponsor_key"], [ENROLLMENT, DURATION])
        .join(star.sponsor.select("sponsor_key", "sponsor_name"), "sponsor_key")
        .groupBy("sponsor_name")
        .agg(
            _total().alias("trial_count"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _mean(DURATION).alias("avg_duration"),
        )
        .orderBy(F.desc("trial_count"), "sponsor_name")
        .limit(k)
    )


def _top(df: DataFrame, k: int | None, *keys: str) -> DataFrame:
    """Groups by falling trial count, ties in key order; all of them without `k`."""
    ordered = df.orderBy(F.desc("trial_count"), *keys)
    return ordered if k is None else ordered.limit(k)


def _by_condition(star: Star) -> DataFrame:
    return (
        _sums(star.fact, ["condition_key"], [ENROLLMENT, DURATION])
        .join(star.condition.select("condition_key", "condition_name", "condition_category"), "condition_key")
        .groupBy("condition_name", "condition_category")
        .agg(
            _total().alias("trial_count"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
            _mean(DURATION).alias("avg_duration"),
        )
    )


def dash_conditions(star: Star, k: int | None = 20) -> DataFrame:
    return _top(_by_condition(star), k, "condition_name", "condition_category")


def _by_place(star: Star) -> DataFrame:
    return (
        _sums(star.fact, ["location_key"], [ENROLLMENT])
        .join(star.location.select("location_key", "country", "state"), "location_key")
        .groupBy("country", "state")
        .agg(_total().alias("trial_count"), F.sum(f"{ENROLLMENT}_sum").alias("total_enrollment"))
    )


def dash_locations(star: Star, k: int | None = 20) -> DataFrame:
    return _top(_by_place(star).filter(F.col("country").isNotNull()), k, "country", "state")


def dash_temporal(star: Star, since: int = 2020) -> DataFrame:
    return _monthly(star, F.col("year") >= since).select(
        "year", "month_name", "trial_count", "avg_enrollment"
    )


def readme_top_sponsors(star: Star, year: int = 2023, k: int = 10) -> DataFrame:
    return top_sponsors_year(star, year, k).drop("avg_duration_days")


def readme_conditions(star: Star, k: int = 20) -> DataFrame:
    return (
        _sums(star.fact, ["condition_key"], [ENROLLMENT, DURATION])
        .join(star.condition.select("condition_key", "condition_name"), "condition_key")
        .groupBy("condition_name")
        .agg(
            _total().alias("trial_count"),
            _mean(DURATION).alias("avg_duration_days"),
            _mean(ENROLLMENT).alias("avg_enrollment"),
        )
        .orderBy(F.desc("trial_count"), "condition_name")
        .limit(k)
    )


def readme_geo(star: Star) -> DataFrame:
    return _by_place(star).orderBy(F.desc("trial_count"), "country", "state")


def category_rollup(star: Star, top: int | None = None) -> DataFrame:
    """Totals per category over all conditions, or the `top` of them; the mean is that of their means."""
    return (
        dash_conditions(star, top)
        .filter(F.col("condition_category").isNotNull())
        .groupBy("condition_category")
        .agg(_total("trial_count").alias("trial_count"), F.avg("avg_enrollment").alias("avg_enrollment"))
    )


def country_rollup(star: Star, k: int | None = None, top: int | None = None) -> DataFrame:
    """Totals per country over all places, or the `top` of them; the first `k` countries if given."""
    totals = (
        dash_locations(star, top)
        .groupBy("country")
        .agg(
            _total("trial_count").alias("trial_count"),
            F.coalesce(F.sum("total_enrollment"), F.lit(0)).alias("total_enrollment"),
        )
    )
    return _top(totals, k, "country")


def temporal_series(star: Star, since: int = 2020) -> DataFrame:
    """Monthly starts with the first day of each month."""
    return _monthly(star, F.col("year") >= since).select(
        "year",
        "month_name",
        "trial_count",
        "avg_enrollment",
        month_start(F.col("year"), F.col("month_number")).alias("date"),
    )
