"""Warehouse tables: date, sponsor, location, condition and intervention dimensions, and the
trial fact table.

The dimension functions take *written* staging tables that carry the noted row places
(keys.place_in_order), and turn those into dense surrogate keys; the fact function takes
such a table of trial ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmart.functions.categories import (
    CONDITION_PREVALENCE,
    CONDITION_TYPES,
    COUNTRY_REGIONS,
    COUNTRY_TIMEZONES,
    RARE_CONDITION_GROUPS,
    by_value,
    status_has,
)
from trialmart.functions.dates import date_key, key_date
from trialmart.operators.keys import POSITION, number_rows

# Fixed value: origin written on every fact row.
SOURCE_SYSTEM = "ClinicalTrials.gov"

# Partition column of the written fact table; reports on start dates prune by it.
FACT_PARTITION = "start_year"

FACT_COLUMNS = [
    "trial_key",
    "nct_id",
    "sponsor_key",
    "location_key",
    "condition_key",
    "intervention_key",
    "start_date_key",
    "completion_date_key",
    "brief_title",
    "official_title",
    "phase",
    "enrollment_count",
    "actual_enrollment",
    "status",
    "study_type",
    "allocation",
    "intervention_model",
    "primary_purpose",
    "masking_info",
    "duration_days",
    "enrollment_target_met",
    "is_completed",
    "is_terminated",
    "is_recruiting",
    "data_completeness_score",
    "data_quality_score",
    "source_system",
]


@dataclass(frozen=True)
class Star:
    """The frames reports read."""

    fact: DataFrame
    sponsor: DataFrame
    location: DataFrame
    condition: DataFrame
    intervention: DataFrame
    dates: DataFrame


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _keyed(staged: DataFrame, key: str, name: str, keys: DataFrame | None) -> DataFrame:
    """Rows with their surrogate key: their number in key order, or the one a key map holds."""
    if keys is None:
        return number_rows(staged, name)
    return staged.drop(POSITION).join(keys.select(key, name), key)


def dim_sponsor(staged: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    kind = F.col("sponsor_type")
    return _keyed(staged, "sponsor_id", "sponsor_key", keys).select(
        "sponsor_key",
        "sponsor_id",
        "sponsor_name",
        "sponsor_class",
        "sponsor_type",
        F.lit(None).cast("string").alias("sponsor_category"),
        _flag(kind == "Industry").alias("is_industry"),
        _flag(kind == "Academic").alias("is_academic"),
        _flag(kind == "Government").alias("is_government"),
        "country",
        "state",
        "city",
        F.lit(1).alias("is_active"),
    )


def dim_location(staged: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    country = F.col("country")
    region = by_value(country, COUNTRY_REGIONS, "Other")
    return _keyed(staged, "location_id", "location_key", keys).select(
        "location_key",
        "location_id",
        "country",
        "state",
        "city",
        "facility_name",
        region.alias("region"),
        region.alias("continent"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        by_value(country, COUNTRY_TIMEZONES, "UTC").alias("timezone"),
        F.lit(1).alias("is_active"),
    )


def dim_condition(staged: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    group = F.col("condition_category")
    return _keyed(staged, "condition_id", "condition_key", keys).select(
        "condition_key",
        "condition_id",
        "condition_name",
        "condition_category",
        by_value(group, CONDITION_TYPES, "Other").alias("condition_type"),
        F.lit(None).cast("string").alias("icd_code"),
        F.col("condition_name").alias("mesh_term"),
        _flag(group.isin(RARE_CONDITION_GROUPS)).alias("is_rare"),
        by_value(group, CONDITION_PREVALENCE, "Low").alias("prevalence_category"),
        F.lit(1).alias("is_active"),
    )


def dim_intervention(staged: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    name, kind = F.col("intervention_name"), F.col("intervention_type")
    return _keyed(staged, "intervention_id", "intervention_key", keys).select(
        "intervention_key",
        "intervention_id",
        "intervention_name",
        "intervention_type",
        kind.alias("intervention_category"),
        F.when(kind == "Drug", name).alias("drug_name"),
        F.when(kind == "Device", name).alias("device_name"),
        F.when(kind == "Procedure", name).alias("procedure_name"),
        _flag(kind == "Drug").alias("is_drug"),
        _flag(kind == "Device").alias("is_device"),
        _flag(kind == "Procedure").alias("is_procedure"),
        _flag(kind == "Behavioral").alias("is_behavioral"),
        F.lit(1).alias("is_active"),
    )


def dim_dates(staged_trials: DataFrame) -> DataFrame:
    """Every day from the first to the last start or completion date.

    The calendar bounds its size: ten thousand years are 3.7 million rows.
    """
    keys = ["start_date_key", "completion_date_key"]
    span = staged_trials.agg(
        F.least(*[F.min(k) for k in keys]).alias("first"),
        F.greatest(*[F.max(k) for k in keys]).alias("last"),
    )
    days = span.select(
        F.explode(F.sequence(key_date(F.col("first")), key_date(F.col("last")))).alias("full_date")
    )
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        _flag(F.dayofweek(day).isin(1, 7)).alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
    )


def fact_trials(
    staged: DataFrame,
    ids: DataFrame,
    sponsor: DataFrame,
    location: DataFrame,
    condition: DataFrame,
    intervention: DataFrame,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Trials with their own and their dimension keys; an id without a member gives a NULL key.

    `ids` holds the trial ids in key order, so that only ids are sampled and sorted to number
    the trials; with a key map in `keys` they have the numbers of that. Dimensions are unique by id, so no row fans out. Each join reads an id and a key column
    only. Spark broadcasts a dimension whose measured size allows it; a larger one is
    shuffled, and adaptive execution splits the partition of an id that many trials share.
    """
    joined = staged.join(_keyed(ids.drop("row_count"), "nct_id", "trial_key", keys), "nct_id")
    for dim, name in [
        (sponsor, "sponsor"),
        (location, "location"),
        (condition, "condition"),
        (intervention, "intervention"),
    ]:
        joined = joined.join(dim.select(f"{name}_id", f"{name}_key"), f"{name}_id", "left")
    status = F.col("status")
    return joined.withColumns(
        {
            "actual_enrollment": F.col("enrollment_count"),
            "enrollment_target_met": _flag(F.col("enrollment_count") > 0),
            "is_completed": _flag(status_has(status, "completed")),
            "is_terminated": _flag(status_has(status, "terminated")),
            "is_recruiting": _flag(status_has(status, "recruiting")),
            "source_system": F.lit(SOURCE_SYSTEM),
            FACT_PARTITION: F.floor(F.col("start_date_key") / 10000).cast("int"),
        }
    ).select(*FACT_COLUMNS, FACT_PARTITION)
