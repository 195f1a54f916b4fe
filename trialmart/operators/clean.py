"""Trial cleaning: one chain of projections over the raw table, with no shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.functions.categories import (
    categorize_condition,
    categorize_continent,
    categorize_region,
    intervention_category,
    sponsor_category,
    sponsor_type,
    status_has,
)
from trialmart.functions.dates import duration_days, parse_date
from trialmart.functions.numbers import categorize_enrollment, parse_count, phase_number
from trialmart.functions.text import clean_string, hash_key, normalize_sponsor_name, split_location
from trialmart.schemas import RAW_TO_CLEAN
from trialmart.session import split_long_code

# Further source names a clean column may come from, after its own name and
# the raw one.
OTHER_NAMES = {
    "status": ["overall_status", "trial_status"],
    "phase": ["study_phase"],
    "lead_sponsor_name": ["sponsor"],
    "lead_sponsor_class": ["sponsor_class"],
    "condition": ["conditions"],
    "intervention_name": ["intervention"],
    "intervention_type": ["interventiontype"],
    "enrollment_count": ["enrollment", "enrollment_total"],
}
LOCATION_PARTS = {"location_country": "country", "location_state": "state", "location_city": "city"}

# Columns that are no text or are parsed as dates.
DATE_COLUMNS = ["study_start_date", "primary_completion_date", "study_completion_date"]
TEXT_COLUMNS = [
    name
    for name in RAW_TO_CLEAN.values()
    if name not in DATE_COLUMNS and name not in ("nct_id", "enrollment_count")
]

# Fixed value.
DATA_VERSION = "1.0"

# Fields counted by the completeness score and the weights of the scores.
REQUIRED_FIELDS = ["nct_id", "brief_title", "lead_sponsor_name", "condition"]
OPTIONAL_FIELDS = ["enrollment_count", "phase", "status", "study_start_date"]
REQUIRED_WEIGHT, OPTIONAL_WEIGHT = 0.7, 0.3
COMPLETENESS_WEIGHT, FACTOR_WEIGHT = 0.6, 0.4
LARGEST_ENROLLMENT = 100000


def conform_columns(raw: DataFrame) -> DataFrame:
    """The 24 clean columns, each from the first source name present, then all other columns.

    Names are compared exactly, while Spark ignores case, so the input is first renamed by
    position.
    """
    sources = {name: f"c{i}" for i, name in enumerate(raw.columns)}
    by_place = raw.toDF(*sources.values())
    taken: set[str] = set()
    chosen = []
    for raw_name, clean_name in RAW_TO_CLEAN.items():
        candidates = [clean_name, raw_name, *OTHER_NAMES.get(clean_name, [])]
        present = next((c for c in candidates if c in sources), None)
        if present:
            taken.add(present)
            value = F.col(sources[present])
            if clean_name == "enrollment_count" and dict(raw.dtypes)[present] == "string":
                value = parse_count(value)
        elif clean_name in LOCATION_PARTS and "location" in sources:
            value = split_location(F.col(sources["location"]))[LOCATION_PARTS[clean_name]]
        else:
            value = F.lit(None).cast("int" if clean_name == "enrollment_count" else "string")
        chosen.append(value.alias(clean_name))
    clean_names = set(RAW_TO_CLEAN.values())
    rest = [
        F.col(place).alias(name)
        for name, place in sources.items()
        if name not in taken and name.lower() not in clean_names
    ]
    return by_place.select(*chosen, *rest)


def clean_text_fields(trials: DataFrame) -> DataFrame:
    present = [c for c in TEXT_COLUMNS if c in trials.columns]
    return trials.withColumns({c: clean_string(F.col(c)) for c in present})


def parse_date_fields(trials: DataFrame) -> DataFrame:
    present = [c for c in DATE_COLUMNS if c in trials.columns]
    return trials.withColumns({c: parse_date(F.col(c)) for c in present})


def process_location(trials: DataFrame) -> DataFrame:
    country = F.col("location_country")
    return trials.withColumns(
        {
            "location_id": hash_key(country, F.col("location_state"), F.col("location_city")),
            "location_region": categorize_region(country),
            "location_continent": categorize_continent(country),
        }
    )


def process_sponsor(trials: DataFrame) -> DataFrame:
    named = trials.withColumn("lead_sponsor_name", normalize_sponsor_name(F.col("lead_sponsor_name")))
    return named.withColumns(
        {
            "sponsor_id": _hash_or("lead_sponsor_name", "SPONSOR_UNKNOWN"),
            "sponsor_type": sponsor_type(F.col("lead_sponsor_class")),
            "sponsor_category": sponsor_category(F.col("lead_sponsor_name")),
        }
    )


def process_condition(trials: DataFrame) -> DataFrame:
    return trials.withColumns(
        {
            "condition_category": categorize_condition(F.col("condition")),
            "condition_id": _hash_or("condition", "COND_UNKNOWN"),
        }
    )


def process_intervention(trials: DataFrame) -> DataFrame:
    return trials.withColumns(
        {
            "intervention_id": _hash_or("intervention_name", "INT_UNKNOWN"),
            "intervention_category": intervention_category(F.col("intervention_type")),
        }
    )


def _hash_or(name: str, unknown: str):
    return F.when(F.col(name).isNull(), unknown).otherwise(hash_key(F.col(name)))


def completeness_score():
    """Weighted share of filled required and optional fields, 0 to 1."""

    def filled(fields: list[str]):
        return sum(F.col(f).isNotNull().cast("int") for f in fields) / F.lit(float(len(fields)))

    return filled(REQUIRED_FIELDS) * F.lit(REQUIRED_WEIGHT) + filled(OPTIONAL_FIELDS) * F.lit(OPTIONAL_WEIGHT)


def dates_in_order():
    """True or False when both study dates are known, else NULL."""
    return F.col("study_start_date") < F.col("study_completion_date")


def enrollment_plausible():
    count = F.col("enrollment_count")
    return F.coalesce((count > 0) & (count <= LARGEST_ENROLLMENT), F.lit(False))


def phase_known():
    return F.coalesce(F.lower("phase") != "unknown", F.lit(False))


def row_quality_score():
    """Blend of the completeness score with the mean of three plausibility factors."""
    dates = F.when(dates_in_order(), 1.0).when(dates_in_order().isNotNull(), 0.5).otherwise(0.0)
    enrollment = F.when(enrollment_plausible(), 1.0).otherwise(0.5)
    phase = F.when(phase_known(), 1.0).otherwise(0.5)
    factors = (dates + enrollment + phase) / F.lit(3.0)
    return F.col("data_completeness_score") * F.lit(COMPLETENESS_WEIGHT) + factors * F.lit(FACTOR_WEIGHT)


def derived_fields(trials: DataFrame) -> DataFrame:
    status = F.col("status")
    derived = trials.withColumns(
        {
            "duration_days": duration_days(F.col("study_start_date"), F.col("study_completion_date")),
            "phase_number": phase_number(F.col("phase")),
            "enrollment_category": categorize_enrollment(F.col("enrollment_count")),
            "is_completed": status_has(status, "completed"),
            "is_recruiting": status_has(status, "recruiting"),
            "is_terminated": status_has(status, "terminated"),
            "data_completeness_score": completeness_score(),
        }
    )
    return derived.withColumn("data_quality_score", row_quality_score())


def add_transformation_metadata(trials: DataFrame, run_ts: dt.datetime | None) -> DataFrame:
    marked = trials.withColumn("data_version", F.lit(DATA_VERSION))
    return marked if run_ts is None else marked.withColumn("transformation_date", F.lit(run_ts))


def clean_trials(valid: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Cleaned, classified and scored trials; `run_ts` adds the transformation date."""
    return (
        valid.transform(split_long_code)
        .transform(conform_columns)
        .transform(clean_text_fields)
        .transform(parse_date_fields)
        .transform(process_location)
        .transform(process_sponsor)
        .transform(process_condition)
        .transform(process_intervention)
        .transform(derived_fields)
        .transform(add_transformation_metadata, run_ts)
    )
