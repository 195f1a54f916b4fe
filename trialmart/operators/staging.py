"""Staging tables: four dimension candidates and the trial rows that point at them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmart.functions.categories import condition_group, sponsor_country, sponsor_type
from trialmart.functions.dates import date_key, duration_days, parse_date
from trialmart.functions.text import or_unknown, trim_or_null
from trialmart.operators.keys import MOST_BROADCAST, first_by_key
from trialmart.sources.search import valid_raw

# Score given to every staged trial, and the three completeness steps.
STAGED_QUALITY = 85.0
COMPLETE, PARTIAL, EMPTY = 100.0, 50.0, 0.0

# Unknown members get one row per dimension under this suffix. Trials point at the plain
# unknown id, so they never join it.
UNKNOWN_SUFFIX = "_1"


def _id(prefix: str, text: Column, space: str) -> Column:
    slug = F.concat(F.lit(prefix), F.lower(F.replace(text, F.lit(" "), F.lit(space))))
    return F.when(text.isNotNull(), slug).otherwise(f"{prefix}UNKNOWN")


def sponsor_id() -> Column:
    return _id("SPONSOR_", F.col("LeadSponsorName"), "_")


def location_id() -> Column:
    parts = [F.col(c) for c in ("LocationCountry", "LocationState", "LocationCity")]
    place = F.concat_ws("_", *[F.coalesce(p, F.lit("")) for p in parts])
    return _id("LOC_", F.when(F.coalesce(*parts).isNotNull(), place), "_")


def condition_id() -> Column:
    return _id("COND_", F.col("Condition"), "")


def intervention_id() -> Column:
    return _id("INT_", F.col("InterventionName"), "")


def _member_id(name: str, trial_id: Column, prefix: str) -> Column:
    """Id of a dimension member: blank names are unknown members here."""
    blank = F.col(name).isNull() | (F.trim(name) == "")
    return F.when(blank, f"{prefix}UNKNOWN{UNKNOWN_SUFFIX}").otherwise(trial_id)


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name) != "", F.lit(False))


def stage_sponsors(raw: DataFrame) -> DataFrame:
    members = (
        valid_raw(raw)
        .filter(_filled("LeadSponsorName"))
        .select(
            sponsor_id().alias("sponsor_id"),
            F.trim("LeadSponsorName").alias("sponsor_name"),
            or_unknown(F.col("LeadSponsorClass")).alias("sponsor_class"),
            sponsor_type(F.col("LeadSponsorClass"), missing="Other").alias("sponsor_type"),
            sponsor_country(F.col("LeadSponsorName")).alias("country"),
        )
        .distinct()
    )
    nothing = F.lit(None).cast("string")
    return first_by_key(members, "sponsor_id").withColumns({"state": nothing, "city": nothing})


def stage_locations(raw: DataFrame) -> DataFrame:
    """One row per place; of its facilities the smallest name is kept."""
    somewhere = _filled("LocationCountry") | _filled("LocationState") | _filled("LocationCity")
    members = (
        valid_raw(raw)
        .filter(somewhere)
        .select(
            location_id().alias("location_id"),
            F.coalesce(F.trim("LocationCountry"), F.lit("Unknown")).alias("country"),
            trim_or_null(F.col("LocationState")).alias("state"),
            trim_or_null(F.col("LocationCity")).alias("city"),
            trim_or_null(F.col("LocationFacility")).alias("facility_name"),
        )
        .distinct()
    )
    return first_by_key(members, "location_id")


def stage_conditions(raw: DataFrame) -> DataFrame:
    members = (
        valid_raw(raw)
        .select(
            _member_id("Condition", condition_id(), "COND_").alias("condition_id"),
            F.coalesce(trim_or_null(F.col("Condition")), F.lit("Unknown Condition")).alias("condition_name"),
            condition_group(F.col("Condition")).alias("condition_category"),
        )
        .distinct()
    )
    return first_by_key(members, "condition_id")


def stage_interventions(raw: DataFrame) -> DataFrame:
    members = (
        valid_raw(raw)
        .select(
            _member_id("InterventionName", intervention_id(), "INT_").alias("intervention_id"),
            F.coalesce(trim_or_null(F.col("InterventionName")), F.lit("Unknown Intervention")).alias("intervention_name"),
            or_unknown(F.col("InterventionType")).alias("intervention_type"),
        )
        .distinct()
    )
    return first_by_key(members, "intervention_id")


def staged_ids(raw: DataFrame) -> DataFrame:
    """The valid rows that become trials."""
    return valid_raw(raw).filter(F.col("NCTId").isNotNull())


def trial_ids(raw: DataFrame) -> DataFrame:
    """Every trial id once, with the number of valid rows that hold it."""
    ids = staged_ids(raw).select(F.col("NCTId").alias("nct_id"))
    return ids.groupBy("nct_id").agg(F.count(F.lit(1)).alias("row_count"))


def repeated_trials(ids: DataFrame) -> DataFrame:
    """Of the counted trial ids, those that occur on several valid rows."""
    return ids.filter("row_count > 1").select("nct_id", "row_count")


def stage_trials(raw: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per trial id with dimension ids, date keys, defaults and scores.

    With the stored `trial_ids` of the same rows only ids on several rows are shuffled and sorted to choose one.
    """
    if ids is None:
        # Straight from the scan, so that each task sends one row of an id at most.
        return first_by_key(_staged_rows(staged_ids(raw)), "nct_id")
    several = repeated_trials(ids).select(F.col("nct_id").alias("NCTId"))
    found = several.count()
    if not found:
        return _staged_rows(staged_ids(raw))
    several = F.broadcast(several) if found <= MOST_BROADCAST else several
    once, often = (staged_ids(raw).join(several, "NCTId", kind) for kind in ("left_anti", "left_semi"))
    return _staged_rows(once).unionByName(first_by_key(_staged_rows(often), "nct_id"))


def _staged_rows(rows: DataFrame) -> DataFrame:
    """Every valid row as a staged trial."""
    start, end = F.col("start_date"), F.col("end_date")
    named = [F.col(c).isNotNull() for c in ("BriefTitle", "LeadSponsorName", "Condition")]
    count = F.col("EnrollmentCount")
    return (
        rows.withColumns(
            {
                "start_date": parse_date(F.col("StudyStartDate")),
                "end_date": parse_date(F.col("StudyCompletionDate")),
            }
        )
        .select(
            F.col("NCTId").alias("nct_id"),
            sponsor_id().alias("sponsor_id"),
            location_id().alias("location_id"),
            condition_id().alias("condition_id"),
            intervention_id().alias("intervention_id"),
            date_key(start).alias("start_date_key"),
            date_key(end).alias("completion_date_key"),
            trim_or_null(F.col("BriefTitle")).alias("brief_title"),
            trim_or_null(F.col("OfficialTitle")).alias("official_title"),
            or_unknown(F.col("Phase")).alias("phase"),
            F.when(count > 0, count).alias("enrollment_count"),
            or_unknown(F.col("Status")).alias("status"),
            or_unknown(F.col("StudyType")).alias("study_type"),
            or_unknown(F.col("Allocation")).alias("allocation"),
            or_unknown(F.col("InterventionModel")).alias("intervention_model"),
            or_unknown(F.col("PrimaryPurpose")).alias("primary_purpose"),
            or_unknown(F.col("MaskingInfo")).alias("masking_info"),
            duration_days(start, end).alias("duration_days"),
            F.when(named[0] & named[1] & named[2], COMPLETE)
            .when(named[0] | named[1] | named[2], PARTIAL)
            .otherwise(EMPTY)
            .alias("data_completeness_score"),
            F.lit(STAGED_QUALITY).alias("data_quality_score"),
        )
    )
