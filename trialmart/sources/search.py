"""Selecting trials from the raw table."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmart.functions.dates import parse_date
from trialmart.functions.text import contains_any
from trialmart.sources.study_pages import VALID

# Columns a free search term is looked up in.
TERM_COLUMNS = ["BriefTitle", "OfficialTitle", "Condition", "InterventionName"]


def search_trials(
    trials: DataFrame,
    search_terms: list[str] | None = None,
    conditions: list[str] | None = None,
    sponsors: list[str] | None = None,
    phases: list[str] | None = None,
    status: list[str] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Trials that meet every given criterion; within a list one hit is enough.

    Texts match anywhere and in any case. Dates (yyyy-mm-dd) are inclusive: the study starts
    on or after `start_date` and completes on or before `end_date`.
    """
    found = trials
    criteria = [
        (search_terms, TERM_COLUMNS),
        (conditions, ["Condition"]),
        (sponsors, ["LeadSponsorName"]),
        (phases, ["Phase"]),
        (status, ["Status"]),
    ]
    for words, columns in criteria:
        if words:
            found = found.filter(_any_holds(columns, words))
    if start_date:
        found = found.filter(parse_date(F.col("StudyStartDate")) >= F.lit(start_date).cast("date"))
    if end_date:
        found = found.filter(parse_date(F.col("StudyCompletionDate")) <= F.lit(end_date).cast("date"))
    return limit_trials(found, limit)


def _any_holds(columns: list[str], words: list[str]) -> Column:
    lowered = [word.lower() for word in words]
    return reduce(or_, [F.coalesce(contains_any(F.col(c), lowered), F.lit(False)) for c in columns])


def limit_trials(trials: DataFrame, limit: int | None) -> DataFrame:
    """First `limit` trials by id; None and 0 mean all of them."""
    return trials.orderBy("NCTId").limit(limit) if limit else trials


def recent_trials(trials: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Trials whose study starts no earlier than `days` before `as_of`."""
    return search_trials(trials, start_date=(as_of - dt.timedelta(days=days)).isoformat())


def trial_details(trials: DataFrame, nct_id: str) -> DataFrame:
    """The trial with this id, or no row; of several, the one that sorts first by its columns in order."""
    found = trials.filter(F.col("NCTId") == nct_id)
    return found.orderBy(*[F.col(f"`{c}`") for c in trials.columns]).limit(1)


def valid_raw(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("validation_status") == VALID)
