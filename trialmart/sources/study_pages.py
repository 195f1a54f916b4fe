"""Landed study pages: read, flatten, validate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.functions.numbers import variant_count
from trialmart.functions.text import has_text, strip_text
from trialmart.schemas import RAW_COLUMNS, STUDY
from trialmart.session import split_long_code

# Fixed value: separator of multi-valued fields.
LIST_SEPARATOR = "; "

# Where each raw column lies in a study. A plain path is one value; a pair is
# an array and the field taken from its elements (None: the elements are texts).
STUDY_PATHS = {
    "NCTId": "identificationModule.nctId",
    "BriefTitle": "descriptionModule.briefSummary",
    "OfficialTitle": "descriptionModule.officialTitle",
    "LeadSponsorName": "sponsorCollaboratorsModule.leadSponsor.name",
    "LeadSponsorClass": "sponsorCollaboratorsModule.leadSponsor.class",
    "Condition": ("conditionsModule.conditions", None),
    "InterventionName": ("armsInterventionsModule.interventions", "name"),
    "InterventionType": ("armsInterventionsModule.interventions", "type"),
    "Phase": ("designModule.phases", None),
    "EnrollmentCount": "enrollmentModule.enrollmentCount",
    "StudyStartDate": "statusModule.startDateStruct.date",
    "PrimaryCompletionDate": "statusModule.primaryCompletionDateStruct.date",
    "StudyCompletionDate": "statusModule.completionDateStruct.date",
    "Status": "statusModule.overallStatus",
    "LocationCountry": ("contactsLocationsModule.locations", "country"),
    "LocationState": ("contactsLocationsModule.locations", "state"),
    "LocationCity": ("contactsLocationsModule.locations", "city"),
    "LocationFacility": ("contactsLocationsModule.locations", "facility"),
    "StudyType": "designModule.studyType",
    "Allocation": "designModule.allocation",
    "InterventionModel": "designModule.interventionModel",
    "PrimaryPurpose": "designModule.primaryPurpose",
    "MaskingInfo": "designModule.maskingInfo.masking",
    "OutcomeMeasureDescription": ("outcomesModule.outcomes", "description"),
}

REJECT_COLUMNS = ["unreadable", "source_file"]
# What is wrong with a page or study that cannot be read.
FAULTS = ["page is no JSON", "page without studies", "study is no object"]

# Extraction metadata.
DATA_SOURCE = "ClinicalTrials.gov API"
VALID = "valid"


def read_pages(spark: SparkSession, path: str, one_page_per_file: bool = True) -> DataFrame:
    """One row per landed page below `path`: page (variant, NULL if it is no JSON), text, source_file.

    With `one_page_per_file` a page may span lines, and a file is read by one task, so it should
    hold no more than a task's memory; otherwise every line is a page, which lets Spark split
    large files. A file or line that holds a list gives a row per item. Blank ones are passed over.
    """
    texts = spark.read.text(path, wholetext=one_page_per_file)
    texts = texts.select(
        F.try_parse_json("value").alias("document"),
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("source_file"),
    ).filter(has_text(F.col("text")))
    items = F.try_variant_get("document", "$", "array<variant>")
    page = F.explode(F.coalesce(items, F.array("document"))).alias("page")
    return texts.select(page, F.when(items.isNull(), F.col("text")).alias("text"), "source_file")


def page_studies(page: Column) -> Column:
    """The list of studies of a page, each as a variant; NULL for a page without such a list."""
    return F.try_variant_get(page, "$.studies", "array<variant>")


def _is_object(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "map<string, variant>").isNotNull()


def studies_of(pages: DataFrame) -> DataFrame:
    """One row per study of pages: study, unreadable, source_file, fault, document.

    Every study is read by itself. A page that is no JSON, a page without a list of studies (an
    error message, for example) and a study that is no object give one row without a study each, with
    its text in `unreadable` and one of FAULTS; a page with an empty list gives none. A value of another
    kind than expected is NULL in its study and is found again in `document`, see lost_values.
    """
    def item(fault: Column, text: Column, document: Column) -> Column:
        study = F.try_variant_get(document, "$", STUDY)
        return F.struct(fault.alias("page_fault"), text.alias("page_text"), document.alias("document"), study.alias("study"))

    no_text, no_document = F.lit(None).cast("string"), F.lit(None).cast("variant")
    read = F.transform(page_studies(F.col("page")), lambda x: item(no_text, no_text, x))
    fault = F.when(F.col("page").isNull(), FAULTS[0]).otherwise(FAULTS[1])
    lost = F.array(item(fault, F.coalesce(F.col("text"), F.to_json("page")), no_document))
    # All of a page is worked out inside the list and taken out by inline, which lets no column be pushed
    # through it: so a page and each of its studies are read once, and no study carries its page along.
    rows = pages.select("source_file", F.inline(F.coalesce(read, lost)))
    study, document = F.col("study"), F.col("document")
    fault = F.coalesce(F.col("page_fault"), F.when(study.isNull(), FAULTS[2]))  # only an object is a struct
    bad_text = F.coalesce(F.col("page_text"), F.to_json(document), F.lit("null"))
    return rows.select(
        study.alias("study"),
        F.when(fault.isNotNull(), bad_text).alias("unreadable"),
        "source_file",
        fault.alias("fault"),
        document.alias("document"),
    )


def read_study_pages(spark: SparkSession, path: str, one_page_per_file: bool = True) -> DataFrame:
    """One row per study in the landed pages below `path`, see read_pages and studies_of."""
    return studies_of(read_pages(spark, path, one_page_per_file))


def fault_counts(studies: DataFrame) -> DataFrame:
    """How many pages and studies could not be read, by fault (one row for each of FAULTS)."""
    counts = studies.agg(*[F.count_if(F.col("fault") == name).alias(name) for name in FAULTS])
    pairs = F.array(*[F.struct(F.lit(name).alias("fault"), F.col(f"`{name}`").alias("row_count")) for name in FAULTS])
    return counts.select(F.inline(pairs))


def lost_values(studies: DataFrame) -> DataFrame:
    """Per raw column, the studies that hold a value for it of another kind than expected, or that
    hold something else in place of a module on the way to it. Columns without any are not listed."""
    document = F.col("document")

    def lost(path: str | tuple[str, str | None]) -> Column:
        place = path if isinstance(path, str) else path[0]
        steps = ["$", *(f"$.{part}" for part in _prefixes(f"protocolSection.{place}"))]
        there = [F.try_variant_get(document, step, "variant") for step in steps]
        other = [there[i].isNotNull() & ~F.is_variant_null(there[i]) for i in range(len(steps))]
        wrong = [other[i] & ~_is_object(document, steps[i]) for i in range(len(steps) - 1)]
        if isinstance(path, tuple):
            items = F.try_variant_get(document, steps[-1], "array<variant>")
            bad = other[-1] & items.isNull()
            if path[1] is not None:
                bad = bad | F.exists(items, lambda x: x.isNotNull() & ~F.is_variant_null(x) & ~_is_object(x))
            wrong.append(F.coalesce(bad, F.lit(False)))
        any_wrong = wrong[0]
        for each in wrong[1:]:
            any_wrong = any_wrong | each
        return F.count_if(F.coalesce(any_wrong, F.lit(False)) & F.col("fault").isNull())

    counts = studies.agg(*[lost(path).alias(name) for name, path in STUDY_PATHS.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("lost")) for name in STUDY_PATHS])
    return counts.select(F.inline(pairs)).filter("lost > 0")


def _prefixes(path: str) -> list[str]:
    parts = path.split(".")
    return [".".join(parts[: n + 1]) for n in range(len(parts))]


def join_list(items: Column, field: str | None = None) -> Column:
    """Elements (or one field of them) joined with the separator; gaps and no list give ''."""
    if field is None:
        texts = F.transform(items, lambda x: F.coalesce(x, F.lit("")))
    else:
        texts = F.transform(items, lambda x: F.coalesce(x[field], F.lit("")))
    return F.coalesce(F.array_join(texts, LIST_SEPARATOR), F.lit(""))


def flatten_studies(studies: DataFrame) -> DataFrame:
    """Project nested studies to the 24 raw columns.

    The rejects of pages and studies that cannot be read keep no value; their text and file stay in the last two
    columns, which are NULL for all other rows.
    """
    root = F.col("study.protocolSection")

    def at(path: str) -> Column:
        value = root
        for step in path.split("."):
            value = value[step]
        return value

    def raw(name: str) -> Column:
        path = STUDY_PATHS[name]
        if name == "EnrollmentCount":
            return variant_count(at(path))
        return at(path) if isinstance(path, str) else join_list(at(path[0]), path[1])

    lost = F.col("unreadable").isNotNull()
    columns = [F.when(~lost, raw(name)).alias(name) for name in RAW_COLUMNS]
    return split_long_code(studies).select(*columns, "unreadable", F.when(lost, F.col("source_file")).alias("source_file"))


def _has_id() -> Column:
    # Tested before trimming: a blank id passes here and becomes NULL below.
    return F.coalesce(F.col("NCTId") != "", F.lit(False))


def validate_trials(flat: DataFrame) -> DataFrame:
    """Drop rows without an id; trim texts and turn empty ones into NULL."""
    flat = flat.drop(*REJECT_COLUMNS)
    texts = {name for name, kind in flat.dtypes if kind == "string"}
    numbers = {
        name
        for name, kind in flat.dtypes
        if kind in ("int", "bigint", "float", "double") and name != "EnrollmentCount"
    }

    def checked(name: str) -> Column:
        if name in texts:
            return strip_text(F.col(name)).alias(name)
        if name in numbers:
            return F.when(F.col(name) >= 0, F.col(name)).alias(name)
        return F.col(name)

    return flat.filter(_has_id()).select(*[checked(name) for name in flat.columns])


def invalid_trials(flat: DataFrame) -> DataFrame:
    """The rows validation drops, rejects of unreadable pages among them."""
    return flat.filter(~_has_id())


def unreadable_pages(flat: DataFrame) -> DataFrame:
    """File and text of every landed page, or study of one, that could not be read."""
    return flat.filter(F.col("unreadable").isNotNull()).select("source_file", "unreadable")


def summary_counts(flat: DataFrame) -> list[Column]:
    """The counts that a validation summary is made of."""
    lost = F.col("unreadable").isNotNull() if "unreadable" in flat.columns else F.lit(False)
    return [
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(_has_id()).alias("valid_trials"),
        F.count_if(lost).alias("unreadable"),
    ]


def validation_summary(flat: DataFrame) -> DataFrame:
    """Processed, valid and invalid counts with the valid share in percent (0 when empty).

    An unreadable page or study counts as one invalid trial, and once more under `unreadable`.
    """
    return summary_of(flat.agg(*summary_counts(flat)))


def summary_of(counted: DataFrame) -> DataFrame:
    rate = F.try_divide(F.col("valid_trials").cast("double"), F.col("total_processed")) * 100.0
    return counted.select(
        "total_processed",
        "valid_trials",
        (F.col("total_processed") - F.col("valid_trials")).alias("invalid_trials"),
        "unreadable",
        F.coalesce(rate, F.lit(0.0)).alias("validation_rate"),
    )


def add_extraction_metadata(trials: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return trials.withColumns(
        {
            "extraction_date": F.lit(run_ts),
            "data_source": F.lit(DATA_SOURCE),
            "validation_status": F.lit(VALID),
        }
    )
