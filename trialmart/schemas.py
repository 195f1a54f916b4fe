"""Fixed schemas: landed pages, the raw trial table and its column names."""

from __future__ import annotations

from pyspark.sql import types as T

# The 24 raw trial columns, in order, with the snake_case name each takes
# when it is cleaned.
RAW_TO_CLEAN = {
    "NCTId": "nct_id",
    "BriefTitle": "brief_title",
    "OfficialTitle": "official_title",
    "LeadSponsorName": "lead_sponsor_name",
    "LeadSponsorClass": "lead_sponsor_class",
    "Condition": "condition",
    "InterventionName": "intervention_name",
    "InterventionType": "intervention_type",
    "Phase": "phase",
    "EnrollmentCount": "enrollment_count",
    "StudyStartDate": "study_start_date",
    "PrimaryCompletionDate": "primary_completion_date",
    "StudyCompletionDate": "study_completion_date",
    "Status": "status",
    "LocationCountry": "location_country",
    "LocationState": "location_state",
    "LocationCity": "location_city",
    "LocationFacility": "location_facility",
    "StudyType": "study_type",
    "Allocation": "allocation",
    "InterventionModel": "intervention_model",
    "PrimaryPurpose": "primary_purpose",
    "MaskingInfo": "masking_info",
    "OutcomeMeasureDescription": "outcome_measure_description",
}

RAW_COLUMNS = list(RAW_TO_CLEAN)

FLAT = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name == "EnrollmentCount" else T.StringType())
        for name in RAW_COLUMNS
    ]
)

RAW = T.StructType(
    FLAT.fields
    + [
        T.StructField("extraction_date", T.TimestampType()),
        T.StructField("data_source", T.StringType()),
        T.StructField("validation_status", T.StringType()),
    ]
)

# A study of a landed page. The enrollment count stays a variant: text "12.0" is not a count, the
# number 12.0 is, and only a variant keeps the two apart.
STUDY = """
struct<protocolSection: struct<
  identificationModule: struct<nctId: string>,
  descriptionModule: struct<briefSummary: string, officialTitle: string>,
  sponsorCollaboratorsModule: struct<leadSponsor: struct<name: string, class: string>>,
  conditionsModule: struct<conditions: array<string>>,
  armsInterventionsModule: struct<interventions: array<struct<name: string, type: string>>>,
  designModule: struct<
    phases: array<string>, studyType: string, allocation: string, interventionModel: string,
    primaryPurpose: string, maskingInfo: struct<masking: string>>,
  enrollmentModule: struct<enrollmentCount: variant>,
  statusModule: struct<
    overallStatus: string, startDateStruct: struct<date: string>,
    primaryCompletionDateStruct: struct<date: string>, completionDateStruct: struct<date: string>>,
  contactsLocationsModule: struct<
    locations: array<struct<country: string, state: string, city: string, facility: string>>>,
  outcomesModule: struct<outcomes: array<struct<description: string>>>
>>
"""
