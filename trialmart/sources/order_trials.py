"""Trial records derived from order tables: one trial per order.

The engine itself reads raw trials from any table with the raw columns. This adapter gives it
such a table over an order schema (orders, customer, nation, lineitem, part), so that the
work grows with those tables. The statement is plain SQL that Spark and other engines read
alike; `{name}` marks the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.schemas import RAW_COLUMNS
from trialmart.session import split_long_code
from trialmart.sources.storage import read_table

INPUTS = ["orders", "customer", "nation", "lineitem", "part"]

ORDER_TRIALS_SQL = """
WITH lines AS (
  SELECT l_orderkey, min(l_partkey) AS pk, cast(sum(l_quantity) AS int) AS qty,
         cast(cast(max(l_shipdate) AS date) + 9131 AS date) AS cdate
  FROM {lineitem} GROUP BY l_orderkey
),
joined AS (
  SELECT o_orderkey AS k, c_custkey AS ck, n_nationkey AS nk, c_name, c_mktsegment, n_name,
         o_orderstatus, o_orderpriority, qty, cdate, p_partkey, p_name, p_type,
         cast(cast(cast(o_orderdate AS date) + 9131 AS date) AS string) AS stext
  FROM {orders}
  JOIN {customer} ON c_custkey = o_custkey
  JOIN {nation} ON n_nationkey = c_nationkey
  LEFT JOIN lines ON l_orderkey = o_orderkey
  LEFT JOIN {part} ON p_partkey = pk
)
SELECT
  k AS order_key,
  CASE WHEN k % 97 = 13 THEN NULL
       ELSE 'NCT' || lpad(cast(k AS string), greatest(8, cast(length(cast(k AS string)) AS int)), '0') END AS NCTId,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN ''
       ELSE '  Study  of ' || p_name || ' ' END AS BriefTitle,
  CASE WHEN k % 5 = 0 THEN NULL ELSE 'A trial of ' || p_name || ' in ' || n_name END AS OfficialTitle,
  CASE WHEN k % 41 = 0 THEN NULL ELSE c_name || CASE ck % 6
       WHEN 0 THEN ' Pharma Inc' WHEN 1 THEN ' University' WHEN 2 THEN ' Hospital'
       WHEN 3 THEN ' National Institute' WHEN 4 THEN ' Biotech Co' ELSE ' Clinic USA' END
       END AS LeadSponsorName,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'INDUSTRY' WHEN 'BUILDING' THEN 'NIH'
       WHEN 'FURNITURE' THEN 'University' WHEN 'HOUSEHOLD' THEN ' Hospital Network ' ELSE ''
       END AS LeadSponsorClass,
  CASE p_partkey % 14 WHEN 0 THEN 'Breast Cancer' WHEN 1 THEN 'Type 2 Diabetes'
       WHEN 2 THEN 'Heart Disease; Hypertension' WHEN 3 THEN 'Asthma' WHEN 4 THEN 'Alzheimer Disease'
       WHEN 5 THEN 'Depression' WHEN 6 THEN 'Lupus' WHEN 7 THEN 'Viral Infection'
       WHEN 8 THEN 'Pediatric Obesity' WHEN 9 THEN 'Geriatric Frailty' WHEN 10 THEN 'Migraine'
       WHEN 11 THEN '' WHEN 12 THEN NULL ELSE ' Lung  Tumor ' END AS Condition,
  p_name AS InterventionName,
  CASE p_type WHEN 'ECONOMY' THEN 'Drug' WHEN 'LARGE' THEN 'Device' WHEN 'MEDIUM' THEN 'Procedure'
       WHEN 'PROMO' THEN 'Behavioral' WHEN 'SMALL' THEN 'Drug; Device' ELSE '' END AS InterventionType,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'PHASE1' WHEN '2' THEN 'PHASE2'
       WHEN '3' THEN 'PHASE2; PHASE3' WHEN '4' THEN '' ELSE 'NA' END AS Phase,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 29 = 0 THEN -5 WHEN k % 31 = 0 THEN 0
       ELSE qty * cast(1 + k % 40 AS int) END AS EnrollmentCount,
  CASE WHEN k % 23 = 0 THEN NULL WHEN k % 37 = 0 THEN substr(stext, 1, 7)
       WHEN k % 7 = 0 THEN substr(stext, 6, 2) || '/' || substr(stext, 9, 2) || '/' || substr(stext, 1, 4)
       WHEN k % 7 = 1 THEN stext || ' 10:11:12'
       WHEN k % 7 = 2 THEN substr(stext, 9, 2) || '/' || substr(stext, 6, 2) || '/' || substr(stext, 1, 4)
       ELSE stext END AS StudyStartDate,
  CASE WHEN k % 11 = 0 THEN NULL ELSE cast(cast(cdate - 30 AS date) AS string) END AS PrimaryCompletionDate,
  cast(cdate AS string) AS StudyCompletionDate,
  CASE o_orderstatus
       WHEN 'F' THEN CASE WHEN k % 3 = 0 THEN 'Completed' ELSE 'COMPLETED' END
       WHEN 'O' THEN CASE k % 3 WHEN 0 THEN 'Recruiting' WHEN 1 THEN 'ACTIVE_NOT_RECRUITING' ELSE 'RECRUITING' END
       ELSE CASE k % 3 WHEN 0 THEN 'TERMINATED' WHEN 1 THEN NULL ELSE '' END END AS Status,
  CASE nk % 12 WHEN 0 THEN 'United States' WHEN 1 THEN 'Canada' WHEN 2 THEN 'United Kingdom'
       WHEN 3 THEN 'Germany' WHEN 4 THEN 'France' WHEN 5 THEN 'China' WHEN 6 THEN 'Japan'
       WHEN 7 THEN 'India' WHEN 8 THEN 'Brazil' WHEN 9 THEN 'South Africa' WHEN 10 THEN 'Australia'
       ELSE 'Egypt' END AS LocationCountry,
  CASE WHEN nk % 3 = 0 THEN NULL ELSE n_name END AS LocationState,
  CASE WHEN ck % 20 = 0 THEN '' ELSE 'City ' || cast(ck % 20 AS string) END AS LocationCity,
  'Site ' || cast(ck % 7 AS string) AS LocationFacility,
  CASE WHEN k % 4 = 0 THEN NULL ELSE 'INTERVENTIONAL' END AS StudyType,
  CASE k % 3 WHEN 0 THEN 'RANDOMIZED' WHEN 1 THEN ' NON_RANDOMIZED ' ELSE '' END AS Allocation,
  CASE k % 4 WHEN 0 THEN 'PARALLEL' WHEN 1 THEN 'CROSSOVER' WHEN 2 THEN 'SINGLE_GROUP' ELSE NULL END AS InterventionModel,
  CASE k % 5 WHEN 0 THEN 'TREATMENT' WHEN 1 THEN 'PREVENTION' WHEN 2 THEN ' ' WHEN 3 THEN '' ELSE NULL END AS PrimaryPurpose,
  CASE k % 6 WHEN 0 THEN 'NONE' WHEN 1 THEN 'DOUBLE' WHEN 2 THEN '' ELSE 'SINGLE' END AS MaskingInfo,
  CASE WHEN k % 9 = 0 THEN NULL ELSE 'Change in ' || c_name || '; Safety' END AS OutcomeMeasureDescription,
  CASE WHEN k % 50 = 7 THEN 'invalid' ELSE 'valid' END AS validation_status
FROM joined
"""

STUDIES_PER_PAGE = 500


def order_trials(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trials with the order key they come from."""
    frames = {name: read_table(spark, f"{folder}/{name}.parquet") for name in INPUTS}
    return split_long_code(spark.sql(ORDER_TRIALS_SQL, **frames))


def raw_trials(spark: SparkSession, folder: str) -> DataFrame:
    return order_trials(spark, folder).select(*RAW_COLUMNS, "validation_status")


def study_pages(trials: DataFrame) -> DataFrame:
    """The trials as nested pages, one JSON text (value) per page, see numbered_pages."""
    listed = F.concat(F.lit('{"studies":['), F.array_join("studies", ","), F.lit("]}"))
    return numbered_pages(trials).select(listed.alias("value"))


def numbered_pages(trials: DataFrame) -> DataFrame:
    """The trials as nested pages (page, studies as JSON texts) of at most STUDIES_PER_PAGE studies (one per order key).

    Flat rows are dealt by page and nested where they arrive, so that neither names of fields nor nested rows
    are shuffled or sorted.
    Enrollment is written the three ways pages carry it: text with thousands commas, a
    number with a fraction, and a whole number.
    """
    names = F.split("InterventionName", "; ")
    types = F.split("InterventionType", "; ")
    count_json = (
        F.when(F.col("order_key") % 3 == 0, F.concat(F.lit('"'), F.format_number("EnrollmentCount", 0), F.lit('"')))
        .when(F.col("order_key") % 3 == 1, F.concat(F.col("EnrollmentCount").cast("string"), F.lit(".7")))
        .otherwise(F.col("EnrollmentCount").cast("string"))
    )

    def dated(name: str):
        return F.struct(F.col(name).alias("date"))

    protocol = F.struct(
        F.struct(F.col("NCTId").alias("nctId")).alias("identificationModule"),
        F.struct(
            F.col("BriefTitle").alias("briefSummary"), F.col("OfficialTitle").alias("officialTitle")
        ).alias("descriptionModule"),
        F.struct(
            F.struct(
                F.col("LeadSponsorName").alias("name"), F.col("LeadSponsorClass").alias("class")
            ).alias("leadSponsor")
        ).alias("sponsorCollaboratorsModule"),
        F.struct(F.split("Condition", "; ").alias("conditions")).alias("conditionsModule"),
        F.struct(
            F.transform(
                F.arrays_zip(F.coalesce(names, F.array(F.lit(None).cast("string"))), types),
                lambda x: F.struct(x["0"].alias("name"), x["1"].alias("type")),
            ).alias("interventions")
        ).alias("armsInterventionsModule"),
        F.struct(
            F.split("Phase", "; ").alias("phases"),
            F.col("StudyType").alias("studyType"),
            F.col("Allocation").alias("allocation"),
            F.col("InterventionModel").alias("interventionModel"),
            F.col("PrimaryPurpose").alias("primaryPurpose"),
            F.struct(F.col("MaskingInfo").alias("masking")).alias("maskingInfo"),
        ).alias("designModule"),
        F.struct(F.parse_json(count_json).alias("enrollmentCount")).alias("enrollmentModule"),
        F.struct(
            F.col("Status").alias("overallStatus"),
            dated("StudyStartDate").alias("startDateStruct"),
            dated("PrimaryCompletionDate").alias("primaryCompletionDateStruct"),
            dated("StudyCompletionDate").alias("completionDateStruct"),
        ).alias("statusModule"),
        F.struct(
            F.array(
                F.struct(
                    F.col("LocationCountry").alias("country"),
                    F.col("LocationState").alias("state"),
                    F.col("LocationCity").alias("city"),
                    F.col("LocationFacility").alias("facility"),
                )
            ).alias("locations")
        ).alias("contactsLocationsModule"),
        F.struct(
            F.transform(
                F.split("OutcomeMeasureDescription", "; "), lambda x: F.struct(x.alias("description"))
            ).alias("outcomes")
        ).alias("outcomesModule"),
    )
    dealt = trials.withColumn("page", F.floor(F.col("order_key") / STUDIES_PER_PAGE)).repartition("page")
    studies = dealt.select("page", F.to_json(F.struct(protocol.alias("protocolSection"))).alias("study"))
    return studies.groupBy("page").agg(F.collect_list("study").alias("studies"))
