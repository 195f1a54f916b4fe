"""The same results in plain SQL, for a second engine to check against.

Every statement starts from the order tables alone and carries the CTEs it needs. The fixed
keyword and value tables are shared with the engine; everything else is stated anew.
"""

from __future__ import annotations

from trialmart.functions import categories as cat
from trialmart.functions.text import EMAIL_FORM, SPONSOR_SPELLINGS
from trialmart.operators.clean import TEXT_COLUMNS
from trialmart.operators.warehouse import FACT_COLUMNS
from trialmart.plans.catalog import AS_OF, CRITERIA, DETAIL_ID, RUN_TS, SEARCH, SPAN
from trialmart.plans.refresh import JOB, STEP_NAMES
from trialmart.schemas import RAW_COLUMNS, RAW_TO_CLEAN
from trialmart.sources.order_trials import INPUTS, ORDER_TRIALS_SQL, STUDIES_PER_PAGE

TODAY = f"DATE '{AS_OF.isoformat()}'"


# ---- Expressions ----------------------------------------------------------------------------


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def clean(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"


def strip(c: str) -> str:
    return f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"


def date(c: str) -> str:
    forms = ["%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M:%S"]
    return f"CAST(coalesce({', '.join(f'try_strptime({clean(c)}, {q(f)})' for f in forms)}) AS DATE)"


def date_key(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def days(start: str, end: str) -> str:
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


def holds(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"lower({c}) LIKE {q('%' + w.lower() + '%')}" for w in words) + ")"


def by_keyword(c: str, table: dict[str, list[str]], missing: str, other: str = "Other") -> str:
    arms = " ".join(f"WHEN {holds(c, words)} THEN {q(label)}" for label, words in table.items())
    return f"CASE WHEN {c} IS NULL THEN {q(missing)} {arms} ELSE {q(other)} END"


def by_value(c: str, table: dict[str, list[str]], other: str) -> str:
    arms = " ".join(
        f"WHEN {c} IN ({', '.join(map(q, values))}) THEN {q(label)}" for label, values in table.items()
    )
    return f"CASE {arms} ELSE {q(other)} END"


def md5(*cols: str) -> str:
    return f"md5(concat_ws('|', {', '.join(cols)}))"


def sponsor_name(c: str) -> str:
    name = clean(c)
    for old, new in SPONSOR_SPELLINGS.items():
        name = f"regexp_replace({name}, '\\b{old}\\b', {q(new)}, 'gi')"
    return name


def enrollment_band(n: str) -> str:
    return (
        f"CASE WHEN {n} IS NULL OR {n} <= 0 THEN 'Unknown' WHEN {n} <= 50 THEN 'Small (≤50)' "
        f"WHEN {n} <= 200 THEN 'Medium (51-200)' WHEN {n} <= 1000 THEN 'Large (201-1000)' "
        f"ELSE 'Very Large (>1000)' END"
    )


def phase_number(c: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({c}, 'phase\\s*(\\d+)', 1, 'i'), '') AS INTEGER)"


def flag(c: str, word: str) -> str:
    return f"coalesce(contains(lower({c}), {q(word)}), false)"


def or_unknown(c: str) -> str:
    return f"coalesce(trim(nullif({c}, '')), 'Unknown')"


def or_null(c: str) -> str:
    return f"trim(nullif({c}, ''))"


def bit(test: str) -> str:
    return f"CAST(coalesce({test}, false) AS INTEGER)"


# ---- Common table expressions -----------------------------------------------------------------

_CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, needs: list[str], body: str) -> None:
    _CTES[name] = (needs, body)


def _with(needs: list[str], query: str) -> str:
    """The query behind the CTEs it needs, each after its own needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in _CTES[name][0]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order) + "\n" + query


_cte("raw_trials", [], ORDER_TRIALS_SQL.format(**{name: name for name in INPUTS}))
_cte("valid_raw", ["raw_trials"], "SELECT * FROM raw_trials WHERE validation_status = 'valid'")

SPONSOR_ID = "coalesce('SPONSOR_' || lower(replace(LeadSponsorName, ' ', '_')), 'SPONSOR_UNKNOWN')"
_PLACE = ["LocationCountry", "LocationState", "LocationCity"]
LOCATION_ID = (
    f"CASE WHEN coalesce({', '.join(_PLACE)}) IS NULL THEN 'LOC_UNKNOWN' ELSE 'LOC_' || "
    f"lower(replace(concat_ws('_', {', '.join(f"coalesce({c}, '')" for c in _PLACE)}), ' ', '_')) END"
)


def _slug_id(c: str, prefix: str) -> str:
    return f"coalesce('{prefix}' || lower(replace({c}, ' ', '')), '{prefix}UNKNOWN')"


def _member_id(c: str, prefix: str) -> str:
    return f"coalesce('{prefix}' || nullif(lower(replace({c}, ' ', '')), ''), '{prefix}UNKNOWN_1')"


def _first(key: str, columns: list[str], source: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    return (
        f"SELECT * FROM ({source}) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"
    )


_cte(
    "stg_sponsors",
    ["valid_raw"],
    "SELECT *, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS city FROM ("
    + _first(
        "sponsor_id",
        ["sponsor_name", "sponsor_class", "sponsor_type", "country"],
        f"""SELECT DISTINCT {SPONSOR_ID} AS sponsor_id,
            coalesce(trim(LeadSponsorName), 'Unknown Sponsor') AS sponsor_name,
            {or_unknown('LeadSponsorClass')} AS sponsor_class,
            {by_keyword('LeadSponsorClass', cat.SPONSOR_TYPES, 'Other')} AS sponsor_type,
            {by_keyword('LeadSponsorName', cat.SPONSOR_COUNTRIES, 'Unknown', 'Unknown')} AS country
            FROM valid_raw WHERE length(LeadSponsorName) > 0""",
    )
    + ")",
)
_cte(
    "stg_locations",
    ["valid_raw"],
    _first(
        "location_id",
        ["country", "state", "city", "facility_name"],
        f"""SELECT DISTINCT {LOCATION_ID} AS location_id,
            coalesce(trim(LocationCountry), 'Unknown') AS country, {or_null('LocationState')} AS state,
            {or_null('LocationCity')} AS city, {or_null('LocationFacility')} AS facility_name
            FROM valid_raw WHERE length(concat({', '.join(_PLACE)})) > 0""",
    ),
)
_cte(
    "stg_conditions",
    ["valid_raw"],
    _first(
        "condition_id",
        ["condition_name", "condition_category"],
        f"""SELECT DISTINCT {_member_id('Condition', 'COND_')} AS condition_id,
            coalesce({or_null('Condition')}, 'Unknown Condition') AS condition_name,
            {by_keyword('Condition', cat.CONDITION_GROUPS, 'Other')} AS condition_category FROM valid_raw""",
    ),
)
_cte(
    "stg_interventions",
    ["valid_raw"],
    _first(
        "intervention_id",
        ["intervention_name", "intervention_type"],
        f"""SELECT DISTINCT {_member_id('InterventionName', 'INT_')} AS intervention_id,
            coalesce({or_null('InterventionName')}, 'Unknown Intervention') AS intervention_name,
            {or_unknown('InterventionType')} AS intervention_type FROM valid_raw""",
    ),
)
def _staged_trials(source: str) -> str:
    return f"""SELECT NCTId AS nct_id, {SPONSOR_ID} AS sponsor_id, {LOCATION_ID} AS location_id,
        {_slug_id('Condition', 'COND_')} AS condition_id, {_slug_id('InterventionName', 'INT_')} AS intervention_id,
        {date_key('start_date')} AS start_date_key, {date_key('end_date')} AS completion_date_key,
        {or_null('BriefTitle')} AS brief_title, {or_null('OfficialTitle')} AS official_title,
        {or_unknown('Phase')} AS phase,
        CASE WHEN EnrollmentCount > 0 THEN EnrollmentCount END AS enrollment_count,
        {or_unknown('Status')} AS status, {or_unknown('StudyType')} AS study_type,
        {or_unknown('Allocation')} AS allocation, {or_unknown('InterventionModel')} AS intervention_model,
        {or_unknown('PrimaryPurpose')} AS primary_purpose, {or_unknown('MaskingInfo')} AS masking_info,
        {days('start_date', 'end_date')} AS duration_days,
        CAST(CASE (BriefTitle IS NOT NULL)::INT + (LeadSponsorName IS NOT NULL)::INT + (Condition IS NOT NULL)::INT
             WHEN 3 THEN 100 WHEN 0 THEN 0 ELSE 50 END AS DOUBLE) AS data_completeness_score,
        85.0::DOUBLE AS data_quality_score
        FROM (SELECT *, {date('StudyStartDate')} AS start_date, {date('StudyCompletionDate')} AS end_date
              FROM {source} WHERE NCTId IS NOT NULL)"""


_cte("stg_trials", ["valid_raw"], _staged_trials("valid_raw"))
_REPEATS = {"BriefTitle": ("'Another title'", 7), "Phase": ("NULL", 14)}
_cte(
    "raw_repeats",
    ["raw_trials"],
    f"SELECT {', '.join(RAW_COLUMNS)}, validation_status FROM raw_trials"
    + "".join(
        f" UNION ALL SELECT {', '.join(value if c == name else c for c in RAW_COLUMNS)}, validation_status "
        f"FROM raw_trials WHERE CAST(substr(NCTId, 4) AS BIGINT) % {n} = 3"
        for name, (value, n) in _REPEATS.items()
    ),
)
_cte("valid_repeats", ["raw_repeats"], "SELECT * FROM raw_repeats WHERE validation_status = 'valid'")
_cte("trial_ids", ["stg_trials"], "SELECT DISTINCT nct_id FROM stg_trials")
_cte("repeated_trials", ["stg_trials"], "SELECT nct_id, count(*) AS n FROM stg_trials GROUP BY nct_id HAVING n > 1")
_cte(
    "dim_sponsor",
    ["stg_sponsors"],
    f"""SELECT row_number() OVER (ORDER BY sponsor_id) AS sponsor_key, *, CAST(NULL AS VARCHAR) AS sponsor_category,
        {bit("sponsor_type = 'Industry'")} AS is_industry, {bit("sponsor_type = 'Academic'")} AS is_academic,
        {bit("sponsor_type = 'Government'")} AS is_government, 1 AS is_active FROM stg_sponsors""",
)
_cte(
    "dim_location",
    ["stg_locations"],
    f"""SELECT row_number() OVER (ORDER BY location_id) AS location_key, location_id, country, state, city,
        facility_name, {by_value('country', cat.COUNTRY_REGIONS, 'Other')} AS region,
        {by_value('country', cat.COUNTRY_REGIONS, 'Other')} AS continent,
        CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
        {by_value('country', cat.COUNTRY_TIMEZONES, 'UTC')} AS timezone, 1 AS is_active FROM stg_locations""",
)
_cte(
    "dim_condition",
    ["stg_conditions"],
    f"""SELECT row_number() OVER (ORDER BY condition_id) AS condition_key, condition_id, condition_name,
        condition_category, {by_value('condition_category', cat.CONDITION_TYPES, 'Other')} AS condition_type,
        CAST(NULL AS VARCHAR) AS icd_code, condition_name AS mesh_term,
        {bit(f"condition_category IN ({', '.join(map(q, cat.RARE_CONDITION_GROUPS))})")} AS is_rare,
        {by_value('condition_category', cat.CONDITION_PREVALENCE, 'Low')} AS prevalence_category,
        1 AS is_active FROM stg_conditions""",
)
_KINDS = {"drug": "Drug", "device": "Device", "procedure": "Procedure"}
_cte(
    "dim_intervention",
    ["stg_interventions"],
    "SELECT row_number() OVER (ORDER BY intervention_id) AS intervention_key, *, "
    + "intervention_type AS intervention_category, "
    + ", ".join(f"if(intervention_type = '{v}', intervention_name, NULL) AS {k}_name" for k, v in _KINDS.items())
    + ", "
    + ", ".join(f"{bit(f"intervention_type = '{v}'")} AS is_{k}" for k, v in _KINDS.items())
    + f", {bit("intervention_type = 'Behavioral'")} AS is_behavioral, 1 AS is_active FROM stg_interventions",
)
_cte(
    "dim_dates",
    ["stg_trials"],
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
        CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
        CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
        CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
        strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
        CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday,
        CAST(year(d) AS INTEGER) AS fiscal_year, CAST(quarter(d) AS INTEGER) AS fiscal_quarter
        FROM (SELECT CAST(unnest(generate_series(
                CAST(strptime(CAST(lo AS VARCHAR), '%Y%m%d') AS DATE),
                CAST(strptime(CAST(hi AS VARCHAR), '%Y%m%d') AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT least(min(start_date_key), min(completion_date_key)) AS lo,
                           greatest(max(start_date_key), max(completion_date_key)) AS hi FROM stg_trials))""",
)
_cte(
    "fact_trials",
    ["stg_trials", "dim_sponsor", "dim_location", "dim_condition", "dim_intervention"],
    f"""SELECT *, row_number() OVER (ORDER BY nct_id) AS trial_key, enrollment_count AS actual_enrollment,
        {bit('enrollment_count > 0')} AS enrollment_target_met, {bit("status ILIKE '%completed%'")} AS is_completed,
        {bit("status ILIKE '%terminated%'")} AS is_terminated, {bit("status ILIKE '%recruiting%'")} AS is_recruiting,
        'ClinicalTrials.gov' AS source_system FROM stg_trials """
    + " ".join(
        f"LEFT JOIN (SELECT {d}_id, {d}_key FROM dim_{d}) USING ({d}_id)"
        for d in ("sponsor", "location", "condition", "intervention")
    ),
)
_cte(
    "wide",
    ["fact_trials", "dim_dates"],
    """SELECT * FROM fact_trials
        LEFT JOIN (SELECT sponsor_key, sponsor_name, sponsor_type FROM dim_sponsor) USING (sponsor_key)
        LEFT JOIN (SELECT location_key, country, state FROM dim_location) USING (location_key)
        LEFT JOIN (SELECT condition_key, condition_name, condition_category FROM dim_condition) USING (condition_key)
        LEFT JOIN (SELECT intervention_key, intervention_type FROM dim_intervention) USING (intervention_key)
        LEFT JOIN (SELECT date_key AS start_date_key, year, month_number, month_name FROM dim_dates) USING (start_date_key)""",
)
_cte(
    "clean_trials",
    ["valid_raw"],
    f"""SELECT c.*,
        data_completeness_score * 0.6::DOUBLE + ((
            CASE WHEN study_start_date < study_completion_date THEN 1.0::DOUBLE
                 WHEN study_start_date IS NOT NULL AND study_completion_date IS NOT NULL THEN 0.5::DOUBLE
                 ELSE 0.0::DOUBLE END
          + CASE WHEN enrollment_count > 0 AND enrollment_count <= 100000 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END
          + CASE WHEN lower(phase) <> 'unknown' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END
        ) / 3.0::DOUBLE) * 0.4::DOUBLE AS data_quality_score, '1.0' AS data_version
        FROM (SELECT t.*,
          {md5('location_country', 'location_state', 'location_city')} AS location_id,
          {by_keyword('location_country', cat.REGION_COUNTRIES, 'Unknown')} AS location_region,
          {by_keyword('location_country', cat.CONTINENT_COUNTRIES, 'Unknown')} AS location_continent,
          CASE WHEN lead_sponsor_name IS NULL THEN 'SPONSOR_UNKNOWN' ELSE md5(lead_sponsor_name) END AS sponsor_id,
          {by_keyword('lead_sponsor_class', cat.SPONSOR_TYPES, 'Unknown')} AS sponsor_type,
          {by_keyword('lead_sponsor_name', cat.SPONSOR_CATEGORIES, 'Unknown')} AS sponsor_category,
          {by_keyword('condition', cat.CONDITION_KEYWORDS, 'Unknown')} AS condition_category,
          CASE WHEN condition IS NULL THEN 'COND_UNKNOWN' ELSE md5(condition) END AS condition_id,
          CASE WHEN intervention_name IS NULL THEN 'INT_UNKNOWN' ELSE md5(intervention_name) END AS intervention_id,
          {by_keyword('intervention_type', cat.INTERVENTION_CATEGORIES, 'Unknown')} AS intervention_category,
          {days('study_start_date', 'study_completion_date')} AS duration_days,
          {phase_number('phase')} AS phase_number, {enrollment_band('enrollment_count')} AS enrollment_category,
          {flag('status', 'completed')} AS is_completed, {flag('status', 'recruiting')} AS is_recruiting,
          {flag('status', 'terminated')} AS is_terminated,
          ((nct_id IS NOT NULL)::INT + (brief_title IS NOT NULL)::INT + (lead_sponsor_name IS NOT NULL)::INT
            + (condition IS NOT NULL)::INT) / 4.0::DOUBLE * 0.7::DOUBLE
          + ((enrollment_count IS NOT NULL)::INT + (phase IS NOT NULL)::INT + (status IS NOT NULL)::INT
            + (study_start_date IS NOT NULL)::INT) / 4.0::DOUBLE * 0.3::DOUBLE AS data_completeness_score
          FROM (SELECT """
    + ", ".join(
        f"{sponsor_name(raw)} AS {name}"
        if name == "lead_sponsor_name"
        else f"{clean(raw)} AS {name}"
        if name in TEXT_COLUMNS
        else f"{date(raw)} AS {name}"
        if name.endswith("_date")
        else f"{raw} AS {name}"
        for raw, name in RAW_TO_CLEAN.items()
    )
    + ", validation_status FROM valid_raw) t) c",
)

# Flat studies as they come back from pages: lists without entries are empty text.
_FLAT = {
    "Condition": "coalesce(Condition, '')",
    "InterventionName": "coalesce(InterventionName || CASE WHEN InterventionType LIKE '%; %' THEN '; ' ELSE '' END, '')",
    "InterventionType": "InterventionType",
    "Phase": "Phase",
    "LocationCountry": "coalesce(LocationCountry, '')",
    "LocationState": "coalesce(LocationState, '')",
    "LocationCity": "coalesce(LocationCity, '')",
    "LocationFacility": "coalesce(LocationFacility, '')",
    "OutcomeMeasureDescription": "coalesce(OutcomeMeasureDescription, '')",
}
_cte(
    "flat_studies",
    ["raw_trials"],
    "SELECT " + ", ".join(f"{_FLAT.get(c, c)} AS {c}" for c in RAW_COLUMNS) + " FROM raw_trials",
)
# Of every third page nothing but its number is left.
_cte(
    "lost_pages",
    ["raw_trials"],
    f"SELECT DISTINCT order_key // {STUDIES_PER_PAGE} AS page FROM raw_trials WHERE (order_key // {STUDIES_PER_PAGE}) % 3 = 1",
)
_cte(
    "damaged_studies",
    ["raw_trials", "lost_pages"],
    "SELECT "
    + ", ".join(f"{_FLAT.get(c, c)} AS {c}" for c in RAW_COLUMNS)
    + f" FROM raw_trials WHERE (order_key // {STUDIES_PER_PAGE}) % 3 <> 1 UNION ALL SELECT "
    + ", ".join("NULL" for _ in RAW_COLUMNS)
    + " FROM lost_pages",
)

# Landed pages with tokens and damage: n is NULL on an error page.
_cte(
    "landed",
    ["raw_trials"],
    f"""SELECT k, copies, CASE WHEN kind = 'error' THEN NULL WHEN kind = 'empty' THEN 0 ELSE n + bad + spoilt END AS n,
        good, bad, spoilt, kind, token AS page_token, CASE WHEN kind <> 'error' THEN next_token END AS next_token,
        CASE WHEN token IS NOT NULL THEN 'page ' || token WHEN kind = 'error'
             THEN 'only ' || sha256('{{"error":"quota","at":' || k || '}}')
             WHEN next_token IS NOT NULL THEN 'first before ' || next_token END AS key
        FROM (SELECT k, n, good, CASE WHEN k % 17 = 6 THEN 2 ELSE 1 END AS copies,
            CASE WHEN kind = 'whole' AND k % 3 = 1 THEN 1 ELSE 0 END AS bad,
            CASE WHEN kind = 'whole' AND k % 4 = 2 THEN 1 ELSE 0 END AS spoilt, kind,
            CASE WHEN k % 5 <> 0 OR (k // 5) % 6 = 5 THEN 't' || k END AS token,
            CASE WHEN k % 5 < 4 THEN 't' || (k + 1) WHEN (k // 5) % 6 = 5 THEN 't' || (k - 4) END AS next_token
          FROM (SELECT k, n, good, CASE WHEN k % 7 = 2 THEN 'error' WHEN k % 13 = 5 THEN 'empty' ELSE 'whole' END AS kind
            FROM (SELECT CAST(order_key // {STUDIES_PER_PAGE} AS BIGINT) AS k, count(*) AS n,
                  count(*) FILTER (WHERE NCTId IS NOT NULL AND NCTId <> '') AS good
                FROM raw_trials GROUP BY ALL) WHERE k % 11 <> 3))""",
)
_cte(
    "page_walk",
    ["landed"],
    """SELECT key, key AS chain, CAST(0 AS BIGINT) AS step, false AS after_empty, next_token, n FROM landed l
        WHERE NOT EXISTS (SELECT 1 FROM landed p WHERE p.next_token = l.page_token)
        UNION ALL SELECT l.key, w.chain, w.step + 1, w.after_empty OR coalesce(w.n = 0, false), l.next_token, l.n
        FROM page_walk w JOIN landed l ON l.page_token = w.next_token""",
)
_cte(
    "page_states",
    ["landed", "page_walk"],
    """SELECT l.page_token, l.next_token, CAST(l.n AS BIGINT) AS n_studies, w.chain, w.step,
        CASE WHEN c.i > 1 THEN 'copy' WHEN w.chain IS NULL THEN 'in or behind a cycle' WHEN w.chain LIKE 'page %' THEN 'after a gap'
             WHEN w.after_empty THEN 'after an empty page' WHEN l.n IS NULL THEN 'no studies' WHEN l.n = 0 THEN 'empty' ELSE 'read' END AS state,
        l.next_token IS NOT NULL AND NOT EXISTS (SELECT 1 FROM landed p WHERE p.page_token = l.next_token) AS next_missing
        FROM landed l LEFT JOIN page_walk w USING (key) JOIN (VALUES (1), (2)) c(i) ON c.i <= l.copies""",
)

# Two loads of the valid trials, and what lies between them.
_cte(
    "numbered",
    ["valid_raw"],
    f"""SELECT {', '.join(RAW_COLUMNS)}, validation_status, CAST(substr(NCTId, 4) AS BIGINT) AS number
        FROM valid_raw WHERE NCTId IS NOT NULL AND NCTId <> ''""",
)
_cte("load_1", ["numbered"], "SELECT * FROM numbered WHERE number % 13 <> 4")
_cte(
    "load_2",
    ["numbered"],
    """SELECT * REPLACE (CASE WHEN number % 19 = 6 THEN 'Another title' ELSE BriefTitle END AS BriefTitle,
            CASE WHEN number % 23 <> 7 THEN Phase END AS Phase) FROM numbered WHERE number % 17 <> 5""",
)
_cte(
    "between_loads",
    ["load_1", "load_2"],
    """SELECT coalesce(a.NCTId, b.NCTId) AS nct_id,
        CASE WHEN a.NCTId IS NULL THEN 'inserted' WHEN b.NCTId IS NULL THEN 'deleted'
             WHEN a.BriefTitle IS DISTINCT FROM b.BriefTitle OR a.Phase IS DISTINCT FROM b.Phase THEN 'changed' ELSE 'same' END AS change
        FROM load_1 a FULL JOIN load_2 b ON a.NCTId = b.NCTId""",
)
# Members of the keyed tables with the trials that name them, and their keys after two refreshes.
_cte(
    "members",
    ["numbered"],
    f"""SELECT 'dim_sponsor' AS table_name, {SPONSOR_ID} AS member_id, number FROM numbered WHERE length(LeadSponsorName) > 0
        UNION ALL SELECT 'dim_location', {LOCATION_ID}, number FROM numbered WHERE length(concat({', '.join(_PLACE)})) > 0
        UNION ALL SELECT 'dim_condition', {_member_id('Condition', 'COND_')}, number FROM numbered
        UNION ALL SELECT 'dim_intervention', {_member_id('InterventionName', 'INT_')}, number FROM numbered
        UNION ALL SELECT 'fact_trials', NCTId, number FROM numbered""",
)
_cte(
    "first_keys",
    ["members"],
    """SELECT table_name, member_id, row_number() OVER (PARTITION BY table_name ORDER BY member_id) AS member_key
        FROM (SELECT DISTINCT table_name, member_id FROM members WHERE number % 5 <> 0)""",
)
_cte(
    "kept_keys",
    ["members", "first_keys"],
    """SELECT table_name, member_id, coalesce(member_key, largest + row_number() OVER (PARTITION BY table_name, member_key IS NULL ORDER BY member_id)) AS member_key
        FROM (SELECT DISTINCT table_name, member_id FROM members WHERE number % 7 <> 0)
        LEFT JOIN first_keys USING (table_name, member_id)
        JOIN (SELECT table_name, max(member_key) AS largest FROM first_keys GROUP BY table_name) USING (table_name)""",
)
_cte("second_trials", ["numbered"], _staged_trials("(SELECT * FROM numbered WHERE number % 7 <> 0)"))


# ---- Statements -------------------------------------------------------------------------------


def _raw_statements() -> dict[str, str]:
    start, end = date("StudyStartDate"), date("StudyCompletionDate")
    terms = " OR ".join(
        holds(c, SEARCH["search_terms"]) for c in ("BriefTitle", "OfficialTitle", "Condition", "InterventionName")
    )
    shown = ", ".join([*RAW_COLUMNS, "validation_status"])
    place = "concat_ws(', ', nullif(LocationCity, ''), LocationState, LocationCountry)"
    parts = f"string_split({place}, ',')"
    contact = (
        "lower(replace(LocationFacility, ' ', '')) || '@' || replace(LocationCity, ' ', '-') || "
        "CASE WHEN LocationState IS NULL THEN '' ELSE '.org' END"
    )
    eighth = "(EnrollmentCount / 8.0::DOUBLE)"
    raw = {
        "raw_trials": f"SELECT {', '.join(RAW_COLUMNS)}, validation_status FROM raw_trials",
        "valid_raw": f"SELECT {shown} FROM raw_trials WHERE validation_status = 'valid'",
        "search_trials": f"""SELECT {shown} FROM raw_trials WHERE ({terms})
            AND {holds('Condition', SEARCH['conditions'])} AND {holds('LeadSponsorName', SEARCH['sponsors'])}
            AND {holds('Phase', SEARCH['phases'])} AND {holds('Status', SEARCH['status'])}
            AND {start} >= DATE '{SEARCH['start_date']}' AND {end} <= DATE '{SEARCH['end_date']}'""",
        "recent_trials": f"SELECT {shown} FROM raw_trials WHERE {start} >= {TODAY} - 30",
        "trial_details": f"SELECT {', '.join(RAW_COLUMNS)}, validation_status FROM raw_trials WHERE NCTId = '{DETAIL_ID}' LIMIT 1",
        "limit_trials": f"""SELECT {shown} FROM raw_trials WHERE validation_status = 'valid' AND NCTId IS NOT NULL
            ORDER BY NCTId LIMIT 25""",
        "clean_text": "SELECT "
        + ", ".join(f"{clean(raw)} AS {name}" for raw, name in RAW_TO_CLEAN.items() if name in TEXT_COLUMNS)
        + " FROM raw_trials",
        "conform_columns": "SELECT "
        + ", ".join(
            f"{_PARTS[raw]} AS {name}" if raw in _PARTS else f"{raw} AS {name}" for raw, name in RAW_TO_CLEAN.items()
        )
        + f", concat_ws(', ', {_PARTS['LocationCity']}, {_PARTS['LocationState']}, LocationCountry) AS location FROM raw_trials",
        "parse_dates": f"""SELECT NCTId, s AS start_date, e AS end_date, {days('s', 'e')} AS duration_days,
            {date_key('s')} AS start_date_key, s AS key_date, CAST(date_trunc('month', s) AS DATE) AS start_month,
            year(s) >= year({TODAY}) - 2 AS in_last_years
            FROM (SELECT NCTId, {start} AS s, {end} AS e FROM raw_trials)""",
        "split_location": f"""SELECT NCTId,
            CASE WHEN len(p) IN (2, 3) THEN trim(p[1]) ELSE place END AS city,
            CASE WHEN len(p) IN (2, 3) THEN trim(p[2]) END AS state,
            CASE WHEN len(p) = 3 THEN trim(p[3]) END AS country
            FROM (SELECT NCTId, {place} AS place, {parts} AS p FROM raw_trials)""",
        "normalize_sponsor": f"SELECT NCTId, {sponsor_name('LeadSponsorName')} AS sponsor_name FROM raw_trials",
        "hash_keys": f"""SELECT NCTId, {md5('LocationCountry', 'LocationState', 'LocationCity')} AS location_hash,
            {md5('BriefTitle', 'OfficialTitle')} AS title_hash FROM raw_trials""",
        "phase_number": f"SELECT NCTId, Phase AS phase, {phase_number('Phase')} AS phase_number FROM raw_trials",
        "enrollment_band": f"""SELECT NCTId, EnrollmentCount AS enrollment_count,
            {enrollment_band('EnrollmentCount')} AS enrollment_category FROM raw_trials""",
        "condition_keywords": f"""SELECT NCTId, Condition AS condition,
            {by_keyword('Condition', cat.CONDITION_KEYWORDS, 'Unknown')} AS category FROM raw_trials""",
        "region_continent": f"""SELECT NCTId, LocationCountry AS country,
            {by_keyword('LocationCountry', cat.REGION_COUNTRIES, 'Unknown')} AS region,
            {by_keyword('LocationCountry', cat.CONTINENT_COUNTRIES, 'Unknown')} AS continent FROM raw_trials""",
        "sponsor_classes": f"""SELECT NCTId, {by_keyword('LeadSponsorClass', cat.SPONSOR_TYPES, 'Unknown')} AS sponsor_type,
            {by_keyword('LeadSponsorName', cat.SPONSOR_CATEGORIES, 'Unknown')} AS sponsor_category FROM raw_trials""",
        "intervention_class": f"""SELECT NCTId,
            {by_keyword('InterventionType', cat.INTERVENTION_CATEGORIES, 'Unknown')} AS intervention_category FROM raw_trials""",
        "status_flags": f"""SELECT NCTId, {flag('Status', 'completed')} AS is_completed,
            {flag('Status', 'recruiting')} AS is_recruiting, {flag('Status', 'terminated')} AS is_terminated FROM raw_trials""",
        "email_rule": f"""SELECT coalesce(regexp_matches(contact, {q(EMAIL_FORM)}), false) AS is_valid,
            count(*) AS row_count FROM (SELECT {contact} AS contact FROM raw_trials) GROUP BY 1""",
        "safe_ratio": f"""SELECT NCTId, CASE WHEN EnrollmentCount IS NULL OR d IS NULL OR d = 0 THEN 0.0::DOUBLE
            ELSE EnrollmentCount::DOUBLE / d::DOUBLE END AS enrollment_per_day
            FROM (SELECT NCTId, EnrollmentCount, {days(start, end)} AS d FROM raw_trials)""",
        "number_labels": f"""SELECT NCTId, coalesce(format('{{:,}}', EnrollmentCount), 'N/A') AS whole_label,
            coalesce(format('{{:,}}', {eighth}), 'N/A') AS exact_label,
            coalesce(printf('%.1f%%', {eighth}), 'N/A') AS percent_label,
            coalesce('$' || format('{{:,.2f}}', {eighth}), 'N/A') AS currency_label,
            coalesce(CAST(EnrollmentCount AS VARCHAR), 'N/A') AS plain_label FROM raw_trials""",
        "quality_report": _quality(
            "raw_trials", [*RAW_COLUMNS, "validation_status"], ["NCTId", "BriefTitle"]
        ),
        "place_duplicates": _quality(
            "raw_trials", ["LocationCountry", "LocationState", "LocationCity"], ["LocationState", "LocationCity"]
        ),
        "missing_values": " UNION ALL ".join(
            f"""SELECT {q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count,
            round_even(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 2) AS missing_percentage
            FROM raw_trials"""
            for c in [*RAW_COLUMNS, "validation_status"]
        ),
        "duplicate_keys": """SELECT LeadSponsorName, count(*) AS row_count FROM raw_trials
            WHERE LeadSponsorName IS NOT NULL GROUP BY LeadSponsorName HAVING count(*) > 1""",
    }
    found = {name: _with(["raw_trials"], query) for name, query in raw.items()}
    found["duplicate_trials"] = _with(
        ["raw_repeats"],
        "SELECT NCTId, count(*) AS row_count FROM raw_repeats WHERE NCTId IS NOT NULL GROUP BY NCTId HAVING count(*) > 1",
    )
    columns = """sponsor_id location_id condition_id intervention_id start_date_key completion_date_key brief_title
        official_title phase enrollment_count status study_type allocation intervention_model primary_purpose
        masking_info duration_days data_completeness_score data_quality_score"""
    found["stage_repeats"] = _with(
        ["valid_repeats"], _first("nct_id", columns.split(), _staged_trials("valid_repeats"))
    )
    found["search_index"] = found["search_trials"]
    return found


# Parts of a place as one text, where a gap is a dash.
_PARTS = {
    "LocationCity": "coalesce(nullif(LocationCity, ''), '-')",
    "LocationState": "coalesce(LocationState, '-')",
    "LocationCountry": "LocationCountry",
}


def _quality(table: str, columns: list[str], required: list[str]) -> str:
    filled = " + ".join(f"count({c})" for c in required)
    listed = ", ".join(columns)
    return f"""SELECT total_rows, duplicate_rows, round_even(dup, 2) AS duplicate_percentage,
        round_even(complete, 2) AS completeness,
        round_even(greatest(0.0::DOUBLE, 100.0::DOUBLE - dup * 2.0::DOUBLE - (100.0::DOUBLE - complete)), 2) AS quality_score
        FROM (SELECT total_rows, duplicate_rows, duplicate_rows * 100.0::DOUBLE / total_rows AS dup,
              filled * 100.0::DOUBLE / (total_rows * {len(required)}) AS complete
              FROM (SELECT count(*) AS total_rows, {filled} AS filled,
                    count(*) - (SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {table})) AS duplicate_rows
                    FROM {table}))"""


def _clean_columns() -> list[str]:
    derived = """location_id location_region location_continent sponsor_id sponsor_type sponsor_category
        condition_category condition_id intervention_id intervention_category duration_days phase_number
        enrollment_category is_completed is_recruiting is_terminated data_completeness_score
        data_quality_score data_version"""
    return [*RAW_TO_CLEAN.values(), "validation_status", *derived.split()]


def _clean_statements() -> dict[str, str]:
    listed = _clean_columns()
    found = {
        "clean_trials": f"SELECT {', '.join(listed)} FROM clean_trials",
        "row_quality": "SELECT nct_id, data_completeness_score, data_quality_score FROM clean_trials",
        "clean_quality_report": _quality("clean_trials", listed, ["nct_id", "brief_title", "lead_sponsor_name"]),
        "business_rules": """SELECT 'dates_in_order' AS rule,
              count(*) FILTER (WHERE study_start_date >= study_completion_date) AS failing_rows FROM clean_trials
            UNION ALL SELECT 'enrollment_in_range',
              count(*) FILTER (WHERE enrollment_count IS NULL OR enrollment_count <= 0 OR enrollment_count > 100000)
              FROM clean_trials
            UNION ALL SELECT 'phase_known',
              count(*) FILTER (WHERE phase IS NULL OR lower(phase) = 'unknown') FROM clean_trials""",
    }
    return {name: _with(["clean_trials"], query) for name, query in found.items()}


def _page_statements() -> dict[str, str]:
    kept = "NCTId IS NOT NULL AND NCTId <> ''"
    tidy = ", ".join(c if c == "EnrollmentCount" else f"{strip(c)} AS {c}" for c in RAW_COLUMNS)
    found = {
        "flatten_study": f"SELECT {', '.join(RAW_COLUMNS)} FROM flat_studies",
        "validate_trials": f"SELECT {tidy} FROM flat_studies WHERE {kept}",
        "invalid_trials": f"SELECT {', '.join(RAW_COLUMNS)} FROM flat_studies WHERE NOT ({kept})",
        "validation_summary": _summary("flat_studies", "0"),
        "write_extraction": f"""SELECT '{RUN_TS.isoformat()}' AS extraction_date, valid_trials AS total_trials,
            valid_trials AS saved_trials, '{CRITERIA["phases"][0]}' AS first_phase,
            CAST({CRITERIA["limit"]} AS BIGINT) AS search_limit, * FROM ({_summary("flat_studies", "0")})""",
    }
    found["saved_trials"] = found["validate_trials"]
    found["extracted_trials"] = (
        "SELECT *, 'ClinicalTrials.gov API' AS data_source, 'valid' AS validation_status "
        f"FROM ({found['validate_trials']})"
    )
    damaged = {
        "damaged_summary": _summary("damaged_studies", "(SELECT count(*) FROM lost_pages)"),
        "damaged_invalid": f"SELECT {', '.join(RAW_COLUMNS)} FROM damaged_studies WHERE NOT ({kept})",
        "unreadable_pages": "SELECT page, true AS is_page FROM lost_pages",
    }
    chains = {
        "page_chains": "SELECT * FROM page_states",
        "chain_summary": """SELECT state, count(*) AS pages, CAST(coalesce(sum(n_studies), 0) AS BIGINT) AS studies,
            count(*) FILTER (WHERE next_missing) AS next_missing FROM page_states GROUP BY state""",
        "page_faults": """SELECT 'page is no JSON' AS fault, CAST(0 AS BIGINT) AS row_count UNION ALL
            SELECT 'page without studies', CAST(coalesce(sum(copies) FILTER (WHERE kind = 'error'), 0) AS BIGINT) FROM landed UNION ALL
            SELECT 'study is no object', CAST(sum(copies * bad) AS BIGINT) FROM landed""",
        "lost_values": """SELECT column_name, lost FROM (SELECT CAST(sum(copies * spoilt) AS BIGINT) AS lost FROM landed),
            (VALUES ('NCTId'), ('Condition'), ('LocationCountry'), ('LocationState'), ('LocationCity'), ('LocationFacility')) v(column_name)
            WHERE lost > 0""",
        "chain_validation": """SELECT total_processed, valid_trials, total_processed - valid_trials AS invalid_trials, unreadable,
            valid_trials::DOUBLE / total_processed * 100.0::DOUBLE AS validation_rate
            FROM (SELECT CAST(sum(copies * coalesce(n, 1)) AS BIGINT) AS total_processed,
                CAST(sum(copies * CASE WHEN kind = 'whole' THEN good ELSE 0 END) AS BIGINT) AS valid_trials,
                CAST(sum(copies * CASE WHEN kind = 'error' THEN 1 ELSE bad END) AS BIGINT) AS unreadable FROM landed)""",
    }
    found |= chains
    needs = {name: ["damaged_studies", "lost_pages"] for name in damaged}
    needs |= {name: ["page_states", "landed"] for name in chains}
    return {name: _with(needs.get(name, ["flat_studies"]), query) for name, query in (found | damaged).items()}


def _summary(table: str, lost: str) -> str:
    kept = "NCTId IS NOT NULL AND NCTId <> ''"
    return f"""SELECT count(*) AS total_processed, count(*) FILTER (WHERE {kept}) AS valid_trials,
        count(*) FILTER (WHERE NOT ({kept})) AS invalid_trials, CAST({lost} AS BIGINT) AS unreadable,
        count(*) FILTER (WHERE {kept})::DOUBLE / count(*) * 100.0::DOUBLE AS validation_rate FROM {table}"""


def _table_statements() -> dict[str, str]:
    stored = {
        "stage_sponsors": "stg_sponsors",
        "stage_locations": "stg_locations",
        "stage_conditions": "stg_conditions",
        "stage_interventions": "stg_interventions",
        "stage_trials": "stg_trials",
        **{name: name for name in ("dim_dates", "dim_sponsor", "dim_location", "dim_condition", "dim_intervention")},
    }
    found = {name: _with([table], f"SELECT * FROM {table}") for name, table in stored.items()}
    found["fact_trials"] = _with(["fact_trials"], f"SELECT {', '.join(FACT_COLUMNS)} FROM fact_trials")
    checks = [
        ("sponsor_key", "dim_sponsor", "sponsor_key"),
        ("location_key", "dim_location", "location_key"),
        ("condition_key", "dim_condition", "condition_key"),
        ("intervention_key", "dim_intervention", "intervention_key"),
        ("start_date_key", "dim_dates", "date_key"),
        ("completion_date_key", "dim_dates", "date_key"),
    ]
    found["referential_integrity"] = _with(
        ["fact_trials", "dim_dates"],
        " UNION ALL ".join(
            f"""SELECT '{key}' AS fact_column, count(*) FILTER ({key} IS NULL) AS null_keys,
            count({key}) FILTER ({key} NOT IN (SELECT {dim_key} FROM {dim})) AS orphan_keys FROM fact_trials"""
            for key, dim, dim_key in checks
        ),
    )
    return found


# Report columns by name; reports are groupings of one wide table of facts and attributes.
_MEASURES = {
    "trial_count": "count(*)",
    "total_trials": "count(*)",
    "avg_enrollment": "avg(enrollment_count)",
    "total_enrollment": "CAST(sum(enrollment_count) AS BIGINT)",
    "avg_duration": "avg(duration_days)",
    "avg_duration_days": "avg(duration_days)",
    "min_duration": "min(duration_days)",
    "max_duration": "max(duration_days)",
    "completed_trials": "count(*) FILTER (status = 'Completed')",
    "recruiting_trials": "count(*) FILTER (status = 'Recruiting')",
    "completion_rate": "round(100.0::DOUBLE * count(*) FILTER (status = 'Completed') / count(*), 2)",
    "unique_sponsors": "count(DISTINCT sponsor_key)",
    "unique_conditions": "count(DISTINCT condition_key)",
    "unique_locations": "count(DISTINCT location_key)",
    "high_quality": "count(*) FILTER (data_completeness_score >= 90)",
    "medium_quality": "count(*) FILTER (data_completeness_score >= 70 AND data_completeness_score < 90)",
    "low_quality": "count(*) FILTER (data_completeness_score < 70)",
    "avg_completeness": "avg(data_completeness_score)",
    "avg_quality": "avg(data_quality_score)",
    "large_trials": "count(*) FILTER (enrollment_count > 1000)",
    "small_trials": "count(*) FILTER (enrollment_count <= 100)",
}


def _rollup(keys: str, measures: str, having: str = "true", where: str = "true", top: int | None = None) -> str:
    """Grouping of the wide table; `top` keeps the largest groups, ties in key order."""
    listed = ", ".join(f"{_MEASURES[m]} AS {m}" for m in measures.split())
    names = ", ".join(keys.split())
    grouped = f"GROUP BY {names} HAVING {having}" if keys else ""
    query = f"SELECT {names}{', ' if keys else ''}{listed} FROM wide WHERE {where} {grouped}"
    if top is not None:
        ties = ", ".join(f"{k} NULLS FIRST" for k in keys.split())
        query += f" ORDER BY {measures.split()[0]} DESC, {ties} LIMIT {top}"
    return query


def _monthly(measures: str, since: str) -> str:
    return _rollup("year month_number month_name", measures, where=f"year >= {since}")


def _report_statements() -> dict[str, str]:
    with_condition, with_place = "condition_key IS NOT NULL", "location_key IS NOT NULL"
    top_conditions = _rollup(
        "condition_name condition_category", "trial_count avg_enrollment avg_duration", where=with_condition, top=20
    )
    top_places = _rollup(
        "country state", "trial_count total_enrollment", where=f"{with_place} AND country IS NOT NULL", top=20
    )
    all_conditions = _rollup("condition_name condition_category", "trial_count avg_enrollment", where=with_condition)
    all_places = _rollup(
        "country state", "trial_count total_enrollment", where=f"{with_place} AND country IS NOT NULL"
    )

    def by_category(rows: str) -> str:
        return f"""SELECT condition_category, CAST(sum(trial_count) AS BIGINT) AS trial_count,
            avg(avg_enrollment) AS avg_enrollment FROM ({rows}) WHERE condition_category IS NOT NULL
            GROUP BY condition_category"""

    def by_country(rows: str) -> str:
        return f"""SELECT country, CAST(sum(trial_count) AS BIGINT) AS trial_count,
            CAST(coalesce(sum(total_enrollment), 0) AS BIGINT) AS total_enrollment FROM ({rows}) GROUP BY country"""

    def cut(rows: str, ties: str, top: int) -> str:
        order = ", ".join(f"{k} NULLS FIRST" for k in ties.split())
        return f"SELECT * FROM ({rows}) ORDER BY trial_count DESC, {order} LIMIT {top}"

    headline = _rollup(
        "", "total_trials unique_sponsors unique_conditions unique_locations avg_enrollment avg_duration"
    )
    bands = "total_trials high_quality medium_quality low_quality avg_completeness avg_quality"
    in_2023 = "sponsor_key IS NOT NULL AND year = 2023"
    found = {
        "top_sponsors_year": _rollup(
            "sponsor_name", "trial_count avg_enrollment avg_duration_days", where=in_2023, top=10
        ),
        "common_conditions": _rollup(
            "condition_name condition_category",
            "trial_count avg_duration_days avg_enrollment min_duration max_duration",
            where=f"{with_condition} AND duration_days IS NOT NULL",
            top=20,
        ),
        "geo_distribution": _rollup(
            "country state",
            "trial_count total_enrollment avg_enrollment avg_duration",
            where=f"{with_place} AND country IS NOT NULL",
            top=20,
        ),
        "status_by_phase": _rollup("phase status", "trial_count avg_enrollment avg_duration"),
        "monthly_activity": "SELECT * EXCLUDE (month_number) FROM ("
        + _monthly("trial_count avg_enrollment total_enrollment", f"year({TODAY}) - 2")
        + ")",
        "sponsor_performance": _rollup(
            "sponsor_name sponsor_type",
            "total_trials completed_trials recruiting_trials avg_enrollment avg_duration completion_rate",
            where="sponsor_key IS NOT NULL",
            having="count(*) >= 5",
            top=15,
        ),
        "condition_category": _rollup(
            "condition_category",
            "trial_count unique_sponsors avg_enrollment avg_duration total_enrollment",
            where=f"{with_condition} AND sponsor_key IS NOT NULL",
        ),
        "intervention_types": _rollup(
            "intervention_type",
            "trial_count avg_enrollment avg_duration unique_conditions",
            where=f"intervention_key IS NOT NULL AND {with_condition}",
        ),
        "quality_assessment": f"SELECT 'Overall' AS metric, * FROM ({_rollup('', bands)}) UNION ALL "
        f"SELECT 'By Sponsor Type', * FROM ({_rollup('', bands, where="sponsor_type = 'Industry'")})",
        "duration_by_condition": _rollup(
            "condition_category",
            "trial_count avg_duration min_duration max_duration",
            where=f"{with_condition} AND duration_days > 0",
        ),
        "enrollment_by_year_phase": _rollup(
            "year phase",
            "trial_count avg_enrollment total_enrollment large_trials small_trials",
            where="year >= 2020 AND enrollment_count IS NOT NULL",
        ),
        "dash_metrics": headline,
        "metric_labels": f"SELECT coalesce(format('{{:,}}', COLUMNS(*)), 'N/A (no valid data)') FROM ({headline})",
        "dash_sponsors": _rollup(
            "sponsor_name", "trial_count avg_enrollment avg_duration", where="sponsor_key IS NOT NULL", top=20
        ),
        "dash_conditions": top_conditions,
        "dash_locations": top_places,
        "dash_temporal": f"SELECT * EXCLUDE (month_number) FROM ({_monthly('trial_count avg_enrollment', '2020')})",
        "readme_top_sponsors": _rollup("sponsor_name", "trial_count avg_enrollment", where=in_2023, top=10),
        "readme_conditions": _rollup(
            "condition_name", "trial_count avg_duration_days avg_enrollment", where=with_condition, top=20
        ),
        "readme_geo": _rollup("country state", "trial_count total_enrollment", where=with_place),
        "category_rollup": by_category(all_conditions),
        "country_rollup": by_country(all_places),
        "top_category_rollup": by_category(cut(all_conditions, "condition_name condition_category", 5)),
        "top_country_rollup": cut(by_country(cut(all_places, "country state", 8)), "country", 3),
        "top_dash_conditions": cut(
            _rollup("condition_name condition_category", "trial_count avg_enrollment avg_duration", where=with_condition),
            "condition_name condition_category",
            5,
        ),
        "top_dash_locations": cut(all_places, "country state", 6),
        "temporal_series": f"""SELECT * EXCLUDE (month_number), make_date(year, month_number, 1) AS date
            FROM ({_monthly('trial_count avg_enrollment', '2020')})""",
    }
    span = f"start_date_key BETWEEN {SPAN[0]} AND {SPAN[1]}"
    for report, name in (("dash_metrics", "metrics"), ("condition_category", "categories"), ("intervention_types", "interventions")):
        found[f"bitmap_{name}"] = found[report]
        found[f"span_{name}"] = found[report].replace("WHERE ", f"WHERE {span} AND ", 1)
    for report, name in (("category_rollup", "categories"), ("country_rollup", "countries"), ("temporal_series", "months"), ("duration_by_condition", "durations")):
        found[f"kept_{name}"] = found[report]
    found["kept_span_durations"] = found["duration_by_condition"].replace("WHERE ", f"WHERE {span} AND ", 1)
    lasting = "CASE WHEN duration_days > 0 THEN duration_days END"
    measures = {"enrollment_count": "enrollment_count", "duration_days": "duration_days", "lasting_days": lasting}
    listed = ", ".join(
        f"count({v}) AS {m}_n, CAST(sum({v}) AS BIGINT) AS {m}_sum, min({v}) AS {m}_min, max({v}) AS {m}_max" for m, v in measures.items()
    )
    found["kept_day_sums"] = f"SELECT location_key, start_date_key, count(*) AS n, {listed} FROM wide GROUP BY ALL"
    for name, old, new in (("common_conditions", 20, 4), ("geo_distribution", 20, 7), ("readme_conditions", 20, 3)):
        found[f"top_{name}"] = found[name].replace(f"LIMIT {old}", f"LIMIT {new}")
    return {name: _with(["wide"], query) for name, query in found.items()}


def _folder_statements() -> dict[str, str]:
    columns = ", ".join(
        f"({i}, {q(c)}, '{'int' if c == 'EnrollmentCount' else 'string'}')"
        for i, c in enumerate([*RAW_COLUMNS, "validation_status"])
    )
    counts = " UNION ALL ".join(
        f"SELECT '{JOB}' AS job_name, '{name}' AS step, count(*) AS row_count FROM {name}" for name in STEP_NAMES
    )
    found = {
        "table_exists": "SELECT count(*) AS row_count, true AS is_there, false AS other_is_there FROM raw_trials",
        "table_info": f"""SELECT CAST(p AS INTEGER) AS ordinal_position, c AS column_name, t AS data_type,
            'YES' AS is_nullable, (SELECT count(*) FROM raw_trials) AS row_count FROM (VALUES {columns}) v(p, c, t)""",
        "job_metrics": counts,
        "run_query": """SELECT Status AS status, sum(1)::BIGINT AS trial_count, max(EnrollmentCount) AS largest
            FROM raw_trials WHERE validation_status = 'valid' AND EnrollmentCount >= 501 GROUP BY ALL""",
    }
    needs = {"job_metrics": STEP_NAMES}
    return {name: _with(needs.get(name, ["raw_trials"]), query) for name, query in found.items()}


def _update_statements() -> dict[str, str]:
    shown = ", ".join([*RAW_COLUMNS, "validation_status"])
    kinds = ("sponsor", "location", "condition", "intervention")
    joins = " ".join(
        f"LEFT JOIN (SELECT member_id AS {d}_id, member_key AS {d}_key FROM kept_keys WHERE table_name = 'dim_{d}') USING ({d}_id)" for d in kinds
    )
    found = {
        "load_changes": (["between_loads"], "SELECT * FROM between_loads WHERE change <> 'same'"),
        "load_change_counts": (
            ["between_loads"],
            """SELECT change, count(nct_id) AS row_count FROM (VALUES ('inserted'), ('changed'), ('deleted'), ('same')) v(change)
            LEFT JOIN between_loads USING (change) GROUP BY change""",
        ),
        "changed_rows": (
            ["between_loads", "load_2"],
            f"SELECT {shown} FROM load_2 WHERE NCTId IN (SELECT nct_id FROM between_loads WHERE change IN ('inserted', 'changed'))",
        ),
        "followed_load": (["load_2"], f"SELECT {shown} FROM load_2"),
        "kept_keys": (["kept_keys"], "SELECT table_name, member_id, CAST(member_key AS BIGINT) AS member_key FROM kept_keys"),
        "second_fact": (
            ["second_trials", "kept_keys"],
            f"""SELECT {', '.join(FACT_COLUMNS)} FROM (SELECT *, enrollment_count AS actual_enrollment,
            {bit('enrollment_count > 0')} AS enrollment_target_met, {bit("status ILIKE '%completed%'")} AS is_completed,
            {bit("status ILIKE '%terminated%'")} AS is_terminated, {bit("status ILIKE '%recruiting%'")} AS is_recruiting,
            'ClinicalTrials.gov' AS source_system FROM second_trials {joins}
            JOIN (SELECT member_id AS nct_id, member_key AS trial_key FROM kept_keys WHERE table_name = 'fact_trials') USING (nct_id))""",
        ),
    }
    return {name: _with(needs, query) for name, (needs, query) in found.items()}


def statements() -> dict[str, str]:
    return {
        **_update_statements(),
        **_folder_statements(),
        **_raw_statements(),
        **_clean_statements(),
        **_page_statements(),
        **_table_statements(),
        **_report_statements(),
    }
