"""Staging, keys, warehouse refresh and quality on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trialmart.operators import clean, keys, quality, reports, staging
from trialmart.plans import refresh
from trialmart.sources import search, storage

RUN_TS = dt.datetime(2024, 1, 2, 3, 4, 5)


def trial(nct_id, **fields):
    base = {
        "BriefTitle": "T",
        "LeadSponsorName": "Acme Inc",
        "LeadSponsorClass": "INDUSTRY",
        "Condition": "Asthma",
        "InterventionName": "x",
        "InterventionType": "Drug",
        "LocationCountry": "France",
        "LocationCity": "Paris",
        "LocationFacility": "Site 1",
        "Status": "Completed",
        "Phase": "PHASE1",
        "EnrollmentCount": 10,
        "StudyStartDate": "2023-01-01",
        "StudyCompletionDate": "2023-01-31",
    }
    return {"NCTId": nct_id, **base, **fields}


ROWS = [
    trial("N3"),
    trial("N1", LeadSponsorName="ACME inc", LeadSponsorClass="NIH"),
    trial("N2", LeadSponsorName="Duke University", LeadSponsorClass=None, Condition="", InterventionName=" "),
    trial("N2", BriefTitle=None, Condition="", LeadSponsorName="Duke University", LeadSponsorClass=None),
    trial("N4", LeadSponsorName=None, Condition=None, InterventionName=None, BriefTitle=None),
    trial("N5", LocationCountry=None, LocationCity=None, EnrollmentCount=0, Phase="", Status=None),
    trial("N6", LocationCountry="", LocationCity="Rome", LocationFacility="Site 0", Condition="Heart; Lung"),
    trial("N7", LocationFacility="Site 0", StudyStartDate="2023-02-30", StudyCompletionDate="01/15/2022"),
    trial("N8", validation_status="invalid", LeadSponsorName="Nobody"),
    trial(None, LeadSponsorName="Keyless", Condition="Lung"),
]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    from trialmart.schemas import RAW, RAW_COLUMNS

    names = [*RAW_COLUMNS, "validation_status"]
    schema = ", ".join(f"{n} {RAW[n].dataType.simpleString()}" for n in names)
    filled = [tuple({"validation_status": "valid", **row}.get(n) for n in names) for row in ROWS]
    root = str(tmp_path_factory.mktemp("warehouse"))
    storage.write_table(spark.createDataFrame(filled, schema), f"{root}/raw")
    raw = storage.read_table(spark, f"{root}/raw")
    return root, raw, refresh.refresh_warehouse(spark, raw, root, RUN_TS)


def rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_stage_sponsors_keeps_one_row_per_id(built):
    found = rows(staging.stage_sponsors(built[1]), "sponsor_id")
    assert set(found) == {"SPONSOR_acme_inc", "SPONSOR_duke_university", "SPONSOR_keyless"}
    acme = found["SPONSOR_acme_inc"]
    assert (acme["sponsor_name"], acme["sponsor_class"], acme["sponsor_type"]) == ("ACME inc", "NIH", "Government")
    duke = found["SPONSOR_duke_university"]
    assert (duke["sponsor_class"], duke["sponsor_type"], duke["country"]) == ("Unknown", "Other", "United Kingdom")


def test_stage_locations(built):
    found = rows(staging.stage_locations(built[1]), "location_id")
    assert set(found) == {"LOC_france__paris", "LOC___rome"}
    assert found["LOC_france__paris"]["facility_name"] == "Site 0"
    assert (found["LOC___rome"]["country"], found["LOC___rome"]["state"]) == ("", None)


def test_unknown_members_are_one_row(built):
    conditions = rows(staging.stage_conditions(built[1]), "condition_id")
    assert set(conditions) == {"COND_UNKNOWN_1", "COND_asthma", "COND_heart;lung", "COND_lung"}
    assert conditions["COND_UNKNOWN_1"]["condition_name"] == "Unknown Condition"
    interventions = rows(staging.stage_interventions(built[1]), "intervention_id")
    assert set(interventions) == {"INT_UNKNOWN_1", "INT_x"}


def test_stage_trials(built):
    found = rows(staging.stage_trials(built[1]), "nct_id")
    assert set(found) == {"N1", "N2", "N3", "N4", "N5", "N6", "N7"}
    assert found["N2"]["condition_id"] == "COND_"
    assert found["N2"]["intervention_id"] == "INT_"
    assert found["N4"]["data_completeness_score"] == 0.0
    assert found["N4"]["sponsor_id"] == "SPONSOR_UNKNOWN"
    assert found["N5"]["location_id"] == "LOC_UNKNOWN"
    assert (found["N5"]["enrollment_count"], found["N5"]["phase"], found["N5"]["status"]) == (None, "Unknown", "Unknown")
    assert (found["N3"]["start_date_key"], found["N3"]["duration_days"]) == (20230101, 30)
    assert (found["N7"]["start_date_key"], found["N7"]["completion_date_key"]) == (None, 20220115)
    assert found["N7"]["duration_days"] is None
    assert staging.repeated_trials(staging.trial_ids(built[1])).collect() == [("N2", 2)]


def test_fact_and_dimension_invariants(built):
    tables = built[2]
    fact = rows(tables["fact_trials"], "nct_id")
    assert [fact[f"N{i}"]["trial_key"] for i in range(1, 8)] == [1, 2, 3, 4, 5, 6, 7]
    assert fact["N2"]["condition_key"] is None and fact["N2"]["intervention_key"] is None
    assert fact["N4"]["sponsor_key"] is None and fact["N5"]["location_key"] is None
    assert fact["N1"]["sponsor_key"] == fact["N3"]["sponsor_key"] is not None
    assert fact["N5"]["enrollment_target_met"] == 0 and fact["N3"]["enrollment_target_met"] == 1
    assert fact["N3"]["start_year"] == 2023 and fact["N7"]["start_year"] is None
    assert fact["N3"]["etl_batch_id"] == RUN_TS and fact["N3"]["created_date"] == RUN_TS
    for name in ("sponsor", "location", "condition", "intervention"):
        dim = tables[f"dim_{name}"]
        numbered = [r[0] for r in dim.orderBy(f"{name}_id").select(f"{name}_key").collect()]
        assert numbered == list(range(1, len(numbered) + 1))
        assert dim.select(f"{name}_id").distinct().count() == len(numbered)
    days = tables["dim_dates"]
    assert days.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first() == (20220115, 20230131, 382)


def test_integrity_and_reports(built):
    star = refresh.star_of(built[2])
    found = rows(quality.referential_integrity(star), "fact_column")
    assert (found["sponsor_key"]["null_keys"], found["sponsor_key"]["orphan_keys"]) == (1, 0)
    assert found["start_date_key"]["null_keys"] == 1
    top = reports.top_sponsors_year(star).collect()
    assert [(r["sponsor_name"], r["trial_count"]) for r in top] == [("ACME inc", 4), ("Duke University", 1)]
    performance = reports.sponsor_performance(star).collect()
    assert [(r["sponsor_name"], r["total_trials"], r["completion_rate"]) for r in performance] == [("ACME inc", 5, 80.0)]


def test_published_run_is_swapped_whole(spark, built):
    root, raw, _ = built
    before = refresh.open_warehouse(spark, root)["fact_trials"].count()
    later = RUN_TS + dt.timedelta(days=1)
    refresh.refresh_warehouse(spark, raw.filter("NCTId = 'N1'"), root, later)
    assert before == 7
    assert refresh.open_warehouse(spark, root)["fact_trials"].count() == 1
    log = storage.read_table(spark, f"{root}/job_runs")
    assert log.count() == 2 * len(refresh.STEP_NAMES)
    assert {r[0] for r in log.filter("step = 'fact_trials'").select("row_count").collect()} == {7, 1}


def test_empty_raw_gives_empty_tables(spark, built, tmp_path):
    root = str(tmp_path)
    tables = refresh.refresh_warehouse(spark, built[1].limit(0), root, RUN_TS)
    assert all(df.count() == 0 for name, df in tables.items())
    star = refresh.star_of(tables)
    metrics = reports.dash_metrics(star).first()
    assert metrics["total_trials"] == 0 and metrics["avg_enrollment"] is None
    assert [r["total_trials"] for r in reports.quality_assessment(star).collect()] == [0, 0]
    assert reports.dash_temporal(star).count() == 0
    assert clean.clean_trials(search.valid_raw(built[1].limit(0))).count() == 0
    report = quality.quality_report(built[1].limit(0), ["NCTId"]).first()
    assert tuple(report) == (0, 0, 0.0, 0.0, 0.0)
    assert quality.missing_values(built[1].limit(0)).count() == 0


def test_numbering_is_dense_over_many_partitions(spark, tmp_path):
    ids = spark.range(0, 50000, 1, 6).select(F.md5(F.col("id").cast("string")).alias("k"))
    storage.write_table(keys.place_in_order(ids, "k"), str(tmp_path / "placed"))
    placed = storage.read_table(spark, str(tmp_path / "placed"))
    parts = placed.select(F.shiftright(keys.POSITION, 33)).distinct().count()
    numbered = [tuple(r) for r in keys.number_rows(placed, "n").orderBy("k").collect()]
    assert parts > 1
    assert [n for n, _ in numbered] == list(range(1, 50001))


def test_repeats_of_one_hot_key(spark):
    hot = spark.range(0, 3000, 1, 6).select(F.lit("hot").alias("k"), (F.col("id") % 500 + 7).alias("v"))
    rest = spark.range(0, 6000, 1, 6).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("bigint").alias("v"))
    both = hot.unionByName(rest)
    repeated = keys.repeated_keys(both, "k")
    assert repeated.collect() == [("hot", 3000)]
    kept = keys.first_by_key(both, "k")
    assert kept.count() == 6001
    assert kept.filter("k = 'hot'").collect() == [("hot", 7)]


def test_quality_report_formula(spark):
    full = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "col1 string, col2 int, col3 string")
    assert tuple(quality.quality_report(full, ["col1", "col2"]).first()) == (3, 0, 0.0, 100.0, 100.0)
    gaps = spark.createDataFrame([("a", 1, "x"), (None, None, "y"), ("c", 3, "z")], full.schema)
    assert tuple(quality.quality_report(gaps, ["col1", "col2"]).first()) == (3, 0, 0.0, 66.67, 66.67)
    assert quality.quality_report(gaps, ["other"]).first()["completeness"] == 100.0
    copies = gaps.unionByName(gaps).unionByName(full.limit(1))
    report = quality.quality_report(copies, ["col3"]).first()
    assert (report["total_rows"], report["duplicate_rows"], report["quality_score"]) == (7, 4, 0.0)
    missing = rows(quality.missing_values(gaps), "column_name")
    assert (missing["col1"]["missing_count"], missing["col1"]["missing_percentage"]) == (1, 33.33)


def test_quality_report_tells_nulls_in_other_columns_apart(spark):
    places = [("US", "New York", None), ("US", None, "New York"), (None, "US", "New York"), ("US", "New York", None)]
    df = spark.createDataFrame(places, "country string, state string, city string")
    report = quality.quality_report(df, ["country"]).first()
    assert (report["total_rows"], report["duplicate_rows"], report["duplicate_percentage"]) == (4, 1, 25.0)
    lists = [(["a", None], ["b"]), ([None, "a"], ["b"]), (["a"], [None, "b"]), (["a", "b"], []), (["a"], ["b"]), (["a"], None)]
    nested = spark.createDataFrame(lists, "x array<string>, y array<string>")
    assert quality.quality_report(nested, ["x"]).first()["duplicate_rows"] == 0
    inner = spark.createDataFrame([(("a", None),), ((None, "a"),), (None,), ((None, None),)], "x struct<p: string, q: string>")
    assert quality.quality_report(inner, ["x"]).first()["duplicate_rows"] == 0


def test_conform_columns_takes_the_first_name(spark):
    df = spark.createDataFrame(
        [("C1", "c2", "o", "Paris, FR, France", "1,200", "kept")],
        "Status string, overall_status string, study_phase string, location string, enrollment string, extra string",
    )
    row = clean.conform_columns(df).first().asDict()
    assert (row["status"], row["phase"], row["enrollment_count"]) == ("C1", "o", 1200)
    assert (row["location_city"], row["location_state"], row["location_country"]) == ("Paris", "FR", "France")
    assert row["extra"] == "kept" and row["condition"] is None


def test_clean_scores(built):
    found = rows(clean.clean_trials(search.valid_raw(built[1]), RUN_TS), "nct_id")
    full = found["N3"]
    assert full["data_completeness_score"] == pytest.approx(1.0)
    assert full["data_quality_score"] == pytest.approx(1.0)
    assert full["transformation_date"] == RUN_TS and full["data_version"] == "1.0"
    assert full["lead_sponsor_name"] == "Acme Inc." and full["enrollment_category"] == "Small (≤50)"
    poor = found["N5"]
    assert poor["data_completeness_score"] == pytest.approx(0.7 + 0.3 * 2 / 4)
    assert poor["data_quality_score"] == pytest.approx(0.6 * 0.85 + 0.4 * (1.0 + 0.5 + 0.5) / 3)
    assert found["N4"]["sponsor_id"] == "SPONSOR_UNKNOWN" and found["N4"]["condition_id"] == "COND_UNKNOWN"


def test_search(built):
    raw = built[1]
    assert {r[0] for r in search.search_trials(raw, sponsors=["duke"]).select("NCTId").collect()} == {"N2"}
    assert search.search_trials(raw, phases=["phase1"], status=["COMPLETED"], start_date="2023-01-02").count() == 0
    assert search.search_trials(raw, end_date="2022-12-31").count() == 1
    assert search.search_trials(raw, search_terms=["heart", "100%"]).count() == 1
    assert search.limit_trials(raw, 0).count() == search.limit_trials(raw, None).count() == len(ROWS)
    assert search.search_trials(raw, limit=2).count() == 2
    assert search.recent_trials(raw, dt.date(2023, 1, 31)).count() == 9
    assert search.recent_trials(raw, dt.date(2023, 2, 1)).count() == 0
    assert search.trial_details(raw, "none").count() == 0
    assert search.trial_details(raw, "N2").count() == 1
