"""Row order of the ordered reports, limits that cut, and the plans of heavy steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trialmart.operators import keys, quality, staging, warehouse
from trialmart.plans import catalog, refresh
from trialmart.sources import storage, study_pages

# Report -> its order; a minus means falling.
ORDERS = {
    "top_sponsors_year": "-trial_count sponsor_name",
    "common_conditions": "-trial_count condition_name condition_category",
    "top_common_conditions": "-trial_count condition_name condition_category",
    "geo_distribution": "-trial_count country state",
    "top_geo_distribution": "-trial_count country state",
    "status_by_phase": "phase -trial_count status",
    "sponsor_performance": "-total_trials sponsor_name sponsor_type",
    "condition_category": "-trial_count condition_category",
    "intervention_types": "-trial_count intervention_type",
    "duration_by_condition": "-avg_duration condition_category",
    "enrollment_by_year_phase": "-year -trial_count phase",
    "dash_sponsors": "-trial_count sponsor_name",
    "dash_conditions": "-trial_count condition_name condition_category",
    "top_dash_conditions": "-trial_count condition_name condition_category",
    "dash_locations": "-trial_count country state",
    "top_dash_locations": "-trial_count country state",
    "readme_top_sponsors": "-trial_count sponsor_name",
    "readme_conditions": "-trial_count condition_name",
    "top_readme_conditions": "-trial_count condition_name",
    "readme_geo": "-trial_count country state",
    "country_rollup": "-trial_count country",
    "top_country_rollup": "-trial_count country",
    "temporal_series": "date",
}


def place(row, order):
    found = []
    for key in order.split():
        value = row[key.lstrip("-")]
        if key[0] == "-":
            found.append(-value if value is not None else float("inf"))  # a null comes last
        elif isinstance(value, dt.date):
            found.append(value)
        else:
            found.append((value is not None, value if value is not None else ""))
    return found


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_reports_come_in_order(spark, folder, name):
    rows = catalog.catalogue()[name](spark, folder).collect()
    assert len(rows) > 1
    assert [place(r, ORDERS[name]) for r in rows] == sorted(place(r, ORDERS[name]) for r in rows)


def test_limits_cut_and_totals_do_not(spark, folder):
    run = {n: q(spark, folder) for n, q in catalog.catalogue().items() if "rollup" in n or "dash_" in n}
    for name in ("top_dash_conditions", "top_dash_locations"):
        assert run[name].count() < run[name.removeprefix("top_")].count()
    for name in ("category_rollup", "country_rollup"):
        cut, whole = (run[n].agg(F.sum("trial_count")).first()[0] for n in (f"top_{name}", name))
        assert cut < whole


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trials_are_cut_on_the_map_side_and_move_once(spark, folder):
    text = plan(staging.stage_trials(catalog.raw_table(spark, folder)))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_quality_report_is_one_pass(spark, folder):
    text = plan(quality.quality_report(catalog.raw_table(spark, folder), ["NCTId"]))
    assert text.count("FileScan") == 1 and "CollectMetrics" not in text


def test_integrity_reads_the_fact_once(spark, folder):
    text = plan(quality.referential_integrity(catalog.star(spark, folder)))
    assert text.count("FileScan") == 1 + 6, "the fact, and one dimension for each key"


def test_fact_files_do_not_grow_with_tasks(spark, tmp_path):
    days = [f"{y}-05-0{d}" for y in ("0001", "2021", "2022", "9999") for d in (1, 2, 3)]
    rows = spark.createDataFrame([(d,) for d in days * 20], "day string").repartition(8)
    fact = rows.select("day", F.year(F.col("day").cast("date")).alias(warehouse.FACT_PARTITION))
    path = str(tmp_path / "fact")
    storage.write_table(fact.hint("rebalance", warehouse.FACT_PARTITION), path, partition_by=(warehouse.FACT_PARTITION,))
    files = list((tmp_path / "fact").glob("*/part-*.parquet"))
    assert len(files) == 4
    assert storage.read_table(spark, path).filter(F.col(warehouse.FACT_PARTITION).isin(1, 9999)).count() == 120


def test_a_failed_refresh_logs_what_it_finished(spark, folder, tmp_path, monkeypatch):
    raw = catalog.raw_table(spark, folder)

    def broken(tables):
        raise ValueError("no such step")

    monkeypatch.setattr(refresh, "WAVES", [refresh.WAVES[0][:1], [("dim_sponsor", broken)]])
    with pytest.raises(ValueError, match="no such step"):
        refresh.refresh_warehouse(spark, raw, str(tmp_path), catalog.RUN_TS)
    log = storage.read_table(spark, f"{tmp_path}/job_runs").collect()
    assert [r["step"] for r in log] == ["stg_sponsors"]
    assert storage.published_run(spark, str(tmp_path)) is None


def test_two_refreshes_with_one_time_do_not_meet(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(refresh, "WAVES", [refresh.WAVES[0][:1]])
    for _ in range(2):
        refresh.refresh_warehouse(spark, catalog.raw_table(spark, folder), str(tmp_path), catalog.RUN_TS)
    assert len(list(tmp_path.glob("run-*"))) == 2


def test_truncated_page_is_a_counted_reject(spark, tmp_path):
    whole = '{"studies": [{"protocolSection": {"identificationModule": {"nctId": "N1"}}}]}'
    (tmp_path / "a.json").write_text(whole)
    (tmp_path / "b.json").write_text(whole[:40])
    flat = study_pages.flatten_studies(study_pages.read_study_pages(spark, f"{tmp_path}/*.json"))
    assert tuple(study_pages.validation_summary(flat).first()) == (2, 1, 1, 1, 50.0)
    lost = study_pages.invalid_trials(flat).first()
    assert lost["unreadable"] == whole[:40] and lost["source_file"].endswith("b.json") and lost["NCTId"] is None
    assert study_pages.validate_trials(flat).count() == 1


def test_hot_id_of_trials(spark):
    hot = spark.range(0, 2000, 1, 4).select(F.lit("hot").alias("k"), (5000 - F.col("id")).alias("v"))
    assert keys.first_by_key(hot, "k").collect() == [("hot", 3001)]


def test_details_of_a_repeated_id(spark, raw_rows):
    """The row that sorts first, however the rows are dealt."""
    from trialmart.sources import search

    rows = [{"NCTId": "N1", "BriefTitle": t, "Phase": p} for t, p in (("b", "x"), ("a", "y"), ("a", "x"), ("c", None))]
    for n in (1, 3):
        found = search.trial_details(raw_rows(*rows, {"NCTId": "N2"}).repartition(n), "N1").collect()
        assert [(r["BriefTitle"], r["Phase"]) for r in found] == [("a", "x")]
    assert search.trial_details(raw_rows(*rows), "N3").count() == 0
