"""Tables, SQL access and inspection."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from trialmart.sources import storage


def test_load_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    storage.write_table(df, path, if_exists="fail")
    storage.write_table(df, path, if_exists="append")
    assert storage.read_table(spark, path).count() == 6
    storage.write_table(df, path)
    assert storage.read_table(spark, path, df.schema).count() == 3
    with pytest.raises(AnalysisException):
        storage.write_table(df, path, if_exists="fail")
    with pytest.raises(KeyError):
        storage.write_table(df, path, if_exists="other")


def test_run_query_with_parameters(spark):
    df = spark.range(10)
    found = storage.run_query(spark, "SELECT count(*) AS n FROM {numbers} WHERE id >= :low", {"numbers": df}, {"low": 7})
    assert found.first()["n"] == 3
    assert not storage.table_exists(spark, "numbers"), "no view is left behind"
    assert not storage.table_exists(spark, "no_such_table")


def test_table_info(spark):
    df = spark.range(4).selectExpr("id", "cast(id as string) AS label")
    found = storage.table_info(spark, df).orderBy("ordinal_position").collect()
    assert [(r["column_name"], r["data_type"], r["is_nullable"], r["row_count"]) for r in found] == [
        ("id", "bigint", "NO", 4),
        ("label", "string", "NO", 4),
    ]


def test_json_round_trip(spark, tmp_path):
    trials = spark.createDataFrame([("N1", 5), ("N2", None)], "NCTId string, EnrollmentCount int")
    storage.save_trials_json(trials, str(tmp_path / "saved"))
    back = storage.read_saved_trials(spark, str(tmp_path / "saved"))
    assert sorted((r["NCTId"], r["EnrollmentCount"]) for r in back.collect()) == [("N1", 5), ("N2", None)]


def test_nothing_published(spark, tmp_path):
    assert storage.published_run(spark, str(tmp_path)) is None
    (tmp_path / "published").mkdir()
    assert storage.published_run(spark, str(tmp_path)) is None


def test_old_runs_are_removed(spark, tmp_path):
    root = f"file://{tmp_path}"
    for day in (1, 2, 3):
        storage.write_table(spark.range(1), f"{root}/run-{day}")
        storage.publish_run(spark, root, f"run-{day}", dt.datetime(2024, 1, day))
    assert storage.remove_old_runs(spark, root, keep=2) == ["run-1"]
    assert storage.published_run(spark, root) == "run-3"
    assert not (tmp_path / "run-1").exists() and (tmp_path / "run-2").exists()
