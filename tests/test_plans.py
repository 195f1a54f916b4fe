"""What the physical plans look like."""

import pytest
from pyspark.sql import functions as F

from trialmart.operators import keys
from trialmart.plans import catalog
from trialmart.sources import search


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.catalogue()))
def test_no_python_and_no_product(spark, folder, name):
    text = plan(catalog.catalogue()[name](spark, folder))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_filters_and_columns_reach_the_scan(spark, folder):
    raw = catalog.raw_table(spark, folder)
    text = plan(search.valid_raw(raw).select("NCTId", "validation_status"))
    assert "EqualTo(validation_status,valid)" in text
    assert "ReadSchema: struct<NCTId:string,validation_status:string>" in text


def test_year_prunes_fact_partitions(spark, folder):
    text = plan(catalog.catalogue()["top_sponsors_year"](spark, folder))
    assert "(start_year" in text and "= 2023" in text.split("PartitionFilters:")[1].split("]")[0]
    monthly = plan(catalog.catalogue()["monthly_activity"](spark, folder))
    assert ">= 2023" in monthly.split("PartitionFilters:")[1].split("]")[0]


def test_single_row_functions_do_not_shuffle(spark, folder):
    for name in ("clean_trials", "parse_dates", "normalize_sponsor", "condition_keywords", "search_trials"):
        assert "Exchange" not in plan(catalog.catalogue()[name](spark, folder))


def test_reports_sum_before_they_join(spark, folder):
    text = plan(catalog.catalogue()["dash_sponsors"](spark, folder))
    join = max(text.find("HashJoin"), text.find("SortMergeJoin"))
    assert "partial_count" in text[join:], "the fact side is summed below the join"
    assert "TakeOrderedAndProject" in text


def test_repeats_are_cut_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("id % 3 AS k", "id AS v")
    text = plan(keys.first_by_key(df, "k"))
    partial = text.find("Partial")
    assert text.count("WindowGroupLimit") == 2 and text.find("Exchange") < partial


def test_hot_dimension_id_is_split(spark):
    """A shuffled left join on an id that holds most rows is split by adaptive execution."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 300000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("sponsor_id"),
            F.md5(F.col("id").cast("string")).alias("payload"),
        )
        dim = spark.range(0, 300000, 3, 4).select(
            F.col("id").cast("string").alias("sponsor_id"), (F.col("id") + 1).alias("sponsor_key")
        )
        joined = facts.join(dim, "sponsor_id", "left")
        joined.write.format("noop").mode("overwrite").save()
        assert joined.filter("sponsor_key is not null").count() == 100000
        executed = joined._jdf.queryExecution()
        executed.executedPlan().executeCollect()
        assert "skew=true" in executed.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
