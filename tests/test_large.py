"""What keeps the shared steps in proportion to the tables."""

import os

from pyspark.sql import functions as F

from trialmart.functions.text import has_text, strip_text
from trialmart.operators import bitmaps, clean, staging
from trialmart.plans import catalog
from trialmart.sources import order_trials


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _trials(spark, rows=3):
    columns = [F.lit(None).cast("int" if c == "EnrollmentCount" else "string").alias(c) for c in order_trials.RAW_COLUMNS if c != "NCTId"]
    return spark.range(rows).select(F.col("id").alias("order_key"), F.concat(F.lit("NCT"), "id").alias("NCTId"), *columns)


def test_pages_are_dealt_as_flat_rows(spark):
    pages = order_trials.numbered_pages(_trials(spark, 1100))
    above, below = _plan(pages).split("RepartitionByExpression")
    assert "StructsToJson" in above and "StructsToJson" not in below and "struct(" not in below
    assert {(r["page"], len(r["studies"])) for r in pages.collect()} == {(0, 500), (1, 500), (2, 100)}
    line = order_trials.study_pages(_trials(spark, 1)).first()["value"]
    assert line.startswith('{"studies":[{"protocolSection":{"identificationModule":{"nctId":"NCT0"}') and line.endswith("]}")


def test_landed_pages_are_packed(spark):
    for path in (catalog.landed_pages(spark, "/root/testdata/sf0.001"),):
        files = [f for f in os.listdir(path.removeprefix("file:")) if not f.startswith((".", "_"))]
        assert files and all(f.endswith(".gz") for f in files)


def test_has_text_is_what_strip_text_leaves(spark):
    odd = [None, "", " ", "\x1c\t  \n", " a ", " x", "{", "\x1f1\x1e"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select(has_text(F.col("t")).alias("a"), strip_text(F.col("t")).isNotNull().alias("b"))
    assert all(bool(r["a"]) == r["b"] for r in rows.collect())


def test_bitmaps_are_made_after_the_shuffle(spark, folder):
    text = _plan(bitmaps.day_bitmaps(catalog.star(spark, folder)))
    parts = text.split("RepartitionByExpression")
    assert len(parts) == 6 and "bitmap_construct_agg" not in parts[-1]
    for part in parts[1:]:
        assert "Distinct" in part or "Aggregate" in part.split("bitmap_construct_agg")[0]


def test_only_repeated_trials_are_sorted(spark, raw_rows):
    rows = [{"NCTId": f"N{i}", "BriefTitle": t} for i, t in ((1, "b"), (2, "x"), (1, "a"), (3, None), (1, None), (3, "z"))]
    raw = raw_rows(*rows, {"NCTId": None}, {"NCTId": "N9", "validation_status": "invalid"}, {"NCTId": ""})
    once = raw_rows(*rows[1:3], {"NCTId": None})
    for table in (raw, once):
        kept = staging.stage_trials(table, staging.trial_ids(table))
        assert kept.columns == staging.stage_trials(table).columns
        assert sorted(map(str, kept.collect())) == sorted(map(str, staging.stage_trials(table).collect()))
    assert "Window" not in _plan(kept) and "Join" not in _plan(kept)


def test_wide_projections_split_their_code(spark, raw_rows):
    key = "spark.sql.codegen.hugeMethodLimit"
    conf = spark.conf
    before = conf.get(key)
    try:
        for given, wanted in ((None, "8000"), ("9000", "9000")):
            conf.unset(key) if given is None else conf.set(key, given)
            clean.clean_trials(raw_rows({"NCTId": "N1"}))
            assert conf.get(key) == wanted
    finally:
        conf.set(key, before)


def test_deriving_trials_splits_its_code(spark, folder):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        order_trials.raw_trials(spark, folder)
        assert spark.conf.get(key) == "8000"
    finally:
        spark.conf.set(key, before)
