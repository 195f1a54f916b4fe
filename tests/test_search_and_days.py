"""Trigram search against the scan, and distinct counts from bitmaps."""

import random
from pathlib import Path

import pytest

from trialmart.operators import bitmaps, reports, text_index
from trialmart.plans import catalog
from trialmart.sources import search

WORDS = ["widget", "Gear", "bölt", "na", "x", "lung cancer", "ABC", "aaaa", "Ärzte", "𝒳yz", "a𝒳b"]


@pytest.fixture(scope="module")
def trials(spark):
    from trialmart.schemas import RAW, RAW_COLUMNS

    dice = random.Random(4)
    rows = []
    for i in range(300):
        text = lambda: " ".join(dice.choice(WORDS) for _ in range(dice.randint(0, 4))) if dice.random() < 0.9 else None
        row = {"NCTId": f"N{i % 290}" if i % 50 else None, "BriefTitle": text(), "OfficialTitle": text(), "Condition": text()}
        row |= {"LeadSponsorName": text(), "Phase": dice.choice(["PHASE2", "NA", "", None]), "Status": dice.choice(["Completed", "Recruiting"])}
        row |= {"StudyStartDate": f"20{dice.randint(18, 24)}-01-05", "validation_status": "valid"}
        rows.append(tuple(row.get(n) for n in [*RAW_COLUMNS, "validation_status"]))
    schema = ", ".join(f"{n} {RAW[n].dataType.simpleString()}" for n in [*RAW_COLUMNS, "validation_status"])
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def indexed(spark, trials, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    text_index.build_index(trials, path, block=16)
    return path


@pytest.mark.parametrize(
    "criteria",
    [
        {"search_terms": ["GEAR"]},
        {"search_terms": ["lung can", "bölt w"]},
        {"search_terms": ["widget"], "conditions": ["ärzte", "abc"], "status": ["complete"]},
        {"phases": ["na"]},
        {"phases": ["na", "phase2"], "sponsors": ["aaaa"]},
        {"search_terms": ["aaaaa"]},
        {"search_terms": ["aaaa aaaa"]},
        {"search_terms": ["𝒳yz", "a𝒳b"]},
        {"search_terms": ["yz widget"], "start_date": "2020-01-01", "limit": 5},
        {"search_terms": ["nowhere to be found"]},
        {"start_date": "2022-01-01"},
        {},
    ],
)
def test_index_finds_what_the_scan_finds(spark, trials, indexed, criteria):
    expected = search.search_trials(trials, **criteria)
    found = text_index.search_index(spark, indexed, **criteria)
    assert found.columns == trials.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) or "limit" in criteria and found.count() == expected.count()


def test_blocks_without_candidates_are_not_read(spark, trials, tmp_path):
    """All but the blocks of one rare word are made unreadable."""
    rare = trials.limit(1).withColumns({"NCTId": catalog.F.lit("M1"), "BriefTitle": catalog.F.lit("Quux trial")})
    text_index.build_index(trials.unionByName(rare), str(tmp_path), block=16)
    rows = text_index._rows(spark, str(tmp_path))
    block = rows.where("BriefTitle = 'Quux trial'").first()[text_index.BLOCK_COLUMN]
    files = list(Path(tmp_path).glob("rows/*/*.parquet"))
    kept = [f for f in files if f.parent.name == f"{text_index.BLOCK_COLUMN}={block}"]
    for file in set(files) - set(kept):
        file.write_bytes(b"not to be read")
    assert len(files) > 10 * len(kept)
    assert [r["NCTId"] for r in text_index.search_index(spark, str(tmp_path), search_terms=["QUUX"]).collect()] == ["M1"]


def test_posting_lists_are_bounded(spark, indexed):
    lists = spark.read.parquet(f"{indexed}/postings")
    assert lists.selectExpr("max(size(rows))").first()[0] <= 16
    assert lists.where("rows <> sort_array(array_distinct(rows))").count() == 0


def test_bitmaps_of_parts_merge(spark, folder):
    """Bitmaps and sums of two halves of the fact, put together, count as those of the whole; no row is expanded."""
    whole = catalog.star(spark, folder)
    halves = [type(whole)(**{**vars(whole), "fact": whole.fact.where(f"trial_key % 2 = {k}")}) for k in (0, 1)]
    bits = bitmaps.day_bitmaps(halves[0]).unionByName(bitmaps.day_bitmaps(halves[1]))
    sums = bitmaps.day_sums(halves[0]).unionByName(bitmaps.day_sums(halves[1]))
    found = bitmaps.dash_metrics(bits, sums)
    assert [round(float(x), 9) for x in found.first()] == [round(float(x), 9) for x in reports.dash_metrics(whole).first()]
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in reports.dash_metrics(whole)._jdf.queryExecution().executedPlan().toString()
    assert bitmaps.dash_metrics(bits, sums, 18000101, 18001231).first()[:4] == (0, 0, 0, 0)
    assert bitmaps.condition_category(bits, sums, 18000101, 18001231).count() == 0


def test_equal_texts_are_indexed_once(spark, raw_rows, tmp_path):
    """Trigrams list one row of each text of a block; rows of a text that comes again are one more list."""
    rows = raw_rows(*[{"NCTId": f"N{i:03}", "Phase": "PHASE2" if i % 2 else "phase2", "BriefTitle": f"title {i % 4}"} for i in range(200)], {"NCTId": "N900", "BriefTitle": "A\U0001d4b3 one"})
    text_index.build_index(rows.coalesce(1), str(tmp_path), block=1 << 20)
    lists = spark.read.parquet(f"{tmp_path}/postings")
    blocks = text_index._rows(spark, str(tmp_path)).select(text_index.BLOCK_COLUMN).distinct().count()
    assert lists.where("gram IS NOT NULL AND field = 'Phase'").selectExpr("sum(size(rows))").first()[0] == 4 * blocks
    assert lists.where("gram IS NULL AND field = 'Phase'").selectExpr("sum(size(rows))").first()[0] == 200
    assert text_index.search_index(spark, str(tmp_path), phases=["ase2"], search_terms=["TLE 3", "one"]).count() == 50
    assert [r["NCTId"] for r in text_index.search_index(spark, str(tmp_path), search_terms=["ONE"]).collect()] == ["N900"]


def test_rows_move_once_to_be_indexed(spark, trials, tmp_path):
    """The number of a row names its block, so blocks are written where the order put them."""
    text_index.build_index(trials, str(tmp_path), block=16)
    assert not (tmp_path / "placed").exists()
    rows = text_index._rows(spark, str(tmp_path))
    assert rows.groupBy(text_index.BLOCK_COLUMN, text_index.ROW).count().where("count > 1").count() == 0
    assert rows.count() == trials.count() and rows.where(f"{text_index.ROW} NOT BETWEEN 0 AND 15").count() == 0
