"""Landed pages: reading, flattening, validating, saving."""

import datetime as dt
import json
import random

import pytest

from trialmart.schemas import RAW_COLUMNS
from trialmart.sources import page_chains, storage, study_pages


def study(nct_id, **modules):
    return {"protocolSection": {"identificationModule": {"nctId": nct_id}, **modules}}


@pytest.fixture
def pages(spark, tmp_path):
    first = {
        "studies": [
            study(
                "NCT1",
                descriptionModule={"briefSummary": "  Title\t", "officialTitle": "  "},
                sponsorCollaboratorsModule={"leadSponsor": {"name": "S", "class": "NIH"}},
                conditionsModule={"conditions": ["A", "B"]},
                armsInterventionsModule={"interventions": [{"name": "x", "type": "Drug"}, {"type": "Device"}]},
                designModule={"phases": [], "maskingInfo": {"masking": "NONE"}},
                enrollmentModule={"enrollmentCount": "1,200"},
                statusModule={"overallStatus": "Completed", "startDateStruct": {"date": "2023-01-15"}},
                contactsLocationsModule={"locations": [{"country": "France", "city": None}, {"country": "Spain"}]},
            ),
            study(" ", enrollmentModule={"enrollmentCount": 12.9}),
            study("", enrollmentModule={"enrollmentCount": "12.0"}),
        ],
        "nextPageToken": "t",
    }
    second = {"studies": [study(None), study("NCT2", enrollmentModule={"enrollmentCount": -3})]}
    for i, page in enumerate([first, second, {"studies": []}]):
        (tmp_path / f"page{i}.json").write_text(json.dumps(page, indent=2))
    return str(tmp_path / "*.json")


def by_id(df):
    return {row["NCTId"]: row for row in df.collect()}


def test_flatten(spark, pages):
    flat = study_pages.flatten_studies(study_pages.read_study_pages(spark, pages))
    assert flat.columns == [*RAW_COLUMNS, *study_pages.REJECT_COLUMNS]
    rows = by_id(flat)
    assert flat.count() == 5
    one = rows["NCT1"]
    assert one["Condition"] == "A; B"
    assert one["InterventionName"] == "x; "
    assert one["InterventionType"] == "Drug; Device"
    assert one["Phase"] == ""
    assert one["LocationCountry"] == "France; Spain"
    assert one["LocationCity"] == "; "
    assert one["OutcomeMeasureDescription"] == ""
    assert one["StudyStartDate"] == "2023-01-15"
    assert one["PrimaryCompletionDate"] is None
    assert one["EnrollmentCount"] == 1200
    assert rows[" "]["EnrollmentCount"] == 12
    assert rows[""]["EnrollmentCount"] is None
    assert rows["NCT2"]["EnrollmentCount"] == -3


def test_validate(spark, pages):
    flat = study_pages.flatten_studies(study_pages.read_study_pages(spark, pages))
    rows = by_id(study_pages.validate_trials(flat))
    assert set(rows) == {"NCT1", None, "NCT2"}
    assert rows["NCT1"]["BriefTitle"] == "Title"
    assert rows["NCT1"]["OfficialTitle"] is None
    assert rows["NCT1"]["Phase"] is None
    assert study_pages.invalid_trials(flat).count() == 2
    assert study_pages.validation_summary(flat).first() == (5, 3, 2, 0, 60.0)
    assert study_pages.validation_summary(flat.limit(0)).first() == (0, 0, 0, 0, 0.0)


def test_negative_numbers_become_null(spark):
    df = spark.createDataFrame([("N", -1, 2.5, -3)], "NCTId string, a int, b double, EnrollmentCount int")
    assert study_pages.validate_trials(df).first() == ("N", None, 2.5, -3)


def test_extraction_is_saved(spark, pages, tmp_path):
    run_ts = dt.datetime(2024, 5, 6, 7, 8, 9)
    flat = study_pages.flatten_studies(study_pages.read_study_pages(spark, pages))
    valid = study_pages.validate_trials(flat)
    out = str(tmp_path / "out")
    storage.write_extraction(flat, out, {"phases": ["PHASE1"], "limit": None}, run_ts)
    saved = storage.read_saved_trials(spark, f"{out}/trials")
    assert sorted(map(str, saved.collect())) == sorted(map(str, valid.collect()))
    envelope = spark.read.json(f"{out}/envelope").first()
    assert envelope["metadata"]["total_trials"] == 3
    assert envelope["metadata"]["search_criteria"]["phases"] == ["PHASE1"]
    assert envelope["validation_summary"]["invalid_trials"] == 2
    marked = study_pages.add_extraction_metadata(valid, run_ts)
    assert marked.columns[-3:] == ["extraction_date", "data_source", "validation_status"]
    assert marked.select("validation_status").distinct().first()[0] == "valid"


def test_one_bad_study_costs_one_study(spark, tmp_path):
    good = study("NCT9", statusModule={"overallStatus": 5}, conditionsModule={"conditions": ["A", None, 7]})
    page = {"studies": ["bad", good, None, study("NCT8", statusModule="gone", designModule={"phases": "one"}), [1]]}
    lines = [json.dumps(page), '{"error": "quota"}', '{"studies": 3}', '{"studies": []}', "", '[{"studies": []}, {"studies": [{}]}]', '{"studies": [']
    (tmp_path / "pages.json").write_text("\n".join(lines))
    studies = study_pages.read_study_pages(spark, str(tmp_path / "pages.json"), one_page_per_file=False)
    flat = study_pages.flatten_studies(studies)
    rows = by_id(study_pages.validate_trials(flat))
    assert set(rows) == {"NCT9", "NCT8"}
    assert (rows["NCT9"]["Status"], rows["NCT9"]["Condition"]) == ("5", "A; ; 7")
    assert rows["NCT8"]["Status"] is None and rows["NCT8"]["Phase"] is None
    assert dict(study_pages.fault_counts(studies).collect()) == {"page is no JSON": 1, "page without studies": 2, "study is no object": 3}
    assert dict(study_pages.lost_values(studies).collect()) == {
        "Phase": 1, "Status": 1, "StudyStartDate": 1, "PrimaryCompletionDate": 1, "StudyCompletionDate": 1
    }
    assert study_pages.validation_summary(flat).first() == (9, 2, 7, 6, 200 / 9)
    assert {r[1] for r in study_pages.unreadable_pages(flat).collect()} == {'"bad"', "null", "[1]", '{"error": "quota"}', '{"studies": 3}', '{"studies": ['}


def test_long_chain_takes_few_rounds(spark, tmp_path, monkeypatch):
    """10,000 pages of one chain in any order, and one lost, one empty and one repeated in a second chain of as many."""
    lines = []
    for chain in "ab":
        for k in range(10_000):
            page = {"studies": [] if (chain, k) == ("b", 4000) else [study(f"{chain}{k}")], "nextPageToken": f"{chain}{k + 1}"}
            page |= {"pageToken": f"{chain}{k}"} if k else {}
            if k == 9_999:
                del page["nextPageToken"]
            if (chain, k) != ("b", 7000):
                lines += [json.dumps(page)] * (2 if (chain, k) == ("b", 2000) else 1)
    random.Random(1).shuffle(lines)
    (tmp_path / "pages.json").write_text("\n".join(lines))
    made = []
    real = page_chains.materialize
    monkeypatch.setattr(page_chains, "materialize", lambda df, label: made.append(label) or real(df, label))
    chains = page_chains.page_chains(study_pages.read_pages(spark, str(tmp_path / "pages.json"), one_page_per_file=False)).cache()
    assert made.count("page-pointers") <= 16
    found = {r["state"]: tuple(r)[1:] for r in page_chains.chain_summary(chains).collect()}
    assert found == {
        page_chains.READ: (14_000, 14_000, 0),
        page_chains.EMPTY: (1, 0, 0),
        page_chains.AFTER_EMPTY: (2_999, 2_999, 1),
        page_chains.AFTER_GAP: (2_999, 2_999, 0),
        page_chains.COPY: (1, 1, 0),
    }
    steps = {(r["page_token"], r["step"]) for r in chains.where("chain = 'first before a1'").collect()}
    assert steps == {(f"a{k}" if k else None, k) for k in range(10_000)}
    chains.unpersist()


def test_no_pages(spark, tmp_path):
    (tmp_path / "pages.json").write_text("")
    pages = study_pages.read_pages(spark, str(tmp_path / "pages.json"), one_page_per_file=False)
    assert page_chains.page_chains(pages).count() == 0 and study_pages.studies_of(pages).count() == 0
