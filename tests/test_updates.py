"""Loads compared by hash trees, keys that stay, runs that failed."""

import datetime as dt
from collections import Counter
from pathlib import Path

import pytest

from trialmart.operators import differences, keys
from trialmart.plans import catalog, refresh
from trialmart.sources import storage
from trialmart.sources.storage import new_run_folder

SCHEMA = "id long, name string, size int, place string"


def stored(spark, rows, ranges):
    path = new_run_folder(spark, "load")
    differences.write_load(spark.createDataFrame(rows, SCHEMA), path, "id", ranges)
    return path


OLD = [(i, f"n{i}", i % 7, None) for i in range(500)]


def changed(rows):
    rows = [r for r in rows if r[0] != 17]
    rows = [(i, "other" if i == 40 else n, s, p) for i, n, s, p in rows]
    rows = [(i, None, s, n) if i == 41 else (i, n, s, p) for i, n, s, p in rows]  # a value that moves over a null
    return [*rows, (9000, None, None, None), (None, "no id", 1, None)]


def test_changes_equal_a_full_join(spark):
    old, new = stored(spark, OLD, 32), stored(spark, changed(OLD), 32)
    found = {r["id"]: r["change"] for r in differences.load_changes(spark, old, new).collect()}
    assert found == {17: "deleted", 40: "changed", 41: "changed", 9000: "inserted"}
    assert dict(differences.change_counts(spark, old, new).collect()) == {"inserted": 1, "changed": 2, "deleted": 1, "same": 497}
    rows = {tuple(r) for r in differences.changed_rows(spark, old, new, "id").collect()}
    assert rows == {(40, "other", 5, None), (41, None, 6, "n41"), (9000, None, None, None)}


def test_ranges_that_stayed_are_not_scanned(spark):
    """Four ids of 500 in 64 ranges: the leaves of at most four ranges are read."""
    old, new = stored(spark, OLD, 64), stored(spark, changed(OLD), 64)
    ranges = differences.changed_ranges(spark, old, new)
    assert 1 <= len(ranges) <= 4
    for path in (old, new):  # what must not be read is made unreadable
        for part in ("leaves", "rows"):
            for file in Path(path.removeprefix("file:")).glob(f"{part}/*/*.parquet"):
                if int(file.parent.name.split("=")[1]) not in ranges:
                    file.write_bytes(b"not to be read")
    found = {r["id"]: r["change"] for r in differences.load_changes(spark, old, new).collect()}
    assert found == {17: "deleted", 40: "changed", 41: "changed", 9000: "inserted"}
    assert differences.changed_rows(spark, old, new, "id").count() == 3


def test_equal_and_empty_loads(spark):
    old, again = stored(spark, OLD, 8), stored(spark, OLD[::-1], 8)
    assert differences.changed_ranges(spark, old, again) == [] and differences.load_changes(spark, old, again).count() == 0
    none = stored(spark, [], 8)
    assert dict(differences.change_counts(spark, none, old).collect()) == {"inserted": 500, "changed": 0, "deleted": 0, "same": 0}
    assert dict(differences.change_counts(spark, old, none).collect()) == {"inserted": 0, "changed": 0, "deleted": 500, "same": 0}
    assert differences.load_changes(spark, none, none).count() == 0
    with pytest.raises(ValueError, match="different numbers of ranges"):
        differences.changed_ranges(spark, old, stored(spark, OLD, 9))


@pytest.mark.parametrize("target", [changed(OLD), OLD[:3], []])
def test_a_table_follows_a_load(spark, target):
    old, new = stored(spark, OLD, 16), stored(spark, target, 16)
    path = new_run_folder(spark, "followed")
    storage.write_table(differences.read_load(spark, old), path, partition_by=(differences.RANGE,))
    ranges = differences.follow_load(spark, path, old, new)
    schema = differences.read_load(spark, old).schema
    got = Counter(tuple(r)[:4] for r in storage.read_table(spark, path, schema).collect())
    assert got == Counter(r for r in target if r[0] is not None)
    assert differences.follow_load(spark, path, new, new) == [] and len(ranges) <= 16


def test_ranges_grow_with_rows_up_to_a_bound():
    assert [differences.ranges_for(n) for n in (0, 1, 50_000, 50_001, 10**12)] == [1, 1, 1, 2, 1 << 16]


def test_extended_keys(spark, tmp_path):
    known = spark.createDataFrame([("b", 1), ("d", 2), ("x", 7)], "id string, number long")
    new = keys.place_in_order(spark.createDataFrame([("a",), ("z",), ("c",)], "id string").repartition(3), "id")
    storage.write_table(new, f"{tmp_path}/new")
    found = keys.extend_keys(known, storage.read_table(spark, f"{tmp_path}/new"), "id", "number")
    assert dict(found.collect()) == {"b": 1, "d": 2, "x": 7, "a": 8, "c": 9, "z": 10}


def keys_of(tables):
    return {
        (name, r[0]): r[1]
        for name, (_, member, key) in refresh.KEYED.items()
        for r in tables[name].select(member, key).collect()
    }


def test_keys_stay_over_runs(spark, raw_rows, tmp_path):
    """Members that are new, lost and back again: none of them changes its key, and facts name the same members."""
    root = f"file://{tmp_path}/warehouse"

    def trial(i, sponsor):
        return {"NCTId": f"N{i}", "LeadSponsorName": sponsor, "Condition": f"C{i % 3}", "LocationCountry": "France", "InterventionName": f"I{i}"}

    loads = [
        [trial(5, "M"), trial(6, "Z"), trial(7, "M")],
        [trial(1, "A"), trial(6, "Z"), trial(8, "N")],  # N5, N7 and sponsor M are lost, A and N are new
        [trial(1, "A"), trial(2, "B"), trial(5, "M"), trial(6, "Z")],  # M is back
    ]
    seen, members = {}, {}
    for day, rows in enumerate(loads):
        raw = raw_rows(*[{"validation_status": "valid", **r} for r in rows])
        tables = refresh.refresh_warehouse(spark, raw, root, dt.datetime(2024, 1, day + 1))
        now = keys_of(tables)
        assert len({(name, key) for (name, _), key in now.items()}) == len(now)
        assert all(seen.get(member, key) == key for member, key in now.items())
        seen |= now
        names = {r["sponsor_key"]: r["sponsor_id"] for r in tables["dim_sponsor"].collect()}
        members = {r["nct_id"]: names[r["sponsor_key"]] for r in tables["fact_trials"].collect()}
        assert members == {r["NCTId"]: f"SPONSOR_{r['LeadSponsorName'].lower()}" for r in rows}
    assert seen["dim_sponsor", "SPONSOR_m"] == 1 and seen["dim_sponsor", "SPONSOR_b"] == 5
    fresh = refresh.refresh_warehouse(spark, raw, root, dt.datetime(2024, 1, 9), keep_keys=False)
    assert keys_of(fresh)["dim_sponsor", "SPONSOR_b"] == 2


def test_folders_of_failed_runs_go(spark, tmp_path):
    root = f"file://{tmp_path}"
    for name in ("run-20240101", "run-20240102", "run-20240103", "run-20240104", "published-not", "raw"):
        storage.write_table(spark.range(1), f"{root}/{name}")
    for day in (1, 3):
        storage.publish_run(spark, root, f"run-2024010{day}", dt.datetime(2024, 1, day))
    assert storage.remove_old_runs(spark, root, keep=2) == ["run-20240102"]
    assert storage.list_folders(spark, root) == ["published", "published-not", "raw", "run-20240101", "run-20240103", "run-20240104"]
    assert storage.remove_old_runs(spark, root, keep=1) == ["run-20240101"]


def test_trees_alone_tell_what_changed(spark):
    """No rows are stored or shuffled for them; rows of the new load are enough to read what came."""
    paths = [new_run_folder(spark, "load") for _ in range(2)]
    for path, rows in zip(paths, (OLD, changed(OLD))):
        differences.write_tree(spark.createDataFrame(rows, SCHEMA), path, "id", 32)
    assert not list(Path(paths[0].removeprefix("file:")).glob("rows*"))
    assert dict(differences.change_counts(spark, *paths).collect()) == {"inserted": 1, "changed": 2, "deleted": 1, "same": 497}
    differences.write_rows(spark.createDataFrame(changed(OLD), SCHEMA), paths[1], "id", 32)
    found = differences.changed_rows(spark, *paths, "id")
    assert {r["id"] for r in found.collect()} == {40, 41, 9000}
    whole = stored(spark, changed(OLD), 32)
    roots = [sorted(map(tuple, spark.read.parquet(f"{p}/roots").collect())) for p in (paths[1], whole)]
    assert roots[0] == roots[1]


def test_wide_rows_are_not_sorted_to_find_changes(spark):
    old, new = stored(spark, OLD, 4), stored(spark, changed(OLD), 4)
    changes = storage.materialize(differences.load_changes(spark, old, new), "changes")
    plan = differences.changed_rows(spark, old, new, "id", changes)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort " not in plan


def test_loads_are_stored_as_far_as_they_are_read(spark, folder, monkeypatch):
    monkeypatch.setattr(catalog, "_built", {})
    paths = [Path(p.removeprefix("file:")) for p in catalog.two_loads(spark, folder)]
    kept = lambda: [(p / "rows").exists() for p in paths]
    assert kept() == [False, False] and all((p / "leaves").exists() for p in paths)
    assert catalog.two_loads(spark, folder, rows=(1,)) and kept() == [False, True]
    assert catalog.two_loads(spark, folder, rows=(0, 1)) and kept() == [True, True]
