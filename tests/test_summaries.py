"""Summaries that follow loads, against fresh builds."""

import random
from pathlib import Path

import pytest

from trialmart.operators import differences, summaries
from trialmart.sources import storage
from trialmart.sources.storage import new_run_folder

SCHEMA = "id long, place string, day int, size int"
KEYS, MEASURES = ("place", "day"), ("size",)


def stored(spark, rows, ranges=16):
    path = new_run_folder(spark, "load")
    differences.write_load(spark.createDataFrame(rows, SCHEMA), path, "id", ranges)
    return path


def built(spark, path):
    return storage.materialize(summaries.summarise(differences.read_load(spark, path), KEYS, MEASURES), "summary")


def rows_of(df):
    return sorted(map(tuple, df.select(*KEYS, "n", "size_n", "size_sum", "size_min", "size_max").collect()), key=repr)


def expected(rows):
    groups = {}
    for _, place, day, size in rows:
        groups.setdefault((place, day), []).append(size)
    out = []
    for key, sizes in groups.items():
        real = [s for s in sizes if s is not None]
        out.append((*key, len(sizes), len(real), sum(real) if real else None, min(real, default=None), max(real, default=None)))
    return sorted(out, key=repr)


def random_rows(seed, ids):
    draw = random.Random(seed)
    return [(i, draw.choice(["a", "b", None]), draw.choice([1, 2, None]), draw.choice([None, -1, 0, 0, 3, 9])) for i in ids]


def followed(spark, first, second):
    old, new = stored(spark, first), stored(spark, second)
    moved = storage.materialize(summaries.moved_rows(spark, old, new, "id"), "moved")
    return summaries.follow_load(spark, built(spark, old), moved, differences.read_load(spark, new), KEYS, MEASURES)


@pytest.mark.parametrize("seed", range(4))
def test_a_summary_that_followed_equals_a_fresh_one(spark, seed):
    """Rows appended, deleted and changed, with null keys and measures."""
    first = random_rows(seed, range(60))
    second = [*first[20:45], *random_rows(seed + 100, [*range(45, 50), *range(70, 90)])]
    assert rows_of(followed(spark, first, second)) == expected(second)


@pytest.mark.parametrize("first, second", [([], []), ([], random_rows(1, range(9))), (random_rows(1, range(9)), []), (random_rows(2, range(9)),) * 2])
def test_empty_and_equal_loads(spark, first, second):
    assert rows_of(followed(spark, first, second)) == expected(second)


def test_extremes_are_repaired_only_where_their_row_went(spark):
    first = [(1, "a", 1, 5), (2, "a", 1, 7), (3, "a", 1, 9), (4, "b", 1, 5), (5, "b", 1, 6), (6, "c", 1, 4), (7, "d", 1, 2), (8, "d", 1, None)]
    second = [(2, "a", 1, 7), (3, "a", 1, 9), (5, "b", 1, 6), (9, "b", 1, 5), (10, "c", 1, 4), (8, "d", 1, None)]
    old, new = stored(spark, first), stored(spark, second)
    moved = summaries.moved_rows(spark, old, new, "id")
    found = summaries.merged(built(spark, old), moved, KEYS, MEASURES)
    # b got another 5, c another 4, and d has no size left
    assert {r["place"] for r in found.where("_lost").collect()} == {"a"}
    assert rows_of(followed(spark, first, second)) == expected(second)


def test_unchanged_ranges_and_loads_without_lost_extremes_are_not_read(spark):
    first = [(i, "a", 1, i) for i in range(200)]
    second = [r for r in first if r[0] != 77]
    old, new = stored(spark, first, 64), stored(spark, second, 64)
    summary = built(spark, old)
    differing = differences.changed_ranges(spark, old, new)
    assert len(differing) == 1
    for path in (old, new):
        for file in Path(path.removeprefix("file:")).glob("rows/*/*.parquet"):
            if int(file.parent.name.split("=")[1]) not in differing:
                file.write_bytes(b"not to be read")
    moved = summaries.moved_rows(spark, old, new, "id")
    got = summaries.follow_load(spark, summary, moved, differences.read_load(spark, new), KEYS, MEASURES)
    assert rows_of(got) == expected(second)
