"""The warehouse refresh: raw table to staging, dimensions and fact.

Every step writes a table below one new folder and reads what earlier steps wrote, so a lost
executor costs the tasks it held and a failed step can be run again. Readers see the run
when it is published as a whole, and the previous one until then.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from trialmart.operators import staging, warehouse
from trialmart.operators.keys import extend_keys, place_in_order
from trialmart.operators.quality import job_metrics, run_observed
from trialmart.operators.warehouse import FACT_PARTITION, Star
from trialmart.sources import storage

JOB = "warehouse_refresh"

Tables = dict[str, DataFrame]
Step = tuple[str, Callable[[Tables], DataFrame]]

# Table -> its key; these are written in key order with the place of every row.
STAGED_KEYS = {
    "stg_sponsors": "sponsor_id",
    "stg_locations": "location_id",
    "stg_conditions": "condition_id",
    "stg_interventions": "intervention_id",
    "trial_ids": "nct_id",
}
# Keyed table -> the staged table that holds its ids, the id, the surrogate key.
KEYED = {
    "dim_sponsor": ("stg_sponsors", "sponsor_id", "sponsor_key"),
    "dim_location": ("stg_locations", "location_id", "location_key"),
    "dim_condition": ("stg_conditions", "condition_id", "condition_key"),
    "dim_intervention": ("stg_interventions", "intervention_id", "intervention_key"),
    "fact_trials": ("trial_ids", "nct_id", "trial_key"),
}
STAGED_KEYS |= {f"new_{key}s": member for _, member, key in KEYED.values()}
STAMPS = {"created_date": ["stg_", "dim_", "fact_"], "updated_date": ["dim_", "fact_"], "etl_batch_id": ["fact_"]}

# The steps of one wave do not depend on each other.
WAVES: list[list[Step]] = [
    [
        ("stg_sponsors", lambda t: staging.stage_sponsors(t["raw_trials"])),
        ("stg_locations", lambda t: staging.stage_locations(t["raw_trials"])),
        ("stg_conditions", lambda t: staging.stage_conditions(t["raw_trials"])),
        ("stg_interventions", lambda t: staging.stage_interventions(t["raw_trials"])),
        ("trial_ids", lambda t: staging.trial_ids(t["raw_trials"])),
    ],
    [
        ("repeated_trials", lambda t: staging.repeated_trials(t["trial_ids"])),
        ("stg_trials", lambda t: staging.stage_trials(t["raw_trials"], t["trial_ids"])),
        ("dim_sponsor", lambda t: warehouse.dim_sponsor(t["stg_sponsors"])),
        ("dim_location", lambda t: warehouse.dim_location(t["stg_locations"])),
        ("dim_condition", lambda t: warehouse.dim_condition(t["stg_conditions"])),
        ("dim_intervention", lambda t: warehouse.dim_intervention(t["stg_interventions"])),
    ],
    [
        ("dim_dates", lambda t: warehouse.dim_dates(t["stg_trials"])),
        (
            "fact_trials",
            lambda t: warehouse.fact_trials(
                t["stg_trials"],
                t["trial_ids"],
                t["dim_sponsor"],
                t["dim_location"],
                t["dim_condition"],
                t["dim_intervention"],
            ),
        ),
    ],
]
STEP_NAMES = [name for wave in WAVES for name, _ in wave]


def _new_members(staged: str, member: str, key: str) -> Step:
    """The ids that the key map of the run before does not hold."""
    return f"new_{key}s", lambda t: t[staged].select(member).join(t[f"known_{key}s"], member, "left_anti")


def _key_map(member: str, key: str) -> Step:
    return f"{key}s", lambda t: extend_keys(t[f"known_{key}s"], t[f"new_{key}s"], member, key)


def _keeping_keys(step: Step) -> Step:
    """A step of WAVES with the numbers of the key maps."""
    name, build = step
    if name not in KEYED:
        return step
    staged, _, key = KEYED[name]
    if name == "fact_trials":
        dims = ["dim_sponsor", "dim_location", "dim_condition", "dim_intervention"]
        return name, lambda t: warehouse.fact_trials(t["stg_trials"], t["trial_ids"], *[t[d] for d in dims], keys=t[f"{key}s"])
    return name, lambda t: getattr(warehouse, name)(t[staged], t[f"{key}s"])


# The same with the keys of an earlier run: the map of each keyed table is extended first.
KEEPING_WAVES: list[list[Step]] = [
    WAVES[0],
    [_new_members(*of) for of in KEYED.values()],
    [_key_map(member, key) for _, member, key in KEYED.values()],
    *[[_keeping_keys(step) for step in wave] for wave in WAVES[1:]],
]


def known_keys(spark: SparkSession, run: str) -> Tables:
    """The key maps of a finished run: those it wrote, or, of a first run, the keys of its tables."""
    found = {}
    for name, (_, member, key) in KEYED.items():
        kept = f"{key}s" in storage.list_folders(spark, run)
        table = storage.read_table(spark, f"{run}/{f'{key}s' if kept else name}")
        found[f"known_{key}s"] = table.select(member, key)
    return found


def _stamped(name: str, df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Load times; the date dimension carries none."""
    if name == "dim_dates":
        return df
    stamps = {
        column: F.lit(run_ts)
        for column, prefixes in STAMPS.items()
        if any(name.startswith(p) for p in prefixes)
    }
    return df.drop(*stamps).withColumns(stamps) if stamps else df


def run_steps(
    spark: SparkSession,
    waves: list[list[Step]],
    tables: Tables,
    folder: str,
    run_ts: dt.datetime,
    records: list[Row],
) -> Tables:
    """Run the waves in order; a step gets the tables of earlier waves, and its result is
    written as a table and noted in `records`. Steps of a wave are submitted together, so that the last tasks of
    one do not leave the cluster idle."""
    done = dict(tables)

    def run(step: Step) -> tuple[str, DataFrame]:
        name, build = step
        df = _stamped(name, build(done), run_ts)
        if name in STAGED_KEYS:
            df = place_in_order(df, STAGED_KEYS[name])
        partitions = (FACT_PARTITION,) if name == "fact_trials" else ()
        if partitions:  # adaptive execution then merges small years into one file and splits large ones
            df = df.hint("rebalance", *partitions)
        path = f"{folder}/{name}"
        record = run_observed(
            JOB, name, df, lambda d: storage.write_table(d, path, if_exists="fail", partition_by=partitions)
        )
        records.append(record)
        return name, storage.read_table(spark, path, df.schema)

    for wave in waves:
        with ThreadPoolExecutor(len(wave)) as pool:
            done |= dict(pool.map(inheritable_thread_target(spark)(run), wave))
    return done


def star_of(tables: Tables) -> Star:
    return Star(
        fact=tables["fact_trials"],
        sponsor=tables["dim_sponsor"],
        location=tables["dim_location"],
        condition=tables["dim_condition"],
        intervention=tables["dim_intervention"],
        dates=tables["dim_dates"],
    )


def refresh_warehouse(
    spark: SparkSession, raw: DataFrame, root: str, run_ts: dt.datetime, keep_keys: bool = True
) -> Tables:
    """Build all tables from a raw trial table (a stored one: it is read several times) in a
    new folder below `root`, log the steps, and publish the run. The steps that a failed
    refresh has finished are logged too.

    Where a run was published before, members and trials keep the keys they had in it or in any run
    before it, and new ones follow the largest key. The maps are tables of the run, so a failed run gives out no key.
    """
    run = f"run-{run_ts:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    before = storage.published_run(spark, root) if keep_keys else None
    waves = WAVES if before is None else KEEPING_WAVES
    given = {"raw_trials": raw} | ({} if before is None else known_keys(spark, f"{root}/{before}"))
    records: list[Row] = []
    try:
        tables = run_steps(spark, waves, given, f"{root}/{run}", run_ts, records)
    finally:
        if records:
            storage.write_table(job_metrics(spark, records), f"{root}/job_runs", if_exists="append")
    storage.publish_run(spark, root, run, run_ts)
    return tables


def open_warehouse(spark: SparkSession, root: str) -> Tables:
    """The tables of the newest published run."""
    run = storage.published_run(spark, root)
    if run is None:
        raise LookupError(f"no published run below {root}")
    return {name: storage.read_table(spark, f"{root}/{run}/{name}") for name in STEP_NAMES}
