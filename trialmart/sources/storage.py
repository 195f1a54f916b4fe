"""Tables on shared storage: read, write, inspect, publish."""

from __future__ import annotations

import datetime as dt
import json
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trialmart.schemas import FLAT
from trialmart.sources.study_pages import summary_counts, summary_of, validate_trials

# Load modes and the Spark save mode of each.
LOAD_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


# The log of published runs.
PUBLISHED = "folder string, published_at timestamp"


def shared_folder(spark: SparkSession) -> str:
    """Folder for tables that cut lineage: the one named in spark.checkpoint.dir.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="trialmart-"))
    return context.getCheckpointDir()


def new_run_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def write_table(
    df: DataFrame, path: str, if_exists: str = "replace", partition_by: tuple[str, ...] = ()
) -> None:
    """Write a parquet table; `if_exists` is 'replace', 'append' or 'fail'."""
    df.write.mode(LOAD_MODES[if_exists]).partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a parquet table; a known schema saves the job that reads file footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe against lost executors,
    and of a size the planner can see."""
    path = new_run_folder(df.sparkSession, label)
    write_table(df, path)
    return read_table(df.sparkSession, path, df.schema)


def run_query(
    spark: SparkSession,
    query: str,
    tables: dict[str, DataFrame] | None = None,
    params: dict[str, object] | None = None,
) -> DataFrame:
    """Run SQL with named parameters (`:name`) over the given tables, written as `{name}`.

    No view of the session is set or replaced.
    """
    return spark.sql(query, args=params, **(tables or {}))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_info(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column, in order, with the row count of the table on each."""
    columns = [
        (i, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO")
        for i, f in enumerate(df.schema.fields)
    ]
    listed = spark.createDataFrame(
        columns, "ordinal_position int, column_name string, data_type string, is_nullable string"
    )
    return listed.withColumn("row_count", F.lit(df.count()).cast("bigint"))


def save_trials_json(trials: DataFrame, path: str) -> None:
    """Write trials as JSON lines, packed: their text is several times the table it stands for."""
    trials.write.mode("overwrite").json(path, compression="gzip")


def read_saved_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FLAT).json(path)


def write_extraction(
    flat: DataFrame,
    path: str,
    criteria: dict[str, object],
    run_ts: dt.datetime,
) -> None:
    """Save an extraction: the valid of the flat trials as JSON lines, and one envelope row beside
    them. Trials are read once: the summary's counts are observed while they are written."""
    seen = Observation()
    save_trials_json(validate_trials(flat.observe(seen, *summary_counts(flat))), f"{path}/trials")
    summary = summary_of(flat.sparkSession.createDataFrame([Row(**seen.get)]))
    envelope = summary.select(
        F.struct(
            F.lit(run_ts.isoformat()).alias("extraction_date"),
            F.col("valid_trials").alias("total_trials"),
            F.parse_json(F.lit(json.dumps(criteria))).alias("search_criteria"),
        ).alias("metadata"),
        F.struct(*summary.columns).alias("validation_summary"),
    )
    envelope.write.mode("overwrite").json(f"{path}/envelope")


def read_extraction(spark: SparkSession, path: str) -> DataFrame:
    """The envelope row of a saved extraction; search criteria stay a variant."""
    kinds = (
        "metadata struct<extraction_date: string, total_trials: bigint, search_criteria: variant>, "
        "validation_summary struct<total_processed: bigint, valid_trials: bigint, invalid_trials: bigint, "
        "unreadable: bigint, validation_rate: double>"
    )
    return spark.read.schema(kinds).json(f"{path}/envelope")


def publish_run(spark: SparkSession, root: str, folder: str, run_ts: dt.datetime) -> None:
    """Make a finished run the one readers see. Runs are only ever added, so a reader
    finds either the previous complete run or this one."""
    entry = spark.createDataFrame([Row(folder=folder, published_at=run_ts)])
    entry.coalesce(1).write.mode("append").json(f"{root}/published")


def published_run(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest published run, or None."""
    try:
        log = spark.read.schema(PUBLISHED).json(f"{root}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.agg(F.max_by("folder", F.struct("published_at", "folder"))).first()[0]


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system; False if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def list_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below `root`."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(path) if f.isDirectory()) if files.exists(path) else []


def remove_old_runs(spark: SparkSession, root: str, keep: int, is_run: str = "run-") -> list[str]:
    """Delete the folders of all published runs but the newest `keep` (one at least), and those
    of runs that were never published and whose name sorts before that of the newest published one: they
    failed. Returns the names of the folders that went; log entries stay.

    Names of runs begin with `is_run` and the time they started, so a run that is still being built, which started
    after the newest published one, is left alone.
    """
    log = spark.read.schema(PUBLISHED).json(f"{root}/published")
    runs = [r[0] for r in log.orderBy(F.desc("published_at"), F.desc("folder")).select("folder").collect()]
    newest = list(dict.fromkeys(runs))
    failed = [f for f in list_folders(spark, root) if f.startswith(is_run) and f not in runs and newest and f < newest[0]]
    return [f for f in newest[max(1, keep) :] + failed if remove_folder(spark, f"{root}/{f}")]
