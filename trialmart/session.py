"""Session settings this package is tuned for. All of them can be set by the cluster instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plans here are built from many small column calls; recording the call site of each costs
    # more driver time than analysing the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM does not compile methods above 8000 bytes of bytecode, and whole-stage code for
    # the wide cleaning projections is larger. Beyond this limit Spark generates split code
    # per operator instead, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def split_long_code(df: DataFrame) -> DataFrame:
    """The frame, after its session was told to split code that the JVM would not compile; a limit of the
    session's own stays. Wide projections call this, since a cluster's session may not have SETTINGS."""
    conf, key = df.sparkSession.conf, "spark.sql.codegen.hugeMethodLimit"
    if conf.get(key, None) is None:
        conf.set(key, SETTINGS[key])
    return df


def local_session(cores: int | str, memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("trialmart")
    local = {
        "spark.sql.shuffle.partitions": str(cores),
        # Test data is tiny in bytes but not in work per row: small splits, and one task per core.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "1m",
        "spark.sql.files.openCostInBytes": "64k",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**SETTINGS, **local, **settings}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
