"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split even when that costs one more exchange later on.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

ROWS_PER_TASK = 1 << 19
"""Rows a task is dealt where their number is known beforehand."""


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the SQL options the package relies on in an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "areapanel", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Checkpoints go when the tables that read them do.
    cleaning = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    for key, value in {**RUNTIME_CONF, **cleaning, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; in local mode, if none is named, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/_stages"
    return folder.rstrip("/")


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` into partitions enough for ``rows`` rows.

    Adaptive execution sizes tasks by the compressed bytes of a shuffle. Where rows unfold after it, or
    compress well, the rows of a task, and the memory they take, would grow with the input; a stated number
    of partitions is kept.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return df.repartition(parts, *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the folder all executors share; the files go when the tables that read them do.

    Spark removes the shuffle files behind a cut once the driver has collected the plan that made
    them. A driver with little to do hardly collects, so it is asked to after each cut.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    cut = df.checkpoint(eager=True)
    context._jvm.System.gc()
    return cut
