"""Gated publication of a month: checks, immutable run folder, checksums, manifest last."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import SCOPES
from ..operators.predictions import require_prediction_contract
from ..operators.quality import QualityError
from ..session import cut_lineage
from ..sources.lineage import file_lineage
from ..sources.sinks import write_predictions, write_report, write_table
from .monthly import validate_base_input

_MANIFEST = (
    "feature_month string, run_id string, status string, generation int, publication string, "
    "model_package_id string, files int, bytes bigint, published_at timestamp"
)


#: Reports that must have passed before a release, and those that may have passed with warnings.
REQUIRED_PASSED = ("base_input", "inference")
MAY_WARN = ("zonal",)
_CLAIM = "feature_month string, generation int, publication string"


class ReleaseConflict(RuntimeError):
    """Another run published in between, or this run id is taken."""


def require_statuses(statuses: Mapping[str, str] | None) -> None:
    """Base input and inference passed; any other report passed, the zonal one perhaps with warnings."""
    given = {name: "absent" for name in REQUIRED_PASSED} | dict(statuses or {})
    failed = {k: v for k, v in given.items() if v != "passed" and not (k in MAY_WARN and v == "passed_with_warnings")}
    if failed:
        raise QualityError(f"reports not passed: {failed}")


def _claims(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.option("recursiveFileLookup", "true").schema(_CLAIM).json(f"{root}/claims")
    except AnalysisException:
        return None


def _latest(rows: DataFrame | None, feature_month: str) -> int:
    if rows is None:
        return 0
    return rows.where(F.col("feature_month") == feature_month).agg(F.max("generation").alias("g")).first()["g"] or 0


def claim_generation(spark: SparkSession, root: str, feature_month: str, generation: int, publication: str) -> None:
    """Write a claim in a folder of its own, then read all: whoever sees another's claim gives way.

    Of two publishers at least one reads after both have written, so both never go on. If both
    see each other, both raise and the generation stays unused.
    """
    spark.createDataFrame([(feature_month, generation, publication)], _CLAIM).write.json(f"{root}/claims/{publication}")
    same = (F.col("feature_month") == feature_month) & (F.col("generation") == generation)
    if _claims(spark, root).where(same & (F.col("publication") != publication)).limit(1).count():
        raise ReleaseConflict(f"generation {generation} of {feature_month} is claimed by another run")


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).json(f"{root}/manifest")
    except AnalysisException:
        return None


def manifest_history(spark: SparkSession, root: str) -> DataFrame:
    found = _manifests(spark, root)
    if found is None:
        raise QualityError(f"no manifest below {root}")
    return found


def read_current(spark: SparkSession, root: str, feature_month: str) -> dict:
    """The current manifest of a month: the highest generation, which must be the only one."""
    rows = (
        manifest_history(spark, root)
        .where((F.col("feature_month") == feature_month) & (F.col("status") == "current"))
        .orderBy(F.desc("generation"), "published_at", "publication")
        .limit(1)
        .collect()
    )
    if not rows:
        raise QualityError(f"no current manifest for {feature_month}")
    return rows[0].asDict(recursive=True)


def publish_month(
    spark: SparkSession,
    root: str,
    run_id: str,
    feature_month: str,
    base: DataFrame,
    scaffold: DataFrame,
    predictions: DataFrame,
    model_package_id: str,
    reports: Mapping[str, DataFrame] | None = None,
    statuses: Mapping[str, str] | None = None,
    scopes: Sequence[int] = SCOPES,
) -> dict:
    """Run every gate, copy the artefacts into ``runs/{run_id}``, then append the manifest row.

    Readers start from the manifest, so an interrupted run is never visible. A run id can be
    used once. If two runs race for one generation, at most one returns and any other raises.
    ``statuses`` must name ``base_input`` and ``inference`` as passed.
    """
    require_statuses(statuses)
    year, month = (int(p) for p in feature_month.split("-"))
    # Computed once: the gates see the very rows that are written, and scoring runs only once.
    base, predictions = cut_lineage(base), cut_lineage(predictions)
    validate_base_input(base, scaffold, year, month)
    require_prediction_contract(predictions, feature_month, base, model_package_id, scopes)

    generation = 1 + max(_latest(_manifests(spark, root), feature_month), _latest(_claims(spark, root), feature_month))
    target = f"{root}/runs/{run_id}"
    try:
        write_table(base, f"{target}/base_input")
        write_predictions(predictions, f"{target}/predictions")
        for name, report in (reports or {}).items():
            write_report(report, f"{target}/reports/{name}")
    except Exception as error:
        if "PATH_ALREADY_EXISTS" in str(error):
            raise ReleaseConflict(f"run {run_id} already has artefacts") from error
        raise
    publication = uuid.uuid4().hex
    # Checksums are a table beside the run, one row per file; the manifest only names the run.
    write_table(
        file_lineage(spark, target, "[!_.]*").select(
            F.regexp_replace("path", r"^.*/runs/", "runs/").alias("name"), "length", "sha256"
        ),
        f"{root}/checksums/{run_id}",
    )
    files = spark.read.parquet(f"{root}/checksums/{run_id}").agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.sum("length").alias("bytes")
    )
    claim_generation(spark, root, feature_month, generation, publication)
    files.select(
        F.lit(feature_month).alias("feature_month"),
        F.lit(run_id).alias("run_id"),
        F.lit("current").alias("status"),
        F.lit(generation).alias("generation"),
        F.lit(publication).alias("publication"),
        F.lit(model_package_id).alias("model_package_id"),
        "files",
        "bytes",
        F.current_timestamp().alias("published_at"),
    ).write.mode("append").json(f"{root}/manifest")
    current = read_current(spark, root, feature_month)
    if current["publication"] != publication:
        raise ReleaseConflict(f"{feature_month} was published by run {current['run_id']} in between")
    return current
