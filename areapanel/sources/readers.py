"""Readers. Ids stay text: no reader infers types, every typed column is cast by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import RASTER_NAME_PATTERNS
from ..functions.nulls import present, strip


def read_panel(spark: SparkSession, path: str, numeric: Sequence[str] = (), integer: Sequence[str] = ()) -> DataFrame:
    """CSV with a header and any columns, all as text but for the named ones.

    The reader drops a byte-order mark itself and, as nothing is inferred, reads once.
    """
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    return df.select(
        *[
            present(F.col(f"`{c}`").try_cast("double")).alias(c)
            if c in numeric
            else present(F.col(f"`{c}`").try_cast("double")).try_cast("int").alias(c)
            if c in integer
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def read_columns(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Only the named columns of a Parquet, ORC, CSV or JSON table."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).select(*[F.col(f"`{c}`") for c in columns])


def union_extracts(parts: Iterable[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Row union of extracts that share some columns."""
    frames = [p.select(*[F.col(f"`{c}`") for c in columns]) for p in parts]
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame)
    return united


# Top-level members of a feature collection.
COLLECTION_MEMBERS = ["type", "features", "name", "crs", "bbox"]


def _year_from_path() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([0-9]{4})[^/]*$", 1).try_cast("int")


def combine_yearly(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Yearly JSON documents as rows: features of a collection, or the records of a list.

    ``source_year`` is the record's own where it has one, else the year in the file name. One
    document is one JSON value, so each file is parsed in one task; files run in parallel.
    """
    raw = spark.read.option("multiLine", True).json(paths)
    named = raw.select("*", _year_from_path().alias("_year"))
    if "features" not in raw.columns:
        own = F.col("source_year").cast("int") if "source_year" in raw.columns else F.lit(None).cast("int")
        return named.withColumn("source_year", F.coalesce(own, F.col("_year"))).drop("_year")
    features = named.select(F.explode("features").alias("f"), "_year")
    records = [c for c in raw.columns if c not in COLLECTION_MEMBERS]
    # A collection's own members stay out, unless list records have fields of these names.
    members = [c for c in raw.columns if c in COLLECTION_MEMBERS and c != "features"]
    if members:
        had = raw.where("features IS NULL").agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in members]).first()
        records += [c for c in members if had[c]]
    fields = features.schema["f"].dataType.fieldNames()
    properties = features.schema["f"].dataType["properties"].dataType.fieldNames() if "properties" in fields else []
    own = F.col("f.properties.source_year").cast("int") if "source_year" in properties else F.lit(None).cast("int")
    from_features = features.select(
        *[F.col(f"f.`{c}`").alias(c) for c in fields if c != "properties"],
        *[F.col(f"f.properties.`{c}`").alias(c) for c in properties if c != "source_year"],
        F.coalesce(own, F.col("_year")).alias("source_year"),
    )
    if not records:
        return from_features
    # Lists read together with collections: their records have no features.
    given = F.col("source_year").try_cast("int") if "source_year" in records else F.lit(None).cast("int")
    from_lists = named.where("features IS NULL").select(
        *[F.col(f"`{c}`") for c in records if c != "source_year"], F.coalesce(given, F.col("_year")).alias("source_year")
    )
    return from_features.unionByName(from_lists, allowMissingColumns=True)


_ZONE_SCHEMA = """
  type string,
  features array<struct<
    type: string,
    properties: struct<area_id: string, admin_code: string>,
    geometry: struct<type: string, coordinates: string>>>,
  properties struct<area_id: string, admin_code: string>,
  geometry struct<type: string, coordinates: string>
"""


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """``area_id, rings`` from GeoJSON polygons; the id is ``area_id``, else ``admin_code``, trimmed.

    Parts and holes all become rings. Ids are gated by ``zonal.require_zone_ids``.
    """
    raw = spark.read.option("multiLine", True).schema(_ZONE_SCHEMA).json(path)
    single = F.struct(F.col("type"), F.col("properties"), F.col("geometry"))
    found = raw.select(F.explode(F.when(F.col("type") == "Feature", F.array(single)).otherwise(F.col("features"))).alias("f"))
    p, g = F.col("f.properties"), F.col("f.geometry")
    named = F.coalesce(F.when(p["area_id"] != "", p["area_id"]), p["admin_code"], F.lit(""))
    polygon = F.from_json(g["coordinates"], "array<array<array<double>>>")
    parts = F.flatten(F.from_json(g["coordinates"], "array<array<array<array<double>>>>"))
    rings = F.when(g["type"] == "Polygon", polygon).otherwise(parts)
    return found.select(
        strip(named).alias("area_id"),
        F.transform(
            rings, lambda ring: F.transform(ring, lambda v: F.struct(v[0].alias("lon"), v[1].alias("lat")))
        ).alias("rings"),
    )


def read_pixels(
    spark: SparkSession, path: str, product: str, patterns: Mapping[str, str] = RASTER_NAME_PATTERNS
) -> DataFrame:
    """Parquet pixels with year and month taken from the raster's file name; other names are skipped."""
    pattern = patterns[product]
    name = F.col("_metadata.file_path")
    return (
        spark.read.option("recursiveFileLookup", True)
        .parquet(path)
        .select("*", F.regexp_extract(name, pattern, 1).alias("_y"), F.regexp_extract(name, pattern, 2).alias("_m"))
        .where(F.col("_y") != "")
        .withColumns({"year": F.col("_y").cast("int"), "month": F.col("_m").cast("int")})
        .drop("_y", "_m")
    )
