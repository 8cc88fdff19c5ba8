import hashlib
import json

import pytest
from pyspark.sql import functions as F

from areapanel.operators.quality import QualityError
from areapanel.operators.scoring import decode, enrich
from areapanel.functions.fixed import TARGETS
from areapanel.plans import publish as publish_plan
from areapanel.plans.publish import ReleaseConflict, manifest_history, publish_month, read_current
from areapanel.sources import lineage, readers, sinks
from conftest import rows


def test_csv_ids_stay_text_and_mark_is_dropped(spark, tmp_path):
    path = tmp_path / "panel.csv"
    path.write_bytes("﻿area_id,year,lat,note\n007,2026.0,1.5,x\n101.0,2026,,\"a,b\"\n".encode())
    df = readers.read_panel(spark, str(path), numeric=["lat"], integer=["year"])
    assert rows(df) == [("007", 2026, 1.5, "x"), ("101.0", 2026, None, "a,b")]


def test_column_pruned_read(spark, tmp_path):
    spark.range(3).select("id", F.lit(1).alias("a"), F.lit(2).alias("b")).write.parquet(str(tmp_path / "t"))
    df = readers.read_columns(spark, str(tmp_path / "t"), ["b"])
    assert "ReadSchema: struct<b:int>" in df._jdf.queryExecution().executedPlan().toString()


def test_yearly_json(spark, tmp_path):
    for year, features in (
        (2020, [{"type": "Feature", "properties": {"name": "a"}, "geometry": None}]),
        (2021, [{"type": "Feature", "properties": {"name": "b", "source_year": 1999}, "geometry": None}]),
    ):
        (tmp_path / f"areas_{year}.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
        (tmp_path / f"list_{year}.json").write_text(json.dumps([{"k": year}, {"k": year + 1, "source_year": 5}]))
    areas = readers.combine_yearly(spark, [str(tmp_path / "areas_2020.json"), str(tmp_path / "areas_2021.json")])
    assert rows(areas, "name", "source_year") == [("a", 2020), ("b", 1999)]
    records = readers.combine_yearly(spark, [str(tmp_path / "list_2020.json"), str(tmp_path / "list_2021.json")])
    assert rows(records, "k", "source_year") == [(2020, 2020), (2021, 5), (2021, 2021), (2022, 5)]
    (tmp_path / "mixed_2019.json").write_text(json.dumps([{"type": "t", "name": "n", "bbox": "b", "k": 1}]))
    mixed = readers.combine_yearly(spark, [str(tmp_path / "areas_2020.json"), str(tmp_path / "mixed_2019.json")])
    assert rows(mixed.where("k = 1"), "type", "name", "bbox", "source_year") == [("t", "n", "b", 2019)]
    assert rows(mixed, "name", "source_year") == [("a", 2020), ("n", 2019)] and "crs" not in mixed.columns


def test_pixels_named_by_month(spark, tmp_path):
    pixels = spark.createDataFrame([(1.0, 2.0, 3.0)], "lon double, lat double, value double")
    for name in ("MOD13A3_2026_04", "MOD13A3_2026_05", "other"):
        pixels.write.parquet(str(tmp_path / "evi" / name))
    assert rows(readers.read_pixels(spark, str(tmp_path / "evi"), "greenness"), "year", "month", "value") == [(2026, 4, 3.0), (2026, 5, 3.0)]
    pixels.write.parquet(str(tmp_path / "gpp" / "GOSIF_GPP_2020.M07"))
    assert rows(readers.read_pixels(spark, str(tmp_path / "gpp"), "productivity"), "year", "month") == [(2020, 7)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 2026, 4, 1.0), ("b", 2026, 5, 2.0)], "area_id string, year int, month int, v double")
    sinks.write_table(df, str(tmp_path / "csv"), ["v", "area_id"], "csv")
    assert rows(readers.read_panel(spark, str(tmp_path / "csv"))) == [("1.0", "a"), ("2.0", "b")]
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sinks.write_table(df, str(tmp_path / "csv"), fmt="csv")
    sinks.write_table(df, str(tmp_path / "csv"), fmt="csv", overwrite=True)
    sinks.write_table(df, str(tmp_path / "panel"), partition_by=["year", "month"], sort_by=["area_id"])
    assert sorted(p.name for p in (tmp_path / "panel" / "year=2026").iterdir()) == ["month=4", "month=5"]
    pruned = spark.read.parquet(str(tmp_path / "panel")).where("year = 2026 and month = 4")
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()
    sinks.write_report(df.select(F.lit(2).alias("b"), F.lit(1).alias("a")).limit(1), str(tmp_path / "report"))
    assert next((tmp_path / "report").glob("*.json")).read_text().strip() == '{"a":1,"b":2}'


def test_lineage(spark, tmp_path):
    (tmp_path / "one.csv").write_text("h\n1\n2\n")
    (tmp_path / "two.csv").write_text("h\n1\n")
    found = lineage.file_lineage(spark, str(tmp_path), "*.csv")
    want = hashlib.sha256(b"h\n1\n2\n").hexdigest()
    assert found.where("name = 'one.csv'").select("length", "sha256").first() == (6, want)
    counts = {r["path"].rsplit("/", 1)[1]: r["data_rows"] for r in lineage.csv_row_counts(spark, str(tmp_path / "*.csv")).collect()}
    assert counts == {"one.csv": 2, "two.csv": 1}
    expected = spark.createDataFrame([("one.csv",), ("three.csv",)], "name string")
    assert rows(lineage.missing_files(expected, found)) == [("three.csv",)]
    (tmp_path / "a b+c%.csv").write_text("x\n1\n2\n")
    (tmp_path / "none.csv").write_text("x\n")
    (tmp_path / "note.txt").write_text("free text")
    files = lineage.file_lineage(spark, str(tmp_path), checksum=False)
    both = lineage.lineage_with_rows(files, lineage.row_counts(spark.read.option("header", True).csv(str(tmp_path / "*.csv"))))
    rows_by_name = {r["name"]: r["data_rows"] for r in both.collect()}
    assert rows_by_name["a b+c%.csv"] == 2
    assert rows_by_name["none.csv"] == 0 and rows_by_name["note.txt"] is None and both.count() == files.count()


@pytest.fixture(scope="module")
def release(spark):
    base = spark.createDataFrame([("1", "1", 2026, 4, 0), ("2", "2", 2026, 4, 1)], "area_id string, admin_code string, year int, month int, _row_id bigint")
    scores = base.select("*", *[F.lit(0.1).alias(f"{t}_score") for t in TARGETS])
    parts = [enrich(decode(scores, {"default": 0.5}), "2026-04", s, "model", "base") for s in (0, 6, 12)]
    return base, parts[0].unionByName(parts[1]).unionByName(parts[2])


PASSED = {"base_input": "passed", "inference": "passed"}


def test_two_publishers_never_both_return(spark, release, tmp_path, monkeypatch):
    base, predictions = release
    root = str(tmp_path / "release")

    def publish(run):
        return publish_month(spark, root, run, "2026-04", base, base, predictions, "model", statuses=PASSED)

    def rival(*args):
        monkeypatch.setattr(publish_plan, "file_lineage", lineage.file_lineage)
        won.append(publish("rival"))
        return lineage.file_lineage(*args)

    won: list[dict] = []
    monkeypatch.setattr(publish_plan, "file_lineage", rival)
    with pytest.raises(ReleaseConflict, match="claimed"):
        publish("late")
    assert [w["run_id"] for w in won] == ["rival"] == [read_current(spark, root, "2026-04")["run_id"]]
    assert publish("next")["generation"] == 2


def test_publish(spark, release, tmp_path):
    base, predictions = release
    root = str(tmp_path / "release")
    report = base.select(F.lit("passed").alias("status")).limit(1)

    def publish(run, **changes):
        given = {"base": base, "predictions": predictions, "statuses": PASSED | {"zonal": "passed_with_warnings"}} | changes
        return publish_month(spark, root, run, "2026-04", scaffold=base, model_package_id="model", reports={"qa": report}, **given)

    with pytest.raises(QualityError):
        read_current(spark, root, "2026-04")
    first = publish("run-1")
    assert (first["run_id"], first["generation"], read_current(spark, root, "2026-04")["run_id"]) == ("run-1", 1, "run-1")
    assert first["files"] == spark.read.parquet(f"{root}/checksums/run-1").count() > 3
    with pytest.raises(ReleaseConflict):
        publish("run-1")
    for broken in (
        {"statuses": PASSED | {"zonal": "failed"}},
        {"statuses": PASSED | {"inference": "passed_with_warnings"}},
        {"statuses": {"inference": "passed"}},
        {"statuses": None},
        {"base": base.where("area_id = '1'")},
        {"predictions": predictions.withColumn("overall_phase_pred", F.lit(7))},
    ):
        with pytest.raises(QualityError):
            publish("run-2", **broken)
    assert not (tmp_path / "release" / "runs" / "run-2").exists()
    assert publish("run-2")["generation"] == 2
    assert read_current(spark, root, "2026-04")["run_id"] == "run-2"
    assert manifest_history(spark, root).count() == 2
    stored = spark.read.parquet(f"{root}/runs/run-1/predictions").where("scope_months = 6")
    assert stored.count() == 2
