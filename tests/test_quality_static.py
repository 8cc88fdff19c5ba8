import random
import statistics

import pytest
from pyspark.sql import functions as F

from areapanel.functions.fixed import STATIC_FEATURE_COLUMNS
from areapanel.operators import aggregates as A
from areapanel.operators import gates as G
from areapanel.operators import joins as J
from areapanel.operators import quality as Q
from areapanel.operators import static as S
from conftest import rows


def test_static_builder(spark):
    columns = "seq int, admin_code string, lat string, lon string, ISO3 string, country string, country_code string, country_en string, state string, year string, month string, AEZ_4000 string, crop string"
    panel = spark.createDataFrame(
        [
            (1, "10", "1.123456789012", "31.123456789012", "AAA", "A", "AA", "A", "A1", "2026", "4", "1", "25"),
            (2, "11", "2.200000000000", "32.200000000000", "BBB", "B", "BB", "B", "B1", "2026", "4", "0", "40"),
            (3, "10", "1.123456789012", "31.123456789012", "AAA", "NA", "AA", "A", "A1", "2025", "4", "1", "26"),
            (4, "9", "9", "9", "CCC", "C", "CC", "C", "C1", "bad", "4", "", "nan"),
            (5, "", "9", "9", "CCC", "C", "CC", "C", "C1", "2026", "4", "1", "1"),
        ],
        columns,
    )
    coast = spark.createDataFrame(
        [(1, "1.1234567890123", "31.1234567890123", "-7.0"), (2, "2.2000000000004", "32.2000000000004", "1"), (3, "2.2000000000004", "32.2000000000004", "44.5"), (4, "x", "y", "5"), (5, "1.1234567890123", "31.1234567890123", "NA")],
        "seq int, lat string, lon string, coastline_dist string",
    )
    table, summary = S.build_static_features(panel, coast)
    got = table.collect()
    assert [r["area_id"] for r in got] == ["9", "10", "11"]  # numeric order
    ten = got[1]
    assert (ten["crop"], ten["country"], ten["coastline_dist"]) == ("25", "A", "-7.0")
    assert (ten["source_row_count"], ten["first_year_month"], ten["last_year_month"]) == (2, "2025-04", "2026-04")
    assert (got[2]["coastline_dist"], got[0]["crop"], got[0]["first_year_month"]) == ("44.5", None, "")
    by = {r["feature"]: r for r in summary.collect()}
    assert (by["coastline_dist"]["areas_with_value"], by["coastline_dist"]["missing_area_count"], by["coastline_dist"]["family"]) == (2, 1, "coastline_distance")
    assert (by["crop"]["max_distinct_values_per_area"], by["crop"]["varying_area_count"], by["crop"]["source_nonmissing_rows"], by["crop"]["missing_area_count"]) == (2, 1, 3, 1)
    assert by["crop"]["classification"] == "slow_or_varying_in_source_panel"
    assert by["AEZ_4000"]["classification"] == "verified_static_in_source_panel"


def test_feature_order():
    assert [f for f, _ in S.ordered_features(["slope", "AEZ_10000", "crop", "AEZ_4000", "other"])] == ["AEZ_4000", "AEZ_10000", "crop", "slope"]


def test_later_row_wins_ties_and_identifiers_ignore_dates(spark):
    df = spark.createDataFrame([(1, "x", "2026", "4", "a", "old"), (2, "x", "2026", "4", "b", "new"), (3, "x", "2020", "1", "c", "last")], "seq int, k string, year string, month string, f string, i string")
    got = S.latest_nonmissing(df, "k", ["f"], ["i"]).first()
    assert (got["f"], got["i"]) == ("b", "last")


def test_order_statistics_match_sorting(spark):
    rng = random.Random(4)
    data = [(rng.gauss(0, 1e6), float(rng.randint(0, 3)), 7.0 if i % 3 else rng.random()) for i in range(20_000)]
    df = spark.createDataFrame(data, "a double, b double, c double").withColumn("d", F.lit(None).cast("double"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = A.order_statistics(df, ["a", "b", "c", "d"], probs, most_rows=64, group=2)
    for i, c in enumerate("abc"):
        values = sorted(r[i] for r in data)
        for p, q in zip(probs, got[c]):
            at = p * (len(values) - 1)
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert q == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12, abs=1e-12)
    assert got["d"] == [None] * len(probs)
    assert A.medians(df, ["b"])["b"] == statistics.median(r[1] for r in data)


def test_order_statistics_with_infinities(spark):
    inf = float("inf")
    values = [float(i) for i in range(5_000)] + [inf] * 5_000 + [-inf] * 2 + [float("nan")] + [1e308, -1e308, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    ranked = sorted(v for v in values if v == v)
    probs = [0.0, 0.25, 0.4, 0.75, 1.0]
    want = [A._between(ranked[int(at)], ranked[min(int(at) + 1, len(ranked) - 1)], at - int(at)) for at in (p * (len(ranked) - 1) for p in probs)]
    assert A.order_statistics(df, ["a"], probs, most_rows=64)["a"] == want
    both = spark.createDataFrame([(inf,), (inf,)], "a double")
    assert A.medians(both, ["a"])["a"] == inf


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, 3.0, None)], "same int, varies double, empty double")
    assert A.drop_constant_columns(df).columns == ["varies", "empty"]
    one = A.describe(df, ["varies"]).first()
    assert (one["count"], one["null_count"], one["q50"], one["min"], one["max"]) == (2, 0, 2.5, 2.0, 3.0)


def test_reference_statuses(spark):
    schema = "area_id string, year int, month int, EVI_mean double"
    observed = spark.createDataFrame([("a", 2026, 4, 1.0), ("b", 2026, 4, 2.0)], schema)
    reference = spark.createDataFrame([("a", 2026, 4, 1.1), ("b", 2026, 4, 1.9)], schema)

    def status(o, r):
        return A.compare_with_reference(o, r, "EVI_mean").first()

    assert (status(observed, reference)["status"], status(observed, reference)["matched_observations"]) == ("advisory_difference", 2)
    assert status(observed, reference)["max_abs_diff"] == pytest.approx(0.1)
    assert status(observed, observed)["status"] == "matched"
    assert status(observed, reference.where("area_id = 'a'"))["status"] == "insufficient_pairs"
    assert status(observed, reference.withColumn("year", F.lit(1)))["status"] == "zero_matches"
    assert status(observed, reference.drop("EVI_mean"))["status"] == "malformed_reference"


def test_schema_modes(spark):
    good = spark.createDataFrame([("1", "1.5", "2", "2026", "4"), ("2", "1.5", "2", "2026", "4")], "admin_code string, lat string, lon string, year string, month string")
    metrics = G.require_schema(good, "forecast-scaffold")
    assert (metrics["rows"], metrics["duplicate_rows"], metrics["min_month_index"]) == (2, 0, 2026 * 12 + 3)
    broken = {
        "duplicate_rows": good.unionByName(good.limit(1)),
        "blank_lat": good.withColumn("lat", F.lit("")),
        "invalid_lat": good.withColumn("lat", F.lit("91")),
        "invalid_lon": good.withColumn("lon", F.lit("east")),
        "invalid_month": good.withColumn("month", F.lit("13")),
        "invalid_year": good.withColumn("year", F.lit("x")),
        "no rows": good.limit(0),
    }
    for reason, df in broken.items():
        with pytest.raises(Q.QualityError, match=reason):
            G.require_schema(df, "forecast-scaffold")
    with pytest.raises(Q.QualityError, match="missing columns"):
        G.require_schema(good, "historical-panel")
    outcomes = good.select("*", *[F.lit("1" if i else "").alias(c) for i, c in enumerate(Q.OUTCOME_COLUMNS)])
    with pytest.raises(Q.QualityError, match="present_overall_phase"):
        G.require_schema(outcomes, "historical-panel")
    static = good.select(F.col("admin_code").alias("area_id"), "*", *[F.lit("1").alias(c) for c in STATIC_FEATURE_COLUMNS])
    G.require_schema(static, "fixed-slow-area")
    with pytest.raises(Q.QualityError, match="id_mismatch"):
        G.require_schema(static.withColumn("admin_code", F.lit("7")), "fixed-slow-area")


def test_column_gates(spark):
    df = spark.createDataFrame([(1, 2)], "`2026_04` int, x int")
    assert Q.require_month_columns(df, r"^\d{4}_\d{2}$", 1) == 1
    with pytest.raises(Q.QualityError):
        Q.require_month_columns(df, r"^\d{4}_\d{2}$", 2)
    with pytest.raises(Q.QualityError):
        Q.require_columns(df, ["X"])


def test_missingness_counts_text_and_nan(spark):
    df = spark.createDataFrame([("", float("nan"), 1), ("x", 1.0, None), (" ", None, 2)], "t string, d double, i int")
    assert rows(Q.missingness(df), "column", "missing_count") == [("d", 2), ("i", 1), ("t", 2)]
    assert rows(Q.missingness(df.limit(0)), "missing_rate") == [(0.0,)] * 3
    assert [r["feature"] for r in Q.null_profile(df, top=1).collect()] == ["d"]


def test_unique_and_universe(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    with pytest.raises(Q.QualityError, match="1 duplicate rows"):
        Q.require_unique(df, ["a", "b"])
    assert tuple(Q.universe(df, df.where("a = 2"), ["a", "b"]).first()) == (1, 1, 0, 1, 0)


def test_left_join_options(spark):
    left = spark.createDataFrame([(1, "a", 5), (None, "b", 6)], "k int, v string, shared int")
    right = spark.createDataFrame([(1, 9, 7), (None, 8, 7)], "k int, w int, shared int")
    assert rows(J.left_join(left, right, ["k"], matched="hit"), "v", "shared", "w", "hit") == [("a", 5, 9, True), ("b", 6, None, False)]
    assert rows(J.left_join(left, right, ["k"], null_keys="match"), "v", "w") == [("a", 9), ("b", 8)]
    assert rows(J.match_counts(J.left_join(left, right, ["k"], matched="hit"), "hit")) == [("both", 1), ("left_only", 1)]
    with pytest.raises(Q.QualityError):
        J.left_join(left, right.unionByName(right), ["k"], validate="many_to_one")
    with pytest.raises(Q.QualityError):
        J.left_join(left.unionByName(left), right, ["k"], validate="one_to_one")


def test_country_lookup(spark):
    names = spark.createDataFrame([("Chad", "TCD"), ("Republic of Chad", "TCD"), ("td", "TCD")], "name string, country_code_3 string")
    df = spark.createDataFrame([(" chad",), ("REPUBLIC OF CHAD",), ("TD",), ("Atlantis",)], "country_name string")
    assert sorted(str(r["country_code_3"]) for r in J.lookup_country_code(df, names).collect()) == ["None", "TCD", "TCD", "TCD"]


def test_join_audit_and_zip(spark):
    zones = spark.createDataFrame([("a",), ("b",)], "area_id string")
    predicted = spark.createDataFrame([("b",), ("c",)], "area_id string")
    assert tuple(J.join_audit(zones, predicted).first()) == (2, 2, 1, 1, 1)
    left = spark.createDataFrame([(0, "x"), (1, "y")], "seq int, v string")
    right = spark.createDataFrame([(0, "p")], "seq int, w string")
    assert rows(J.zip_by_sequence(left, right), "v", "w") == [("x", "p"), ("y", None)]


def test_salted_left_join_is_the_same_join(spark):
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert rows(J.left_join(left, right, ["k"], matched="hit")) == rows(J.left_join(left, right, ["k"], matched="hit", salts=8))
