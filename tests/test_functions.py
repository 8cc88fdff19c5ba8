import math

import pytest
from pyspark.sql import functions as F

from areapanel.functions import keys as K
from areapanel.functions.coerce import coerce, dtype_family, unreadable
from areapanel.functions.geo import haversine_km
from areapanel.functions.nulls import is_blank, normalize_null_tokens


def values(spark, data, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def test_area_id_normal_form(spark):
    given = ["101.0", "007", " A ", "", None, "1e3", "-4.0", "4.5", "nan", "inf", "12d", "3f", "0x1p3", "99999999999999999999", "\t5\n"]
    want = ["101", "7", "A", "", "", "1000", "-4", "4.5", "nan", "inf", "12d", "3f", "0x1p3", "99999999999999999999", "5"]
    assert values(spark, given, K.normalize_area_id) == want


def test_area_id_of_numbers(spark):
    assert values(spark, [101.0, 4.5], K.normalize_area_id, "double") == ["101", "4.5"]


def test_parse_int_truncates_and_rejects(spark):
    assert values(spark, ["4.0", "4.9", "-4.9", "", "x", "nan", None, " 7 "], K.parse_int) == [4, 4, -4, None, None, None, None, 7]


def test_trim_key_keeps_zeros(spark):
    assert values(spark, [" 007 "], K.trim_key) == ["007"]


def test_coordinates(spark):
    assert values(spark, [1.5, -0.1], K.coordinate_text, "double") == ["1.500000000000", "-0.100000000000"]
    assert values(spark, ["1.1234567890123", "bad"], K.coordinate_rounded) == [1.123456789, None]


def test_calendar(spark):
    df = spark.createDataFrame([(2026, 4), (-1, -1), (987, 12)], "y int, m int")
    text = [r[0] for r in df.select(K.year_month_text(F.col("y"), F.col("m"))).collect()]
    assert text == ["2026-04", "", "0987-12"]
    assert values(spark, ["2026-04", "2025-12"], lambda c: K.target_period(c, 12)) == ["2027-04", "2026-12"]
    assert values(spark, ["2026-10"], lambda c: K.target_period(c, 6)) == ["2027-04"]
    assert K.parse_feature_month("202604") == K.parse_feature_month("2026-04") == (2026, 4)
    for bad in ("2026-13", "26-04", "2026-04x"):
        with pytest.raises(ValueError):
            K.parse_feature_month(bad)
    for year, month in ((1899, 1), (2101, 1), (2026, 0), (2026, 13)):
        with pytest.raises(ValueError):
            K.check_target_month(year, month)


@pytest.mark.parametrize(
    ("vocabulary", "blank"),
    [
        ("builder", ["", " "]),
        ("validator", [""]),
        ("static", ["", " ", "NA", " N/A ", "NaN", "nan", "None", "null"]),
        ("inference", ["", " ", "NA", " N/A ", "NaN", "nan", "None", "null", "NULL", "#N/A"]),
    ],
)
def test_null_vocabularies_stay_apart(spark, vocabulary, blank):
    data = ["", " ", "NA", " N/A ", "NaN", "nan", "None", "null", "NULL", "#N/A", "x", None]
    got = [d for d, b in zip(data, values(spark, data, lambda c: is_blank(c, vocabulary))) if b]
    assert got == [*blank, None]


def test_null_tokens_leave_numbers_alone(spark):
    df = normalize_null_tokens(spark.createDataFrame([(1, "#N/A", " x ")], "n int, a string, b string"))
    assert df.first() == (1, None, " x ")


def test_coercion(spark):
    given = ["1", "2.5", "yes", "F", "abc", None, "3.0"]
    assert values(spark, given, lambda c: coerce(c, "float64")) == [1.0, 2.5, None, None, None, None, 3.0]
    assert values(spark, given, lambda c: coerce(c, "Int64")) == [1, None, None, None, None, None, 3]
    assert values(spark, given, lambda c: coerce(c, "boolean")) == [True, None, True, False, None, None, None]
    assert values(spark, given, lambda c: unreadable(c, "int")) == [False, True, True, True, True, False, False]
    assert values(spark, given, lambda c: coerce(c, "category")) == given
    with pytest.raises(ValueError):
        dtype_family("date")


def test_haversine_against_math(spark):
    def reference(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        t = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(t))

    cases = [(0.0, 0.0, 0.0, 1.0), (10.0, 179.5, -5.0, -179.5), (90.0, 0.0, -90.0, 0.0), (45.0, 7.0, 45.0, 7.0)]
    df = spark.createDataFrame(cases, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert got == pytest.approx([reference(*c) for c in cases], abs=1e-6)
