"""What keeps the memory and the shuffles of panel queries in step with their input."""

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as driver
from areapanel.catalog.views import PANEL_SQL, panel
from areapanel.operators.joins import grouped_left_join, left_join
from areapanel.operators.zonal import merge_tiles
from areapanel.plans.scaffold import month_spine
from areapanel.session import ROWS_PER_TASK, dealt
from tools.compare import rows_of

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]


def test_rows_of_a_task_are_bounded(spark):
    df = dealt(spark.range(1000), 40 * ROWS_PER_TASK, "id")
    assert df.rdd.getNumPartitions() == 40 and df.count() == 1000
    assert dealt(spark.range(1000), 1, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_spine_is_not_taken_for_small(spark):
    areas = spark.range(1000).withColumnRenamed("id", "area_id")
    spine = month_spine(areas, (1995, 1), (2001, 8))
    assert spine._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() >= 80_000 * 16
    assert spine.count() == 80_000 and spine.distinct().count() == 80_000


def test_reference_compare_broadcasts_no_spine(spark):
    assert "BroadcastHashJoin" not in plan(driver.queries()["a20_reference_compare"](spark, "/root/testdata/sf0.01"))


@pytest.fixture
def odd_tables(spark, tmp_path):
    db = duckdb.connect()
    db.execute(f"""COPY (SELECT * FROM (VALUES (1::BIGINT, 3), (1, 4), (2, 5), (NULL, 6), (9, 7)) t(c_custkey, c_nationkey)) TO '{tmp_path}/customer.parquet'""")
    db.execute(f"""COPY (SELECT * FROM (VALUES (1::BIGINT, 10.4, TIMESTAMP '1995-01-01'), (1, 20.0, '1995-01-31'), (1, NULL, '2001-08-31'), (2, 7.0, '1994-12-31'),
        (2, 8.0, '2001-09-01'), (NULL, 5.0, '1999-01-01'), (2, 6.0, NULL), (7, 1.0, '1999-01-01')) t(o_custkey, o_totalprice, o_orderdate)) TO '{tmp_path}/orders.parquet'""")
    return db, str(tmp_path)


def test_panel_of_repeated_null_and_outlying_keys(spark, odd_tables):
    db, folder = odd_tables
    for name in ("customer", "orders"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    found = db.execute(f"WITH {PANEL_SQL} SELECT * FROM panel")
    names = [d[0] for d in found.description]
    got = panel(spark, folder)
    assert rows_of(got.columns, got.collect()) == rows_of(names, found.fetchall())
    assert rows(got.where("order_cnt > 0 AND month = 1"), "area_id", "country_id", "order_cnt", "price_sum") == [(1, 3, 2, 30), (1, 4, 2, 30)]


def test_universe_counts_keys_where_they_lie(spark):
    above, _, below = plan(driver.queries()["u2_universe"](spark, SF_DIR)).partition("Union")
    assert below and "hashpartitioning" not in above  # both sides lie dealt by area: no task combines a whole file's keys


@pytest.mark.parametrize("name", ["w6_interp", "w6_interp_hold"])
def test_series_stay_where_the_panel_unfolds(spark, name):
    above, _, below = plan(driver.queries()[name](spark, SF_DIR)).partition("BroadcastNestedLoopJoin")
    assert "Exchange" not in above and "REPARTITION_BY_NUM" in below


def test_history_chain_shuffles_no_panel(spark):
    by_month = [line for line in exchanges(driver.queries()["w3_history_chain"](spark, SF_DIR)) if "(area_id#" in line and "REPARTITION_BY_NUM" not in line]
    assert len(by_month) == 1  # the orders, reduced to one outcome a month


def test_grouped_left_join_is_a_left_join(spark):
    left = spark.createDataFrame([("a", 2020, 1, 5), ("a", 2020, 1, 5), ("a", 2020, None, 6), (None, 2020, 1, 7), ("b", 2021, 2, 8)], "g string, year int, month int, x int")
    right = spark.createDataFrame(
        [("a", 2020, 1, 50, None), ("a", 2020, 2, 51, "q"), ("a", 2020, None, 52, "r"), (None, 2020, 1, 53, "s"), ("b", 2021, 2, None, "t"), ("c", 2021, 2, 54, "u")],
        "g string, year int, month int, x int, `y.z` string",
    )
    for side in (right, right.withColumnRenamed("x", "w"), right.withColumn("month", right["month"].cast("long")), right.select("g", "year", "month", "x")):
        got, asked = grouped_left_join(left, side, ["g"], ["year", "month"]), left_join(left, side, ["g", "year", "month"])
        assert got.columns == asked.columns and rows(got) == rows(asked)


@pytest.mark.parametrize("name", ["s7_blended_tiles", "s7_tile_merge"])
def test_pixels_are_dealt_before_they_are_grouped(spark, name):
    by_place = [line for line in exchanges(driver.queries()[name](spark, SF_DIR)) if "_y#" in line]
    assert by_place and all("REPARTITION_BY_NUM" in line for line in by_place)


def test_tiles_beyond_the_broadcast(spark):
    kind = "tile string, year int, month int, band string, lat double, lon double, value double"
    cells = [(t, 2020, 1, "B1", y / 10, x / 10, v) for t, v, first in (("l", 10.0, 0), ("r", 20.0, 3), (None, 5.0, 1)) for x in range(first, first + 6) for y in range(5)]
    df = spark.createDataFrame(cells, kind)
    blended = merge_tiles(df, 0.1, tile="tile")
    assert "BroadcastHashJoin" in plan(blended) and "SortMergeJoin" not in plan(blended)
    assert rows(blended) == rows(merge_tiles(df, 0.1, tile="tile", broadcast_tiles=1)) and blended.count() == 9 * 5
