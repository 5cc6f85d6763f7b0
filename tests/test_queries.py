"""Registered queries: results against SQL, and the shape of their plans."""

import os

import pytest
from checks.compare import Oracle, differences
from checks.file_queries import QUERIES as FILE_QUERIES
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES as TABLE_QUERIES

import __spark_entry__ as driver

QUERIES = {**TABLE_QUERIES, **FILE_QUERIES}
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")


@pytest.fixture(scope="module")
def oracle():
    return Oracle(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, oracle, name):
    frame = QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in (
        "EvalPython", "InPandas", "InArrow",  # no Python in the tasks
        "CartesianProduct", "BroadcastNestedLoopJoin",  # equi joins only
        "Window", "Exchange SinglePartition, REPARTITION",
    ):
        assert node not in plan
    assert differences(frame.toPandas(), oracle.run(ORACLE_SQL[name])) == ""


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scans_read_the_columns_used(spark):
    plan = plan_of(QUERIES["mean_price_daily"](spark, SF))
    assert "l_quantity" not in plan and "l_orderkey" not in plan and "s_acctbal" not in plan


def test_a_plant_table_reads_one_year(spark):
    plan = plan_of(QUERIES["plant_table"](spark, SF))
    assert "= 1998" in plan and "= 1999" not in plan


def test_horizons_need_no_shuffle(spark):
    from gridtally.operators.calendar import stamp_horizons
    from gridtally.operators.windows import pad_year, rolling_horizons

    series = spark.range(100).selectExpr("id + 1 AS t", "id AS v")
    assert "Exchange" not in plan_of(rolling_horizons(pad_year(series, 100, 10, 120)))
    model = spark.range(100).selectExpr("'r11' AS horizon", "cast(id AS int) AS period")
    assert "Exchange" not in plan_of(stamp_horizons(model, 2021))


def test_aggregations_combine_before_the_shuffle(spark):
    """Every hash exchange of the balance carries partial sums or comes from one."""
    plan = plan_of(QUERIES["region_balance_annual"](spark, SF))
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(side" in line:
            assert "partial_" in lines[i + 1]


def test_results_survive_a_hot_key(spark, tmp_path):
    """A third of all line items move to one supplier, one order and one part."""
    from pyspark.sql import functions as F

    from checks.compare import TABLES
    from checks.views import table

    for name in TABLES:
        source, target = f"{SF}/{name}.parquet", f"{tmp_path}/{name}.parquet"
        if name == "lineitem":
            hot = F.col("l_linenumber") <= 2
            first = {
                c: F.when(hot, F.lit(0)).otherwise(F.col(c)).cast("long")
                for c in ("l_suppkey", "l_orderkey", "l_partkey")
            }
            skewed = table(spark, SF, name).withColumns(first)
            skewed.coalesce(1).write.parquet(f"{tmp_path}/parts")
            target_file = next((tmp_path / "parts").glob("*.parquet"))
            os.symlink(target_file, target)
        else:
            os.symlink(source, target)
    skewed_oracle = Oracle(str(tmp_path))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for name in ("generation_daily", "load_weighted_price_daily", "storage_net_output"):
            found = QUERIES[name](spark, str(tmp_path)).toPandas()
            assert differences(found, skewed_oracle.run(ORACLE_SQL[name])) == "", name
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
