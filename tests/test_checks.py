"""All rules of a table in one scan."""
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from wharf.operators import checks as chk

SF = "/root/testdata/sf0.001"


def failing(spark, df, *rules):
    return {(r["rule"], r["column"]): r["failing_rows"] for r in chk.run_checks(spark, df, list(rules)).collect()}


def test_every_rule_kind(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (1, "a", -0.0), (2, None, 1.5), (None, None, None), (3, "", 1.5), (3, None, 9.0)],
                               "k int, s string, d double")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "p long")
    got = failing(spark, df, chk.NotNull(["k", "s"]), chk.Unique(["k"]), chk.Unique(["k", "s"]), chk.Unique(["d"]),
                  chk.AcceptedValues("s", ["a"]), chk.Expect("positive", F.col("d") > 0), chk.Relationship("k", parent, "p"))
    assert got == {("not_null", "k"): 1, ("not_null", "s"): 3, ("unique", "k"): 2, ("unique", "k,s"): 1, ("unique", "d"): 2,
                   ("accepted_values", "s"): 1, ("expect", "positive"): 3, ("relationships", "k"): 2}


def test_keys_of_several_columns_do_not_run_together(spark):
    df = spark.createDataFrame([("a,b", "c"), ("a", "b,c"), (None, "x"), ("", "x"), ("null", "x")], "a string, b string")
    assert failing(spark, df, chk.Unique(["a", "b"])) == {("unique", "a,b"): 0}


def test_empty_tables_and_no_rules(spark):
    df = spark.createDataFrame([], "k int")
    assert failing(spark, df, chk.Unique(["k"]), chk.NotNull(["k"]), chk.Relationship("k", df)) == {
        ("unique", "k"): 0, ("not_null", "k"): 0, ("relationships", "k"): 0}
    assert chk.run_checks(spark, df, []).count() == 0
    assert failing(spark, spark.createDataFrame([(1,), (1,)], "k int"), chk.Relationship("k", df)) == {("relationships", "k"): 2}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_one_scan_of_the_table(spark):
    for name, table in (("checks_orders", "orders"), ("checks_lineitem", "lineitem")):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"{table}.parquet") == 1, name
