"""Ranks and normal scores of large groups: right with ties and hot values, one shuffle of the rows, code that is compiled."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrisk.functions.normal import normal_quantile
from windrisk.operators import ranks


@pytest.fixture(scope="module")
def table():
    """A third of one group is one value, both zeros, infinities, ties, a constant group and one of a single row."""
    rng = np.random.default_rng(11)
    hot = np.concatenate([np.full(2000, 0.25), rng.normal(size=3000), [0.0, -0.0, np.inf, -np.inf, np.inf]])
    parts = {"hot": hot, "ties": np.round(rng.normal(size=3000), 1), "constant": np.ones(500), "one": np.ones(1)}
    frame = pd.concat([pd.DataFrame({"k": k, "x": v}) for k, v in parts.items()], ignore_index=True)
    return frame.assign(row=range(len(frame)))


def joins_and_windows(df):
    """Join operators of the plan, and the number of its windows."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"(\w+Join)\b", plan)), plan.count("Window [")


def test_ranks_of_large_groups_need_no_join_of_rows(spark, table):
    df = spark.createDataFrame(table).repartition(6)
    ranked = ranks.with_average_ranks(df, ["k"], "x", in_memory_rows=0)
    assert ranked.columns == ["k", "x", "row", "rank", "n"]
    joins, windows = joins_and_windows(ranked)
    got = ranked.toPandas().set_index("row").sort_index()
    want = table.groupby("k")["x"].rank()
    assert got["rank"].tolist() == want.tolist()
    assert got["n"].tolist() == table.groupby("k")["x"].transform("size").tolist()
    assert joins == {"BroadcastHashJoin"} and windows == 1


def test_frequent_values_are_not_ordered_in_one_task(spark, table):
    """Rows that share a window, by the salt in the plan's key: those of a value on a cut stay in the tasks that read them."""
    df = spark.createDataFrame(table).where("k = 'constant'").repartition(5)
    ranked = ranks.with_average_ranks(df, ["k"], "x", in_memory_rows=0)
    assert "spark_partition_id" in ranked._jdf.queryExecution().analyzed().toString().lower()
    assert {(r["rank"], r.n) for r in ranked.collect()} == {(250.5, 500)}


def test_buckets_are_found_by_halving(spark):
    rng = np.random.default_rng(3)
    for n_cuts in (1, 2, 3, 63, 64, 100):
        cuts = np.sort(np.round(rng.normal(size=n_cuts), 1)).tolist()
        values = [*np.round(rng.normal(size=200), 1).tolist(), float("inf"), float("-inf")]
        df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("cuts", F.array(*map(F.lit, cuts)))
        got = [r[0] for r in df.select(ranks._bucket(F.col("v"), n_cuts)).collect()]
        assert got == [2 * sum(c < v for c in cuts) + (v in cuts) for v in values]


def test_code_of_the_normal_quantile_is_short_enough_to_be_compiled(spark):
    df = spark.range(100).select(((F.col("id") + 0.5) / 100).alias("p")).select(normal_quantile(F.col("p")).alias("z"))
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    # The JVM interprets methods of over 8000 bytes for ever.
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", plan))) < 8000
