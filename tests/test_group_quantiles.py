"""Quantiles of any number of groups of any size against sorted lists."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import chartdata, quantiles, split
from millrace.operators.quantiles import Rank, group_quantiles


def plain(values, rank):
    v = sorted(values)
    if rank.smallest is not None:
        return v[min(len(v), rank.smallest) - 1]
    if not rank.interpolated:
        return v[min(len(v), max(1, math.ceil(round(rank.p * len(v), 9)))) - 1]
    return float(np.quantile(v, rank.p))


def test_many_groups_and_a_hot_one(spark):
    kind = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1000 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("g"), F.col("id") % 15_000))
    df = spark.range(60_000).select(kind.alias("g"), (F.pmod(F.col("id") * 7919, F.lit(2003)) / 8).alias("x")).repartition(5)
    ranks = [Rank(0.0), Rank(0.25), Rank(0.5), Rank(1.0), Rank(0.2, interpolated=False), Rank(0.0, smallest=3)]
    found = group_quantiles(df.groupBy("g", "x").agg(F.count("*").alias("copies")), ["g"], "x", ranks)
    got = {r["g"]: (r["n"], r["q"]) for r in found.collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r["g"], []).append(r["x"])
    assert len(got) == len(values) > quantiles.MAX_GROUPS / 2 and None in got
    for g in [None, "hot", *list(values)[:200]]:
        assert got[g] == (len(values[g]), pytest.approx([plain(values[g], r) for r in ranks]))


def test_bracket_between_two_hot_ends(spark):
    """Narrowing can't part it, so it is sorted by ranges instead of in one window."""
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 0.0).when(F.col("id") % 3 == 1, 1.0).otherwise(F.col("id") / 9_000).alias("x"))
    values = [r["x"] for r in df.collect()]
    ranks = [0.1, 0.4, 0.5, 0.7]
    got = quantiles.quantiles(df, {"x": ranks}, sortable=50, grid=4)["x"]
    assert [got[p] for p in ranks] == pytest.approx([float(np.quantile(values, p)) for p in ranks])


def test_more_strata_than_a_driver_should_list(spark):
    df = spark.range(36_000).select(F.col("id").alias("obs_id"), (F.col("id") % 12_000).alias("s"))
    flagged = split.stratified_flag(df, "obs_id", "s", share=0.3)
    assert flagged.columns == ["obs_id", "s", "is_test"]
    counts = flagged.groupBy("s").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n"))
    assert counts.where("t <> 1 or n <> 3").count() == 0


def test_box_figures_of_groups_with_one_value_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 100.0), ("a", 3.0), ("b", 5.0), (None, 7.0), ("c", None)], "k string, x double")
    got = {(r["grouping"], r["series"]): tuple(r)[2:] for r in chartdata.box_figures(df, "x", [None, "k"]).collect()}
    assert got["k", "b"] == (5.0, 5.0, 5.0, 5.0, 5.0, 0, 1) and got["k", None][-1] == 1 and ("k", "c") not in got
    assert got["k", "a"] == (1.75, 2.5, 27.25, 1.0, 3.0, 1, 4) and got["column", "all"][-2:] == (1, 6)
